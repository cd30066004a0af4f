"""Article body extraction from crawled HTML, as native column expressions.

This is our own rule, not a general boilerplate remover: take the first
``<article>`` (else ``<body>``), delete script/style/navigation blocks and
comments, turn block tags into line breaks, drop remaining tags, decode a fixed
set of entities and keep the non-blank stripped lines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, strip_ws

ARTICLE = r"(?is)<article\b[^>]*>(.*?)</article\s*>"
BODY = r"(?is)<body\b[^>]*>(.*?)</body\s*>"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
DROP_BLOCKS = ("script", "style", "nav", "footer", "aside", "header", "form", "noscript")
COMMENT = r"(?s)<!--.*?-->"
BLOCK_TAG = r"(?i)</?(?:br|p|div|h[1-6]|li|tr|blockquote|pre|section|article|ul|ol|table)\b[^>]*>"
ANY_TAG = r"<[^>]*>"
# Entity -> text, applied in this order, "&amp;" last
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"), ("&ndash;", "–"),
    ("&hellip;", "…"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&amp;", "&"),
)


def unescape(col) -> Column:
    out = _c(col)
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def strip_markup(fragment) -> Column:
    out = F.regexp_replace(_c(fragment), COMMENT, "")
    for tag in DROP_BLOCKS:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    out = F.regexp_replace(out, BLOCK_TAG, "\n")
    out = unescape(F.regexp_replace(out, ANY_TAG, ""))
    lines = F.filter(F.transform(F.split(out, "\n", -1), strip_ws), lambda x: F.length(x) > 0)
    return F.array_join(lines, "\n")


def page_body(html) -> Column:
    h = F.coalesce(_c(html), F.lit(""))
    art = F.regexp_extract(h, ARTICLE, 1)
    frag = F.when(F.length(art) > 0, art).otherwise(F.regexp_extract(h, BODY, 1))
    return strip_markup(frag)


def page_title(html) -> Column:
    return strip_ws(unescape(F.regexp_extract(F.coalesce(_c(html), F.lit("")), TITLE, 1)))
