"""Column expressions for the text rules of the digest.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python runs per row.

Regular expressions are written in the subset shared by Java's ``Pattern`` and
RE2, so the DuckDB oracle can use the very same patterns.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

# Whitespace as Python's ``str.split()`` / ``str.strip()`` see it.
WS = r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
# Characters removed by the title normaliser: anything that is neither a word
# character (letter, number, underscore) nor whitespace.
NON_WORD = r"[^\p{L}\p{N}_\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
# Line boundaries as Python's ``str.splitlines()`` sees them.
LINE_BREAK = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\x{2028}\x{2029}]"
# The same set as characters, built from the rule Python's strip() uses (str.isspace), for
# the native trim functions.
WS_CHARS = "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(col) -> Column:
    """Python ``str.strip()`` (native trim over the whitespace set)."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def rstrip_ws(col) -> Column:
    return F.rtrim(_c(col), F.lit(WS_CHARS))


def lstrip_ws(col) -> Column:
    return F.ltrim(_c(col), F.lit(WS_CHARS))


def normalize_title(title) -> Column:
    """lower-case, drop non-word characters, collapse whitespace runs, trim."""
    cleaned = F.regexp_replace(F.lower(_c(title)), NON_WORD, "")
    return F.trim(F.regexp_replace(cleaned, rf"{WS}+", " "))


def article_slug(run_date, link, title) -> Column:
    """``YYYY-MM-DD-`` + first 10 hex digits of sha1(link, or title when link is empty)."""
    key = F.coalesce(F.nullif(_c(link), F.lit("")), _c(title), F.lit(""))
    return F.concat(F.date_format(_c(run_date), "yyyy-MM-dd"), F.lit("-"),
                    F.substring(F.sha1(F.encode(key, "UTF-8")), 1, 10))


def cjk_count(text) -> Column:
    return F.regexp_count(F.coalesce(_c(text), F.lit("")), F.lit(C.CJK_CLASS))


def latin_word_count(text) -> Column:
    return F.regexp_count(F.coalesce(_c(text), F.lit("")), F.lit(C.LATIN_WORD))


def reading_minutes(text) -> Column:
    """0 for empty text, else max(1, round-half-even(cjk/350 + words/220))."""
    t = _c(text)
    minutes = cjk_count(t) / F.lit(float(C.CJK_PER_MINUTE)) + latin_word_count(t) / F.lit(float(C.LATIN_WORDS_PER_MINUTE))
    return (F.when(F.coalesce(F.length(t), F.lit(0)) == 0, F.lit(0))
            .otherwise(F.greatest(F.lit(1), F.bround(minutes, 0).cast("int"))))


def line_cost(text) -> Column:
    """Screen lines of a paragraph: max(1, cjk/32 + words/12)."""
    t = _c(text)
    return F.greatest(F.lit(1.0), cjk_count(t) / F.lit(float(C.CJK_PER_LINE))
                      + latin_word_count(t) / F.lit(float(C.LATIN_WORDS_PER_LINE)))


def paragraph_cost(text) -> Column:
    """Lines charged to a paragraph when paginating (line cost + spacing)."""
    return line_cost(text) + F.lit(C.PARAGRAPH_SPACING)


def split_paragraphs(text) -> Column:
    """array<string>: lines of the text, each stripped, blank ones dropped, in order."""
    parts = F.split(F.coalesce(_c(text), F.lit("")), LINE_BREAK, -1)
    return F.filter(F.transform(parts, strip_ws), lambda p: F.length(p) > 0)


def clip_source(text, limit) -> Column:
    """Head (65 % of the budget, right-trimmed) + marker + tail (rest, left-trimmed)."""
    t, lim = _c(text), _c(limit)
    head = F.floor(lim.cast("double") * F.lit(C.CLIP_HEAD_SHARE)).cast("int")
    tail = lim - head
    clipped = F.concat(rstrip_ws(F.substring(t, F.lit(1), head)), F.lit(C.CLIP_MARKER),
                       lstrip_ws(F.when(tail > 0, F.right(t, tail)).otherwise(F.lit(""))))
    return F.when((lim <= 0) | (F.length(t) <= lim), t).otherwise(clipped)


def source_budget(long_form, settings: C.Settings) -> Column:
    return F.when(_c(long_form), F.lit(settings.longform_source_chars)).otherwise(F.lit(settings.summary_source_chars))


def is_long_form(category, markers: Iterable[str]) -> Column:
    c = F.lower(F.coalesce(_c(category), F.lit("")))
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(c, F.lower(F.lit(str(m))))
    return out


# Page titles of the published products, (Chinese, English)
TITLES = {
    "digest": ("每日 AI 文摘", "Daily AI Digest"),
    "quiz": ("昨日回顧小考", "Daily Recall Quiz"),
    "weekly": ("本週主題回顧", "This Week in Themes"),
    "deep": ("每日深讀", "Deep Read of the Day"),
    "archive": ("文摘存檔", "Digest Archive"),
}


def digest_title(kind: str, language, day=None) -> Column:
    zh, en = TITLES[kind]
    label = F.when(F.startswith(_c(language), F.lit("zh")), F.lit(zh)).otherwise(F.lit(en))
    if day is None:
        return label
    return F.concat(label, F.lit(" "), F.date_format(_c(day), "yyyy-MM-dd"))


def date_parse(s) -> Column:
    """ISO date (month/day may be unpadded) or NULL."""
    return F.try_to_date(_c(s), "yyyy-M-d")


def interest_score(title, summary, keywords: Iterable[str]) -> Column:
    """How many keywords occur (case-insensitively) in ``title + ' ' + summary``."""
    hay = F.lower(F.concat_ws(" ", F.coalesce(_c(title), F.lit("")), F.coalesce(_c(summary), F.lit(""))))
    score = F.lit(0)
    for k in keywords:
        score = score + F.contains(hay, F.lower(F.lit(str(k)))).cast("int")
    return score


def lead_sentence(text) -> Column:
    """First sentence of the text (through the first . ! or ?); first line when there is none."""
    t = F.coalesce(_c(text), F.lit(""))
    s = F.regexp_extract(t, r"^[ \t\n\r]*([^.!?]*[.!?])", 1)
    return strip_ws(F.when(F.length(s) > 0, s).otherwise(F.split_part(t, F.lit("\n"), F.lit(1))))
