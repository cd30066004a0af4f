"""Cutting article bodies into screen-sized pages, and the page manifest.

The greedy rule (start a page when the current one is non-empty and the next
paragraph would overflow it; never split a paragraph) is a left fold, so it runs
as ``aggregate`` over the article's paragraph costs inside its own row: no
shuffle, and floating additions happen in the same order as the reference.  The fold returns page starts;
pages are slices between them, so the work per paragraph does not grow with the article.
Neighbour links are arithmetic on the page number, so no window is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T


BLOCK = 128                                      # page starts in a block of the fold


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def page_starts(paragraphs, lines: int, enabled: bool = True) -> Column:
    """array<int>: 1-based number of each page's first paragraph; empty without paragraphs.

    The fold keeps page starts only, in blocks of ``BLOCK``: a page break copies one short block, not all starts so far.
    """
    paras = _c(paragraphs)
    if not enabled or lines <= 0:
        return F.when(F.size(paras) > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    costs = F.transform(paras, T.paragraph_cost)
    none = F.array().cast("array<int>")
    init = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("used"), none.alias("block"), F.array().cast("array<array<int>>").alias("blocks"))

    def step(st, c):
        n = st["n"] + 1
        brk = (n == 1) | (st["used"] + c > F.lit(float(lines)))
        full = F.size(st["block"]) >= BLOCK
        return F.struct(n.alias("n"), F.when(brk, F.lit(0.0) + c).otherwise(st["used"] + c).alias("used"),
                        F.when(~brk, st["block"]).when(full, F.array(n)).otherwise(F.array_append(st["block"], n)).alias("block"),
                        F.when(brk & full, F.array_append(st["blocks"], st["block"])).otherwise(st["blocks"]).alias("blocks"))

    return F.aggregate(costs, init, step, lambda st: F.flatten(F.array_append(st["blocks"], st["block"])))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row; a separate projection could be merged into the lambdas that use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def page_structs(text, lines: int, enabled: bool = True) -> Column:
    """array<struct<page_no, page_total, page_paragraphs>>: the text's pages, each a slice of its paragraphs; one empty page without paragraphs."""
    empty = F.array(F.struct(F.lit(1).alias("page_no"), F.lit(1).alias("page_total"), F.array().cast("array<string>").alias("page_paragraphs")))

    def cut(paras, starts):
        def page(start, k):
            end = F.coalesce(F.get(starts, k + 1), F.size(paras) + 1)
            return F.struct((k + 1).alias("page_no"), F.size(starts).alias("page_total"), F.slice(paras, start, end - start).alias("page_paragraphs"))
        return F.when(F.size(starts) > 0, F.transform(starts, page)).otherwise(empty)
    return _let(T.split_paragraphs(text), lambda paras: _let(page_starts(paras, lines, enabled), lambda starts: cut(paras, starts)))


def paginate(articles: DataFrame, text: str, lines: int, enabled: bool = True) -> DataFrame:
    """Add ``pages`` (array<struct<page_no, page_total, page_paragraphs>>)."""
    return articles.withColumn("pages", page_structs(text, lines, enabled))


def paragraph_pages(pages: str = "pages") -> Column:
    """array<int>: page number of each paragraph."""
    return F.flatten(F.transform(pages, lambda p: F.array_repeat(p["page_no"], F.size(p["page_paragraphs"]))))


def pages(paginated: DataFrame) -> DataFrame:
    """One row per article page with the page's paragraphs."""
    return paginated.select(*[c for c in paginated.columns if c != "pages"], F.inline("pages"))


def base_name(slug, page_no) -> Column:
    """``{slug}.html`` for page 1, ``{slug}-p{n}.html`` after it."""
    n = _c(page_no)
    return F.when(n == 1, F.concat(_c(slug), F.lit(".html"))).otherwise(
        F.concat(_c(slug), F.lit("-p"), n.cast("string"), F.lit(".html")))


def with_font(name, suffix) -> Column:
    """Insert the font suffix before ``.html``."""
    nm = _c(name)
    return F.when(_c(suffix) == "", nm).otherwise(
        F.concat(F.substring(nm, F.lit(1), F.length(nm) - 5), _c(suffix), F.lit(".html")))


def font_cross(df: DataFrame) -> DataFrame:
    """Every row once per font variant (a generator over the fixed font list, not a join)."""
    fonts = F.array(*[F.struct(F.lit(n).alias("font"), F.lit(s).alias("suffix")) for n, s in C.FONTS])
    return df.withColumn("_f", F.explode(fonts)).select("*", "_f.font", "_f.suffix").drop("_f")


def page_manifest(articles: DataFrame, settings: C.Settings, text: str = "text") -> DataFrame:
    """Article x page x font with file names, neighbours, minutes on page 1 and Q&A on the last page."""
    p = pages(paginate(articles, text, settings.article_page_lines, settings.paginate_articles))
    p = font_cross(p)
    n, total = F.col("page_no"), F.col("page_total")
    return (p.withColumn("file_name", with_font(base_name("slug", n), "suffix"))
             .withColumn("prev_file", F.when(n > 1, with_font(base_name("slug", n - 1), "suffix")))
             .withColumn("next_file", F.when(n < total, with_font(base_name("slug", n + 1), "suffix")))
             .withColumn("minutes_shown", F.when(n == 1, F.col("read_minutes")))
             .withColumn("show_qa", n == total))
