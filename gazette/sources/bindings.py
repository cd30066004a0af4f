"""Bindings from the provided test tables to the digest's input tables.

The reference reads RSS feeds, web pages and model replies over the network.
Here they are derived from the landed tables with Spark, so every downstream
operator's work grows with those tables:

* ``entries``  <- ``documents`` (60 documents a run, so run days grow with the table; feed = ``source``;
  title = the ``<title>`` of page ``doc_id div 4`` of ``pages``)
* ``feeds``    <- distinct ``documents.source``
* ``bodies``   <- ``pages`` (article body extraction)
* ``sightings``<- ``events`` (link = user_id/event_type, one row per link and day)
* ``qa_pairs`` / ``replies`` <- ``conversations``
* ``dated_files`` <- ``orders`` (file names carrying ``o_orderdate``)
* ``short_titles`` <- distinct ``part.p_name``
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import html as H
from .tables import table

# Fixed values of the test binding
FIRST_RUN_DATE = "2024-01-01"
DOCS_PER_BLOCK, RUNS_PER_BLOCK = 300, 5          # a block's documents are dealt to its runs in turn
DOCS_PER_PAGE = 4                                # page that gives a document its title
LANG_CATEGORY = (("en", "World"), ("fr", "Science"), ("de", "Long Reads"))
OTHER_CATEGORY = "Tech"
FEED_CATEGORIES = ("Tech", "World", "Science", "Long Reads", None)   # by feed_ord % 5


def _category(lang: Column) -> Column:
    out = F.lit(OTHER_CATEGORY)
    for code, cat in reversed(LANG_CATEGORY):
        out = F.when(lang == code, F.lit(cat)).otherwise(out)
    return out


def entries(spark: SparkSession, sf_dir: str, early: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``early`` adds columns (from ``full_text``, ``summary``, ``category``) before titles join, so that a reader
    of those columns alone joins, sorts and shuffles no text."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("full_text"), "lang", "source")
    k = (F.when((F.col("doc_id") % 11 == 0) & (F.col("doc_id") >= 200), F.col("doc_id") - 200)
         .when((F.col("doc_id") % 7 == 0) & (F.col("doc_id") >= 140), F.col("doc_id") - 140)
         .otherwise(F.col("doc_id")))
    p = table(spark, sf_dir, "pages").select("page_id", H.page_title("html").alias("page_title"))
    rest = F.when(F.instr("full_text", "\n") > 0, F.trim(F.expr(r"substring(full_text, instr(full_text, '\n') + 1)"))).otherwise(F.lit(""))
    summary, category, more = F.when(F.col("full_text").isNotNull(), rest), _category(F.col("lang")), []
    if early is not None:
        d = d.withColumn("summary", summary).withColumn("category", category)
        known = d.columns
        d, summary, category = early(d), F.col("summary"), F.col("category")
        more = [c for c in d.columns if c not in known]
    d = d.join(p, F.expr(f"doc_id div {DOCS_PER_PAGE}") == F.col("page_id"), "left")
    run = F.expr(f"doc_id div {DOCS_PER_BLOCK}") * RUNS_PER_BLOCK + F.col("doc_id") % RUNS_PER_BLOCK
    return d.select(
        F.date_add(F.lit(FIRST_RUN_DATE).cast("date"), run.cast("int")).alias("run_date"),
        F.regexp_extract("source", r"[0-9]+", 0).cast("int").alias("feed_ord"),
        F.col("source").alias("feed"),
        F.col("doc_id").alias("entry_pos"),
        F.coalesce("page_title", F.lit("")).alias("title"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), k.cast("string")).alias("link"),
        summary.alias("summary"),
        "full_text",
        "lang",
        category.alias("category"),
        *more,
    )


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "documents").select("source").distinct()
    ord_ = F.regexp_extract("source", r"[0-9]+", 0).cast("int")
    raw = F.lit(None).cast("string")
    for i, cat in enumerate(FEED_CATEGORIES):
        if cat is not None:
            raw = F.when(ord_ % len(FEED_CATEGORIES) == i, F.lit(cat)).otherwise(raw)
    return src.select(
        ord_.alias("feed_ord"),
        F.col("source").alias("name"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/rss")).alias("url"),
        F.coalesce(raw, F.lit(C.DEFAULT_CATEGORY)).alias("category"),
    )


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", H.page_body("html").alias("body"), H.page_title("html").alias("fallback"))


def link_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages by the link they were fetched from: link .../k has page ``k div 4``."""
    links = entries(spark, sf_dir).select("link").distinct()
    page = F.expr(f"cast(regexp_extract(link, '[0-9]+$', 0) as bigint) div {DOCS_PER_PAGE}")
    return links.join(bodies(spark, sf_dir).select("page_id", "body"), page == F.col("page_id")).select("link", "body")


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    return e.select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("link"),
                    F.to_date("ts").alias("day")).distinct()


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn directly followed by an assistant turn (equi-join on turn + 1: no window per conversation)."""
    c = table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                      F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"], "inner")


def json_str(col: Column) -> Column:
    """A JSON string literal for a text column."""
    s = F.coalesce(col, F.lit(""))
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), s, F.lit('"'))


def _json_list(arr: Column, render) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(arr, render), ", "), F.lit("]"))


def _noised(j: Column, key: Column, before: str, after: str) -> Column:
    """A reply as is, fenced, wrapped in prose, truncated, or followed by more text in brackets."""
    return (F.when(key % 4 == 1, F.concat(F.lit("```json\n"), j, F.lit("\n```")))
            .when(key % 4 == 2, F.concat(F.lit(before), j, F.lit(after)))
            .when(key % 4 == 3, F.substring(j, F.lit(1), (F.length(j) / 2).cast("int")))
            .when(key % 16 == 4, F.concat(j, F.lit(" see {b}")))
            .when(key % 16 == 8, F.concat(j, j))
            .otherwise(j))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic model reply per conversation, built from its question/answer pairs.

    The reply carries the keys of every product (summary, qa, quiz, brief, deep read,
    weekly) and is noised by ``conv_id``: as is, fenced, wrapped in prose, truncated, or followed by more brackets.
    Some replies miss ``summary`` or use a wrong answer key, some items are blank.
    """
    w = Window.partitionBy("conv_id").orderBy("turn")
    numbered = qa_pairs(spark, sf_dir).withColumn("pair_no", F.row_number().over(w))
    g = numbered.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pair_no", "question", "answer"))).alias("p"))
    cid = F.col("conv_id")
    ans_key = F.when(cid % 7 == 6, F.lit("reply")).otherwise(F.lit("answer"))
    p0 = F.col("p")[0]

    def qa_item(x):
        return F.concat(F.lit('{"question": '), json_str(x["question"]), F.lit(', "'), ans_key, F.lit('": '),
                        json_str(x["answer"]), F.lit("}"))

    def quiz_item(x):
        q = F.when(x["pair_no"] == 2, F.lit(" ")).otherwise(x["question"])
        return F.concat(F.lit('{"question": '), json_str(q), F.lit(', "answer": '), json_str(x["answer"]), F.lit("}"))

    def gloss_item(x):
        d = F.when(x["pair_no"] == 3, F.lit("")).otherwise(
            F.concat(F.lit(', "definition": '), json_str(F.split_part(x["answer"], F.lit("\n"), F.lit(1)))))
        return F.concat(F.lit('{"term": '), json_str(F.split_part(x["question"], F.lit(" "), F.lit(1))), d, F.lit("}"))

    def theme_item(x):
        t = F.when(x["pair_no"] == 2, F.lit("")).otherwise(F.split_part(x["question"], F.lit(" "), F.lit(1)))
        return F.concat(F.lit('{"title": '), json_str(t), F.lit(', "body": '), json_str(x["answer"]), F.lit("}"))

    members = F.concat_ws(
        ", ",
        F.when(cid % 10 == 2, F.lit('"summary": null')).when(cid % 5 != 4, F.concat(F.lit('"summary": '), json_str(p0["question"]))),
        F.when(cid % 3 == 0, F.concat(F.lit('"summary_secondary": '),
                                      json_str(F.split_part(p0["answer"], F.lit("\n"), F.lit(1))))),
        F.concat(F.lit('"qa": '), _json_list(F.col("p"), qa_item)),
        F.concat(F.lit('"quiz": '), _json_list(F.col("p"), quiz_item)),
        F.concat(F.lit('"brief": '), json_str(p0["answer"])),
        F.concat(F.lit('"background": '), json_str(p0["answer"])),
        F.concat(F.lit('"points": '), _json_list(F.col("p"), lambda x: json_str(x["question"]))),
        F.concat(F.lit('"implications": '), json_str(F.element_at("p", -1)["answer"])),
        F.concat(F.lit('"glossary": '), _json_list(F.col("p"), gloss_item)),
        F.concat(F.lit('"intro": '), json_str(p0["question"])),
        F.concat(F.lit('"themes": '), _json_list(F.col("p"), theme_item)),
    )
    g = g.withColumn("j", F.concat(F.lit("{"), members, F.lit("}")))
    j = F.col("j")
    noised = _noised(j, cid, "Here is the JSON you asked for:\n", "\nHope this helps.")
    # Model replies are a landed table (the reply stage persists before use); landing the
    # synthetic ones too keeps the reply text a leaf for the many parse expressions above it.
    return g.select("conv_id", noised.alias("reply")).checkpoint(eager=True)


def event_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.props`` as model replies, noised by ``event_id``."""
    e = table(spark, sf_dir, "events").select("event_id", "props")
    j, eid = F.col("props"), F.col("event_id")
    noised = _noised(j, eid, "Sure, here it is: ", " -- done")
    return e.select("event_id", noised.alias("reply"))


# Fixed values of the dated-file binding
FILE_RUN_DATE = "1998-08-02"


def dated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published file names derived from ``orders``: archive pages, font variants, article pages, strays."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey")
    slug = F.concat(d, F.lit("-"), F.substring(F.sha1(F.encode(key.cast("string"), "UTF-8")), 1, 10))
    name = (F.when(key % 13 == 0, F.concat(F.lit("draft-"), d, F.lit(".html")))
            .when(key % 4 == 0, F.concat(d, F.lit(".html")))
            .when(key % 4 == 1, F.concat(d, F.lit("-sans.html")))
            .when(key % 4 == 2, F.concat(slug, F.lit(".html")))
            .otherwise(F.concat(slug, F.lit("-p2-sans.html"))))
    kind = F.when((key % 4 <= 1) | (key % 13 == 0), F.lit("archive")).otherwise(F.lit("article"))
    return o.select("o_orderkey", kind.alias("kind"), name.alias("file_name"))


def short_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("title")).distinct()
