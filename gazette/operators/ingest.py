"""Entry selection: per-feed limit, body-or-fallback, no-text filter, seen-state anti join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from .ordering import top_n


def feed_top_n(entries: DataFrame, n: int) -> DataFrame:
    """First ``n`` entries of each feed and run, before any other filter."""
    if n < 0:
        raise ValueError("a negative feed limit is rejected")
    return top_n(entries, ["run_date", "feed_ord"], [F.col("entry_pos").asc()], n, "feed_rank").drop("feed_rank")


def body_or_fallback(df: DataFrame, body: str = "full_text", fallback: str = "summary") -> DataFrame:
    """``text`` = body when it has at least 400 characters, else the fallback; flag ``has_full_text``."""
    b = F.coalesce(F.col(body), F.lit(""))
    full = F.length(b) >= C.MIN_FULLTEXT_CHARS
    return (df.withColumn("has_full_text", full)
              .withColumn("text", F.when(full, b).otherwise(F.coalesce(F.col(fallback), F.lit("")))))


def drop_no_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(F.length(F.col(text)) > 0)


def seen_anti(entries: DataFrame, seen: DataFrame) -> DataFrame:
    """Entries whose link is not in the seen state ("" is an ordinary link)."""
    keys = seen.select(F.coalesce(F.col("link"), F.lit("")).alias("_link")).distinct()
    return (entries.withColumn("_link", F.coalesce(F.col("link"), F.lit("")))
            .join(keys, "_link", "left_anti").drop("_link"))


def feed_lookup(entries: DataFrame, feeds: DataFrame) -> DataFrame:
    """Attach feed name and category; the feed list is configuration, bounded by the number of feeds."""
    f = feeds.select("feed_ord", F.col("name").alias("source"), F.col("category").alias("feed_category"))
    return entries.join(F.broadcast(f), "feed_ord", "left")


def with_text_fields(df: DataFrame, settings: C.Settings) -> DataFrame:
    """The article fields that need no title: summary stand-in, minutes, long-form flag."""
    return (df.withColumn("summary_text", T.lead_sentence("text"))
              .withColumn("read_minutes", T.reading_minutes("text"))
              .withColumn("long_form", T.is_long_form("category", settings.long_form_categories)))


def with_article_fields(df: DataFrame, settings: C.Settings) -> DataFrame:
    """Per-article columns of the digest: summary stand-in, minutes, long-form flag, score, slug."""
    return with_scores(with_text_fields(df, settings), settings)


def with_scores(df: DataFrame, settings: C.Settings) -> DataFrame:
    """The article fields that need the title: score, deep score, slug."""
    return (df.withColumn("interest", T.interest_score("title", "summary_text", settings.interests))
              .withColumn("deep_score", F.col("read_minutes") + 3 * F.col("interest")
                          + F.when(F.col("long_form"), 5).otherwise(0))
              .withColumn("slug", T.article_slug("run_date", "link", "title")))


def seen_anti_by_day(entries: DataFrame, seen: DataFrame, hold_days: int) -> DataFrame:
    """Each run's entries whose link was not accepted in the ``hold_days`` days before the run:
    an equi-join on link with a day-range condition (state holds one row per link and day)."""
    s = seen.select(F.col("link").alias("_link"), F.col("first_seen").alias("_seen"))
    cond = ((F.col("link") == F.col("_link")) & (F.col("_seen") < F.col("run_date"))
            & (F.col("_seen") >= F.date_sub(F.col("run_date"), hold_days)))
    return entries.join(s, cond, "left_anti")
