"""The daily run as one lazy DataFrame chain.

entries -> per-feed limit -> body or fallback -> no-text filter -> article fields
-> category order and in-category rank -> day position -> deep-read choice.

Link and title de-duplication (``operators.dedup``) slot in between the limit and
the article fields; ``daily_articles`` runs them, ``candidate_articles`` does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators import ingest, rank
from ..sources import bindings


def candidate_articles(entries: DataFrame, settings: C.Settings, limit: bool = True) -> DataFrame:
    """Limited, text-bearing entries with all per-article fields (no de-duplication).
    ``limit=False`` skips the per-feed limit, for timing the per-article operators on whole tables."""
    top = ingest.feed_top_n(entries, settings.max_articles_per_feed) if limit else entries
    return ingest.with_article_fields(ingest.drop_no_text(ingest.body_or_fallback(top)), settings)


def positioned(articles: DataFrame) -> DataFrame:
    return rank.with_positions(articles)


def deep_reads(spark: SparkSession, sf_dir: str, settings: C.Settings = C.TEST_SETTINGS) -> DataFrame:
    """Flagship: which article should each day's reader read in depth?"""
    arts = positioned(candidate_articles(bindings.entries(spark, sf_dir), settings))
    pick = rank.deep_read_pick(arts)
    return pick.select(
        "run_date", "slug", "title", "feed", "category",
        F.col("read_minutes").cast("long").alias("read_minutes"),
        F.col("interest").cast("long").alias("interest"),
        "long_form", "has_full_text",
        F.col("deep_score").cast("long").alias("deep_score"),
        F.col("pos").cast("long").alias("pos"),
    )


def recent_rows(spark: SparkSession, sf_dir: str, settings: C.Settings = C.TEST_SETTINGS,
                limit: bool = False) -> DataFrame:
    """The ``recent`` state: each day's snapshots (title, summary, source) at their day position."""
    arts = positioned(candidate_articles(bindings.entries(spark, sf_dir), settings, limit))
    return rank.day_flatten(arts)


def daily_digest(spark: SparkSession, sf_dir: str, settings: C.Settings = C.TEST_SETTINGS) -> DataFrame:
    """Backfill of daily runs with every rule of the reference: per-feed limit, seen state
    carried across days (retention applied at the end of each run), link and similar-title
    first-come de-duplication, no-text skip; then ranking and positions.

    One greedy over all runs on narrow keys: an entry is blocked by an accepted earlier one that has its link and
    lies in the state of its run, or has a similar title in its run.  What is taken from the text is taken as it is read, so
    text passes a join or sort only for a caller that selects it.
    """
    from ..functions import text as T
    from ..operators import dedup as D

    def early(d: DataFrame) -> DataFrame:
        return ingest.with_text_fields(ingest.body_or_fallback(d), settings).withColumn("_has_text", F.length("text") > 0)

    e = bindings.entries(spark, sf_dir, early)
    top = ingest.feed_top_n(e, settings.max_articles_per_feed)
    keys = top.where("_has_text").select(
        F.col("run_date").alias("run"), F.struct("feed_ord", "entry_pos").alias("o"), F.coalesce("link", F.lit("")).alias("link"),
        F.coalesce(T.normalize_title("title"), F.lit("")).alias("t")).checkpoint(eager=True)
    # one row per run day: bounded by the calendar
    days = e.select(F.col("run_date").alias("run")).distinct()
    prev = F.lag("run").over(Window.orderBy("run"))
    keep = settings.seen_retention_days
    since = F.date_sub(prev, keep) if keep and keep > 0 else F.lit(None).cast("date")
    holds = days.select("run", since.alias("since"))
    edges = D.similar_titles(keys, "run", "t")
    taken = (D.greedy_rounds(keys, edges, holds).where("accepted")
             .select(F.col("run").alias("run_date"), "o.feed_ord", "o.entry_pos"))
    articles = top.drop("_has_text").join(taken, ["run_date", "feed_ord", "entry_pos"])
    return positioned(ingest.with_scores(articles, settings))
