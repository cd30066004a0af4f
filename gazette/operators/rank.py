"""Grouping by category, in-category ranking, deep-read choice, day totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import ranked


def category_groups(articles: DataFrame) -> DataFrame:
    """One row per (run, category): order of first appearance (feed order, then entry order), size."""
    g = (articles.groupBy("run_date", "category")
         .agg(F.min(F.struct("feed_ord", "entry_pos")).alias("_first"), F.count(F.lit(1)).alias("n_articles")))
    # categories per run are few: a window over the aggregated table is cheap
    w = Window.partitionBy("run_date").orderBy(F.col("_first.feed_ord"), F.col("_first.entry_pos"))
    return g.select("run_date", "category", F.col("_first.feed_ord").alias("first_feed_ord"),
                    F.dense_rank().over(w).alias("cat_ord"), "n_articles")


def rank_in_category(articles: DataFrame, score: str = "interest") -> DataFrame:
    """Stable sort by score descending inside each (run, category); ties keep feed, entry order."""
    return ranked(articles, ["run_date", "category"],
                  [F.col(score).desc(), F.col("feed_ord").asc(), F.col("entry_pos").asc()], "cat_rank")


def with_positions(articles: DataFrame) -> DataFrame:
    """Add ``cat_ord``, ``cat_rank`` and the day position ``pos`` (category order, then rank).

    Ranking runs on a narrow key projection (the skew-safe ranker shuffles, samples and
    lands its input); the positions are joined back to the wide article rows once."""
    keys = articles.select("run_date", "category", "feed_ord", "entry_pos", "interest")
    r = rank_in_category(keys)
    cats = category_groups(r)
    w = Window.partitionBy("run_date").orderBy("cat_ord").rowsBetween(Window.unboundedPreceding, -1)
    offs = cats.select("run_date", "category", "cat_ord",
                       F.coalesce(F.sum("n_articles").over(w), F.lit(0)).alias("_off"))
    pos = (r.join(offs, ["run_date", "category"])
            .select("run_date", "feed_ord", "entry_pos", "cat_ord", "cat_rank",
                    (F.col("_off") + F.col("cat_rank")).cast("long").alias("pos")))
    return articles.join(pos, ["run_date", "feed_ord", "entry_pos"])


def deep_read_pick(positioned: DataFrame) -> DataFrame:
    """Per run, the highest deep score among full-text articles (all when none has full text);
    the first in day order wins ties.  A max over narrow keys (partial aggregation, no sort per day); the article's other
    columns, its text among them, join the winners."""
    order = F.struct(F.col("has_full_text"), F.col("deep_score"), (-F.col("pos")).alias("neg_pos"))
    best = positioned.groupBy("run_date").agg(F.max(order).alias("_best"))
    winners = best.select("run_date", (-F.col("_best.neg_pos")).alias("pos"))        # a position is unique in its run
    return positioned.join(winners, ["run_date", "pos"]).select(*positioned.columns)


def digest_totals(articles: DataFrame) -> DataFrame:
    """Articles, minutes and full-text share by day and source, with subtotals (rollup)."""
    return (articles.rollup("run_date", "feed")
            .agg(F.count(F.lit(1)).alias("n_articles"),
                 F.sum("read_minutes").cast("long").alias("minutes"),
                 F.avg(F.col("has_full_text").cast("double")).alias("full_text_share"),
                 F.grouping_id().alias("level")))


def day_flatten(positioned: DataFrame) -> DataFrame:
    """The day's snapshot rows in (category, rank) order: the ``recent`` state table."""
    return positioned.select(F.col("run_date").alias("day"), "pos", "title",
                             F.col("summary_text").alias("summary"), F.col("feed").alias("source"))


def category_concat(articles: DataFrame) -> DataFrame:
    """Articles of one category appended feed by feed: position before scoring."""
    return ranked(articles, ["run_date", "category"], [F.col("feed_ord").asc(), F.col("entry_pos").asc()],
                  "concat_pos")
