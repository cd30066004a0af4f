"""Publishing: the digest as day-partitioned tables instead of static pages.

* ``publish_day``: the day's digest rows under their day, replacing only that day.
* ``front_page``: the newest published day.
* ``publish_rolling``: one row per rolling product (quiz, deep read, weekly);
  quiz and deep read are replaced every run with articles, even when empty; the
  weekly roundup only when a new one exists, so the newest non-null one is kept.
* ``publish_articles``: the page manifest, partitioned by day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def by_partition(df: DataFrame, *parts: str) -> DataFrame:
    """The rows dealt by the columns that a write partitions by: a partition is one file, not one of every task, so files
    grow with the partitions alone.  The number of tasks is given, as days are many and small: adaptive coalescing would
    leave all files to a few tasks.  A task streams a day's rows to its file and gathers none."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *parts)


def _dynamic_overwrite(df: DataFrame, path: str, part: str) -> None:
    (by_partition(df, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).parquet(path))


def publish_day(digest_rows: DataFrame, path: str, day: str = "day") -> None:
    """Idempotent: rerunning a day rewrites exactly that day's partition."""
    if digest_rows.isEmpty():        # quiet run: published days stay as they are
        return
    _dynamic_overwrite(digest_rows, path, day)


def front_page(spark: SparkSession, path: str, day: str = "day") -> DataFrame:
    t = spark.read.parquet(path)
    return t.where(F.col(day) == t.select(F.max(day)).scalar())


def rolling_products(history: DataFrame) -> DataFrame:
    """``history(day, product, payload)``, payload NULL when a run produced nothing.
    quiz / deep: the latest run's payload (even NULL = empty page); weekly: the newest
    non-null payload.  One row per product (max_by: partial aggregation, no sort)."""
    latest = history.groupBy("product").agg(F.max_by("payload", "day").alias("latest"),
                                            F.max_by("payload", F.when(F.col("payload").isNotNull(), F.col("day")))
                                            .alias("latest_nonnull"), F.max("day").alias("as_of"))
    return latest.select("product", "as_of",
                         F.when(F.col("product") == "weekly", F.col("latest_nonnull"))
                         .otherwise(F.col("latest")).alias("payload"))


def publish_rolling(history: DataFrame, path: str) -> DataFrame:
    out = rolling_products(history)
    out.write.mode("overwrite").parquet(path)
    return out


def publish_articles(manifest: DataFrame, path: str) -> None:
    m = manifest.withColumn("day", F.to_date(F.substring("slug", 1, 10)))
    _dynamic_overwrite(m, path, "day")
