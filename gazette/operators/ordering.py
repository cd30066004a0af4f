"""Ranking helpers that survive a hot group.

``row_number().over(partitionBy(g))`` sorts each group inside one task; when
one group holds a third of the rows that task holds a third of the data.
``ranked`` instead range-partitions on (group, order) -- the sampler splits a
hot group over many partitions -- numbers rows inside each partition, and adds
per-partition offsets (one small row per partition, broadcast).  The group's
first global index is a partial aggregate; joining it back is a join against
one row per group, which AQE's skew handling splits on the big side.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rn",
           partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row inside its ``by`` group under ``order``.

    ``order`` must be a total order inside the group (end with a unique key), so
    that a recomputed partition numbers its rows the same way.
    """
    n = partitions or _partitions(df)
    keys = [F.col(c).asc() for c in by] + list(order)
    # the range sampler and the shuffle both read the input: land it once (callers pass
    # narrow key projections, so this write is small)
    df = df.checkpoint(eager=True)
    s = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)).drop("_mid")
    # monotonically_increasing_id is not stable across recomputation: pin it.
    s = s.checkpoint(eager=True)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    # one row per partition: bounded by the partition count
    s = s.join(F.broadcast(offsets), "_pid").withColumn("_g", F.col("_off") + F.col("_local"))
    if not by:
        return s.withColumn(name, (F.col("_g") + 1).cast("long")).drop("_pid", "_local", "_off", "_g")
    starts = s.groupBy(*by).agg(F.min("_g").alias("_g0"))
    out = s.join(starts, list(by)).withColumn(name, (F.col("_g") - F.col("_g0") + 1).cast("int"))
    return out.drop("_pid", "_local", "_off", "_g", "_g0")


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, name: str = "rn") -> DataFrame:
    """Rows with position <= n inside their group; plans as a partial + final WindowGroupLimit."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
