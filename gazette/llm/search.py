"""Helpers of the vector searches: clean vectors, and blocks of an index that visitors stream past.

A search deals the index rows to units of at most about ``UNIT_ROWS`` rows and sends each query (a visitor) to the units that it has to see.
``visit`` brings both together: a task holds one unit at a time and reads its visitors in Arrow batches behind it, so its memory is
bounded whatever the number of visitors is, and no pair of rows is ever shuffled.
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT_ROWS = 4096


def usable(vec: Column) -> Column:
    """Neither null nor empty, and every component finite."""
    ok = vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(ok, F.lit(False))


def dealt(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` with ``unit``: its group, or for a group above ``UNIT_ROWS`` rows one of its parts; and the group's ``parts``.

    The table of large groups has at most (rows / UNIT_ROWS) entries; the groups are cells of an index of bounded size, so it is small.
    """
    large = (rows.groupBy(group).count().where(F.col("count") > UNIT_ROWS)
             .select(group, F.ceil(F.col("count") / UNIT_ROWS).cast("int").alias("parts")))
    with_parts = rows.join(F.broadcast(large), group, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return with_parts.withColumn("unit", F.struct(group, F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int").alias("part")))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of vectors of one length as a matrix."""
    data = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return data.flatten().to_numpy(zero_copy_only=False).reshape(len(data), -1)


def visit(index: DataFrame, visitors: DataFrame, meet: Callable, schema: str) -> DataFrame:
    """``meet(unit rows, a batch of visitors)`` for every unit and its visitors.

    ``index`` and ``visitors`` have the same columns, among them ``unit``; ``meet`` gets Arrow tables and yields record batches of
    ``schema``.  Units without visitors and visitors of no unit meet nothing.
    """
    spark = index.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = (index.withColumn("side", F.lit(0)).unionByName(visitors.withColumn("side", F.lit(1)))
            .withColumn("unit_key", F.xxhash64("unit")))
    cols = ["unit_key", "side", *[c for c in both.columns if c not in ("unit_key", "side", "unit")]]
    both = both.select(*cols).repartition(parts, "unit_key").sortWithinPartitions("unit_key", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, met = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, side = (batch.column(k).to_numpy() for k in (0, 1))
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (side[1:] != side[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                some = batch.slice(lo, hi - lo)
                if keys[lo] != key:
                    key, held, met = keys[lo], [], None
                if side[lo] == 0:
                    held.append(some)
                elif held:
                    if met is None:
                        met = pa.Table.from_batches(held)
                    yield from meet(met, some)
    return both.mapInArrow(run, schema)
