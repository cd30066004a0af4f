"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.session import ensure_checkpoint_dir

# text hashes are broadcast up to this many (8 bytes each)
BROADCAST_HASHES = 500_000
# beyond, a bit table of fixed size stands for them: parts by the lower bits of a hash, bits of a part (as a power of two), bits set by a hash
BIT_PARTS, PART_BITS, MARKS = 64, 21, 4
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def land(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; later reads do not recompute it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII values take the byte-wise ``lower``."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it.

    A separate projection would not do: the optimizer may merge projections and so move an
    expensive value into the lambdas that use it.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not use yet (names clash case-insensitively)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Part and, per mark, bit of each hash."""
    u = h.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u ^= u >> np.uint64(32)
    marks = (np.arange(MARKS, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1)
    return h.astype(np.int64) & (BIT_PARTS - 1), ((u[:, None] * marks) >> np.uint64(64 - PART_BITS)).astype(np.int64)


def bit_table(hashes: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A test of arrays that holds for every one of ``hashes`` (one long column) and for few other values, while there are not far more of
    them than bits."""
    step = 1 << PART_BITS - 3

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            part, at = _places(batch.column(0).to_numpy(zero_copy_only=False))
            for k in np.unique(part).tolist():
                own = at[part == k].ravel()
                np.bitwise_or.at(bits.setdefault(k, np.zeros(step, np.uint8)), own >> 3, (1 << (own & 7)).astype(np.uint8))
        if bits:
            yield pa.RecordBatch.from_pydict({"part": pa.array(list(bits), pa.int32()), "bits": pa.array([b.tobytes() for b in bits.values()], pa.binary())})

    name = hashes.columns[0]
    dealt = hashes.repartition(BIT_PARTS, F.col(name).bitwiseAND(F.lit(BIT_PARTS - 1)))                  # a part lies in one task
    table_ = np.zeros((BIT_PARTS, step), np.uint8)
    for r in dealt.mapInArrow(mark, "part int, bits binary").collect():                                 # BIT_PARTS rows of a fixed size
        table_[r["part"]] = np.frombuffer(r["bits"], np.uint8)

    def test(h: np.ndarray) -> np.ndarray:
        part, at = _places(h)
        return (table_[part[:, None], at >> 3] >> (at & 7).astype(np.uint8) & 1).all(1)
    return test


def perhaps_in(hashes: DataFrame) -> Callable[[Column], Column]:
    """``bit_table`` as a test of a column."""
    within = bit_table(hashes)

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        return pd.Series(within(h.to_numpy()))
    return test


def known_in(hashes: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A test of arrays that holds for every one of ``hashes`` (landed, distinct, one long column), and perhaps for few other values."""
    if hashes.count() > BROADCAST_HASHES:
        return bit_table(hashes)
    some = np.sort(np.array([r[0] for r in hashes.collect()], np.int64))

    def test(h: np.ndarray) -> np.ndarray:
        return some[np.minimum(np.searchsorted(some, h), len(some) - 1)] == h if len(some) else np.zeros(len(h), bool)
    return test


def parted(rows: DataFrame, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have one of ``hashes`` (landed, distinct, one long column that both have; all that have one are among them), and the
    other rows; no row is shuffled."""
    name = hashes.columns[0]
    if hashes.count() <= BROADCAST_HASHES:
        side = F.broadcast(hashes)
        return rows.join(side, name, "left_semi"), rows.join(side, name, "left_anti")
    test = perhaps_in(hashes)
    return rows.where(test(F.col(name))), rows.where(~test(F.col(name)))


def keep_rows(docs: DataFrame, decided: DataFrame, text_hash: Column) -> DataFrame:
    """Rows of ``docs`` with a kept row in ``decided`` (doc_id, hash, kept: of every row of ``docs``), with all their columns.

    Rows meet by doc_id (nulls included) and text hash; where several rows agree in both, one stays.  Only rows that go or have such
    copies, and few others, are shuffled.
    """
    d, h, n, k, x = fresh(docs, "x_doc", "x_hash", "x_n", "x_kept", "x_both")
    special = land(decided.groupBy(F.col("doc_id").alias(d), F.col("hash").alias("r_hash"))
                   .agg(F.max("kept").alias(k), F.count(F.lit(1)).alias(n)).where(~F.col(k) | (F.col(n) > 1)))
    rows = docs.withColumn(h, text_hash).withColumn(x, F.xxhash64("doc_id", h))
    some, others = parted(rows, land(special.select(F.xxhash64(d, "r_hash").alias(x)).distinct()))
    met = some.alias("l").join(special.withColumnRenamed("r_hash", h).alias("r"),
                               F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(f"l.{h}") == F.col(f"r.{h}")), "left").select("l.*", n, k)
    once = met.where(F.col(n).isNull())
    again = met.where(F.col(k)).dropDuplicates(["doc_id", h])
    return others.select(*docs.columns).unionByName(once.select(*docs.columns)).unionByName(again.select(*docs.columns))


def rows_with(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """``rows`` that have one of ``hashes`` (landed, distinct, one long column that both have); few others are shuffled."""
    some, _ = parted(rows, hashes)
    return some if hashes.count() <= BROADCAST_HASHES else some.join(hashes, hashes.columns[0], "left_semi")


def pair_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b: text hashes) with the texts ta and tb from ``texts`` (th, text).

    Only texts that occur in a pair are shuffled.
    """
    needed = land(pairs.select(F.col("a").alias("th")).union(pairs.select(F.col("b").alias("th"))).distinct())
    # landed, so that both sides of the joins below are plain shuffles and AQE can split a text with many pairs
    some = land(rows_with(texts, needed).dropDuplicates(["th"]))
    return (pairs.join(some.select(F.col("th").alias("a"), F.col("text").alias("ta")), "a")
            .join(some.select(F.col("th").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Smallest reachable id per vertex of an undirected graph.

    ``edges`` has long columns ``a`` and ``b``; the result has ``v`` and ``root`` for every vertex
    that has an edge (self-loops count).  Alternating large-star and small-star contraction: every step is a minimum
    per vertex (partial aggregation) joined back to the edges (AQE splits a vertex with many
    edges), so no neighbour list is ever gathered.  Each round is landed.
    """
    e = land(edges.where(F.col("a") != F.col("b"))
             .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    verts = edges.select(F.col("a").alias("v")).union(edges.select(F.col("b").alias("v"))).distinct()
    for _ in range(max_rounds):
        # large star: every larger neighbour of v moves to v's smallest neighbour
        both = e.select(F.col("lo").alias("v"), F.col("hi").alias("w")).union(
            e.select(F.col("hi").alias("v"), F.col("lo").alias("w")))
        m = both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("m"))
        large = (both.join(m, "v").where(F.col("w") > F.col("v"))
                 .select(F.col("m").alias("lo"), F.col("w").alias("hi")).where(F.col("lo") != F.col("hi")).distinct())
        # small star: every smaller neighbour of v, and v, move to the smallest of them
        m2 = large.groupBy("hi").agg(F.min("lo").alias("m"))
        j = large.join(m2, "hi")
        small = (j.select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
                 .union(j.select(F.col("m").alias("lo"), F.col("hi")))
                 .where(F.col("lo") != F.col("hi")).distinct())
        nxt = land(small)
        same = nxt.count() == e.count() and nxt.exceptAll(e).isEmpty()
        e = nxt
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.groupBy(F.col("hi").alias("v")).agg(F.min("lo").alias("root"))
    return verts.join(roots, "v", "left").select("v", F.coalesce("root", "v").alias("root"))
