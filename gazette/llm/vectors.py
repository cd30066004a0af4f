"""Near-duplicate vectors with equal labels by randomised-rotation binary codes.

A unit vector o is rotated by a random orthogonal matrix; its code is the signs of the result, and the stored
correction factor f = <code, o> turns <code, q> / f into an unbiased estimate of <o, q> for a rotated vector q, with an error
below EPSILON * sqrt((1 - f^2) / f^2 / (D - 1)) but for rare cases.  Pairs whose estimate plus bound reaches the
threshold, seen from either side, are recomputed exactly in double precision; nothing else decides a link.

The codes of further rotations are the index: a table takes some of their bits as bucket key (with label and
dimension), and only vectors in one bucket of some table are compared.  Bits per table grow with the largest
label (about ``FILL`` vectors a bucket if vectors were spread evenly), and the number of tables follows so that a pair at the threshold meets
with probability ``RECALL``.  A pair that meets in several tables counts in the first.  Buckets above ``BLOCK`` vectors are dealt as pairs of blocks, so
no task holds a whole large bucket.  A bucket emits one row per vector (its links there and the smallest vector it
is connected to there), never the pairs.  Equal vectors are collapsed beforehand and counted by multiplicity.

Defined cases: null labels, null or zero vectors and vectors with null or non-finite components link with nothing, not even with
their equals; vectors of different lengths never link; repeated rows are vectors of their own with the same id; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import connected_components, land
from gazette.llm.shingles import mix64

FILL, BLOCK, RECALL, EPSILON = 256, 256, 0.997, 3.5
# the table of large buckets is broadcast up to this many rows
BROADCAST_KEYS = 100_000


def rotation(dim: int, number: int) -> np.ndarray:
    """Random orthogonal matrix; the number tells the rotations of one dimension apart."""
    q, r = np.linalg.qr(np.random.default_rng([31, dim, number]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def plan_tables(largest: int, threshold: float) -> tuple[int, int]:
    """(bits per table, tables) for a largest label of so many vectors."""
    bits = max(2, math.ceil(math.log2(max(1, largest) / FILL)))
    alike = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - alike)))


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotated vectors (float32) and the correction factor of each code."""
    rotated = units @ rotation(units.shape[1], 0)
    return rotated.astype(np.float32), (np.abs(rotated).sum(1) / math.sqrt(units.shape[1])).astype(np.float32)


def table_keys(units: np.ndarray, labels: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(vectors, tables) bucket keys: hash of label, dimension, table and the table's code bits."""
    dim = units.shape[1]
    per = max(1, dim // bits)
    out = np.zeros((len(units), tables), np.uint64)
    for t in range(tables):
        if t % per == 0:
            signs = units @ rotation(dim, 1 + t // per) > 0
        lo = (t % per) * bits
        own = signs[:, lo:lo + bits].astype(np.uint64) @ (np.uint64(1) << np.arange(min(bits, dim - lo), dtype=np.uint64))
        out[:, t] = mix64(mix64(mix64(labels.astype(np.int64).view(np.uint64)) + np.uint64(dim * 4096 + t)) + own)
    return out


def _index(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vid, label, vec = (batch.column(k) for k in range(3))
            sizes = np.diff(vec.offsets.to_numpy())
            flat, ends = vec.values.to_numpy(zero_copy_only=False).astype(np.float64), vec.offsets.to_numpy()
            labels = label.to_numpy(zero_copy_only=False).astype(np.int64)
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x = flat[ends[rows][:, None] + np.arange(dim)]
                units = x / np.linalg.norm(x, axis=1, keepdims=True)
                _, factor = encode(units)
                keys = table_keys(units, labels[rows], bits, tables).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "vid": vid.take(pa.array(rows)), "mult": batch.column(3).take(pa.array(rows)),
                    "vec": vec.take(pa.array(rows)), "factor": pa.array(factor),
                    "keys": pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * tables, pa.int32()), pa.array(keys.ravel()))})
    return run


def linked_pairs(units: np.ndarray, factor: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float):
    """(i, j) index arrays of the pairs from left x right that reach the threshold exactly."""
    dim = units.shape[1]
    rotated, _ = encode(units)
    signs = np.sign(rotated) / np.float32(math.sqrt(dim))
    f = np.maximum(factor.astype(np.float64), 1e-6)
    bound = (EPSILON * np.sqrt(np.maximum(1 - f * f, 0) / (f * f) / max(1, dim - 1))).astype(np.float32)
    one = signs[left] @ rotated[right].T / f[left, None] + bound[left, None] >= threshold
    two = rotated[left] @ signs[right].T / f[None, right] + bound[None, right] >= threshold
    i, j = np.nonzero(one | two)
    i, j = left[i], right[j]
    keep = np.zeros(len(i), bool)
    for lo in range(0, len(i), 65536):
        s = slice(lo, lo + 65536)
        keep[s] = np.einsum("nd,nd->n", units[i[s]], units[j[s]]) >= threshold
    return i[keep], j[keep]


def _compare(threshold: float):
    """Sorted rows of many buckets in, one row per vector and bucket out."""
    def bucket(rows: pa.Table) -> dict[str, np.ndarray] | None:
        n = rows.num_rows
        if n < 2:
            return None
        vec = rows.column("vec").combine_chunks()
        x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if len(x) % n:
            return None                                     # lengths differ: a hash collision of keys
        x = x.reshape(n, -1)
        units = x / np.linalg.norm(x, axis=1, keepdims=True)
        vid, mult = rows.column("vid").to_numpy(), rows.column("mult").to_numpy()
        keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(n, -1)
        table, block = int(rows.column("t")[0].as_py()), rows.column("block").to_numpy()
        p, q = rows.column("p")[0].as_py(), rows.column("q")[0].as_py()
        left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
        if not len(left) or not len(right):
            return None
        i, j = linked_pairs(units, rows.column("factor").to_numpy(), left, right, threshold)
        fresh = np.ones(len(i), bool) if p != q else i < j
        for t in range(table):                              # met before in an earlier table
            fresh &= keys[i, t] != keys[j, t]
        i, j = i[fresh], j[fresh]
        if not len(i):
            return None
        links = np.bincount(i, mult[j], n) + np.bincount(j, mult[i], n)
        root = vid.copy()
        while True:
            low = np.minimum(root[i], root[j])
            new = root.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            if (new == root).all():
                break
            root = new
        some = links > 0
        return {"vid": vid[some], "links": links[some].astype(np.int64), "root": root[some]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
            gid = table.column("gid").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(gid[1:] != gid[:-1]) + 1, [len(gid)]])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if (out := bucket(table.slice(lo, hi - lo))) is not None:
                    yield pa.RecordBatch.from_pydict(out)

        for batch in batches:                               # a bucket may go on in the next batch
            gid = batch.column(batch.schema.get_field_index("gid")).to_numpy()
            last = int(np.searchsorted(gid, gid[-1], "left")) if batch.num_rows else 0
            if last == 0:
                if held and batch.num_rows and held[-1].column(0)[0].as_py() != gid[-1]:
                    yield from solve(pa.Table.from_batches(held))
                    held = []
                held.append(batch)
                continue
            yield from solve(pa.Table.from_batches([*held, batch.slice(0, last)]))
            held = [batch.slice(last)]
        if held:
            yield from solve(pa.Table.from_batches(held))
    return run


def link_vectors(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = land(embeddings.select("vec_id", "embedding", "label").withColumn("rid", F.monotonically_increasing_id()))
    vec = F.col("embedding")
    fit = (F.col("label").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
           & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
           & F.exists(vec, lambda v: v != 0))
    fit = F.coalesce(fit, F.lit(False))
    same = land(rows.where(fit).groupBy("label", "embedding").agg(F.min("rid").alias("vid"), F.count(F.lit(1)).alias("mult")))
    largest = same.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, threshold)
    index = land(same.select("vid", F.col("label").cast("long").alias("label"), "embedding", "mult").mapInArrow(
        _index(bits, tables), f"vid long, mult long, vec {embeddings.schema['embedding'].dataType.simpleString()}, factor float, keys array<long>"))
    dealt = index.select("vid", "mult", "vec", "factor", "keys", F.posexplode("keys").alias("t", "key"))
    large = land(index.select(F.explode("keys").alias("key")).groupBy("key").count().where(F.col("count") > BLOCK)
                 .select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    side = F.broadcast(large) if large.count() <= BROADCAST_KEYS else large
    dealt = (dealt.join(side, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
             .select(F.xxhash64("key", "p", "q").alias("gid"), "vid", "mult", "vec", "factor", "keys", "t", "block", "p", "q"))
    parts = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = land(dealt.repartition(parts, "gid").sortWithinPartitions("gid")
                 .mapInArrow(_compare(threshold), "vid long, links long, root long"))
    links = found.groupBy("vid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("vid").alias("a"), F.col("root").alias("b")))
    per = same.join(links, "vid", "left").join(roots.withColumnRenamed("v", "vid"), "vid", "left").select(
        F.col("label").alias("l"), F.col("embedding").alias("e"),
        (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "vid").alias("root"))
    placed = rows.where(fit).join(per, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e"))).select(
        "vec_id", "rid", "n_links", "root")
    placed = land(placed.unionByName(rows.where(~fit).select("vec_id", "rid", F.lit(0).cast("long").alias("n_links"),
                                                             F.col("rid").alias("root"))))
    lowest = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return placed.join(lowest, "root").select(
        "vec_id", F.col("n_links").cast("long"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
