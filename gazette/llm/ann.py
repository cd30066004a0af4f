"""Nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on at most ``SAMPLE`` vectors (a documented bound; every row is indexed): k-means with ``BRANCH`` centres, again
inside each cell, until a cell stands for about ``LEAF_ROWS`` rows or has too few sample vectors to be cut.  Every row goes down to the leaf of the
nearest centres.  A query keeps a priority queue of cells by the distance to their centres: the nearest cell is taken out; an inner
cell puts its children in, a leaf is visited.  How many leaves are visited is calibrated: for ``CALIBRATION`` of the
queries the exact neighbours are found by a scan of all rows, and the number of leaves widens until the leaves visited hold ``TARGET``
of these neighbours.

The visit of the first leaf bounds a query's k-th distance, so later leaves return nearer rows only.  Leaves above ``search.UNIT_ROWS``
rows are dealt in parts, so a vector that a third of all rows share is no hot task.  Distances are recomputed from the
original components in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part; vectors of different lengths are
not compared; a query with fewer other rows than ``k`` gets them all; equal distances go by the smaller id (rows without an id last); repeated rows are
rows of their own, so a query may find its own id in another row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import land
from gazette.llm.search import dealt, matrix, usable, visit

SAMPLE, LEAF_ROWS, BRANCH = 32_768, 512, 8
CALIBRATION, TARGET = 64, 0.97
LEAST_SAMPLE = 8                                 # sample vectors of a leaf, so at most SAMPLE / 8 leaves
RESULT = "query_rid long, query_id long, rid long, vec_id long, score double"


class Tree:
    """Cells numbered from the root 0: centres, children (none: a leaf) and the leaf's number."""

    def __init__(self, sample: np.ndarray, rows: int):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._rng = np.random.default_rng(7)
        self._grow(sample, rows / max(1, len(sample)))

    def _grow(self, x: np.ndarray, weight: float) -> int:
        cell = len(self.leaf)
        self.centres.append(np.zeros((0, x.shape[1])))
        self.children.append([])
        self.leaf.append(-1)
        parts = self._split(x, min(BRANCH, math.ceil(len(x) * weight / LEAF_ROWS), len(x) // LEAST_SAMPLE))
        if len(parts) < 2:
            self.leaf[cell] = self.leaves
            self.leaves += 1
            return cell
        self.centres[cell] = np.array([p.mean(0) for p in parts])
        self.children[cell] = [self._grow(p, weight) for p in parts]
        return cell

    def _split(self, x: np.ndarray, k: int) -> list[np.ndarray]:
        if k < 2:
            return [x]
        centres = x[self._rng.choice(len(x), k, replace=False)]
        for _ in range(10):
            near = nearest(x, centres)
            centres = np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(k)])
        near = nearest(x, centres)
        return [x[near == c] for c in range(k) if (near == c).any()]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row goes down to."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            cell, rows = todo.pop()
            if self.leaf[cell] >= 0:
                out[rows] = self.leaf[cell]
                continue
            near = nearest(x[rows], self.centres[cell])
            todo += [(child, rows[near == c]) for c, child in enumerate(self.children[cell]) if (near == c).any()]
        return out

    def best_bins(self, q: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < visits:
            _, cell = heapq.heappop(queue)
            if self.leaf[cell] >= 0:
                out.append(self.leaf[cell])
                continue
            far = ((self.centres[cell] - q) ** 2).sum(1)
            for d, child in zip(far.tolist(), self.children[cell]):
                heapq.heappush(queue, (d, child))
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.nan_to_num((centres ** 2).sum(1) - 2 * x @ centres.T, nan=np.inf).argmin(1)


def closest(x: np.ndarray, ids: np.ndarray, rids: np.ndarray, q: np.ndarray, q_rid: int, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (indices) and exact distances of the k rows nearest to q within ``bound``, but for q's own row."""
    with np.errstate(all="ignore"):
        rough = (x ** 2).sum(1) + (q ** 2).sum() - 2 * (x @ q)
        slack = 1e-9 * ((x ** 2).sum(1).max() + (q ** 2).sum())
        own = rids == q_rid
        if np.isfinite(rough).all() and math.isfinite(slack):
            rough[own] = np.inf
            most = np.partition(rough, k - 1)[k - 1] if len(rough) > k else np.inf
            rows = np.flatnonzero((rough <= min(most, bound ** 2) + slack) & ~own)
        else:
            rows = np.flatnonzero(~own)
        score = np.sqrt(((x[rows] - q) ** 2).sum(1))
    rows, score = rows[score <= bound], score[score <= bound]
    order = np.lexsort((rids[rows], ids[rows], score))[:k]
    return rows[order], score[order]


def _result(found: list[tuple], null_id: int) -> pa.RecordBatch:
    q_rid, q_id, rid, vid, score = (np.concatenate([np.broadcast_to(f[c], len(f[4])) for f in found]) for c in range(5))
    return pa.RecordBatch.from_pydict({
        "query_rid": pa.array(q_rid.astype(np.int64)), "query_id": pa.array(q_id.astype(np.int64)), "rid": pa.array(rid),
        "vec_id": pa.array(vid, mask=vid == null_id), "score": pa.array(score)})


NO_ID = 2 ** 63 - 1                              # stands for a missing id inside a task, so it sorts last


def _ids(column) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _scan(queries, k: int):
    """Per batch of all rows: the k nearest to each of the (few) queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid_q, vec_q = queries
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids, rids, leaf = matrix(batch.column(2)), _ids(batch.column(1)), batch.column(0).to_numpy(), batch.column(3).to_numpy()
            for r, q in zip(rid_q, vec_q):
                rows, score = closest(x, ids, rids, q, r, k, math.inf)
                yield pa.RecordBatch.from_pydict({"query_rid": pa.array(np.full(len(rows), r)), "rid": pa.array(rids[rows]), "vec_id": pa.array(ids[rows]),
                                                  "leaf": pa.array(leaf[rows]), "score": pa.array(score)})
    return run


def first_k(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_rid").orderBy("score", F.col("vec_id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def calibrate(tree: Tree, indexed: DataFrame, queries: DataFrame, k: int, target: float) -> tuple[int, float]:
    """(leaf visits, share of the calibration queries' true neighbours that these visits hold)."""
    some = queries.orderBy(F.xxhash64("rid"), "rid").limit(CALIBRATION).select("rid", "vec").toArrow()
    rid_q, vec_q = some.column("rid").to_numpy(), matrix(some.column("vec"))
    truth = first_k(indexed.select("rid", "vec_id", "vec", "leaf").mapInArrow(
        _scan((rid_q, vec_q), k), "query_rid long, rid long, vec_id long, leaf long, score double"), k)
    place = {int(r): {leaf: n for n, leaf in enumerate(tree.best_bins(q, tree.leaves))} for r, q in zip(rid_q, vec_q)}
    depth = np.array([place[r.query_rid][r.leaf] for r in truth.select("query_rid", "leaf").collect()])   # at most CALIBRATION * k rows
    if not len(depth):
        return 1, 1.0
    visits = 1
    while (depth < visits).mean() < target:
        visits = min(tree.leaves, max(visits + 1, math.ceil(visits * 1.2)))
    return visits, float((depth < visits).mean())


def _one_length(rows: DataFrame, k: int, target: float) -> DataFrame:
    spark = rows.sparkSession
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("rid", F.lit(1)), "rid").limit(SAMPLE).select("vec").toArrow()
    tree = Tree(matrix(sample.column("vec")), n)
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.leaf_of(matrix(batch.column(3))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["rid", "vec_id", "query", "vec", "leaf"])
    indexed = land(dealt(rows.mapInArrow(assign, "rid long, vec_id long, query boolean, vec array<double>, leaf long"), "leaf"))
    queries = indexed.where("query").select("rid", "vec_id", "vec")
    visits, _ = calibrate(tree, indexed, queries, k, target)
    parts = indexed.select("leaf", "parts").distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [shared.value.best_bins(q, visits) for q in matrix(batch.column(2))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bins, pa.list_(pa.int64()))], names=["rid", "vec_id", "vec", "bins"])
    routed = land(queries.mapInArrow(route, "rid long, vec_id long, vec array<double>, bins array<long>"))

    def meet(unit: pa.Table, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, ids, rids = matrix(unit.column("vec")), _ids(unit.column("vec_id")), unit.column("rid").to_numpy()
        found = []
        for r, i, q, b in zip(some.column("rid").to_pylist(), some.column("vec_id").to_pylist(), matrix(some.column("vec")), some.column("bound").to_pylist()):
            at, score = closest(x, ids, rids, q, r, k, b)
            if len(at):
                found.append((r, i, rids[at], ids[at], score))
        if found:
            yield _result(found, NO_ID)

    index = indexed.select("unit", "rid", "vec_id", "vec", F.lit(0.0).alias("bound"))

    def visited(who: DataFrame, leaves: Column) -> DataFrame:
        to = (who.withColumn("leaf", F.explode(leaves)).join(F.broadcast(parts), "leaf")
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select(F.struct("leaf", "part").alias("unit"), "rid", "vec_id", "vec", "bound"))
        return visit(index, to, meet, RESULT)

    near = land(visited(routed.withColumn("bound", F.lit(math.inf)), F.slice("bins", 1, 1)))
    kth = (first_k(near, k).groupBy("query_rid").agg(F.max("score").alias("score"), F.count(F.lit(1)).alias("n"))
           .select(F.col("query_rid").alias("rid"), F.when(F.col("n") == k, F.col("score")).alias("kth")))
    rest = (routed.where(F.size("bins") > 1).join(kth, "rid", "left").withColumn("bound", F.coalesce("kth", F.lit(math.inf))))
    return first_k(near.unionByName(visited(rest, F.expr("slice(bins, 2, size(bins) - 1)"))), k)


def nearest_rows(embeddings: DataFrame, is_query: Column, k: int = 10, target: float = TARGET) -> DataFrame:
    """Per query row: query_id, rank, vec_id, score of its ``k`` nearest other rows found."""
    vec = F.col("embedding")
    fit = usable(vec) & F.exists(vec, lambda v: v != 0)
    rows = land(embeddings.where(F.coalesce(fit, F.lit(False))).select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("query"), vec.cast("array<double>").alias("vec")))
    lengths = [r[0] for r in rows.where("query").select(F.size("vec")).distinct().collect()]       # as many as vector lengths
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for n in sorted(lengths):
        out = out.unionByName(_one_length(rows.where(F.size("vec") == n), k, target).select("query_id", "rank", "vec_id", "score"))
    return out
