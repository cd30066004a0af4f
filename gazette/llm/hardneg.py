"""Hard negatives by an STR-packed R-tree over integer vectors.

Components are scaled to integers, so scores (inner products) are exact.  Sort-tile-recursive packing cuts the rows into tiles: sort by the
coordinate with the largest variance, cut into slabs of equal size, go on in each slab with the next coordinate.  The cuts of the upper levels
come from at most ``SAMPLE`` rows (a documented bound; at most ``MAX_TILES`` tiles); every row is dealt by them and each tile's minimum bounding box
covers all its rows.  A task packs the rows of its unit (a tile, or a part of a large one) into pages of ``PAGE`` rows under inner nodes of
``FAN_OUT`` pages.  With an anchor, a box gives the interval of possible inner products, coordinate by coordinate.  A best-first queue takes the box
with the largest upper end; a box is left out when its interval misses every open score window, or when its upper end is strictly below
the k-th score found (equal ones stay, as ties go by the smaller id).

Two such searches: the ``positives`` best rows of the anchor's label, then for every positive the ``k`` best rows of other labels in its score
window.  Each runs in two rounds: the most promising tile first, whose k-th score prunes the other tiles before anything is sent there.
The result is exact; nothing is capped.

Defined cases: rows with a null label or vector, an empty vector or null or non-finite components take no part; vectors of different
lengths are not compared; ties go by the smaller id (rows without an id last); repeated rows are rows of their own; an anchor without
another row of its label has no positives and gives nothing; a positive with an empty window gives nothing (so one with a negative score);
an empty table gives an empty result; extra columns are ignored.  Scores are 64-bit integers.
"""

from __future__ import annotations

import heapq
import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import land
from gazette.llm.search import UNIT_ROWS, dealt, matrix, usable, visit

SAMPLE, MAX_TILES, PAGE, FAN_OUT = 32_768, 4096, 64, 8
LOW, HIGH = -(2 ** 62), 2 ** 62
NO_ID = 2 ** 63 - 1
EXACT = 2.0 ** 53
FOUND = "anchor long, slot int, rid long, vec_id long, score long"


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of integers: in doubles while sums stay below 2^53, else in 64-bit integers."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def intervals(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest inner product of each a with a point of each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return product(up, low) + product(down, high), product(up, high) + product(down, low)


def str_order(x: np.ndarray, page: int) -> list[np.ndarray]:
    """Row numbers of each page, sort-tile-recursive; neighbours in the list are neighbours in space."""
    axes = np.argsort(-x.var(0), kind="stable")

    def tile(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        pages = -(-len(rows) // page)
        if pages <= 1 or depth == len(axes):
            return [rows[i:i + page] for i in range(0, len(rows), page)]
        slabs = math.ceil(pages ** (1 / (len(axes) - depth)))
        rows = rows[np.argsort(x[rows, axes[depth]], kind="stable")]
        size = -(-pages // slabs) * page
        return [p for i in range(0, len(rows), size) for p in tile(rows[i:i + size], depth + 1)]
    return tile(np.arange(len(x)), 0) if len(x) else []


class Tiles:
    """The upper cuts: a nested list of (axis, cut values, children); a leaf is a tile number."""

    def __init__(self, sample: np.ndarray, rows: int, unit: int = UNIT_ROWS):
        self.count = 0
        axes = np.argsort(-sample.var(0), kind="stable")

        def cut(x: np.ndarray, tiles: int, depth: int):
            if tiles <= 1 or depth == len(axes) or len(x) < 2:
                self.count += 1
                return self.count - 1
            slabs = math.ceil(tiles ** (1 / (len(axes) - depth)))
            x = x[np.argsort(x[:, axes[depth]], kind="stable")]
            at = [len(x) * k // slabs for k in range(1, slabs)]
            values = np.unique(x[at, axes[depth]])
            of = np.searchsorted(values, x[:, axes[depth]], "right")
            return (int(axes[depth]), values, [cut(x[of == k], -(-tiles // slabs), depth + 1) for k in range(len(values) + 1)])
        self.root = cut(sample, min(MAX_TILES, max(1, -(-rows // unit)), max(1, len(sample) // 8)), 0)

    def tile_of(self, x: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if isinstance(node, int):
                out[rows] = node
                continue
            axis, values, children = node
            of = np.searchsorted(values, x[rows, axis], "right")
            todo += [(child, rows[of == k]) for k, child in enumerate(children) if (of == k).any()]
        return out


class Unit:
    """A unit's R-tree: pages of rows, their boxes, and the boxes of their parents."""

    def __init__(self, rows: pa.Table):
        self.x, self.rid = matrix(rows.column("vec")), rows.column("rid").to_numpy()
        self.id = rows.column("vec_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.label = rows.column("label").to_numpy()
        pages = str_order(self.x, PAGE)
        # rows lie in page order, so a page is a slice
        order = np.concatenate(pages)
        self.x, self.rid, self.id, self.label = self.x[order], self.rid[order], self.id[order], self.label[order]
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in pages])]).tolist()
        low = np.array([self.x[i:j].min(0) for i, j in zip(self.starts[:-1], self.starts[1:])])
        high = np.array([self.x[i:j].max(0) for i, j in zip(self.starts[:-1], self.starts[1:])])
        self.groups = [range(k, min(k + FAN_OUT, len(pages))) for k in range(0, len(pages), FAN_OUT)]
        self.low = np.concatenate([low, [low[g.start:g.stop].min(0) for g in self.groups]])
        self.high = np.concatenate([high, [high[g.start:g.stop].max(0) for g in self.groups]])
        self.pages = len(pages)

    def search(self, a: np.ndarray, rid: int, label: int, same: bool, k: int, slots: list[dict], lower: np.ndarray, upper: np.ndarray):
        """Per slot the best k rows (score, id, rid) of its window, best first.  Boxes are numbered pages first, then parents."""
        found = [(np.zeros(0, np.int64),) * 3 for _ in slots]
        least = [max(s["lo"], LOW if s["kth"] is None else s["kth"]) for s in slots]
        queue = [(-int(upper[self.pages + g]), self.pages + g) for g in range(len(self.groups))]
        heapq.heapify(queue)
        lower, upper = lower.tolist(), upper.tolist()
        while queue:
            top, box = heapq.heappop(queue)
            if -top < min(least):
                break
            open_ = [n for n, s in enumerate(slots) if upper[box] >= least[n] and lower[box] <= s["hi"]]
            if not open_:
                continue
            if box >= self.pages:
                for page in self.groups[box - self.pages]:
                    heapq.heappush(queue, (-upper[page], page))
                continue
            rows = slice(self.starts[box], self.starts[box + 1])
            score = product(self.x[rows], a[None])[:, 0]
            fit = (self.label[rows] == label) & (self.rid[rows] != rid) if same else self.label[rows] != label
            for n in open_:
                at = np.flatnonzero(fit & (score >= least[n]) & (score <= slots[n]["hi"]))
                if not len(at):
                    continue
                s, i, r = (np.concatenate(p) for p in zip(found[n], (score[at], self.id[rows][at], self.rid[rows][at])))
                best = np.lexsort((r, i, -s))[:k]
                found[n] = (s[best], i[best], r[best])
                if len(best) == k:
                    least[n] = max(least[n], int(s[best[-1]]))
        return found


def _meet(same: bool, k: int):
    held: list = [None, None]

    def meet(rows: pa.Table, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if held[0] is not rows:
            held[:] = [rows, Unit(rows)]
        unit: Unit = held[1]
        a = matrix(some.column("vec"))
        lower, upper = intervals(a, unit.low, unit.high)
        out: list[tuple] = []
        for n, (rid, label, slots) in enumerate(zip(*(some.column(c).to_pylist() for c in ("rid", "label", "slots")))):
            for slot, (s, i, r) in zip(slots, unit.search(a[n], rid, label, same, k, slots, lower[n], upper[n])):
                if len(s):
                    out.append((np.full(len(s), rid), np.full(len(s), slot["slot"], np.int32), r, i, s))
        if out:
            cols = [np.concatenate(c) for c in zip(*out)]
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(cols[0]), "slot": pa.array(cols[1]), "rid": pa.array(cols[2]),
                                              "vec_id": pa.array(cols[3], mask=cols[3] == NO_ID), "score": pa.array(cols[4])})
    return meet


def best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class Index:
    """All rows of one vector length (rid, vec_id, label, vec), dealt to units, and the tiles' boxes."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        sample = rows.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).select("vec").toArrow()
        tiles = spark.sparkContext.broadcast(Tiles(matrix(sample.column("vec")), rows.count()))

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tile = tiles.value.tile_of(matrix(batch.column(3))) if batch.num_rows else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile)], names=["rid", "vec_id", "label", "vec", "tile"])

        def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = {}, {}
            for batch in batches:
                if batch.num_rows:
                    x, of = matrix(batch.column(0)), batch.column(1).to_numpy()
                    for t in np.unique(of).tolist():
                        own = x[of == t]
                        low[t] = np.minimum(low.get(t, own[0]), own.min(0))
                        high[t] = np.maximum(high.get(t, own[0]), own.max(0))
            if low:
                yield pa.RecordBatch.from_pydict({"tile": pa.array(list(low), pa.int64()), "low": pa.array([v.tolist() for v in low.values()], pa.list_(pa.int64())),
                                                  "high": pa.array([v.tolist() for v in high.values()], pa.list_(pa.int64()))})
        self.rows = land(dealt(rows.select("rid", "vec_id", "label", "vec").mapInArrow(
            assign, "rid long, vec_id long, label long, vec array<long>, tile long"), "tile"))
        self.parts = self.rows.select("tile", "parts").distinct()
        per = (self.rows.select("vec", "tile").mapInArrow(boxes, "tile long, low array<long>, high array<long>")
               .select("tile", F.posexplode(F.arrays_zip("low", "high")).alias("d", "b")).groupBy("tile", "d")
               .agg(F.min("b.low").alias("low"), F.max("b.high").alias("high"))
               .groupBy("tile").agg(F.array_sort(F.collect_list(F.struct("d", "low", "high"))).alias("b")).orderBy("tile")
               .select("tile", F.col("b.low").alias("low"), F.col("b.high").alias("high")).toArrow())      # at most MAX_TILES boxes
        self.boxes = spark.sparkContext.broadcast((per.column("tile").to_numpy(), matrix(per.column("low")), matrix(per.column("high"))))

    def search(self, anchors: DataFrame, slots: DataFrame, same: bool, k: int) -> DataFrame:
        """(anchor, slot, rid, vec_id, score, rank): the best k rows per slot (rid, slot, lo, hi) of the anchors (rid, label, vec)."""
        shared = self.boxes
        names = "rid long, label long, vec array<long>, slots array<struct<slot:int,lo:long,hi:long,kth:long>>"

        def route(first: bool):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                tiles, low, high = shared.value
                for batch in batches:
                    to = []
                    if batch.num_rows:
                        lower, upper = intervals(matrix(batch.column(2)), low, high)
                    for n, of in enumerate(batch.column(3).to_pylist()):
                        fit = np.zeros(len(tiles), bool)
                        for s in of:
                            least = max(s["lo"], LOW if s["kth"] is None else s["kth"])
                            fit |= (upper[n] >= least) & (lower[n] <= s["hi"])
                        top = int(upper[n].argmax())
                        if first:
                            fit[:top] = fit[top + 1:] = False
                        else:
                            fit[top] = False
                        to.append(tiles[fit].tolist())
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to, pa.list_(pa.int64()))], names=["rid", "label", "vec", "slots", "to"])
            return run

        def visited(slots: DataFrame, first: bool) -> DataFrame:
            own = slots.groupBy("rid").agg(F.collect_list(F.struct("slot", "lo", "hi", "kth")).alias("slots"))       # a few per anchor
            to = (anchors.join(own, "rid").select("rid", "label", "vec", "slots").mapInArrow(route(first), names + ", to array<long>")
                  .withColumn("tile", F.explode("to")).join(F.broadcast(self.parts), "tile")
                  .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                  .select(F.struct("tile", "part").alias("unit"), "rid", F.lit(None).cast("long").alias("vec_id"), "label", "vec", "slots"))
            index = self.rows.select("unit", "rid", "vec_id", "label", "vec", F.lit(None).cast(to.schema["slots"].dataType).alias("slots"))
            return visit(index, to, _meet(same, k), FOUND)

        none = F.lit(None).cast("long")
        near = land(visited(slots.withColumn("kth", none), True))
        kth = (best(near, k).groupBy("anchor", "slot").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
               .select(F.col("anchor").alias("rid"), "slot", F.when(F.col("n") == k, F.col("score")).alias("kth")))
        return best(near.unionByName(visited(slots.join(kth, ["rid", "slot"], "left"), False)), k)


def hard_negatives(embeddings: DataFrame, anchor_every: int = 100, positives: int = 5, k: int = 10, lowest: int = 30, highest: int = 90) -> DataFrame:
    """Per anchor (ids divisible by ``anchor_every``) and positive: the ``k`` best rows of other labels whose score lies between
    ``lowest`` and ``highest`` percent of the positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``embeddings``: vec_id, label, vec (array<long>).
    """
    rows = land(embeddings.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
                                  F.col("label").cast("long").alias("label"), F.col("vec").cast("array<long>").alias("vec")))
    is_anchor = F.col("vec_id") % anchor_every == 0
    out = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for n in sorted(r[0] for r in rows.where(is_anchor).select(F.size("vec")).distinct().collect()):                # as many as vector lengths
        own = rows.where(F.size("vec") == n)
        index = Index(own)
        anchors = land(own.where(is_anchor))
        pos = land(index.search(anchors, anchors.select("rid", F.lit(0).alias("slot"), F.lit(LOW).alias("lo"), F.lit(HIGH).alias("hi")),
                                True, positives).select("anchor", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
        # lowest * p <= 100 * s <= highest * p for an integer s: nothing for p < 0
        p = F.col("positive_score")
        windows = (pos.where(p >= 0).select(F.col("anchor").alias("rid"), "slot", F.expr(f"(positive_score * {lowest} + 99) div 100").alias("lo"),
                                            F.expr(f"(positive_score * {highest}) div 100").alias("hi")).where(F.col("lo") <= F.col("hi")))
        neg = index.search(anchors, windows, False, k)
        ids = anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        out = out.unionByName(neg.join(pos, ["anchor", "slot"]).join(ids, "anchor").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return out


def scaled(embeddings: DataFrame, shift_every: int = 7, labels: int = 10, scale: int = 256) -> DataFrame:
    """vec_id, label, vec of the rows that take part: components floor(scale * x); labels of ids divisible by ``shift_every`` move on by one."""
    moved = F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return embeddings.where(F.col("label").isNotNull() & usable(F.col("embedding"))).select(
        "vec_id", moved.cast("long").alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vec"))
