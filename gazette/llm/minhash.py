"""Near-duplicate documents by improved consistent weighted sampling.

A document is the weighted set of its shingles of five words: weight = occurrences x idf.  Document frequencies
come from one pass that adds up a count table of ``BUCKETS`` entries over all documents; the idf of a shingle is
1 - DAMP + DAMP * ln(N / df) / ln(RARE), N / df taken between 1 and RARE, so boilerplate weighs less but a large group of near copies, whose
own shingles are frequent because of the copies, still reaches the threshold.  The table's size is fixed, and so
is its noise relative to N / RARE: the mean bucket is subtracted.

Improved consistent weighted sampling draws ``BANDS * ROWS`` samples per document; two documents agree in one
with the probability of their weighted Jaccard similarity.  Per band, documents with equal samples form a bucket, led by the member
with the smallest hash under that band's key; members pair with their leader first, so a bucket of
m makes m - 1 pairs, and every band draws other leaders.

Where texts are built on one template, buckets fill with texts that share the template only, and two near copies among them may both
miss their leaders.  So each document is sampled a second time, ``SINGLES`` times with weights tf x idf**2 without damping, where a template
weighs next to nothing: equal single samples are shingles that the copies have beside the template, and their buckets hold little else.
A candidate pair of either kind is verified where at least ``SKETCH_LEAST`` of its ``BANDS * ROWS`` damped samples agree, one byte of
each (at 0.8, 19 are expected and fewer than 12 come with probability 0.0002), by the exact weighted Jaccard similarity of the whole texts.
Verified links give classes by connected components.  Equal texts are collapsed beforehand.

A leader may be unlike two members that are alike.  So in every bucket whose members are not yet of one class, the pairs of members of
different classes are compared as well, all of them: members are dealt into blocks of about ``BLOCK``, a task takes two blocks.  Pairs that pass
the sketch and a longer one (``LONG`` further samples of the members' texts, at least ``LONG_LEAST`` equal: at 0.8, 77 are expected and fewer come with
probability 0.0007) are compared again by ``FINE`` samples (``FINE_LEAST`` equal: 199 are expected, fewer come with probability 0.0004), and
what is left by the texts themselves.  Pairs stay in their tasks: a pass leaves the members that have one, the last a forest of links, so rows
grow with the members, not with the pairs.  So every pair that meets in a bucket and is at the threshold ends in one class.

Defined cases: null, empty and wordless texts are near nothing but equal texts; repeated rows and
equal texts share a class; the class id is the class's smallest doc_id (null is largest) and of the rows with it one is kept;
an empty table gives an empty result; extra columns are ignored, or passed through by ``drop_near_duplicates``.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import connected_components, keep_rows, land, pair_texts, parted, rows_with, text_or_empty
from gazette.llm.shingles import mix64, shingle_hashes, slices

BANDS, ROWS = 8, 3
SINGLES, SKETCH_LEAST = 16, 12
LONG, LONG_LEAST, FINE, FINE_LEAST, BLOCK = 96, 64, 248, 177, 2000
BLOCK_BYTES = 4 << 20
BUCKETS, PARTS, LANES = 1 << 18, 64, 16
RUN = 1 << 17
DAMP, RARE = 0.25, 100.0
SKETCH = ("s0", "s1", "s2")

_SEED = np.random.default_rng(21)
ODD = _SEED.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _SEED.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64)
# quantiles of Gamma(2, 1) sums of two exponentials, drawn once from a fixed seed
_U = _SEED.random((4, 1 << 16)) * (1 - 1e-9) + 1e-9
RATE = (-np.log(_U[0]) - np.log(_U[1])).astype(np.float32)
LOG_C = np.log(-np.log(_U[2]) - np.log(_U[3])).astype(np.float32)
ODD_S = _SEED.integers(0, 1 << 62, SINGLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD_S = _SEED.integers(0, 1 << 62, SINGLES, dtype=np.uint64)
ODD_L = _SEED.integers(0, 1 << 62, LONG + FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD_L = _SEED.integers(0, 1 << 62, LONG + FINE, dtype=np.uint64)


def weighted_sets(col: pa.Array, idf: np.ndarray | None):
    """Distinct shingles of each text (sorted), their log weights and weights, and each text's first."""
    s, starts, _ = shingle_hashes(col)
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.uint64), np.diff(starts))
    key = np.sort((owner << np.uint64(44)) | (s >> np.uint64(20)))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.append(new, len(key))).astype(np.float32)
    key = key[new]
    first = np.searchsorted(key, np.arange(len(starts), dtype=np.uint64) << np.uint64(44))
    sh = key & np.uint64((1 << 44) - 1)
    weight = tf if idf is None else tf * idf[bucket(sh)]
    return sh, weight, first


def bucket(sh: np.ndarray) -> np.ndarray:
    return (mix64(sh) >> np.uint64(46)).astype(np.int64)


def document_frequencies(docs: DataFrame, repeats: bool = False) -> tuple[int, np.ndarray]:
    """Number of documents and the count table, added up over all documents; with ``repeats`` a shingle counts wherever it stands.

    Every task sends its table once, in ``PARTS`` parts; parts add up in two steps, so that no task gathers all tables.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            col = batch.column(0)
            for lo, hi in slices(col):
                part = col.slice(lo, hi - lo)
                sh = shingle_hashes(part)[0] >> np.uint64(20) if repeats else weighted_sets(part, None)[0]
                total += np.bincount(bucket(sh), minlength=BUCKETS)
            n += batch.num_rows
        lane = TaskContext.get().partitionId() % LANES
        step = BUCKETS // PARTS
        if n:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(range(PARTS), pa.int32()), "lane": pa.array([lane] * PARTS, pa.int32()),
                "n": pa.array([n] + [0] * (PARTS - 1), pa.int64()),
                "counts": pa.array([total[k * step:(k + 1) * step].astype("<i8").tobytes() for k in range(PARTS)], pa.binary())})

    def merge(key: tuple, batches: Iterator[pd.DataFrame] | pd.DataFrame) -> pd.DataFrame:
        pdf = batches
        total = np.zeros(BUCKETS // PARTS, np.int64)
        for raw in pdf["counts"]:
            total += np.frombuffer(raw, "<i8")
        return pd.DataFrame({"part": [key[0]], "lane": [0], "n": [int(pdf["n"].sum())], "counts": [total.tobytes()]})

    schema = "part int, lane int, n long, counts binary"
    parts = docs.select(text_or_empty().alias("text")).mapInArrow(count, schema)
    parts = parts.groupBy("part", "lane").applyInPandas(merge, schema).groupBy("part").applyInPandas(merge, schema)
    got = {r["part"]: r for r in parts.collect()}                   # PARTS rows of a fixed size
    if not got:
        return 0, np.zeros(BUCKETS, np.int64)
    return got[0]["n"], np.concatenate([np.frombuffer(got[k]["counts"], "<i8") for k in range(PARTS)])


def idf_table(n: int, counts: np.ndarray) -> np.ndarray:
    df = np.maximum(counts - np.median(counts), 1.0)
    ratio = np.clip(max(n, 1) / df, 1.0, RARE)
    return (1 - DAMP + DAMP * np.log(ratio) / np.log(RARE)).astype(np.float32)


def steep_table(n: int, counts: np.ndarray) -> np.ndarray:
    """Squared idf without damping or bound; a shingle of every document keeps a trace of weight."""
    df = np.maximum(counts - np.median(counts), 1.0)
    return np.maximum(np.log(max(n, 1) / df), 0.05).astype(np.float32) ** 2


def sample(sh: np.ndarray, weight: np.ndarray, first: np.ndarray, odd: np.ndarray = ODD, shift: np.ndarray = ADD,
           whole: bool = False) -> np.ndarray:
    """(texts, samples) samples of 32 bits, or of 64 (``whole``); a text without shingles has zeros.

    For a shingle of weight w and one sample: r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its hash,
    t = floor(ln w / r + b); the shingle with the least ln c - r (t - b) - r is drawn, together with t.
    Texts are taken in runs of about ``RUN`` shingles, so scratch arrays are small and stay in the processor's cache.
    """
    out = np.zeros((len(first) - 1, len(odd)), np.uint64 if whole else np.uint32)
    full = np.flatnonzero(np.diff(first) > 0)
    log_w, ends, at = np.log(weight), first[1:][full], 0
    while at < len(full):
        lo = int(first[full[at]])
        to = max(at + 1, int(np.searchsorted(ends, lo + RUN, "right")))
        hi = int(ends[to - 1])
        _sample_run(sh[lo:hi], log_w[lo:hi], first[full[at:to]] - lo, full[at:to], odd, shift, out, whole)
        at = to
    return out


def _sample_run(sh: np.ndarray, log_w: np.ndarray, begin: np.ndarray, texts: np.ndarray, odd: np.ndarray, shift: np.ndarray,
                out: np.ndarray, whole: bool) -> None:
    """``sample`` of successive texts that have shingles: ``begin`` are their first ones, ``texts`` their rows of ``out``."""
    m = len(sh)
    sizes, order = np.diff(np.append(begin, m)), np.arange(len(texts))
    x, y, place = (np.empty(m, np.uint64) for _ in range(3))
    r, t, b, c = (np.empty(m, np.float32) for _ in range(4))
    is_least = np.zeros(-(-m // 8) * 8, bool)
    sixteen = x.view("<u2").reshape(m, 4)
    rank, flip = c.view(np.int32), r.view(np.int32)
    for k in range(len(odd)):
        np.add(sh, shift[k], out=x)
        np.multiply(x, odd[k], out=x)
        x ^= np.right_shift(x, np.uint64(29), out=y)
        np.multiply(x, odd[-1 - k], out=x)
        x ^= np.right_shift(x, np.uint64(32), out=y)
        np.right_shift(y, np.uint64(16), out=place)          # the upper half of x is that of y, shifted
        np.take(RATE, place.view(np.int64), out=r, mode="clip")
        b[:] = sixteen[:, 1]
        b *= np.float32(1 / 65536)
        np.divide(log_w, r, out=t)
        t += b
        np.floor(t, out=t)
        np.subtract(t, b, out=b)
        b += np.float32(1)
        b *= r
        np.bitwise_and(y, np.uint64(0xFFFF), out=place)
        np.take(LOG_C, place.view(np.int64), out=c, mode="clip")
        c -= b
        # the bits of floats, as numbers in the order of the floats
        np.right_shift(rank, 31, out=flip)
        flip &= 0x7FFFFFFF
        rank ^= flip
        np.equal(rank, np.repeat(np.minimum.reduceat(rank, begin), sizes), out=is_least[:m])
        eights = np.flatnonzero(is_least.view(np.uint64))[:, None] * 8 + np.arange(8)       # few: most bytes are zero
        drawn = eights[is_least[eights]]
        xd, td = x[drawn], t[drawn].astype(np.int64).view(np.uint64)
        low = (xd ^ (xd >> np.uint64(20)) ^ (td * np.uint64(0x9E3779B1))) & np.uint64(0xFFFFFFFF)
        owner = order
        if len(drawn) > len(texts):                   # equal ranks: the least of the low bits is drawn
            owner = np.searchsorted(begin, drawn, "right") - 1
            least = np.full(len(texts), (1 << 64) - 1, np.uint64)
            np.minimum.at(least, owner, low)
            keep = low == least[owner]
            drawn, td, low, owner = drawn[keep], td[keep], low[keep], owner[keep]
        out[texts[owner], k] = mix64(sh[drawn] + (td << np.uint64(44))) if whole else low


def _signatures(idf: np.ndarray, steep: np.ndarray):
    """Keys of the bands and of the single samples, and one byte of every damped sample in three longs."""
    per_text = BANDS + SINGLES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(2)
            for lo, hi in slices(col):
                sh, tf, first = weighted_sets(col.slice(lo, hi - lo), None)
                sig = sample(sh, tf * idf[bucket(sh)], first).astype(np.uint64)
                single = sample(sh, tf * steep[bucket(sh)], first, ODD_S, ADD_S, whole=True)
                sketch = np.ascontiguousarray((sig & np.uint64(255)).astype(np.uint8)).view("<i8")
                keys = np.zeros((hi - lo, per_text), np.uint64)
                keys[:, BANDS:] = mix64(single + np.arange(1, SINGLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                for band in range(BANDS):
                    h = np.full(hi - lo, band + 1, np.uint64)
                    for row in range(ROWS):
                        h = mix64(h * np.uint64(0x2545F4914F6CDD1D) + sig[:, band * ROWS + row])
                    keys[:, band] = h
                flat = pa.array(keys.view(np.int64).ravel())
                bands = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * per_text, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), bands,
                     pa.array(np.diff(first) > 0), *[pa.array(sketch[:, k]) for k in range(3)]],
                    ["doc_id", "th", "bands", "wordy", *SKETCH])
    return run


def _verify(idf: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = 64
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                x, wx, fx = weighted_sets(part.column(2), idf)
                y, wy, fy = weighted_sets(part.column(3), idf)
                sims = []
                for k in range(part.num_rows):
                    i, j = slice(fx[k], fx[k + 1]), slice(fy[k], fy[k + 1])
                    _, p, q = np.intersect1d(x[i], y[j], assume_unique=True, return_indices=True)
                    both = float(np.minimum(wx[i][p], wy[j][q]).sum(dtype=np.float64))
                    all_ = float(wx[i].sum(dtype=np.float64) + wy[j].sum(dtype=np.float64)) - both
                    sims.append(both / all_ if all_ else 0.0)
                sims = np.array(sims)
                near = pa.array(sims >= threshold)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(near), part.column(1).filter(near), pa.array(sims[sims >= threshold])],
                    ["a", "b", "similarity"])
    return run


def _sketches(idf: np.ndarray, odd: np.ndarray, shift: np.ndarray):
    """One byte of each of the damped samples that ``odd`` and ``shift`` draw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, once = np.unique(batch.column(0).to_numpy(), return_index=True)
            if len(once) < batch.num_rows:
                batch = batch.take(pa.array(np.sort(once)))
            col = batch.column(1)
            for lo, hi in slices(col):
                sig = sample(*weighted_sets(col.slice(lo, hi - lo), idf), odd, shift)
                sketch = np.ascontiguousarray((sig & np.uint32(255)).astype(np.uint8)).view("<i8")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *[pa.array(np.ascontiguousarray(c)) for c in sketch.T]],
                                                 ["th", *[f"l{k}" for k in range(sketch.shape[1])]])
    return run


def sketched(texts: DataFrame, some: DataFrame, idf: np.ndarray, odd: np.ndarray, shift: np.ndarray) -> DataFrame:
    """(th, l0, l1, ...) of the texts (th, text) whose th is in ``some`` (landed, distinct), and perhaps of few others; no text is shuffled."""
    schema = "th long, " + ", ".join(f"l{k} long" for k in range(len(odd) // 8))
    few, _ = parted(texts, some)
    return land(few.select("th", "text").mapInArrow(_sketches(idf, odd, shift), schema).dropDuplicates(["th"]))


def agreeing(x: str, y: str) -> Column:
    """Of the damped samples of two rows (column aliases), how many agree in the byte that the sketch holds."""
    same = [F.shiftrightunsigned(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}")), 8 * k).bitwiseAND(F.lit(255)) == 0
            for s in SKETCH for k in range(8)]
    return reduce(add, [c.cast("int") for c in same])


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def shared_keys(keyed: DataFrame) -> DataFrame:
    """(th, key, leader) of the buckets that hold several texts, from distinct (th, key); most keys are one text's alone."""
    leaders = (keyed.groupBy("key").agg(F.min_by("th", F.xxhash64("th", "key")).alias("leader"), F.count(F.lit(1)).alias("n"))
               .where("n > 1").drop("n"))
    return keyed.join(leaders, "key").select("th", "key", "leader")


def candidate_pairs(keyed: DataFrame) -> DataFrame:
    """Distinct (a, b) from (th, key) or the result of ``shared_keys``: every member of a bucket with its leader."""
    shared = keyed if "leader" in keyed.columns else shared_keys(keyed)
    return (shared.where(F.col("th") != F.col("leader"))
            .select(F.least("th", "leader").alias("a"), F.greatest("th", "leader").alias("b")).distinct())


def likely_pairs(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) with enough equal samples, from one sketch per text (th, SKETCH)."""
    return (pairs.join(sketches.alias("x"), F.col("a") == F.col("x.th")).join(sketches.alias("y"), F.col("b") == F.col("y.th"))
            .where(agreeing("x", "y") >= SKETCH_LEAST).select("a", "b"))


def open_buckets(keyed: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, th, root, blocks, own) of the buckets that hold texts of different classes (v, root); ``own``: the member's block."""
    classed = land(keyed.join(roots.withColumnRenamed("v", "th"), "th", "left").withColumn("root", F.coalesce("root", "th")))
    mixed = (classed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
             .where("lo < hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    return land(classed.join(mixed, "key").withColumn("own", F.pmod(F.xxhash64("th", F.lit(1)), F.col("blocks")).cast("int")))


def alike(x: np.ndarray, y: np.ndarray, least: int) -> np.ndarray:
    """(rows of x, rows of y): whether both sketches of two rows agree enough; a row holds one byte of every sample, the short sketch first."""
    short = 8 * len(SKETCH)
    if len(x) * len(y) <= 1024:
        same = x[:, None, :] == y[None, :, :]
        return (same[:, :, :short].sum(2) >= SKETCH_LEAST) & (same[:, :, short:].sum(2) >= least)
    xt, yt = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    total, first = np.zeros((len(x), len(y)), np.uint8), None
    for k in range(x.shape[1]):
        if k == short:
            first, total = total >= SKETCH_LEAST, np.zeros_like(total)
        total += xt[k][:, None] == yt[k][None, :]
    return first & (total >= least)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Each run of rows with equal first three columns: its numbers, and its texts where there is a column ``text``."""
    def joined(parts: list) -> tuple[np.ndarray, pa.Array]:
        return np.concatenate([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts])

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index("text")
        texts = batch.column(at) if at >= 0 else pa.nulls(batch.num_rows, pa.string())
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for k, c in enumerate(batch.columns) if k != at])
        cut = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1)) + 1
        for lo, hi in zip(np.append(0, cut), np.append(cut, len(rows))):
            if held and (held[-1][0][-1, :3] != rows[lo, :3]).any():
                yield joined(held)
                held = []
            held.append((rows[lo:hi], texts.slice(lo, hi - lo)))
    if held:
        yield joined(held)


def _sides(g: np.ndarray) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether a group is one block, and the rows of its two blocks; the first columns are key, b1, b2, own, th, root."""
    if g[0, 1] == g[0, 2]:
        return True, np.arange(len(g)), np.arange(len(g))
    return False, np.flatnonzero(g[:, 3] == g[0, 1]), np.flatnonzero(g[:, 3] == g[0, 2])


def _pairs_of(g: np.ndarray, least: int, long: int, home: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, rows) of a group that are of different classes and pass both sketches, the second of ``long`` numbers; with ``home`` a pair
    counts only where the group's key is the least of the keys that both rows have (the last columns)."""
    one, x, y = _sides(g)
    last = 6 + len(SKETCH) + long
    bytes_of = lambda rows: np.ascontiguousarray(g[rows, 6:last]).view(np.uint8)                     # noqa: E731
    far = bytes_of(y)
    for lo in range(0, len(x), 256):
        part = x[lo:lo + 256]
        ok = alike(bytes_of(part), far, least) & (g[part, 5][:, None] != g[y, 5][None, :])
        if one:
            ok &= g[part, 4][:, None] < g[y, 4][None, :]            # both orders meet: one is taken
        i, j = np.nonzero(ok)
        i, j = part[i], y[j]
        for at in range(0, len(i) if home else 1, 4096):
            p, q = (i[at:at + 4096], j[at:at + 4096]) if home else (i, j)
            if home:
                # a key that both have and that is less than this one is the pair's home
                less = lambda rows: np.where(g[rows, last:] < g[0, 0], g[rows, last:], g[0, 0])      # noqa: E731
                u, v, earlier = less(p), less(q), np.zeros(len(p), bool)
                for k in range(v.shape[1]):
                    earlier |= ((u == v[:, k:k + 1]) & (u != g[0, 0])).any(1)
                p, q = p[~earlier], q[~earlier]
            yield p, q


def _met(least: int, long: int, home: bool):
    """The rows (key, th, root) of each group that are in any of its pairs, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, _ in _groups(batches):
            met = np.zeros(len(g), bool)
            for p, q in _pairs_of(g, least, long, home):
                met[p] = met[q] = True
            yield pa.RecordBatch.from_arrays([pa.array(g[met, k]) for k in (0, 4, 5)], ["key", "th", "root"])
    return run


def _links(least: int, long: int, idf: np.ndarray, threshold: float):
    """Links of each group, from the exact weighted Jaccard similarity of its pairs' texts; a pair that the group's links so far connect adds
    nothing to the classes, so a group of m texts makes m - 1 links at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, texts in _groups(batches):
            sh, weight, first = weighted_sets(texts, idf)
            _, place = np.unique(sh, return_inverse=True)
            dense = np.zeros(int(place.max(initial=-1)) + 1, np.float32)
            total = [float(weight[first[k]:first[k + 1]].sum(dtype=np.float64)) for k in range(len(g))]
            _, cls = np.unique(g[:, 5], return_inverse=True)
            up = list(range(int(cls.max()) + 1))

            def top(c: int) -> int:
                while up[c] != c:
                    up[c] = c = up[up[c]]
                return c

            a, b = [], []
            for p, q in _pairs_of(g, least, long, True):
                spread = -1
                for i, j in zip(p.tolist(), q.tolist()):
                    s, t = top(int(cls[i])), top(int(cls[j]))
                    if s == t:
                        continue
                    if spread != i:
                        if spread >= 0:
                            dense[place[first[spread]:first[spread + 1]]] = 0
                        dense[place[first[i]:first[i + 1]]] = weight[first[i]:first[i + 1]]
                        spread = i
                    own = slice(first[j], first[j + 1])
                    both = float(np.minimum(dense[place[own]], weight[own]).sum(dtype=np.float64))
                    all_ = total[i] + total[j] - both
                    if all_ and both / all_ >= threshold:
                        up[s] = t
                        a.append(min(g[i, 4], g[j, 4]))
                        b.append(max(g[i, 4], g[j, 4]))
                if spread >= 0:
                    dense[place[first[spread]:first[spread + 1]]] = 0
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def dealt(members: DataFrame, *extra: str) -> DataFrame:
    """Members (key, th, root, blocks, own, ...) as rows of each pair of blocks of their bucket, sorted by (key, b1, b2).

    Each pair of blocks of a bucket is a key of its own, so a large bucket is spread over tasks; a task holds two blocks at a time.
    """
    rows = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "th", "root", *extra)
    at = ["key", "b1", "b2"]
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *at).sortWithinPartitions(*at)


def more_links(keyed: DataFrame, sketches: DataFrame, links: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Links between members of a bucket that its leader did not bring into one class.

    No pair leaves a task: the first two passes leave the members that have a pair, by the longer and by the fine sketch, and the third reads
    the texts of those, in blocks of about ``BLOCK_BYTES``, and leaves a forest of links.  A pair that shares several buckets counts in one.
    """
    met = "key long, th long, root long"
    members = open_buckets(keyed, connected_components(links))
    longer = sketched(texts, land(members.select("th").distinct()), idf, ODD_L[:LONG], ADD_L[:LONG])
    columns = [*SKETCH, *longer.drop("th").columns]
    some = land(dealt(members.join(sketches, "th").join(longer, "th"), *columns)
                .mapInArrow(_met(LONG_LEAST, LONG // 8, False), met).select("th").distinct())
    fine = sketched(texts, some, idf, ODD_L[LONG:], ADD_L[LONG:])
    # a text has one key of every band and single sample at most
    homes = keyed.join(some, "th", "left_semi").groupBy("th").agg(F.sort_array(F.collect_set("key")).alias("keys")).select(
        "th", *[F.coalesce(F.get("keys", F.lit(k)), F.lit((1 << 63) - 1)).alias(f"k{k}") for k in range(BANDS + SINGLES)])
    known = land(sketches.join(fine, "th").join(homes, "th"))
    columns = known.drop("th").columns
    pairs = land(dealt(members.join(known, "th"), *columns).mapInArrow(_met(FINE_LEAST, FINE // 8, True), met).distinct())
    few = land(rows_with(texts, land(pairs.select("th").distinct())).dropDuplicates(["th"]).select("th", "text"))
    blocks = pairs.join(few, "th").groupBy("key").agg(
        F.ceil(F.sum(F.octet_length("text").cast("long")) / BLOCK_BYTES).cast("int").alias("blocks"))
    again = (pairs.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("th", F.lit(2)), F.col("blocks")).cast("int"))
             .join(known, "th").join(few, "th"))
    return dealt(again, *columns, "text").mapInArrow(_links(FINE_LEAST, FINE // 8, idf, threshold), "a long, b long")


def near_classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Per row: doc_id, th (text hash), class_id, class_size, kept."""
    n, counts = document_frequencies(docs)
    idf = idf_table(n, counts)
    rows = docs.select("doc_id", text_hash(text_or_empty()).alias("th"), text_or_empty().alias("text"))
    sketch = ", ".join(f"{s} long" for s in SKETCH)
    sigs = land(rows.mapInArrow(_signatures(idf, steep_table(n, counts)), f"doc_id long, th long, bands array<long>, wordy boolean, {sketch}")
                .withColumn("rid", F.monotonically_increasing_id()))
    once = land(sigs.where("wordy").select("th", "bands", *SKETCH).dropDuplicates(["th"]))
    shared = land(shared_keys(once.select("th", F.explode(F.array_distinct("bands")).alias("key"))))
    keyed, sketches = shared.select("th", "key"), once.select("th", *SKETCH)
    pairs = land(likely_pairs(land(candidate_pairs(shared)), sketches))
    texts = rows.select("th", "text")
    links = land(pair_texts(pairs, texts).mapInArrow(_verify(idf, threshold), "a long, b long, similarity double").select("a", "b"))
    links = land(links.union(more_links(keyed, sketches, links, texts, idf, threshold)))
    roots = land(connected_components(links))
    classed = sigs.select("doc_id", "th", "rid").join(roots.withColumnRenamed("v", "th"), "th", "left").select(
        "doc_id", "th", "rid", F.coalesce("root", "th").alias("root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    classes = land(classed.groupBy("root").agg(first.alias("first"), F.count(F.lit(1)).alias("class_size")))
    return classed.join(classes, "root").select(
        "doc_id", "th", F.col("first.doc_id").alias("class_id"), F.col("class_size").cast("long"),
        (F.col("rid") == F.col("first.rid")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    return keep_rows(docs, near_classes(docs, threshold).withColumnRenamed("th", "hash"), text_hash(text_or_empty()))
