"""Mixing sources to target weights by the cube method.

Targets: the sources, by code point with null last, weigh 5, 2, 1, repeating, and share ``share`` of
all words; no target exceeds ``most`` times its source's words, and what that leaves over is shared
again by weight until none does.  The final level is found from running sums over the per-source totals.

Selection: a source's rate = target / words gives every document floor(rate) copies and an
inclusion probability for one more.  The flight phase moves three fractional probabilities at a time along
the null space of the two constraints (words, documents) -- for sizes s1, s2, s3 the direction
(s2 - s3, s3 - s1, s1 - s2) -- until one of them is 0 or 1, so both totals stay exactly what they
were.  Flights run on blocks of about ``BLOCK`` documents of one source; each leaves at most two
fractional documents, ``FAN`` blocks' rests fly again together, and so on until one block per source is left.
A source's first block leaves ``POOL`` documents out of every flight; they and the last two fractional ones land together
on the combination nearest to the word total (2**(POOL + 2) combinations, whatever the source's size).  Only (doc_id, source, size, text hash) travel.

Defined cases: a null or empty text has size 0 (it may be taken, which takes no words); a null
source is a source of its own; repeated rows are separate documents; a source without words has
target 0; an empty table gives an empty result; extra columns are ignored, or passed through by ``mix_rows``.
Reruns agree: blocks, order and random numbers come from the rows and ``seed`` alone.
"""

from __future__ import annotations

import itertools
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import fresh, land, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK, FAN, POOL = 2000, 512, 10
EPS = 1e-9
# the per-source table is broadcast up to this many rows; beyond, it is joined by shuffling
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """One row per source: source, rank, source_size, n, target, rate.

    The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights)).cast("int"))
    per = per.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", weight)
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    per = (per.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
           .withColumn("k", F.row_number().over(order))
           .withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("level", (F.col("total") - F.col("before")) / F.col("left")))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    per = per.withColumn("level", F.min_by("level", F.when(fits, F.col("k"))).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return per.select("source", "rank", "source_size", "n", target.alias("target"),
                      F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def _direction(s: list[float]) -> tuple[float, ...] | None:
    """A move that keeps both totals, or None."""
    if len(s) == 3:
        u = (s[1] - s[2], s[2] - s[0], s[0] - s[1])
        return u if any(u) else (1.0, -1.0, 0.0)
    if len(s) == 2 and s[0] == s[1]:
        return (1.0, -1.0)
    return None


def flight(size: np.ndarray, pi: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: 0 or 1 but for two at most; sum(pi) and sum(pi * size) stay."""
    p, s = pi.astype(float).tolist(), size.astype(float).tolist()
    for k, v in enumerate(p):
        p[k] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v
    waiting = iter([k for k, v in enumerate(p) if 0.0 < v < 1.0])
    luck = iter(rng.random(2 * len(p) + 4).tolist())
    active = list(itertools.islice(waiting, 3))
    while (u := _direction([s[k] for k in active])) is not None:
        up = min([(1.0 - p[k]) / d if d > 0 else p[k] / -d for k, d in zip(active, u) if d])
        down = min([p[k] / d if d > 0 else (1.0 - p[k]) / -d for k, d in zip(active, u) if d])
        step = up if next(luck) * (up + down) < down else -down
        for k, d in zip(active, u):
            v = p[k] + step * d
            p[k] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v
        active = [k for k in active if 0.0 < p[k] < 1.0]
        active += itertools.islice(waiting, 3 - len(active))
    return np.array(p)


def landing(size: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """Settle the few fractional values on the combination nearest to the word, then document total."""
    open_ = np.flatnonzero((pi > 0) & (pi < 1))
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    words = np.abs((ways - pi[open_]) @ size[open_].astype(float)).round(6)
    rows = np.abs(ways.sum(1) - pi[open_].sum()).round(6)
    out = pi.copy()
    out[open_] = ways[np.lexsort((rows, words))[0]]
    return out


def _fly(seed: int, level: int, last: bool):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "size", "doc_id", "th"], kind="stable", na_position="first")
        size, out = pdf["size"].to_numpy(), pdf["pi"].to_numpy().copy()
        cut = max(0, len(out) - POOL) if int(key[1]) == 0 else len(out)
        out[:cut] = flight(size[:cut], out[:cut], np.random.default_rng([seed, level, int(key[0]), int(key[1])]))
        settled = np.where(out < EPS, 0.0, np.where(out > 1 - EPS, 1.0, out))
        return pdf.assign(pi=landing(size, settled) if last else settled, block=pdf["block"] // FAN)
    return run


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS, seed: int = 7) -> DataFrame:
    """Per row: doc_id, source, th (text hash), size, source_size, target, copies, taken."""
    sizes = land(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                             F.xxhash64(text_or_empty()).alias("th")))
    targets = land(source_targets(sizes, share, most, weights))
    known = targets.agg(F.count(F.lit(1)), F.max("n")).first()
    side = F.broadcast(targets) if known[0] <= BROADCAST_SOURCES else targets
    whole = F.floor(F.col("rate")).cast("int")
    cur = sizes.join(side.withColumnRenamed("source", "src"), F.col("source").eqNullSafe(F.col("src"))).select(
        "doc_id", "source", "size", "th", "rank", "source_size", "target", whole.alias("whole"),
        (F.col("rate") - whole).alias("pi"),
        F.pmod(F.xxhash64("doc_id", "size", "th"), F.ceil(F.col("n") / BLOCK)).cast("long").alias("block"),
        F.xxhash64(F.lit(seed), "doc_id", "th").alias("order"))
    blocks, level, done = max(1, -(-int(known[1] or 0) // BLOCK)), 0, []
    while True:
        last = blocks == 1
        cur = land(cur.groupBy("rank", "block").applyInPandas(_fly(seed, level, last), cur.schema))
        if last:
            done.append(cur)
            break
        settled = (F.col("pi") == 0) | (F.col("pi") == 1)
        done.append(cur.where(settled))
        cur, blocks, level = cur.where(~settled), -(-blocks // FAN), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = (F.col("whole") + F.col("pi")).cast("int")
    return out.select("doc_id", "source", "th", "size", "source_size", "target", copies.alias("copies"),
                      (F.col("size") * copies).cast("long").alias("taken"))


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    i, s, h, n, c = fresh(docs, "m_doc", "m_src", "m_hash", "m_n", "m_copies")
    plan = mix(docs, **options).groupBy(F.col("doc_id").alias(i), F.col("source").alias(s), F.col("th").alias(h)).agg(
        F.count(F.lit(1)).alias(n), F.sum("copies").cast("int").alias(c)).where(F.col(c) > 0)
    rows = docs.withColumn(h, F.xxhash64(text_or_empty())).alias("l").join(
        plan.alias("r"), (F.col(f"l.{h}") == F.col(f"r.{h}")) & F.col("doc_id").eqNullSafe(F.col(i))
        & F.col("source").eqNullSafe(F.col(s))).select("l.*", n, c)
    again = rows.where(F.col(n) > 1).dropDuplicates(["doc_id", "source", h])      # repeated rows share their copies
    return (rows.where(F.col(n) == 1).unionByName(again)
            .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(c)))).select(*docs.columns))
