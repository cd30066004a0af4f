"""Reproducible shuffle into shards by a Feistel permutation (built-in functions only).

Rows get global numbers 0..N-1 in ``doc_id`` order.  A Feistel network over Z_a x Z_b, the
smallest near-square grid with a*b >= N, permutes the numbers; a value that lands at N or beyond is
permuted again until it falls below N (cycle walking).  The permuted number p gives shard p mod S
and slot p div S, so both are computable from the row number and the key alone, shard counts are at
most one apart, and slots have no gaps: the law is ``rows``.

From a start below N a walk only visits the a*b - N < a values beyond N, each once, so ``WALKS``
steps are proven enough up to N = WALKS**2; beyond, a walk of that length has a chance below
WALKS**-WALKS, and a row that would need more raises an error rather than take a wrong place.

Defined cases: a null text has size 8 and crc32 0; rows with equal doc_id are numbered by text, repeated
rows in any order (they are interchangeable); an empty table gives an empty result; more shards than
rows leave shards empty; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import ensure_checkpoint_dir, let, text_or_empty
from gazette.operators.ordering import ranked

PRIME = 2147483647
ROUNDS, WALKS = 6, 32


def round_keys(key: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Pairs below PRIME from a linear congruential sequence started at ``key``."""
    out, x = [], key % PRIME
    for _ in range(rounds):
        x = (x * 48271 + 11) % PRIME
        add = x
        x = (x * 48271 + 11) % PRIME
        out.append((add, x | 1))
    return out


def grid(n: int) -> tuple[int, int]:
    """Sides of the grid that holds n numbers: a = ceil(sqrt(n)), b = ceil(n / a)."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _mix(x: Column, add: int, mul: int) -> Column:
    """Round function: two squarings and a multiplication modulo PRIME; products stay below 2**62."""
    p = F.lit(PRIME).cast("long")

    def square(u: Column) -> Column:
        return let(((u * u) % p * F.lit(mul).cast("long") + u) % p, lambda v: (v * v + u) % p)

    return let((x + F.lit(add).cast("long")) % p, square)


def _round(i: int, add: int, mul: int, la: Column, lb: Column):
    """One round: even rounds change l by a function of r, odd rounds r by a function of l."""
    if i % 2 == 0:
        return lambda s: F.struct(((s["l"] + _mix(s["r"], add, mul)) % la).alias("l"), s["r"].alias("r"))
    return lambda s: F.struct(s["l"].alias("l"), ((s["r"] + _mix(s["l"], add, mul)) % lb).alias("r"))


def _permute(x: Column, a: int, b: int, keys: list[tuple[int, int]]) -> Column:
    """One pass of the network over x = r * a + l; each round's state is evaluated once."""
    la, lb = F.lit(a).cast("long"), F.lit(b).cast("long")
    state = F.struct((x % la).alias("l"), F.call_function("div", x, la).alias("r"))
    for i, (add, mul) in enumerate(keys):
        state = let(state, _round(i, add, mul, la, lb))
    return let(state, lambda s: s["r"] * la + s["l"])


def feistel(number: Column, n: int, key: int) -> Column:
    """Permutation of 0..n-1 at ``number`` (long)."""
    a, b = grid(n)
    keys = round_keys(key)
    end = F.lit(n).cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), _permute(number, a, b, keys),
        lambda x, _: F.when(x < end, x).otherwise(_permute(x, a, b, keys)))
    return F.when(walked < end, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def shard(docs: DataFrame, shards: int = 24, key: int = 2024) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    if shards < 1:
        raise ValueError("shards must be positive")
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(
        "doc_id", (F.octet_length(text_or_empty()) + 8).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).cast("long").alias("text_crc32"), F.monotonically_increasing_id().alias("tie"))
    numbered = ranked(rows, [], [F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc(),
                                 F.col("tie").asc()], "number")
    n = numbered.count()
    place = feistel(F.col("number") - 1, n, key)
    return numbered.withColumn("place", place).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", F.col("place"), F.lit(shards).cast("long")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
