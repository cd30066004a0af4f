"""Exact de-duplication by content-defined chunk recipes (built-in functions only).

A text is lower-cased (A-Z only) and cut into units that end at sentence punctuation or a line
break (200 code points at most); a chunk ends after a unit whose hash is 0 modulo ``CUT``, or after
``MAX_UNITS`` units, so equal passages give equal chunks wherever they stand.  A chunk's identifier
is 128 bits of hash.  The chunk dictionary -- every distinct chunk text once, combined before its
only shuffle -- proves that no identifier stands for two texts; should one do, the next wider identifier
is tried.  A document then is its ordered identifier list, a few dozen bytes: grouping and joining
compare these lists, so long texts are not moved again.

Defined cases: a null text counts as empty; equal texts form one group whatever other columns hold;
the row with the largest ``doc_id`` stays (null is smallest), and of repeated rows with that doc_id
exactly one; an empty table gives an empty result; extra columns are ignored, or passed through by
``drop_exact_duplicates``.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import ascii_lower, keep_rows, land, let, text_or_empty

UNIT = r"(?s)[^.!?\n]{0,200}+(?:[.!?\n]++\s{0,16}+|.)|[^.!?\n]++\z"
CUT, MAX_UNITS = 8, 64


def id128(c: Column) -> Column:
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))


def id256(c: Column) -> Column:
    return F.sha2(c, 256)


def chunks_of(text: Column) -> Column:
    """Array of chunks; joined, they give ``text`` back.  Empty for an empty text."""
    def ends(units: Column) -> Column:
        last = F.size(units) - 1
        return F.filter(F.sequence(F.lit(0), last), lambda i: (
            F.pmod(F.xxhash64(F.get(units, i)), F.lit(CUT)) == 0) | (i == last))

    def runs(ends: Column) -> Column:
        return F.flatten(F.transform(ends, lambda e, k: F.transform(
            F.sequence(F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1), e, F.lit(MAX_UNITS)),
            lambda s: F.struct(s.alias("s"), F.least(F.lit(MAX_UNITS), e - s + 1).alias("n")))))

    def cut(units: Column) -> Column:
        return F.transform(let(ends(units), runs), lambda r: F.array_join(F.slice(units, r["s"] + 1, r["n"]), ""))

    none = F.array().cast("array<string>")
    return F.when(F.length(text) > 0, let(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), cut)).otherwise(none)


def _one_to_one(chunked: DataFrame, ident: Callable[[Column], Column]) -> bool:
    """Does every identifier stand for one chunk text?  Moves each distinct chunk once."""
    book = (chunked.select(F.explode("chunks").alias("chunk"))
            .select("chunk", ident(F.col("chunk")).alias("id")).distinct())
    return book.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def exact_groups(docs: DataFrame, idents: Sequence[Callable[[Column], Column]] = (id128, id256)) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    norm = docs.select("doc_id", ascii_lower(text_or_empty()).alias("norm"))
    chunked = norm.withColumn("chunks", chunks_of(F.col("norm")))
    for ident in idents:
        if _one_to_one(chunked, ident):
            break
    else:
        raise RuntimeError("no identifier tells all chunks apart")
    recipes = land(chunked.select(
        "doc_id", F.sha2("norm", 256).alias("text_sha256"), F.transform("chunks", lambda c: ident(c)).alias("recipe"),
        F.monotonically_increasing_id().alias("rid")))
    # landed, so that both sides of the join are plain shuffles and AQE can split a recipe that many rows share
    groups = land(recipes.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).cast("long").alias("group_size")))
    return recipes.join(groups, "recipe").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("keep.rid") == F.col("rid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, land(exact_groups(docs)).withColumnRenamed("text_sha256", "hash"),
                     F.sha2(ascii_lower(text_or_empty()), 256))
