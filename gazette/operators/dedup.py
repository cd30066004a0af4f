"""Near-duplicate titles and first-come de-duplication inside a run.

``similar_titles`` finds ordered pairs of *distinct* normalised titles with a
Ratcliff-Obershelp ratio of at least 0.75, without a cross join:

* a title is the set of tokens (character, k-th occurrence), so the character
  multiset overlap of two titles is the size of their token intersection;
* a match needs ``2M/(la+lb) >= 0.75`` with ``M <= overlap <= min(la, lb)``,
  hence ``overlap >= ceil(0.6 * len)`` on both sides.  Under one global token
  order per run (rarest first), two such titles share a token among each one's
  first ``len - ceil(0.6 * len) + 1`` tokens (prefix filtering) -- an equi-join
  on token that loses no match;
* candidates, pairs of title numbers, then pass the length band, an edit-distance
  bound (ratio <= 1 - levenshtein / (la + lb)) and the exact overlap bound natively;
* only the survivors reach ``difflib`` in an Arrow-batched UDF, both argument
  orders (the ratio is not symmetric).

Equal titles never become pairs: every entry is mapped to its title and equal
titles are handled as one group, so a title repeated by a third of all rows
costs one aggregate, not a quadratic pair list.

``dedup_greedy`` reproduces the sequential rule (an entry is dropped when its
link equals, or its title is similar to, that of an *accepted earlier* entry of
the run) with rounds of aggregates over link groups, title groups and title
edges; see ``greedy_rounds``.
"""

from __future__ import annotations

import difflib
import logging
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from .. import config as C

_STATUS_UNDECIDED, _STATUS_ACCEPTED, _STATUS_REJECTED, _STATUS_CANDIDATE = 0, 1, 2, 3
log = logging.getLogger(__name__)


@pandas_udf(StructType([StructField("rxy", DoubleType()), StructField("ryx", DoubleType())]))
def title_ratios(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Both argument orders of the ratio in one pass (it is not symmetric)."""
    fwd = [difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)]
    bwd = [difflib.SequenceMatcher(None, y, x).ratio() for x, y in zip(a, b)]
    return pd.DataFrame({"rxy": fwd, "ryx": bwd})


def _tokens(t: Column) -> Column:
    """array<string> of ``char#k`` tokens: the k-th occurrence of each character."""
    chars = F.regexp_extract_all(t, F.lit(r"(?s)."), 0)
    return F.transform(chars, lambda c, i: F.concat(c, F.lit("#"),
                                                    F.size(F.filter(F.slice(chars, 1, i), lambda x: x == c)).cast("string")))


def similar_titles(titles: DataFrame, group: str, title: str,
                   threshold: float = C.SIMILARITY_THRESHOLD) -> DataFrame:
    """Directed pairs ``(group, new_title, old_title, ratio)`` of distinct non-empty titles
    with ``ratio(new, old) >= threshold``; ratio computed as in the reference (new first)."""
    if abs(threshold - 0.75) > 1e-12:
        raise ValueError("the lossless bounds are derived for the 0.75 threshold")
    t = (titles.select(F.col(group).alias("g"), F.col(title).alias("t"))
         .where(F.length("t") > 0).distinct()
         .withColumn("len", F.length("t"))
         .withColumn("id", F.monotonically_increasing_id())
         .checkpoint(eager=True))   # the title dictionary: read below; its numbers, not titles, travel with tokens and pairs
    tok = t.select("g", "id", "len", F.explode(_tokens(F.col("t"))).alias("tok"))
    freq = tok.groupBy("g", "tok").agg(F.count(F.lit(1)).alias("df"))
    ranked = (tok.join(freq, ["g", "tok"])
              .groupBy("g", "id", "len")
              .agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("_o")))
    # prefix length: len - ceil(0.6 len) + 1  (integer form of ceil(3 len / 5))
    plen = F.col("len") - F.floor((F.col("len") * 3 + 4) / 5) + 1
    prefix = ranked.select("g", "id", "len", F.explode(F.slice("_o", 1, plen.cast("int"))).alias("_p")) \
                   .select("g", "id", "len", F.col("_p.tok").alias("tok"))
    a, b = prefix.alias("a"), prefix.alias("b")
    cand = (a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.tok") == F.col("b.tok"))
                   & (F.col("a.id") < F.col("b.id"))
                   & (F.least("a.len", "b.len") * 5 >= F.greatest("a.len", "b.len") * 3))     # min/max >= 0.6
            .select(F.col("a.id").alias("ix"), F.col("b.id").alias("iy"))
            .distinct())
    tx = t.select("g", F.col("id").alias("ix"), F.col("t").alias("x"), F.col("len").alias("lx"))
    ty = t.select(F.col("id").alias("iy"), F.col("t").alias("y"), F.col("len").alias("ly"))
    c = cand.join(tx, "ix").join(ty, "iy")
    # matching blocks form a common subsequence, so ratio <= 1 - levenshtein / (la + lb):
    # a match needs 4 * levenshtein <= la + lb (native, before any Python)
    near = F.levenshtein("x", "y") * 4 <= F.col("lx") + F.col("ly")
    # the tokens of the few pairs that are left are made here again, rather than carried with every candidate
    overlap = F.size(F.array_intersect(_tokens(F.col("x")), _tokens(F.col("y"))))
    c = c.where(F.when(near, overlap * 8 >= (F.col("lx") + F.col("ly")) * 3).otherwise(False))
    # exact ratios: spread the Python work over all shuffle partitions, one UDF call per pair
    n = int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    c = c.select("g", "x", "y").repartition(n, "g", "x", "y").withColumn("r", title_ratios("x", "y"))
    both = F.array(F.struct(F.col("x").alias("new_title"), F.col("y").alias("old_title"), F.col("r.rxy").alias("ratio")),
                   F.struct(F.col("y").alias("new_title"), F.col("x").alias("old_title"), F.col("r.ryx").alias("ratio")))
    out = c.select("g", F.inline(F.filter(both, lambda p: p["ratio"] >= F.lit(threshold))))
    return out.withColumnRenamed("g", group)


def _judged(work: DataFrame, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Candidates that ``judge`` fails are rejected, the others accepted."""
    candidate = F.col("status") == _STATUS_CANDIDATE
    asked = work.where(candidate)
    if asked.isEmpty():
        return work
    failed = judge(asked.select("run", "o", "link", "t")).select("run", "o").distinct().withColumn("_failed", F.lit(True))
    status = (F.when(candidate & F.col("_failed").isNotNull(), F.lit(_STATUS_REJECTED))
              .when(candidate, F.lit(_STATUS_ACCEPTED)).otherwise(F.col("status")))
    return work.join(failed, ["run", "o"], "left").select(*[status.alias(c) if c == "status" else F.col(c) for c in work.columns]).checkpoint(eager=True)


def greedy_rounds(nodes: DataFrame, edges: DataFrame, holds: DataFrame | None = None,
                  judge: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """First-come acceptance over conflict groups.

    ``nodes(run, o, link, t)``: ``o`` orders entries inside a run (unique), ``t`` the
    normalised title ('' never conflicts).  ``edges(run, new_title, old_title)``: title
    pairs where a *later* entry titled ``new_title`` is blocked by an earlier accepted
    ``old_title``.  ``holds(run, since)``, one row per run: links accepted in an earlier run
    from ``since`` on are still in the state that the run starts from (without ``holds`` runs do not see
    each other).  Returns ``nodes`` with ``accepted`` boolean.

    Round rule, from the statuses at the start of the round: an undecided node is rejected when an
    accepted entry conflicts with it and comes before it, and accepted when no undecided one does.
    The earliest undecided node always decides, so the loop ends, and the
    result equals the sequential pass.  Conflicts are found in group minima (per link and run, per
    title, per title edge) and, across runs, in a window over one row per link and run,
    which the calendar bounds; equal links or titles never expand into pairs.  Each round
    is checkpointed into the shared folder.

    ``judge`` (the model stage) gets the nodes (run, o, link, t) that nothing blocks any more, each exactly once, and
    returns those (run, o) that fail.  A failed node is rejected and blocks nobody, so what it would have blocked is
    decided later: the accepted nodes, and the nodes that were judged, are those of the sequential pass that judges as it goes.
    """
    n = nodes.select("run", "o", "link", "t")
    link_n = n.groupBy("link" if holds is not None else F.struct("run", "link").alias("link")).agg(F.count(F.lit(1)).alias("_nl"))
    if holds is None:
        link_n = link_n.select("link.run", "link.link", "_nl")
    title_n = n.where(F.col("t") != "").groupBy("run", "t").agg(F.count(F.lit(1)).alias("_nt"))
    # edges and node statuses are read every round: land them once
    e = edges.select("run", F.col("new_title").alias("t"), F.col("old_title").alias("y")).checkpoint(eager=True)
    has_edge = e.select("run", "t").union(e.select("run", F.col("y").alias("t"))).distinct() \
                .withColumn("_ne", F.lit(1))
    n = (n.join(link_n, ["link"] if holds is not None else ["run", "link"], "left").join(title_n, ["run", "t"], "left")
          .join(has_edge, ["run", "t"], "left"))
    lonely = (F.col("_nl") == 1) & (F.coalesce(F.col("_nt"), F.lit(1)) == 1) & F.col("_ne").isNull()
    n = (n.withColumn("status", F.when(lonely, F.lit(_STATUS_ACCEPTED)).otherwise(F.lit(_STATUS_UNDECIDED)))
          .select("run", "o", "link", "t", "status", lonely.alias("_lonely")).checkpoint(eager=True))
    settled = n.where(F.col("_lonely")).drop("_lonely")
    if judge is not None:
        settled = _judged(settled.withColumn("status", F.lit(_STATUS_CANDIDATE)), judge)
    work = n.where(~F.col("_lonely")).drop("_lonely")
    before = Window.partitionBy("link").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)

    rnd = 0
    while not work.where(F.col("status") == _STATUS_UNDECIDED).isEmpty():
        rnd += 1
        live = F.col("status") != _STATUS_REJECTED
        acc = F.col("status") == _STATUS_ACCEPTED
        und = F.col("status") == _STATUS_UNDECIDED

        def mins(keys):
            return work.groupBy(*keys).agg(
                F.min(F.when(live, F.col("o"))).alias("_ml"),
                F.min(F.when(acc, F.col("o"))).alias("_ma"), F.max(und).alias("_u"))

        by_link = mins(["run", "link"])
        if holds is not None:
            by_link = (by_link.withColumn("_run_a", F.max(F.when(F.col("_ma").isNotNull(), F.col("run"))).over(before))
                       .withColumn("_run_u", F.max(F.when(F.col("_u"), F.col("run"))).over(before))
                       .join(holds, "run", "left"))
            held = lambda c: F.col(c).isNotNull() & (F.col("since").isNull() | (F.col(c) >= F.col("since")))
            by_link = by_link.select("run", "link", "_ml", "_ma", held("_run_a").alias("_held"), held("_run_u").alias("_open"))
        else:
            by_link = by_link.select("run", "link", "_ml", "_ma", F.lit(False).alias("_held"), F.lit(False).alias("_open"))
        by_link = by_link.withColumnRenamed("_ml", "_ml_l").withColumnRenamed("_ma", "_ma_l")
        by_title = mins(["run", "t"]).drop("_u").where(F.col("t") != "")
        by_sim = (e.join(by_title.withColumnRenamed("t", "y"), ["run", "y"])
                  .groupBy("run", "t").agg(F.min("_ml").alias("_ml_s"), F.min("_ma").alias("_ma_s")))
        by_title = by_title.withColumnRenamed("_ml", "_ml_t").withColumnRenamed("_ma", "_ma_t")
        w = (work.join(by_link, ["run", "link"], "left").join(by_title, ["run", "t"], "left")
                 .join(by_sim, ["run", "t"], "left"))
        first_live = F.least("_ml_l", "_ml_t", "_ml_s")
        first_acc = F.least("_ma_l", "_ma_t", "_ma_s")
        blocked = F.col("_held") | F.coalesce(first_acc < F.col("o"), F.lit(False))
        new = (F.when(und & blocked, F.lit(_STATUS_REJECTED))
                .when(und & ~F.col("_open") & (first_live >= F.col("o")), F.lit(_STATUS_ACCEPTED if judge is None else _STATUS_CANDIDATE))
                .otherwise(F.col("status")))
        work = w.select("run", "o", "link", "t", new.alias("status")).checkpoint(eager=True)
        if judge is not None:
            work = _judged(work, judge)
    log.info("greedy de-duplication settled after %d rounds", rnd)
    out = settled.unionByName(work)
    return out.withColumn("accepted", F.col("status") == _STATUS_ACCEPTED).drop("status")


def dedup_greedy(entries: DataFrame, run: str = "run_date", title: str = "norm_title",
                 order: tuple[str, ...] = ("feed_ord", "entry_pos")) -> DataFrame:
    """Entries of each run that survive first-come de-duplication by link and similar title.
    ``entries`` must already be limited, seen-filtered and text-bearing (the reference's
    order of checks); adds ``accepted`` and keeps every input column."""
    o = F.struct(*[F.col(c) for c in order])
    keyed = entries.withColumn("_o", o)
    nodes = keyed.select(F.col(run).alias("run"), F.col("_o").alias("o"),
                         F.coalesce(F.col("link"), F.lit("")).alias("link"),
                         F.coalesce(F.col(title), F.lit("")).alias("t"))
    edges = similar_titles(nodes, "run", "t").select("run", "new_title", "old_title")
    decided = greedy_rounds(nodes, edges).select(F.col("run").alias(run), F.col("o").alias("_o"), "accepted")
    return keyed.join(decided, [run, "_o"]).drop("_o")
