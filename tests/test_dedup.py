"""Near-duplicate titles and greedy de-duplication against brute force and the sequential loop."""

import difflib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from gazette.functions import text as T
from gazette.operators import dedup as D
from gazette.sources import bindings as B


def _entries(spark, sf):
    return B.entries(spark, sf).withColumn("norm_title", T.normalize_title("title"))


def test_similar_titles_equals_all_pairs(spark, sf):
    e = _entries(spark, sf)
    got = {(r.run_date, r.new_title, r.old_title) for r in D.similar_titles(e, "run_date", "norm_title").collect()}
    runs = defaultdict(set)
    for r in e.select("run_date", "norm_title").collect():
        if r.norm_title:
            runs[r.run_date].add(r.norm_title)
    want = set()
    for d, ts in runs.items():
        for x in ts:
            for y in ts:
                if x != y and difflib.SequenceMatcher(None, x, y).ratio() >= 0.75:
                    want.add((d, x, y))
    assert got == want


def test_similar_titles_near_copies(spark):
    titles = ["abcd", "abcx", "the quick brown fox", "the quick brown fix", "", "zzzz", "abcd"]
    df = spark.createDataFrame([(0, t) for t in titles], "g int, t string")
    got = {(r.new_title, r.old_title) for r in D.similar_titles(df, "g", "t").collect()}
    assert ("abcx", "abcd") in got and ("abcd", "abcx") in got
    assert ("the quick brown fix", "the quick brown fox") in got
    assert all(a and b for a, b in got)


def _sequential(rows):
    """The reference's loop: skip a link taken earlier this run or a title similar to an accepted one."""
    seen, titles, out = set(), [], set()
    for r in rows:
        if r["link"] in seen:
            continue
        if any(difflib.SequenceMatcher(None, r["t"], t).ratio() >= 0.75 for t in titles if r["t"] and t):
            continue
        seen.add(r["link"])
        titles.append(r["t"])
        out.add(r["o"])
    return out


def test_greedy_equals_sequential_on_entries(spark, sf):
    e = _entries(spark, sf)
    got = {r.entry_pos for r in D.dedup_greedy(e).where("accepted").collect()}
    runs = defaultdict(list)
    for r in e.select("run_date", "feed_ord", "entry_pos", "link", "norm_title").collect():
        runs[r.run_date].append(r)
    want = set()
    for rs in runs.values():
        rs.sort(key=lambda r: (r.feed_ord, r.entry_pos))
        want |= _sequential([{"o": r.entry_pos, "link": r.link, "t": r.norm_title} for r in rs])
    assert got == want


def test_greedy_random_conflicts(spark):
    """Adversarial shapes: long chains of similar titles, shared links, repeated titles."""
    rnd = random.Random(3)
    alphabet = ["aaaa", "aaab", "aabb", "abbb", "bbbb", "bbbc", "cccc", ""]
    rows = []
    for run in range(6):
        for o in range(40):
            rows.append((run, o, f"l{rnd.randint(0, 25)}", rnd.choice(alphabet)))
    df = spark.createDataFrame(rows, "run int, o int, link string, t string")
    edges = D.similar_titles(df, "run", "t").select("run", "new_title", "old_title")
    got = {(r.run, r.o) for r in D.greedy_rounds(df, edges).where("accepted").collect()}
    want = set()
    for run in range(6):
        rs = sorted([r for r in rows if r[0] == run], key=lambda r: r[1])
        want |= {(run, o) for o in _sequential([{"o": r[1], "link": r[2], "t": r[3]} for r in rs])}
    assert got == want


def test_no_cartesian_in_similar_titles(spark, sf):
    plan = D.similar_titles(_entries(spark, sf), "run_date", "norm_title")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
