"""Hot keys: a group or title holding a third of all rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from gazette.operators import dedup as D
from gazette.operators.ordering import ranked


def test_ranked_hot_group_matches_window_and_is_split(spark):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", rnd.randint(0, 20), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "grp string, score int, uid int")
    order = [F.col("score").desc(), F.col("uid").asc()]
    got = {r.uid: r.rn for r in ranked(df, ["grp"], order, "rn", partitions=8).collect()}
    w = Window.partitionBy("grp").orderBy(*order)
    want = {r.uid: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want
    # the hot group is spread over several range partitions, not one task
    parts = (df.repartitionByRange(8, F.col("grp").asc(), *order).where(F.col("grp") == "hot")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1
    plan = ranked(df, ["grp"], order, "rn", partitions=8)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan          # no per-group window sort


def test_hot_title_dedup_is_exact_without_equal_title_pairs(spark):
    import difflib
    rnd = random.Random(11)
    titles = ["breaking news today", "breaking news toady", "weather report", "market update", ""]
    rows = []
    for o in range(300):
        t = titles[0] if o % 3 == 0 else rnd.choice(titles[1:])
        rows.append((0, o, f"l{rnd.randint(0, 120)}", t))
    df = spark.createDataFrame(rows, "run int, o int, link string, t string")
    edges = D.similar_titles(df, "run", "t")
    pairs = {(r.new_title, r.old_title) for r in edges.collect()}
    assert all(a != b for a, b in pairs) and len(pairs) <= len(titles) ** 2
    got = {r.o for r in D.greedy_rounds(df, edges.select("run", "new_title", "old_title")).where("accepted").collect()}
    seen, acc, want = set(), [], set()
    for _, o, link, t in rows:
        if link in seen:
            continue
        if t and any(a and difflib.SequenceMatcher(None, t, a).ratio() >= 0.75 for a in acc):
            continue
        seen.add(link)
        acc.append(t)
        want.add(o)
    assert got == want
