"""State tables and publishing: round trips, replace-by-day, idempotent reruns, keep-latest."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from gazette.session import scratch_path
from gazette.sources import publish as PB
from gazette.sources import state as ST


def test_seen_round_trip_with_retention(spark):
    root = scratch_path(spark, "seen-test")
    assert ST.read_seen(spark, root).count() == 0
    rows = [("a", dt.date(2026, 1, 1)), ("b", dt.date(2026, 1, 20)), ("", dt.date(2026, 1, 25))]
    ST.write_seen(spark.createDataFrame(rows, ST.SEEN_SCHEMA), root, "2026-01-25", 14)
    got = {r.link for r in ST.read_seen(spark, root).collect()}
    assert got == {"b", ""}
    ST.write_seen(spark.createDataFrame([("c", dt.date(2026, 1, 26))], ST.SEEN_SCHEMA), root, "2026-01-26", 14)
    assert {r.link for r in ST.read_seen(spark, root).collect()} == {"c"}


def test_recent_replaces_its_day_and_forgets_old_ones(spark):
    root = scratch_path(spark, "recent-test")
    d0, d1, d2 = dt.date(2025, 1, 1), dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    ST.write_recent(spark.createDataFrame([(d0, 1, "old", "s", "src"), (d1, 1, "t1", "s", "src"), (d2, 1, "t2", "s", "src"),
                                           (d2, 2, "t3", "s", "src")], ST.RECENT_SCHEMA), root, "2025-01-05", 14)
    assert ST.read_recent(spark, root).count() == 4
    ST.write_recent(spark.createDataFrame([(d2, 1, "new", "s", "src")], ST.RECENT_SCHEMA), root, "2026-01-02", 14)
    got = sorted((r.day, r.title) for r in ST.read_recent(spark, root).collect())
    assert got == [(d1, "t1"), (d2, "new")]


def test_broken_save_and_storage_errors(spark):
    """A version without its _SUCCESS file does not count; an unreadable version is no empty state."""
    import os
    root = scratch_path(spark, "seen-broken").replace("file:", "")
    ST.write_seen(spark.createDataFrame([("a", dt.date(2026, 1, 1))], ST.SEEN_SCHEMA), root, "2026-01-02", 14)
    second = ST.write_seen(spark.createDataFrame([("b", dt.date(2026, 1, 2))], ST.SEEN_SCHEMA), root, "2026-01-02", 14)
    os.rename(f"{second}/_SUCCESS", f"{second}/_half")
    assert [r.link for r in ST.read_seen(spark, root).collect()] == ["a"]
    bad = f"{root}/v-000000000009-x"
    os.makedirs(bad)
    for name in ("_SUCCESS", "part-0.parquet"):
        with open(f"{bad}/{name}", "w") as f:
            f.write("no parquet")
    import pytest
    with pytest.raises(Exception):
        ST.read_seen(spark, root).collect()


def test_publish_day_idempotent_and_quiet_rerun(spark):
    path = scratch_path(spark, "digest-test")
    rows = spark.createDataFrame([(dt.date(2026, 1, 1), 1, "a"), (dt.date(2026, 1, 2), 1, "b")],
                                 "day date, pos int, title string")
    PB.publish_day(rows, path)
    PB.publish_day(rows, path)
    PB.publish_day(rows.where(F.lit(False)), path)
    t = spark.read.parquet(path)
    assert t.count() == 2
    assert [r.title for r in PB.front_page(spark, path).collect()] == ["b"]


def test_files_grow_with_the_days_alone(spark):
    """However many tasks hold a day's rows, a day is one file; a run of a stream the same."""
    import glob
    from gazette.streaming import streams as STR
    rows = [(dt.date(2026, 1, 1) + dt.timedelta(days=k % 10), k, f"t{k}") for k in range(400)] + [(None, 400, "no day")]
    df = spark.createDataFrame(rows, "day date, pos int, title string").repartition(16)
    files = lambda path: len(glob.glob(path.replace("file:", "") + "/**/*.parquet", recursive=True))      # noqa: E731
    path = scratch_path(spark, "digest-files")
    PB.publish_day(df, path)
    assert files(path) == 11
    assert sorted((r.pos, r.day, r.title) for r in spark.read.parquet(path).collect()) == sorted((k, d, t) for d, k, t in rows)
    table = scratch_path(spark, "stream-files")
    STR.publish_batch(table, "1")(df, 0)
    STR.commit_run(spark, table, "1")
    assert files(table) == 11
    assert STR.published(spark, table).count() == 400           # a row without a day has no newest run


def test_rolling_products_keep_latest_weekly(spark):
    h = spark.createDataFrame([(dt.date(2026, 1, 4), "weekly", "w1"), (dt.date(2026, 1, 5), "weekly", None),
                               (dt.date(2026, 1, 4), "quiz", "q1"), (dt.date(2026, 1, 5), "quiz", None)],
                              "day date, product string, payload string")
    got = {r.product: r.payload for r in PB.rolling_products(h).collect()}
    assert got == {"weekly": "w1", "quiz": None}


def test_complete_batch_retries_and_lands(spark):
    from gazette.operators.summaries import complete_batch
    calls = spark.sparkContext.accumulator(0)

    def model(prompt, cap):
        calls.add(1)
        if prompt.startswith("bad"):
            raise RuntimeError("provider down")
        return '{"summary": "%s"}' % prompt[:3]

    prompts = spark.createDataFrame([(i, ("bad" if i % 3 == 0 else "ok ") + str(i)) for i in range(9)],
                                    "k long, prompt string")
    out = complete_batch(prompts, "k", model, max_parallel=4, base_delay_s=0)
    rows = {r.k: r for r in out.collect()}
    out.count()
    assert calls.value == 3 * 4 + 6          # failures tried 4 times; a second action calls nothing
    assert rows[0].reply is None and rows[0].attempts == 4 and "provider down" in rows[0].error
    assert rows[1].reply == '{"summary": "ok "}' and rows[1].attempts == 1


def test_publish_articles_partitions_by_slug_day(spark):
    from gazette import config as C
    from gazette.operators import paging as P
    path = scratch_path(spark, "articles-test")
    df = spark.createDataFrame([("2026-08-04-3e9781fff5", "\n".join(["x " * 100] * 3), 4),
                                ("2026-08-05-489b06ed50", "short", 1)],
                               "slug string, text string, read_minutes int")
    m = P.page_manifest(df, C.Settings())
    PB.publish_articles(m, path)
    PB.publish_articles(m, path)
    t = spark.read.parquet(path)
    assert t.count() == 2 * (3 + 1)
    assert {r.day for r in t.select("day").distinct().collect()} == {dt.date(2026, 8, 4), dt.date(2026, 8, 5)}
