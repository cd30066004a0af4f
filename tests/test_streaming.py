"""Streams over several micro-batches: gaps and shuffled files keep the seen rule exact; no published row is lost."""

import datetime as dt
import random

from pyspark.sql import functions as F

from gazette.operators import history as Hs
from gazette.session import scratch_path
from gazette.streaming import streams as ST

BASE = dt.date(2026, 1, 1)


def _seen(spark, rows, batches, name):
    """Accepted (link, day) of a stream whose files are ``batches`` of rows, closed by a far row."""
    df = spark.createDataFrame(rows, "link string, day date")
    path = scratch_path(spark, name)
    for part in [*batches, [("<end>", max(r[1] for r in rows) + dt.timedelta(days=60))]]:
        spark.createDataFrame(part, "link string, day date").coalesce(1).write.mode("append").parquet(path)
    src = ST.read_stream(spark, path, df, max_files=1)
    out = ST.run_available(ST.stream_seen(src, sorted({r[1] for r in rows}), 14, watermark="30 days"), f"{name}-run")
    got = sorted((r.link, r.day) for r in out.collect() if r.link != "<end>")
    assert got == sorted((r.link, r.day) for r in Hs.replay_seen(df, 14).collect())


def test_stream_seen_with_skipped_run_days(spark):
    days = [0, 10, 16, 17, 40, 41, 60, 75, 90]
    rows = [(f"l{i}", BASE + dt.timedelta(days=d)) for d in days for i in range(3) if (d + i) % 4]
    rows += [("x", BASE), ("x", BASE + dt.timedelta(days=16))]
    by_day = [[r for r in rows if r[1] == BASE + dt.timedelta(days=d)] for d in days]
    _seen(spark, rows, [p for p in by_day if p], "seen-gaps")


def test_stream_seen_with_shuffled_files(spark):
    rng = random.Random(2)
    rows = [(f"l{rng.randrange(6)}", BASE + dt.timedelta(days=rng.randrange(28))) for _ in range(60)]
    rng.shuffle(rows)
    _seen(spark, rows, [rows[:20], rows[20:40], rows[40:]], "seen-shuffled")


def test_seen_state_calls_by_bucket_not_by_link():
    """One call decides all links of its bucket, and the state that it leaves holds each link's own days."""
    class State:
        value, exists, hasTimedOut, wake, closed = None, False, False, None, 0

        get = property(lambda self: self.value)
        getCurrentWatermarkMs = lambda self: self.closed * 86_400_000                             # noqa: E731

        def update(self, value):
            self.value, self.exists = value, True

        def setTimeoutTimestamp(self, ms):
            self.wake = ms

        def remove(self):
            self.value, self.exists = None, False
    n, state, runs = 500, State(), list(range(0, 60))
    fn = ST._seen_fn(14, runs)
    rows = [(f"l{k}", k % 3 + step) for k in range(n) for step in (0, 5, 20)] + [(None, 4)]
    frame = ST.pd.DataFrame({"link": [r[0] for r in rows], "day_n": [r[1] for r in rows], "seed": [False] * len(rows)})
    assert list(fn((7,), iter([frame]), state)) == [] and len(state.value[0]) == n + 1
    state.closed, state.hasTimedOut = 10, True
    first = list(fn((7,), iter([]), state))
    assert len(first) == 1 and len(first[0]) == n + 1 and state.wake == 20 * 86_400_000 + 1      # link None: day 19 closes
    state.closed = 100
    later = list(fn((7,), iter([]), state))[0]
    assert sorted(later["link"]) == sorted(f"l{k}" for k in range(n)) and not state.exists
    assert {(d - BASE.replace(year=1970)).days for d in later["day"]} == {20, 21, 22}


def _days(spark, rows):
    return spark.createDataFrame(rows, "day date, pos long, title string, summary string, source string")


def test_stream_publish_over_batches_and_runs(spark):
    d1, d2 = BASE, BASE + dt.timedelta(days=1)
    rows = _days(spark, [(d1, k, f"t{k}", "s", "x") for k in range(6)] + [(d2, 0, "b", "s", "x")])
    table = scratch_path(spark, "publish-batches")
    for run in ("1", "2"):
        src = ST.read_stream(spark, ST.land(rows, f"rows-{run}", "pos", 3), rows, max_files=1)
        ST.stream_publish(src, table, f"publish-{run}", run)
        assert ST.published(spark, table).count() == 7
    again = _days(spark, [(d2, 0, "new", "s", "x")])
    ST.stream_publish(ST.read_stream(spark, ST.land(again, "rows-3"), again), table, "publish-3", "3")
    got = sorted((r.day, r.title) for r in ST.published(spark, table).collect())
    assert got == [(d1, f"t{k}") for k in range(6)] + [(d2, "new")]


def test_a_run_counts_once_it_is_complete(spark):
    """Between two batches of a run, and after one that broke off, readers see the run before."""
    d1, d2 = BASE, BASE + dt.timedelta(days=1)
    old, new = (_days(spark, [(d, k, f"{name}{k}", "s", "x") for d in (d1, d2) for k in range(4)]) for name in ("old", "new"))
    table = scratch_path(spark, "publish-commit")
    ST.stream_publish(ST.read_stream(spark, ST.land(old, "old"), old), table, "run-1", "1")
    write = ST.publish_batch(table, "2")
    write(new.where("pos < 2"), 0)
    assert {r.title[:3] for r in ST.published(spark, table).collect()} == {"old"} and ST.published(spark, table).count() == 8
    write(new.where("pos >= 2"), 1)
    assert {r.title[:3] for r in ST.published(spark, table).collect()} == {"old"}
    for _ in range(2):                                          # said twice: no row twice
        ST.commit_run(spark, table, "2")
        assert sorted(r.title for r in ST.published(spark, table).collect()) == sorted([f"new{k}" for k in range(4)] * 2)


def test_warm_start_from_a_saved_state(spark):
    """Half the history as batch runs, the rest as a stream that starts from their state: the replay of it all."""
    from gazette.sources import state as STT
    rng = random.Random(6)
    days = sorted(rng.sample(range(80), 36))
    rows = sorted({(f"l{rng.randrange(9)}", BASE + dt.timedelta(days=rng.choice(days))) for _ in range(220)})
    df = spark.createDataFrame(rows, "link string, day date")
    runs = sorted({r[1] for r in rows})
    cut = runs[len(runs) // 2]
    first, rest = df.where(F.col("day") <= F.lit(cut)), [r for r in rows if r[1] > cut]
    state = Hs.replay_seen(first, 14).groupBy("link").agg(F.max("day").alias("first_seen"))
    root = scratch_path(spark, "warm-state")
    STT.write_seen(state, root, cut.isoformat(), 14)
    assert 0 < STT.read_seen(spark, root).count() <= state.count()
    path = scratch_path(spark, "warm-rest")
    for part in [rest[k::3] for k in range(3)] + [[("<end>", runs[-1] + dt.timedelta(days=120))]]:
        spark.createDataFrame(part, "link string, day date").coalesce(1).write.mode("append").parquet(path)
    src = ST.read_stream(spark, path, df, max_files=1)
    seeds = ST.seed_stream(spark, STT.read_seen(spark, root))
    out = ST.run_available(ST.stream_seen(src, runs, 14, watermark="90 days", seeds=seeds), "warm-run")
    got = sorted((r.link, r.day) for r in out.collect() if r.link != "<end>")
    whole = sorted((r.link, r.day) for r in Hs.replay_seen(df, 14).collect())
    assert got == [r for r in whole if r[1] > cut]
    cold = ST.run_available(ST.stream_seen(ST.read_stream(spark, path, df, max_files=1), runs, 14, watermark="90 days"), "cold-run")
    assert sorted((r.link, r.day) for r in cold.collect() if r.link != "<end>") != got


def test_landing_keeps_null_keys_and_order(spark):
    rows = [(k, None if k % 10 == 0 else BASE + dt.timedelta(days=k)) for k in range(200)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, day date")
    path = ST.land(df, "land-order", "day", 4)
    files = sorted(ST._files(spark, path), key=lambda s: s.getModificationTime())
    assert len(files) > 4 and [s.getPath().getName() for s in files] == sorted(s.getPath().getName() for s in files)
    parts = [[r.day for r in spark.read.parquet(s.getPath().toString()).collect()] for s in files]
    assert [d for p in parts for d in p] == sorted((r[1] for r in rows), key=lambda d: (d is not None, d or BASE))
    seen = ST.run_available(ST.read_stream(spark, path, df, ST.files_per_batch(spark, path, 4)), "land-read")
    assert seen.count() == 200


def test_late_rows_are_dropped_and_counted(spark):
    ts = [dt.datetime(2026, 1, 1) + dt.timedelta(hours=3 * k) for k in range(80)]
    df = spark.createDataFrame([(k, t, "a") for k, t in enumerate(ts)], "event_id long, ts timestamp, event_type string")
    late = F.col("event_id").isin(1, 2, 9)
    path = ST.land(df.where(~late), "late-on-time", "ts", 4)
    per = ST.files_per_batch(spark, path, 4)
    ST.land(df.where(late), "late-late", path=path)
    progress = []
    out = ST.run_available(ST.stream_daily(ST.read_stream(spark, path, df, per), "event_type"), "late-run", progress=progress)
    assert ST.dropped_by_watermark(progress) > 0
    got = {r.day: r for r in ST.late_rows(df, out, "event_type", "1 hour").collect()}
    assert [got[BASE + dt.timedelta(days=k)].late_n for k in range(3)] == [2, 1, 0]
    assert all(r.batch_n == r.stream_n + r.late_n + r.open_n == 8 for r in got.values())
    assert sum(r.open_n for r in got.values()) == 8


def test_approx_state_expires(spark):
    """With a retention of 14 days the state of a link is gone after about 28: a far sighting passes again."""
    rows = [("a", BASE), ("a", BASE + dt.timedelta(days=3)), ("b", BASE + dt.timedelta(days=40)),
            ("c", BASE + dt.timedelta(days=60)), ("a", BASE + dt.timedelta(days=80))]
    df = spark.createDataFrame(rows, "link string, day date")
    path = scratch_path(spark, "approx")
    for r in rows:
        spark.createDataFrame([r], "link string, day date").coalesce(1).write.mode("append").parquet(path)
    out = ST.run_available(ST.stream_seen_approx(ST.read_stream(spark, path, df, 1), 14), "approx-run")
    assert sorted(r.link for r in out.collect()) == ["a", "a", "b", "c"]
