"""Structured Streaming forms of the digest's state rules.

The reference is a daily batch; these carry its rules to a stream of link
sightings and entries.  Sources are file streams over a landing folder; sinks
are files (or ``foreachBatch`` table writes), never the driver-side memory
sink.  ``run_available`` drives a query with ``availableNow`` to completion, so
a bounded landing folder gives the same answer as the batch operator.
"""

from __future__ import annotations

import bisect
import datetime as dt
from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import scratch_path
from ..sources.publish import by_partition

EPOCH = dt.date(1970, 1, 1)
SEEN_BUCKETS = 4096                              # keys of the seen state: links of one hash


def land(df: DataFrame, name: str, order: str | None = None, batches: int | None = None, path: str | None = None) -> str:
    """Write a bounded DataFrame as the files of a stream source; returns the folder.

    With ``order`` and ``batches``, one range partitioning on ``order`` (nulls first) deals the rows to a multiple of ``batches``
    files in order; a stream that reads ``files_per_batch`` of them at a time meets the rows in order over that
    many micro-batches, each read by several tasks.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    if not batches:
        (df.sortWithinPartitions(order) if order else df).write.mode("append").parquet(path)
        return path
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = batches * max(1, -(-wide // batches))
    key = F.col(order).asc_nulls_first()
    (df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("errorifexists").parquet(path))
    age_in_order(spark, path)
    return path


def _files(spark: SparkSession, path: str) -> list:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder) if s.getPath().getName().startswith("part-")]


def age_in_order(spark: SparkSession, path: str) -> None:
    """A file source reads by modification time; tasks end in any order, so files get the times of their part numbers."""
    files = sorted(_files(spark, path), key=lambda s: s.getPath().getName())
    if files:
        first = min(s.getModificationTime() for s in files) - 1000 * len(files)
        fs = files[0].getPath().getFileSystem(spark._jsc.hadoopConfiguration())
        for k, s in enumerate(files):
            fs.setTimes(s.getPath(), first + 1000 * k, -1)


def files_per_batch(spark: SparkSession, path: str, batches: int) -> int:
    """Files that one of so many micro-batches takes (empty ranges write no file)."""
    return max(1, -(-len(_files(spark, path)) // batches))


def read_stream(spark: SparkSession, path: str, like: DataFrame, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(like.schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def run_available(stream: DataFrame, name: str, output_mode: str = "append", progress: list | None = None) -> DataFrame:
    """Run to completion on what the source holds now; return the sink files as a batch DataFrame.  ``progress`` gets the
    micro-batches' progress reports."""
    spark = stream.sparkSession
    out, ck = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    if progress is not None:
        progress.extend(q.recentProgress)
    return spark.read.schema(stream.schema).parquet(out)


def dropped_by_watermark(progress: list) -> int:
    """Input rows of the stateful operators (after partial aggregation) that the watermark dropped."""
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])


# ------------------------------------------------------------ seen state
def _seen_fn(retention_days: int, runs: list[int]):
    """Days in ``runs`` (day numbers, sorted) are the runs.  A key is a bucket of links; state: its links, the last acceptance of each and
    its days not yet decided (``counts`` of them, flat in ``waiting``)."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict = {}                                               # link: [last, days not yet decided]
        if state.exists:
            links, lasts, counts, flat = state.get
            at = 0
            for link, last, n in zip(links, lasts, counts):
                held[link] = [last, set(flat[at:at + n])]
                at += n
        if not state.hasTimedOut:
            for pdf in pdfs:
                for link, d, seed in zip(pdf["link"].tolist(), pdf["day_n"].tolist(), pdf["seed"].tolist()):
                    d = int(d)
                    if (h := held.get(link)) is None:
                        h = held[link] = [None, set()]
                    if seed:
                        h[0] = d if h[0] is None else max(d, h[0])
                    else:
                        h[1].add(d)
        closed = state.getCurrentWatermarkMs() // 86_400_000          # days before it are complete
        acc_links, acc_days, wake, kept = [], [], None, {}
        for link, (last, waiting) in held.items():
            for d in sorted(x for x in waiting if x < closed):
                waiting.discard(d)
                k = bisect.bisect_left(runs, d)
                if last is None or k and last < runs[k - 1] - retention_days:
                    acc_links.append(link)
                    acc_days.append(EPOCH + dt.timedelta(days=d))
                    last = d
            # the run after the first run day beyond the retention starts without the link: nothing to remember then
            k = bisect.bisect_right(runs, last + retention_days) if last is not None else len(runs)
            free = runs[k] if k < len(runs) else None
            if not waiting and free is not None and closed > free:
                continue
            kept[link] = (last, waiting)
            due = min(waiting) + 1 if waiting else free + 1 if free is not None else None
            if due is not None:
                wake = due if wake is None else min(wake, due)
        if kept:
            state.update((list(kept), [last for last, _ in kept.values()], [len(w) for _, w in kept.values()],
                          [d for _, w in kept.values() for d in sorted(w)]))
            if wake is not None:
                state.setTimeoutTimestamp(wake * 86_400_000 + 1)
        else:
            state.remove()
        if acc_links:
            yield pd.DataFrame({"link": acc_links, "day": acc_days})
    return fn


def seed_stream(spark: SparkSession, seen: DataFrame) -> DataFrame:
    """A saved seen table (link, first_seen) as a stream, the start of ``stream_seen``'s state."""
    rows = seen.select("link", F.col("first_seen").alias("day"))
    return read_stream(spark, land(rows, "seen-seeds"), rows)


def stream_seen(sightings: DataFrame, run_days: Sequence[dt.date], retention_days: int = 14, watermark: str = "1 day",
                seeds: DataFrame | None = None, buckets: int = SEEN_BUCKETS) -> DataFrame:
    """Exact seen-state rule on a stream.  A link accepted on day s is in the state that a run starts from while
    s >= previous run - retention; ``run_days`` (one per run: the calendar) tells the previous run.

    A day is decided once the watermark has passed it, in day order per link, so files may come in any order that the
    watermark allows and skipped run days are exact.  State per link: the last acceptance and the days not yet decided.  Links are
    dealt to ``buckets`` keys by hash: a call of the Python function costs about as much as some hundred links do, so a bucket takes many; more
    links than some thousand a bucket want more buckets.
    ``seeds`` (link, day; a stream, see ``seed_stream``) starts the state from a saved table: its rows are acceptances of
    earlier runs; ``run_days`` then has to name the last run before the stream as well.

    A day that the watermark has not passed when the source ends stays undecided.  The last day is closed by the next day's
    first sighting, or by a row of a link that does not exist, dated after the watermark delay (as the registered query does).
    """
    runs = sorted((d - EPOCH).days for d in run_days)
    rows = sightings.select("link", "day", F.lit(False).alias("seed"))
    if seeds is not None:
        rows = rows.unionByName(seeds.select("link", "day", F.lit(True).alias("seed")))
    # one row per (link, day) before the keyed state: a link's rows in a micro-batch are
    # bounded by the days it covers, not by how many raw sightings a hot link has
    s = (rows.withColumn("ts", F.col("day").cast("timestamp"))
         .withColumn("day_n", F.datediff(F.col("day"), F.lit("1970-01-01").cast("date")))
         .withWatermark("ts", watermark)
         .dropDuplicatesWithinWatermark(["link", "day_n", "seed"]))
    bucket = F.pmod(F.xxhash64("link"), F.lit(buckets)).alias("bucket")
    return s.select("link", "day_n", "seed", "ts", bucket).groupBy("bucket").applyInPandasWithState(
        _seen_fn(retention_days, runs), outputStructType="link string, day date",
        stateStructType="links array<string>, lasts array<int>, counts array<int>, waiting array<int>",
        outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)


def stream_seen_approx(sightings: DataFrame, retention_days: int = 14) -> DataFrame:
    """Links, each once while its state lives: built-in watermark de-duplication.  State
    expires only after the watermark passes, so suppression can outlast the retention; which day of a link
    survives is arbitrary, so only the link is returned."""
    s = sightings.withColumn("ts", F.col("day").cast("timestamp"))
    return (s.withWatermark("ts", f"{retention_days} days")
             .dropDuplicatesWithinWatermark(["link"]).select("link"))


# ------------------------------------------------------------ windows
def stream_daily(events: DataFrame, key: str, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Per-day counts by ``key``; append mode emits a day once the watermark closes it."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    g = e.groupBy(F.window("_ts", "1 day"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.to_date(F.col("window.start")).alias("day"), key, "n")


def stream_weekly(events: DataFrame, key: str, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Trailing 7-day counts stepping daily; only closed windows appear."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    g = e.groupBy(F.window("_ts", "7 days", "1 day"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.to_date(F.col("window.start")).alias("start_day"), key, "n")


def stream_feed_lookup(entries: DataFrame, feeds: DataFrame) -> DataFrame:
    """Stream-static join: the feed list is configuration, bounded by the number of feeds."""
    f = feeds.select("feed_ord", F.col("name").alias("source"), F.col("category").alias("feed_category"))
    return entries.join(F.broadcast(f), "feed_ord", "left")


# ------------------------------------------------------------ publishing
def publish_batch(table_path: str, run_id: str, day_col: str = "day"):
    """``foreachBatch`` writer: a day's rows lie under (day, run_id, batch).  A batch replaces only
    its own part of a day, so a day may come in several batches and a retried batch writes
    nothing twice; an empty batch writes nothing (the quiet-rerun rule)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        (by_partition(batch, day_col).withColumn("run_id", F.lit(run_id)).withColumn("batch", F.lit(epoch_id))
         .write.mode("overwrite").partitionBy(day_col, "run_id", "batch")
         .option("partitionOverwriteMode", "dynamic").parquet(table_path))
    return write


def committed_runs(table_path: str) -> str:
    """Folder of the commit log: one row per complete run."""
    return f"{table_path.rstrip('/')}-runs"


def commit_run(spark: SparkSession, table_path: str, run_id: str) -> None:
    """From now on readers see the run.  Saying it again changes nothing."""
    spark.range(1).select(F.lit(run_id).alias("run_id")).write.mode("append").parquet(committed_runs(table_path))


def published(spark: SparkSession, table_path: str, day_col: str = "day") -> DataFrame:
    """The table's current rows: per day those of its newest complete run (run ids sort by time).  A run that is being
    written, or that broke off, is not in the commit log and hides nothing."""
    t = spark.read.parquet(table_path).withColumn("run_id", F.col("run_id").cast("string"))
    runs = spark.read.schema("run_id string").parquet(committed_runs(table_path)).distinct()      # one row per run
    t = t.join(F.broadcast(runs), "run_id", "left_semi")
    newest = t.groupBy(day_col).agg(F.max("run_id").alias("run_id"))     # one row per day: the calendar
    return t.join(newest, [day_col, "run_id"], "left_semi").drop("run_id", "batch")


def stream_publish(rows: DataFrame, table_path: str, name: str, run_id: str, day_col: str = "day") -> None:
    """Publish a run; a later run replaces the days that it has, and no others.  The run counts once its last batch is written."""
    spark = rows.sparkSession
    ck = scratch_path(spark, f"{name}-ckpt")
    q = (rows.writeStream.foreachBatch(publish_batch(table_path, run_id, day_col))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    commit_run(spark, table_path, run_id)


def late_rows(batch_events: DataFrame, stream_output: DataFrame, key: str, delay: str) -> DataFrame:
    """Reconcile per (day, key) what a finished stream counted with what the batch holds: ``late_n`` rows came after the
    watermark had closed their day, ``open_n`` lie in a day that is still open."""
    b = batch_events.groupBy(F.to_date("ts").alias("day"), key).agg(F.count(F.lit(1)).alias("batch_n"))
    end = batch_events.select(F.max(F.col("ts").cast("timestamp"))).scalar() - F.expr(f"INTERVAL {delay}")
    closed = F.date_add("day", 1).cast("timestamp") <= end
    missing = F.col("batch_n") - F.coalesce("stream_n", F.lit(0))
    s = stream_output.select("day", key, F.col("n").alias("stream_n"))
    return (b.join(s, ["day", key], "left")
             .select("day", key, "batch_n", F.coalesce("stream_n", F.lit(0)).alias("stream_n"),
                     F.when(closed, missing).otherwise(0).alias("late_n"), F.when(closed, F.lit(0)).otherwise(missing).alias("open_n")))
