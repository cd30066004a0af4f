"""Durable replies of the model stage.

A reply is kept under a hash of (kind, prompt) in a shared folder, one sub-folder per kind.  Before any call the batch is
anti-joined with the store, so a prompt that has a reply is never sent again: not by a rerun, not by another day, not by a job that
starts anew after it died.  Calls run in waves of ``max_parallel`` tasks with at most about ``calls_per_task`` prompts each; a task's
replies are durable when the task ends (its file moves to the store at task commit), so a job that dies repeats at
most the calls of the tasks that were running, and with ``calls_per_task=1`` nothing that was answered.

A prompt that fails every attempt is stored with its error and the run's name: the same run does not try it again, a later run
does.  Equal prompts of a batch are one call.
"""

from __future__ import annotations

import time
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import config as C
from ..session import ensure_checkpoint_dir, scratch_path
from .ordering import ranked

SCHEMA = "reply_key string, run string, reply string, error string, attempts int"
Complete = Callable[[str, int], str]
BROADCAST_KEYS = 100_000        # asked keys are broadcast up to this many (64 characters each)


def reply_key(kind: str, prompt: str = "prompt") -> Column:
    return F.sha2(F.concat(F.lit(kind), F.lit("\x1f"), F.coalesce(F.col(prompt), F.lit(""))), 256)


def caller(complete: Complete, cap: int, run: str, attempts: int, base_delay_s: float):
    """Per task: call, retry with doubling delay, record what failed."""
    def one(prompt: str) -> tuple[str | None, str | None, int]:
        for n in range(1, attempts + 1):
            try:
                return complete(prompt, cap), None, n
            except Exception as exc:  # noqa: BLE001 - any provider failure is recorded
                error = f"{type(exc).__name__}: {exc}"
                if n < attempts and base_delay_s > 0:
                    time.sleep(base_delay_s * (2 ** (n - 1)))
        return None, error, attempts

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [one(p) for p in pdf["prompt"]]
            yield pd.DataFrame({"reply_key": pdf["reply_key"], "run": run, "reply": [g[0] for g in got],
                                "error": [g[1] for g in got], "attempts": [g[2] for g in got]})
    return task


class ReplyStore:
    def __init__(self, spark: SparkSession, path: str):
        ensure_checkpoint_dir(spark)
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, kind: str) -> str:
        return f"{self.path}/kind={kind}"

    def read(self, kind: str) -> DataFrame:
        """All stored outcomes of a kind; an absent folder is an empty store."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(kind))
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self._folder(kind))

    def outcomes(self, kind: str, run: str, keys: DataFrame | None = None) -> DataFrame:
        """Per key the reply that counts: an answered one, whichever run made it, else this run's failure.  With ``keys`` (reply_key)
        of those only: the rest of the store is read and dropped before any shuffle, where the keys are few."""
        rows = self.read(kind).where(F.col("reply").isNotNull() | (F.col("run") == run))
        if keys is not None:
            rows = rows.join(keys, "reply_key", "left_semi")
        order = F.struct(F.col("reply").isNotNull(), F.col("run"), F.col("reply"))
        return rows.groupBy("reply_key").agg(F.max_by(F.struct("reply", "error", "attempts"), order).alias("o")) \
                   .select("reply_key", "o.*")

    def _wave(self, folder: str, wave: int, schema: StructType) -> DataFrame:
        """One wave's prompts, from its own folder: neither the other waves' folders are listed nor a file opened for the schema."""
        return self.spark.read.schema(schema).parquet(f"{folder}/wave={wave}")

    def complete(self, prompts: DataFrame, complete: Complete, kind: str, run: str, max_parallel: int,
                 calls_per_task: int = 16, attempts: int = C.RETRY_ATTEMPTS, base_delay_s: float = C.RETRY_BASE_DELAY_S) -> DataFrame:
        """``prompts`` (with a column ``prompt``) and their ``reply``, ``error``, ``attempts``; only prompts without an outcome are
        sent to ``complete(prompt, max_tokens)``."""
        p = prompts.withColumn("reply_key", reply_key(kind)).checkpoint(eager=True)
        asked = p.select("reply_key")
        if p.count() <= BROADCAST_KEYS:
            asked = F.broadcast(asked)
        known = self.outcomes(kind, run, asked).select("reply_key")
        todo = p.select("reply_key", "prompt").dropDuplicates(["reply_key"]).join(known, "reply_key", "left_anti")
        # numbered, so that waves and tasks are of equal size: a task has calls_per_task prompts and no more
        todo = ranked(todo, [], [F.col("reply_key").asc()], "n").withColumn("n", F.col("n") - 1).checkpoint(eager=True)
        size = max_parallel * calls_per_task
        waves = -(-todo.count() // size)
        task = caller(complete, C.TOKEN_CAPS[kind], run, attempts, base_delay_s)
        if waves > 1:                            # each wave reads its own folder only
            folder = scratch_path(self.spark, "prompts")
            (todo.withColumn("wave", F.floor(F.col("n") / size).cast("int")).write.partitionBy("wave").parquet(folder))
        for wave in range(waves):
            part = todo if waves == 1 else self._wave(folder, wave, todo.schema)
            slot = F.pmod(F.col("n"), F.lit(max_parallel)).cast("int")
            (part.repartitionById(max_parallel, slot).select("reply_key", "prompt").mapInPandas(task, SCHEMA)
             .write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(self._folder(kind)))
        return p.join(self.outcomes(kind, run, asked), "reply_key", "left").drop("reply_key")
