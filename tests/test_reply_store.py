"""Durable replies: a job that dies calls nobody twice; failures are tried again by the next run only."""

import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gazette.operators.reply_store import ReplyStore, reply_key
from gazette.session import scratch_path

# the model functions below run in the workers, which cannot import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def prompts(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("p"), F.col("id")).alias("prompt"))


def logged(path):
    """A model that notes every call in its own file, one line per answered prompt."""
    def complete(prompt, cap):
        with open(path, "a") as f:
            f.write(prompt + "\n")
        return f"r-{prompt}-{cap}"
    return complete


def lines(path):
    return open(path).read().split() if os.path.exists(path) else []


def test_a_killed_job_repeats_no_finished_call(spark, tmp_path):
    log = str(tmp_path / "calls")
    answer = logged(log)

    def dies(prompt, cap):
        if len(lines(log)) >= 7:
            os._exit(1)                          # the worker is gone, and with it the job
        return answer(prompt, cap)
    store = ReplyStore(spark, scratch_path(spark, "store"))
    with pytest.raises(Exception):
        store.complete(prompts(spark, 20), dies, "summary", "d1", max_parallel=1, calls_per_task=1)
    first = lines(log)
    assert len(first) == 7 and store.read("summary").count() == 7
    out = store.complete(prompts(spark, 20), answer, "summary", "d1", max_parallel=1, calls_per_task=1)
    assert {r.id: r.reply for r in out.collect()} == {i: f"r-p{i}-800" for i in range(20)}
    assert sorted(lines(log)) == sorted(f"p{i}" for i in range(20))            # the rest, and only the rest


def test_waves_and_equal_prompts(spark, tmp_path):
    log = str(tmp_path / "calls")
    twice = prompts(spark, 30).unionByName(prompts(spark, 30).withColumn("id", F.col("id") + 100))
    store = ReplyStore(spark, scratch_path(spark, "store"))
    out = store.complete(twice, logged(log), "quiz", "d1", max_parallel=2, calls_per_task=4)
    assert out.count() == 60 and out.where("reply is null").count() == 0
    assert sorted(lines(log)) == sorted(f"p{i}" for i in range(30))
    store.complete(twice, logged(log), "brief", "d1", max_parallel=2)            # another kind is another question
    assert len(lines(log)) == 60


def test_failures_belong_to_their_run(spark, tmp_path):
    log = str(tmp_path / "calls")

    def down(prompt, cap):
        logged(log)(prompt, cap)
        raise RuntimeError("down")
    store = ReplyStore(spark, scratch_path(spark, "store"))
    p = prompts(spark, 3)
    out = store.complete(p, down, "deep", "d1", 2, attempts=2, base_delay_s=0).collect()
    assert all(r.reply is None and r.error == "RuntimeError: down" and r.attempts == 2 for r in out) and len(lines(log)) == 6
    store.complete(p, down, "deep", "d1", 2, attempts=2, base_delay_s=0)
    assert len(lines(log)) == 6
    out = store.complete(p, logged(log), "deep", "d2", 2).collect()
    assert all(r.reply and r.error is None for r in out) and len(lines(log)) == 9
    store.complete(p, down, "deep", "d3", 2)
    assert len(lines(log)) == 9


def test_null_and_no_prompts(spark, tmp_path):
    store = ReplyStore(spark, scratch_path(spark, "store"))
    none = spark.createDataFrame([], "id long, prompt string")
    assert store.complete(none, logged(str(tmp_path / "c")), "weekly", "d1", 2).count() == 0
    one = store.complete(spark.createDataFrame([(1, None), (2, "")], "id long, prompt string"), lambda p, cap: f"{p!r}", "weekly", "d1", 2)
    assert one.where("reply is not null").count() == 2


def test_wave_reads_its_own_folder_only(spark, tmp_path):
    store, folder = ReplyStore(spark, str(tmp_path / "replies")), str(tmp_path / "prompts")
    p = spark.createDataFrame([(f"k{n}", f"p{n}", n, n // 2) for n in range(6)], "reply_key string, prompt string, n long, wave int")
    p.write.partitionBy("wave").parquet(folder)
    part = store._wave(folder, 1, p.drop("wave").schema)
    assert sorted(r.n for r in part.collect()) == [2, 3]
    assert all("/wave=1/" in f for f in part.inputFiles())


def test_outcomes_of_the_asked_keys_only(spark, tmp_path):
    store = ReplyStore(spark, str(tmp_path / "replies"))
    p = spark.createDataFrame([(f"p{n}",) for n in range(6)], "prompt string")
    store.complete(p, lambda prompt, cap: prompt.upper(), "quiz", "1", 2, 1, 1, 0)
    keys = p.where("prompt < 'p2'").select(reply_key("quiz").alias("reply_key"))
    assert sorted(r.reply for r in store.outcomes("quiz", "1", keys).collect()) == ["P0", "P1"]
    assert store.outcomes("quiz", "1").count() == 6
