"""State tables kept between runs: ``seen(link, first_seen)`` and ``recent(day, pos, ...)``.

Both are small and rewritten whole each run.  A save writes a new version folder ``v-<counter>-<id>`` beside the
old ones; a version counts once its ``_SUCCESS`` file is there, which the writer puts last, and the newest
such version is current.  So a save that breaks off leaves the old version current, and there is no moment without one.
Only a missing folder reads as empty state; any other storage error is raised.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from ..operators import history as Hs

SEEN_SCHEMA = StructType([StructField("link", StringType()), StructField("first_seen", DateType())])
RECENT_SCHEMA = StructType([StructField("day", DateType()), StructField("pos", LongType()),
                            StructField("title", StringType()), StructField("summary", StringType()),
                            StructField("source", StringType())])


def _versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Complete versions under ``root``, oldest first; none when the folder does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v-")]
    done = [p for p in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted((int(p.getName().split("-")[1]), p.toString()) for p in done)


def _read(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    found = _versions(spark, root)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(found[-1][1])


def _write(df: DataFrame, root: str) -> str:
    found = _versions(df.sparkSession, root)
    number = found[-1][0] + 1 if found else 1
    version = f"{root.rstrip('/')}/v-{number:012d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(version)
    return version


def read_seen(spark: SparkSession, root: str) -> DataFrame:
    """The current seen table; an absent state is empty."""
    return _read(spark, root, SEEN_SCHEMA)


def write_seen(seen: DataFrame, root: str, run_date: str, retention_days: int) -> str:
    """Apply retention and save a new version."""
    kept = Hs.retention_seen(seen.select("link", "first_seen"), F.lit(run_date).cast("date"), retention_days)
    return _write(kept, root)


def read_recent(spark: SparkSession, root: str) -> DataFrame:
    """The current recent table; an absent state is empty."""
    return _read(spark, root, RECENT_SCHEMA)


def write_recent(today: DataFrame, root: str, run_date: str, retention_days: int) -> str:
    """Replace the days present in ``today``, drop days beyond the retention, save a new version."""
    cols = [f.name for f in RECENT_SCHEMA.fields]
    merged = Hs.recent_upsert(read_recent(today.sparkSession, root).select(*cols), today.select(*cols))
    return _write(merged.where(Hs.keep_after_cutoff("day", F.lit(run_date).cast("date"), retention_days, False)), root)
