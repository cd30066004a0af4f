"""Landed feed documents: RSS-like XML, one folder per feed, read with Spark's XML source.

``feed_scan`` reads a whole landing folder.  ``scan_new`` reads what has landed since the scan before: a file stream that runs once over the files its
checkpoint does not know.  It cuts the text at item ends and parses every item by itself, so an item that is no well-formed
XML, has no end, or whose position is no number is kept aside as it came, and the items next to it are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import config as C

ITEM_SCHEMA = StructType([
    StructField("pos", LongType()), StructField("title", StringType()),
    StructField("link", StringType()), StructField("description", StringType()),
])


CORRUPT = "_corrupt_record"
PARSED_SCHEMA = StructType([*ITEM_SCHEMA.fields, StructField(CORRUPT, StringType())])
LANDED_SCHEMA = StructType([StructField("value", StringType()), StructField("feed", StringType())])


def write_landing(entries: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Land entries as feed documents: ``<channel><item>...</item></channel>`` per feed folder.
    The item position is written with the item (row order is data)."""
    items = entries.select("feed", F.col("entry_pos").alias("pos"), "title", "link",
                           F.col("summary").alias("description"))
    (items.write.mode(mode).partitionBy("feed").format("xml")
     .option("rootTag", "channel").option("rowTag", "item").save(path))
    return path


def _entry_columns() -> list[Column]:
    """The reference defaults: missing title -> "Untitled", missing link or summary -> ""."""
    return [F.col("feed"), F.col("pos").alias("entry_pos"), F.coalesce("title", F.lit(C.DEFAULT_TITLE)).alias("title"),
            F.coalesce("link", F.lit("")).alias("link"), F.coalesce("description", F.lit("")).alias("summary")]


def feed_scan(spark: SparkSession, path: str) -> DataFrame:
    """Entry rows of every file under ``path``."""
    r = spark.read.format("xml").option("rowTag", "item").schema(ITEM_SCHEMA).load(path)
    return r.select(*_entry_columns())


def scan_new(spark: SparkSession, path: str, store: str) -> list[int]:
    """Scan the files under ``path`` that no earlier scan has read; returns the numbers of the scans made (none: no new file).

    ``store`` holds the stream's checkpoint and the scanned items by scan.  A scan that broke off is made again over the same
    files and replaces its part, so no item is lost or read twice.
    """
    store, scans = store.rstrip("/"), []
    # a record of the text source ends where an item ends; what it holds before its last item start has no end
    text = spark.readStream.schema(LANDED_SCHEMA).format("text").option("lineSep", "</item>").load(path)
    starts = F.split("value", r"<item(?=[\s>])", -1)
    items = F.transform(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), lambda x, i: F.concat(
        F.lit("<item"), x, F.when(i == F.size(starts) - 2, F.lit("</item>")).otherwise(F.lit(""))))
    items = (text.select("feed", F.col("_metadata.file_path").alias("file"), F.explode(items).alias("item"))
             .select("feed", "file", "item", F.from_xml("item", PARSED_SCHEMA.simpleString(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("x"))
             .select("feed", "file", "item", "x.*"))

    def keep(batch: DataFrame, scan: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/items/scan={scan}")
        scans.append(scan)
    q = items.writeStream.foreachBatch(keep).option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return scans


def _scanned(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store.rstrip('/')}/items")


def scanned_entries(spark: SparkSession, store: str) -> DataFrame:
    """Entry rows of all scans, with ``scan``; filter on it to read one scan (a partition column)."""
    return _scanned(spark, store).where(F.col(CORRUPT).isNull()).select("scan", *_entry_columns())


def rejected_items(spark: SparkSession, store: str) -> DataFrame:
    """Items that could not be read: scan, feed, file, item (as it came)."""
    return _scanned(spark, store).where(F.col(CORRUPT).isNotNull()).select("scan", "feed", "file", "item")
