"""Rolling products with their payload: the current quiz, deep read and weekly roundup, one row each.

All products are one version of one table (see ``state``), so a reader sees the products of one run, and a write that breaks off
leaves the run before.  A run with articles replaces quiz and deep read even when it has none (the row stays, its payload is
null), and the weekly roundup only when there is a new one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import state as STT

QUIZ = "array<struct<question:string,answer:string>>"
DEEP = "struct<slug:string,title:string,background:string,points:array<string>,implications:string,glossary:array<struct<term:string,definition:string>>>"
WEEKLY = "struct<label:string,intro:string,themes:array<struct<title:string,body:string>>>"
SCHEMA = f"product string, as_of date, source_day date, quiz {QUIZ}, deep {DEEP}, weekly {WEEKLY}"
PRODUCTS = ("quiz", "deep", "weekly")


def _payload(product: str, c: str, typ: str, own: str) -> Column:
    return (F.col(c) if product == own else F.lit(None)).cast(typ).alias(own)


def product_row(spark: SparkSession, product: str, run_date: dt.date, payload: DataFrame) -> DataFrame:
    """The product's row of this run; ``payload`` has at most one row (column ``p``, and ``source_day`` of a quiz)."""
    base = spark.range(1).select(F.lit(product).alias("product"), F.lit(run_date).cast("date").alias("as_of"))
    p = payload if "source_day" in payload.columns else payload.withColumn("source_day", F.lit(None).cast("date"))
    return base.join(p.select(F.lit(product).alias("product"), "source_day", "p"), "product", "left").select(
        "product", "as_of", "source_day", _payload(product, "p", QUIZ, "quiz"), _payload(product, "p", DEEP, "deep"),
        _payload(product, "p", WEEKLY, "weekly"))


def read_products(spark: SparkSession, root: str) -> DataFrame:
    return STT._read(spark, root, SCHEMA)


def write_products(spark: SparkSession, root: str, run_date: dt.date, quiz: DataFrame, deep: DataFrame, weekly: DataFrame) -> str:
    """``quiz`` (source_day, quiz), ``deep`` and ``weekly`` (their fields): at most one row each.  Saves a new version."""
    rows = product_row(spark, "quiz", run_date, quiz.where(F.size("quiz") > 0).select("source_day", F.col("quiz").alias("p")))
    rows = rows.unionByName(product_row(spark, "deep", run_date, deep.select(F.struct(*deep.columns).alias("p"))))
    news = product_row(spark, "weekly", run_date, weekly.select(F.struct(*weekly.columns).alias("p"))).where(F.col("weekly").isNotNull())
    kept = read_products(spark, root).where(F.col("product") == "weekly").join(news.select("product"), "product", "left_anti")
    return STT._write(rows.unionByName(news).unionByName(kept).coalesce(1), root)
