"""The engine's input tables, derived from a star-schema folder of Parquet files.

Every view covers the whole of its tables. Money is averaged in whole cents, so the values
are the same under any partitioning.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def mean_cents(col: str) -> Column:
    """The mean in whole cents, rounded down."""
    total = F.sum(F.round(F.col(col) * 100).cast("bigint"))
    return F.call_function("div", total, F.count(F.lit(1)))


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per supplier and ship day; the close is the day's mean price."""
    lines = table(spark, folder, "lineitem")
    price = F.col("l_extendedprice")
    return (
        lines.groupBy(F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.min(price).alias("low"),
            F.max(price).alias("high"),
            (mean_cents("l_extendedprice") / 100).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
        .select(
            "date", "ticker", ((F.col("low") + F.col("high")) / 2).alias("open"),
            "high", "low", "close", "volume",
        )
    )


def vix(spark: SparkSession, folder: str) -> DataFrame:
    """One market-wide value per order day; some bar days have none."""
    orders = table(spark, folder, "orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        (mean_cents("o_totalprice") / 1_000_000).alias("vix")
    )


def _source_number() -> Column:
    return F.substring("source", 4, 10).cast("int")


def _headline_time() -> Column:
    days = 20 * ((F.col("doc_id") - F.col("doc_id") % 10) / 10 % 50)
    return F.timestamp_add(
        "HOUR",
        (days * 24).cast("bigint") + F.col("doc_id") % 24,
        F.expr("TIMESTAMP_NTZ'1995-06-01 00:00:00'"),
    )


def headlines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as one headline of a ticker at a time of day."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("news_id"),
        (F.col("doc_id") % 10).alias("ticker"),
        _headline_time().alias("date"),
        F.col("text").alias("headline"),
        _source_number().alias("source"),
    )


def feed_a(spark: SparkSession, folder: str) -> DataFrame:
    """Sources 0-11. Together the two feeds hold every document; 8-11 come twice."""
    return headlines(spark, folder).where(F.col("source") < 12).drop("source")


def feed_b(spark: SparkSession, folder: str) -> DataFrame:
    return headlines(spark, folder).where(F.col("source") >= 8).drop("source")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled sentences: 0 negative, 1 neutral, 2 positive."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    label = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1)
    return (
        table(spark, folder, "labels")
        .join(docs, "doc_id")
        .select("doc_id", F.col("text").alias("sentence"), label.alias("label"))
    )


def scored_headlines(spark: SparkSession, folder: str) -> DataFrame:
    """Headlines with stand-in class scores that sum to one."""
    raw = {
        "p": (F.col("news_id") * 7 % 11 + 1).cast("double"),
        "n": (F.col("news_id") * 5 % 13 + 1).cast("double"),
        "u": (F.col("news_id") * 3 % 7 + 1).cast("double"),
    }
    total = F.col("p") + F.col("n") + F.col("u")
    return (
        headlines(spark, folder).withColumns(raw)
        .select(
            "news_id", "ticker", "date", "headline",
            (F.col("p") / total).alias("pos"),
            (F.col("n") / total).alias("neg"),
            (F.col("u") / total).alias("neu"),
        )
    )
