"""Sinks: Parquet, JSON, CSV and fitted models."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BUCKETS = "buckets int, by array<string>, sort array<string>"
AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


def write_table(
    df: DataFrame, path: str, cluster_by: Sequence[str] = ("ticker", "date"),
    partition_by: Sequence[str] = (),
) -> None:
    """Overwrite a Parquet table, each file sorted by (ticker, date).

    Rows are gathered by the first key in one shuffle that evens out file sizes, a ticker
    with very many rows included, and needs no sampling run over ``df`` first. A ticker's
    rows then lie together, so a ticker filter skips the other row groups. A folder per
    ticker (``partition_by``) only suits a handful of tickers.
    """
    keys = [c for c in cluster_by if c in df.columns]
    if keys:
        df = df.hint("rebalance", F.col(keys[0])).sortWithinPartitions(*keys)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_buckets(
    df: DataFrame, path: str, by: Sequence[str] = ("ticker",), sort: Sequence[str] = ("ticker", "date"),
    buckets: int | None = None, dealt: bool = False, codec: str | None = None,
) -> int:
    """Overwrite a Parquet table laid out for readers that work key by key: rows of a key are in one of
    ``buckets`` files, sorted. Windows and aggregates by these keys, and joins of tables with as many
    buckets, then read it without a shuffle (``readers.read_buckets``).

    By default as many buckets as the session has shuffle partitions. One key is one task's work, so
    this is for bounded series, such as daily ones; ``write_table`` splits a key of any length. ``dealt``
    states that the rows are in ``buckets`` partitions by these keys already, each in the order that its file
    shall have, so that nothing is shuffled or sorted for the writing.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"buckets_{uuid.uuid4().hex}"
    laid = df if dealt else df.repartition(n, *by)  # the hash that buckets go by: one file each
    writer = laid.write.mode("overwrite").format("parquet").bucketBy(n, *by)
    if codec:
        writer = writer.option("compression", codec)
    at_once = spark.conf.get(AT_ONCE)
    try:
        if dealt:
            spark.conf.set(AT_ONCE, "8")  # files of a task; as there is one, Spark need not sort by them
        else:
            writer = writer.sortBy(*sort)
        writer.option("path", path).saveAsTable(name)
    finally:
        spark.conf.set(AT_ONCE, at_once)
    spark.sql(f"DROP TABLE {name}")  # the files stay, read_buckets names them again
    layout = spark.createDataFrame([(n, list(by), list(sort))], BUCKETS)
    layout.coalesce(1).write.mode("overwrite").json(f"{path}_layout")
    return n


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
