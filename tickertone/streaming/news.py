"""Headlines as they land: copies dropped and daily tone closed by event time.

Both are grouped aggregates behind a watermark in append mode. Spark keeps one small row per open
(ticker, time, headline) or (ticker, day) in its state store, whatever the number of copies, and
writes a group once, when the watermark has passed it; rows that come later than ``delay`` behind
the newest one are dropped and counted in the progress of the query. Each run takes what has landed since
the last one and stops; its checkpoint lets the next run, or one after a crash, go on without losing
or repeating a row.

Groups are closed by rows that pass all filters, so a quiet feed needs a row with a later time to be closed.
On a table that is no stream the same functions give the result of all rows at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import confidence, day, utc_wall_time

DELAY = "2 days"


def landed(spark: SparkSession, path: str, schema: T.StructType | str, files: int = 1000) -> DataFrame:
    """Parquet files of a landing folder as a stream, at most ``files`` in one batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _timed(rows: DataFrame, delay: str) -> DataFrame:
    """With the event time as an instant, which watermarks need: ``date`` as wall time in UTC."""
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01'"), F.col("date"))
    return rows.where("date IS NOT NULL").withColumn("__at", F.timestamp_micros(micros)).withWatermark("__at", delay)


def without_copies(news: DataFrame, delay: str = DELAY, carry: Sequence[str] = ()) -> DataFrame:
    """One row per (ticker, date, headline), from the first feed that has it, with the smallest of
    each column in ``carry``: ``operators.news.drop_copies`` on a stream. ``date`` is the event time."""
    kept = [F.min(c).alias(c) for c in ("feed", *carry)]
    groups = _timed(news, delay).groupBy("ticker", "__at", "headline").agg(*kept)
    return groups.select("ticker", utc_wall_time(F.col("__at")).alias("date"), "headline", "feed", *carry)


def daily_tone_most_confident(
    scored: DataFrame, delay: str = DELAY, scores: Sequence[str] = ("pos", "neg", "neu"),
    tie: Sequence[str] = ("news_id",),
) -> DataFrame:
    """The scores of each closed (ticker, day)'s most confident headline; of equally confident ones
    the first by the ``tie`` columns."""
    sure = scored.withColumn("__conf", confidence(*[F.col(c) for c in scores])).where(
        "__conf IS NOT NULL AND ticker IS NOT NULL"
    )
    best = _timed(sure, delay).groupBy("ticker", F.window("__at", "1 day").alias("__day")).agg(
        F.min_by(F.struct(*scores), F.struct(-F.col("__conf"), *tie)).alias("__best")
    )
    return best.select(
        "ticker", day(utc_wall_time(F.col("__day.start"))).alias("date"), *[F.col(f"__best.{c}").alias(c) for c in scores]
    )


def append_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything that has landed and not been taken yet, appended to a Parquet table; returns the
    finished query. ``checkpoint`` must be a folder that all executors share."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return query
