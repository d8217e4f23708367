"""Readers for landed files: bars, two headline feeds, index, corpus, results."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    day,
    epoch_nanos_to_wall_time,
    epoch_seconds_to_wall_time,
    no_nan,
    utc_wall_time,
)
from .writers import BUCKETS

PRICES = ("open", "high", "low", "close", "volume")
NEWS = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("headline", T.StringType()),
])
FEED_A = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("news", T.ArrayType(T.StructType([
            T.StructField("created_at", T.TimestampType()),
            T.StructField("headline", T.StringType()),
        ]))),
    ])),
])
FEED_B = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("datetime", T.LongType()),
    T.StructField("headline", T.StringType()),
])
HISTORY = "epoch int, train_loss double, val_loss double, val_acc double"
METRICS = "model string, accuracy double, precision double, recall double, f1 double"


def _wall_time(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return utc_wall_time(F.col(name)) if isinstance(kind, T.TimestampType) else F.col(name)


def _midnight(df: DataFrame, name: str, on: dt.date) -> Column:
    """UTC midnight in the column's own type, so that the filter reaches the scan."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.lit(dt.datetime(on.year, on.month, on.day, tzinfo=dt.timezone.utc))
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ'{on.isoformat()} 00:00:00'")
    return F.lit(on)


def read_parquet(spark: SparkSession, *paths: str, nanos: Sequence[str] = ()) -> DataFrame:
    """Parquet tables; ``nanos`` names columns stored as nanosecond timestamps.

    Those are read as numbers and turned into zone-less microsecond times. The session
    setting this needs is looked at while the scan is planned, so it stays on.
    """
    if nanos:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(*paths)
    for name in nanos:
        if isinstance(df.schema[name].dataType, T.LongType):
            df = df.withColumn(name, epoch_nanos_to_wall_time(F.col(name)))
    return df


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``writers.write_buckets``. Spark only knows buckets of catalog tables, so the folder is
    named in the session's catalog; any session that sees the folder can read it."""
    layout = spark.read.schema(BUCKETS).json(f"{path}_layout").first()
    name = f"buckets_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields
    )
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"""CREATE TABLE {name} ({columns}) USING parquet
        CLUSTERED BY ({", ".join(f"`{c}`" for c in layout.by)}) SORTED BY ({", ".join(f"`{c}`" for c in layout.sort)})
        INTO {layout.buckets} BUCKETS LOCATION '{path}'""")
    return spark.table(name)


def read_bars(
    spark: SparkSession, *paths: str, tickers: Sequence | None = None,
    start: dt.date | None = None, end: dt.date | None = None, fmt: str = "parquet",
) -> DataFrame:
    """Daily bars of all paths: one row per ticker and day, seven columns.

    ``symbol`` and ``timestamp`` are accepted as names of ticker and date. The ticker and
    date filters are plain predicates on the scan.
    """
    df = spark.read.format(fmt).load(list(paths))
    for old, new in (("symbol", "ticker"), ("timestamp", "date")):
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    if tickers is not None:
        df = df.where(F.col("ticker").isin(list(tickers)))
    if start is not None:
        df = df.where(F.col("date") >= _midnight(df, "date", start))
    if end is not None:
        df = df.where(F.col("date") <= _midnight(df, "date", end))
    when = _wall_time(df, "date")
    numbers = [no_nan(F.col(c).cast("double")).alias(c) for c in PRICES]
    return df.select(day(when).alias("date"), "ticker", *numbers)


BAD_LINE = "__bad_line"
FILE = "__file"


def _landed_json(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, tolerant: bool
) -> DataFrame:
    """Rows of JSON lines; those that cannot be parsed hold only the line, in BAD_LINE.

    Folders are read as deep as they go. A payload without a ticker has that of the folder
    ``ticker=...`` it landed in, whichever root or folder the path names.
    """
    marked = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = spark.read.schema(marked).option("columnNameOfCorruptRecord", BAD_LINE)
    reader = reader.option("recursiveFileLookup", "true")
    raw = reader.option("ignoreCorruptFiles", str(tolerant).lower()).json(list(paths))
    file = F.col("_metadata.file_path")
    # Folder names are escaped once as a partition and once as part of an address.
    folder = F.regexp_extract(file, r".*/ticker=([^/]+)/", 1)
    named = F.when(folder != "", folder)
    for _ in range(2):
        named = F.try_url_decode(F.replace(named, F.lit("+"), F.lit("%2B")))
    known = F.nullif(named, F.lit("__HIVE_DEFAULT_PARTITION__"))
    return raw.withColumns({FILE: file, "ticker": F.coalesce("ticker", known)})


def _whole_lines(landed: DataFrame, watch: Observation | None = None) -> DataFrame:
    """Without the lines that could not be parsed; ``watch`` counts lines, bad ones and files while
    the rows are used. A parsed column is looked at, too, since Spark refuses to read nothing but
    the marker."""
    parsed = F.length(F.coalesce("ticker", F.lit(""))) >= 0
    if watch is not None:
        landed = landed.observe(
            watch, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(BAD_LINE).isNotNull()).alias("bad_lines"),
            # One number per file, of which the driver holds the list anyway.
            F.size(F.collect_set(F.xxhash64(FILE))).alias("files"),
        )
    return landed.where(F.col(BAD_LINE).isNull() & parsed)


def present(spark: SparkSession, *paths: str) -> tuple[list[str], list[str]]:
    """The paths that are there, and those that are not."""
    there, gone = [], []
    for path in paths:
        try:
            spark.read.text(path)
            there.append(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            gone.append(path)
    return there, gone


def filled_files(landed: DataFrame) -> int:
    """Files that are not empty, from their listing; none is opened."""
    files = landed.inputFiles()
    if not files:
        return 0
    listed = landed.sparkSession.read.format("binaryFile").load(list(files))
    return listed.where("length > 0").select(F.lit(1)).count()


def feed_problems(spark: SparkSession, schema: T.StructType, *paths: str) -> dict[str, int]:
    """What a tolerant read of these paths leaves out: paths that are not there, lines that are
    not JSON of this schema, and files of which not one line could be read."""
    there, gone = present(spark, *paths)
    counts = {"missing_paths": len(gone), "bad_lines": 0, "skipped_files": 0}
    if there:
        raw = _landed_json(spark, there, schema, tolerant=True)
        seen = raw.select("ticker", BAD_LINE, FILE).agg(
            F.count("ticker").alias("tickers"),  # see _whole_lines
            F.count_if(F.col(BAD_LINE).isNotNull()).alias("bad"),
            F.count_distinct(FILE).alias("files"),
        ).first()
        counts["bad_lines"] = seen.bad
        counts["skipped_files"] = filled_files(raw) - seen.files
    return counts


def _items_a(landed: DataFrame) -> DataFrame:
    """One row per headline of a nested payload."""
    item = landed.withColumn("item", F.explode_outer("data.news"))
    return item.withColumns({"date": utc_wall_time(F.col("item.created_at")), "headline": F.col("item.headline")})


def _items_b(landed: DataFrame) -> DataFrame:
    return landed.withColumns({"item": F.lit(True), "date": epoch_seconds_to_wall_time(F.col("datetime"))})


def read_news_feed_a(
    spark: SparkSession, *paths: str, tolerant: bool = False, watch: Observation | None = None
) -> DataFrame:
    """Nested payloads ``{ticker, data: {news: [{created_at, headline}]}}``, flattened."""
    lines = _whole_lines(_landed_json(spark, paths, FEED_A, tolerant), watch)
    return _items_a(lines).where("item IS NOT NULL").select("ticker", "date", "headline")


def read_news_feed_b(
    spark: SparkSession, *paths: str, tolerant: bool = False, watch: Observation | None = None
) -> DataFrame:
    """Flat rows ``{ticker, datetime, headline}`` with the time in epoch seconds."""
    lines = _whole_lines(_landed_json(spark, paths, FEED_B, tolerant), watch)
    return _items_b(lines).select("ticker", "date", "headline")


@dataclass(frozen=True)
class FeedIntake:
    """What one pass over a feed's files gave."""

    rows: DataFrame        # ticker, date, headline
    quarantine: DataFrame  # file, line, reason
    counts: dict[str, int]  # missing paths, skipped files; lines landed, good, put aside; rows


INTAKE = "ticker string, date timestamp_ntz, headline string, file string, line string, reason string, part string"


def take_in(spark: SparkSession, feed: str, path: str, *paths: str) -> FeedIntake:
    """Read a feed (``a`` or ``b``) once; in the same pass, write its rows and the lines that are put
    aside to ``path``, in a folder each, and count them.

    A line is put aside if it is not JSON of the feed's schema, or has no ticker, neither itself nor
    in its folder, or no time (flat lines only). The counts are observed while writing: a task that
    runs again after an executor was lost may count its lines twice, the tables never hold them twice.
    """
    schema, items = {"a": (FEED_A, _items_a), "b": (FEED_B, _items_b)}[feed]
    there, gone = present(spark, *paths)
    counts = {"missing_paths": len(gone), "skipped_files": 0, "lines": 0, "good_lines": 0,
              "lines_put_aside": 0, "rows": 0}
    if there:
        landed = _landed_json(spark, there, schema, tolerant=True)
        reason = F.when(F.col(BAD_LINE).isNotNull(), "not JSON of the schema").when(
            F.col("ticker").isNull(), "no ticker")
        if feed == "b":
            reason = reason.when(F.col("datetime").isNull(), "no time")
        seen, made = Observation(), Observation()
        lines = landed.withColumn("reason", reason).observe(
            seen, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("lines_put_aside"),
            F.size(F.collect_set(F.xxhash64(FILE))).alias("files"),
        )
        aside = F.col("reason").isNotNull()
        line = F.when(aside, F.coalesce(BAD_LINE, F.to_json(F.struct(*schema.fieldNames()))))
        if feed == "a":  # a line that is put aside has no items
            lines = lines.withColumns({"line": line, "data": F.when(~aside, F.col("data"))})
        else:
            lines = lines.withColumn("line", line)
        kept = items(lines).where(aside | F.col("item").isNotNull()).select(
            *[F.when(~aside, F.col(c)).alias(c) for c in NEWS.fieldNames()],
            F.when(aside, F.col(FILE)).alias("file"), "line", "reason",
            F.when(aside, "quarantine").otherwise("rows").alias("part"),
        ).observe(made, F.count_if(F.col("part") == "rows").alias("rows"))
        kept.write.mode("overwrite").partitionBy("part").parquet(path)
        found = seen.get
        counts |= {k: found[k] for k in ("lines", "lines_put_aside")} | made.get
        counts["good_lines"] = found["lines"] - found["lines_put_aside"]
        counts["skipped_files"] = filled_files(landed) - found["files"]
    else:
        spark.createDataFrame([], INTAKE).write.mode("overwrite").parquet(path)
    whole = spark.read.schema(INTAKE).parquet(path)
    return FeedIntake(
        whole.where("part = 'rows'").select(*NEWS.fieldNames()),
        whole.where("part = 'quarantine'").select("file", "line", "reason"), counts,
    )


def read_or_empty(
    spark: SparkSession, read: Callable[..., DataFrame], *paths: str,
    schema: T.StructType = NEWS,
) -> DataFrame:
    """The paths of a feed that are there; without any, an empty table. So one ticker's missing
    file costs no other's rows. Files and lines that cannot be read are passed over, and
    counted by ``feed_problems``."""
    there, _ = present(spark, *paths)
    return read(spark, *there, tolerant=True) if there else spark.createDataFrame([], schema)


def _first_level(name: str) -> str:
    """'(\'Close\', \'^VIX\')' -> 'close': the first level of a two-level header."""
    inner = re.match(r"\(\s*'([^']*)'", name)
    return (inner.group(1) if inner else name).lower()


def read_vix(spark: SparkSession, *paths: str, fmt: str = "parquet") -> DataFrame:
    """The index file's close as ``vix`` per day; header levels and case do not matter."""
    raw = spark.read.format(fmt).option("header", True).load(list(paths))
    df = raw.toDF(*[_first_level(c) for c in raw.columns])
    return df.select(
        day(_wall_time(df, "date")).alias("date"),
        no_nan(F.col("close").cast("double")).alias("vix"),
    )


def read_corpus(
    spark: SparkSession, *paths: str, fmt: str = "parquet", key: str | None = None
) -> DataFrame:
    """Labelled sentences whose rows sit in a struct column ``train``.

    ``key`` adds a number that follows the order of the files (by path) and of the rows in
    them, which Parquet files know.
    """
    raw = spark.read.format(fmt).load(list(paths))
    if key is None:
        return raw.select("train.sentence", "train.label")
    placed = raw.select(
        "train.sentence", "train.label", F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__at"),
    )
    files = placed.select("__file").distinct().select(
        "__file", (F.row_number().over(Window.orderBy("__file")) - 1).cast("bigint").alias("__nth")
    )
    number = F.shiftleft("__nth", 40) + F.col("__at")
    return placed.join(files, "__file").select(number.alias(key), "sentence", "label")


def read_history(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON arrays of epochs, one file per model; the model is the file name's head."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)_history\.json", 1)
    return (
        spark.read.schema(HISTORY).option("multiLine", True).json(list(paths))
        .withColumn("model", name)
    )


def read_metrics(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(METRICS).option("multiLine", True).json(list(paths))


def backfill_years(ranges: DataFrame) -> DataFrame:
    """(ticker, start, end) -> one request per calendar year, cut to the range."""
    years = F.sequence(F.year("start"), F.year("end"))
    return (
        ranges.where(F.col("start") <= F.col("end"))
        .select("*", F.explode(years).alias("year"))
        .select(
            "ticker", "year",
            F.greatest("start", F.make_date("year", F.lit(1), F.lit(1))).alias("from_date"),
            F.least("end", F.make_date("year", F.lit(12), F.lit(31))).alias("to_date"),
        )
    )
