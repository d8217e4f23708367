"""Session and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "tickertone", cores: str | int = "*", **conf) -> SparkSession:
    """A local session with the settings the engine is tuned for (tests, bench)."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call sites for error messages cost several round trips per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own; on a
    cluster that folder would be lost with its machine, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tickertone-")
        _own_folders.append(folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_staged: list[str] = []
_own_folders: list[str] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, removed with the other staged tables."""
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a plan needs its input twice (fit, then transform): the input is
    computed once, both readers prune columns, and a lost executor costs a re-read
    rather than the whole lineage.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def _remove(paths: list[str]) -> None:
    for path in paths:
        files, folder = pafs.FileSystem.from_uri(path if ":/" in path else os.path.abspath(path))
        if files.get_file_info(folder).type == pafs.FileType.Directory:
            files.delete_dir(folder)


@contextmanager
def staging() -> Iterator[None]:
    """Tables staged inside are removed at the end. For work that writes its results inside;
    a lazy result that is returned still needs them."""
    first = len(_staged)
    try:
        yield
    finally:
        _remove(_staged[first:])
        del _staged[first:]


def _remove_own_folders() -> None:
    _remove([path for path in _staged if path.startswith(tuple(_own_folders))] if _own_folders else [])


atexit.register(_remove_own_folders)

@contextmanager
def batches_by_rows(spark: SparkSession) -> Iterator[None]:
    """While inside, Arrow batches end by their number of rows only. Spark otherwise measures the batch after every
    row, which costs more than a short row does; for rows of which a batch is small anyway."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(2**31 - 1))
    try:
        yield
    finally:
        spark.conf.set(name, before)


SMALL_INPUT = 128 << 20  # could be a single row group
SHUFFLE_BYTES = 128 << 20
_file_bytes: dict[frozenset[str], int] = {}


def estimated_bytes(df: DataFrame) -> int:
    """Bytes of all files ``df`` reads, listed once per set of files."""
    files = frozenset(df.inputFiles())
    if files and files not in _file_bytes:
        listed = df.sparkSession.read.format("binaryFile").load(sorted(files))
        _file_bytes[files] = listed.agg(F.sum("length")).first()[0] or 0
    return _file_bytes.get(files, 0)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Share the rows of a small input among the cores, for heavy work per row.

    A file of one row group is one task, however much is done to each row. Only the plan
    depends on the size: inputs that fill more than one task anyway are left as they are.
    """
    size = estimated_bytes(df)
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, (size >> 20) + 1)
    if size >= SMALL_INPUT or tasks == 1:
        return df
    return df.repartition(tasks, key)


@contextmanager
def sized_shuffles(spark: SparkSession, *inputs: DataFrame) -> Iterator[int]:
    """While inside, at least so many shuffle partitions that one holds about 128 MB of ``inputs``.

    Never fewer than the session asks for: adaptive execution merges partitions that turn out
    small, but cannot divide ones that were planned too large.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    partitions = max(int(before), sum(map(estimated_bytes, inputs)) // SHUFFLE_BYTES)
    spark.conf.set(name, str(partitions))
    try:
        yield partitions
    finally:
        spark.conf.set(name, before)
