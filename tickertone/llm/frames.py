"""Small helpers the operators share: row keys, Arrow passes, sums of long vectors."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import mixed

ROW = "__row"
SLICE = 1 << 18    # numbers of a long vector that travel in one row
FAN_IN = 512       # partial vectors that one task adds up

Batches = Iterator[pa.RecordBatch]


def rows_of(df: DataFrame, **columns: Column | str) -> DataFrame:
    """The named columns and a key of the row. The key is safe to use once staged."""
    picked = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return df.select(F.monotonically_increasing_id().alias(ROW), *picked)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` begins with."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = f"_{name}"
    return name


def give_back() -> None:
    """Hand freed memory back to the system. Spark keeps its Python workers for later tasks, and what
    they keep adds up with the workers of the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only glibc has it
        pass


def tidied(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` on the batches of a task, after which the worker gives back its memory."""
    def run(batches: Batches) -> Batches:
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


def each_batch(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch],
    schema: str | T.StructType,
) -> DataFrame:
    """``work`` on every Arrow batch of ``df``; it returns one batch or yields several."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            done = work(batch)
            if isinstance(done, pa.RecordBatch):
                yield done
            else:
                yield from done
    return df.mapInArrow(tidied(run), schema)


def _add_up(batches: Batches) -> Batches:
    totals: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for part, piece, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            numbers = np.frombuffer(zlib.decompress(packed), dtype=np.float64)
            held = totals.get((part, piece))
            totals[part, piece] = numbers.copy() if held is None else held + numbers
    yield from vector_rows(totals)


def vector_rows(totals: dict[tuple, np.ndarray]) -> Batches:
    for (part, piece), numbers in totals.items():
        packed = zlib.compress(numbers.astype(np.float64).tobytes(), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([piece], pa.int32()), pa.array([packed])],
            names=["part", "piece", "numbers"],
        )


VECTOR = "part int, piece int, numbers binary"


def pieces(vector: np.ndarray, part: int) -> dict[tuple, np.ndarray]:
    """A long vector in slices, those without a number other than zero left out."""
    out = {}
    for start in range(0, len(vector), SLICE):
        piece = vector[start:start + SLICE]
        if piece.any():
            out[part, start // SLICE] = piece
    return out


def summed_vector(df: DataFrame, length: int) -> np.ndarray:
    """The sum of the long vectors that the tasks of ``df`` (rows of VECTOR) hold.

    ``part`` is the id of the task that made the row. Slices are added up in two steps, so
    that no task reads more than FAN_IN partial vectors of a slice at first, nor more than
    (tasks / FAN_IN) afterwards. What reaches the driver is one vector of ``length`` numbers.
    """
    wide = -(-length // SLICE)
    grouped = df.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
    once = grouped.repartition(wide, "part", "piece").mapInArrow(tidied(_add_up), VECTOR)
    both = (
        once.withColumn("part", F.lit(0)).repartition(wide, "piece").mapInArrow(tidied(_add_up), VECTOR)
    )
    total = np.zeros(wide * SLICE)
    for row in both.toLocalIterator():
        numbers = np.frombuffer(zlib.decompress(row.numbers), dtype=np.float64)
        total[row.piece * SLICE:row.piece * SLICE + len(numbers)] += numbers
    return total[:length]


SLOTS = 1 << 22  # of a filter of ids: 512 kB when broadcast, whatever the input


def _slots(ids: pa.Array) -> np.ndarray:
    numbers = np.asarray(ids.fill_null(-1)).astype(np.int64).view(np.uint64)
    return (mixed(numbers) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


class IdFilter:
    """Which ids may be among those of a table: never misses one, lets a few others through.

    With many more ids than slots it lets everything through, which costs a shuffle of rows
    that a join then drops, and changes no result.
    """

    def __init__(self, ids: DataFrame):
        def fill(batches: Batches) -> Batches:
            total = np.zeros(SLOTS, dtype=np.int8)
            for batch in batches:
                total[_slots(batch.column(0))] = 1
            yield from vector_rows(pieces(total, TaskContext.get().partitionId()))

        filled = summed_vector(ids.mapInArrow(tidied(fill), VECTOR), SLOTS) > 0
        self._bits = ids.sparkSession.sparkContext.broadcast(np.packbits(filled))

    def holds(self, ids: pa.Array) -> pa.Array:
        at = _slots(ids)
        return pa.array((self._bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)


def among(df: DataFrame, chosen: IdFilter, id_column: int = 0) -> DataFrame:
    """Rows whose id may be among the chosen ones."""
    return each_batch(
        df, lambda batch: batch.filter(chosen.holds(batch.column(id_column))), df.schema
    )
