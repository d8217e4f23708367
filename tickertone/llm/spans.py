"""Spans in texts as ``kind:start:end``, counted in code points, end exclusive."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Span = tuple[int, int, int]  # start, number of the kind, end


def joined(spans: Sequence[Span], kinds: Sequence[str]) -> str:
    """By start, then in the order of ``kinds``."""
    return ",".join(f"{kinds[k]}:{start}:{end}" for start, k, end in sorted(spans))


def digest(spans: Sequence[Span], kinds: Sequence[str]) -> str:
    return hashlib.sha256(joined(spans, kinds).encode()).hexdigest()


def counts(spans: Sequence[Span], n: int) -> list[int]:
    out = [0] * n
    for _, kind, _ in spans:
        out[kind] += 1
    return out


class Taken:
    """What some spans cover, as separate stretches in order; each question is a binary search."""

    def __init__(self, spans: Iterable[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end) - 1
        return before >= 0 and self.ends[before] > start


def joined_column(spans: Column, kinds: Sequence[str]) -> Column:
    """``joined`` for an array of structs (start, kind, end) in Spark."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]),
        ),
        ",",
    )


def sliced(batch: pa.RecordBatch, rows: int = 256):
    """The batch a few rows at a time, so that few texts are Python strings at once."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def text_rows(df: DataFrame, text: str, doc_id: str) -> dict[str, Column]:
    return {"doc_id": F.col(doc_id).cast("long"), "text": F.col(text).cast("string")}
