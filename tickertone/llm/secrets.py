"""Secrets in texts, told apart by who owns them.

Three kinds follow fixed patterns (``assign``, ``access``, ``hex``) and are always reported.
A fourth, ``opaque``, is any other long run of mixed characters; whether it is a credential is
decided by the whole corpus. Every candidate value is hashed, and the distinct repositories and
owners that hold the hash are counted. A value of many owners is a copied example; one that
looks random and stays with few owners and repositories is taken as live. Opaque candidates
are reported only if they are live.

Defined cases: a null text is empty (no spans). Null owners or repositories count as one owner
or repository of their own. Rows are never merged: a repeated row has its own result, and
copies inside one repository do not raise a value's count. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import spans as S
from .frames import ROW, each_batch, rows_of

KINDS = ("assign", "access", "hex", "opaque")
MAX_OWNERS, MAX_REPOSITORIES = 2, 4  # beyond these a value is a copied example
LEAST_BITS = 3.0                     # entropy per character of a value that looks live

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are matched whole, so short ones need no check
_OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_DIGIT = re.compile(r"[0-9]")
_PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|your|xxxx|0000|1234", re.I)

FOUND = (
    "__row long, doc_id long, owner string, repository string, n_assign long, n_access long, "
    "n_hex long, base_sha256 string, "
    "found array<struct<start:int, kind:int, end:int, value:binary, random:boolean>>"
)


def bits(value: str) -> float:
    """Shannon entropy per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    return bits(value) >= LEAST_BITS and not _PLACEHOLDER.search(value)


def base_spans(text: str) -> list[tuple[S.Span, str]]:
    """Spans of the three fixed kinds with their secret values."""
    out = []
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= 12:
            out.append(((m.start(), 0, m.end()), m[2]))
    if "AKIA" in text:
        out += [((m.start(), 1, m.end()), m[0]) for m in _ACCESS.finditer(text)]
    out += [((m.start(), 2, m.end()), m[0]) for m in _HEX.finditer(text)]
    return out


def opaque_spans(text: str, taken: list[S.Span]) -> list[tuple[S.Span, str]]:
    """Long runs with digits and letters that overlap none of ``taken``."""
    if not _DIGIT.search(text):
        return []
    out, covered = [], S.Taken(taken)
    for m in _OPAQUE.finditer(text):
        value = m[0]
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        if mixed and not covered.touches(m.start(), m.end()):
            out.append(((m.start(), 3, m.end()), value))
    return out


def _find(batch: pa.RecordBatch):
    for part in S.sliced(batch):
        numbers, digests, found = [], [], []
        for text in part.column(3).to_pylist():
            base = base_spans(text or "")
            spans = [span for span, _ in base]
            numbers.append(S.counts(spans, 3))
            digests.append(S.digest(spans, KINDS))
            found.append([
                {
                    "start": start, "kind": kind, "end": end,
                    "value": hashlib.blake2b(value.encode(), digest_size=16).digest(),
                    "random": looks_random(value),
                }
                for (start, kind, end), value in base + opaque_spans(text or "", spans)
            ])
        kind = pa.list_(pa.struct([
            ("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()),
            ("value", pa.binary()), ("random", pa.bool_()),
        ]))
        counted = [pa.array(c, pa.int64()) for c in zip(*numbers, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), part.column(2), part.column(4), *counted,
             pa.array(digests), pa.array(found, kind)],
            names=["__row", "doc_id", "owner", "repository", "n_assign", "n_access", "n_hex",
                   "base_sha256", "found"],
        )


def find_secrets(
    docs: DataFrame, text="text", doc_id="doc_id",
    owner: Column | None = None, repository: Column | None = None,
) -> DataFrame:
    """Every candidate of every row. Owner and repository default to the source, and to the
    source's part in one language."""
    owner = F.col("source") if owner is None else owner
    if repository is None:
        repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    rows = rows_of(
        docs, doc_id=F.col(doc_id).cast("long"), owner=owner.cast("string"),
        text=F.col(text).cast("string"), repository=repository.cast("string"),
    )
    return each_batch(rows, _find, FOUND)


def ownership(found: DataFrame) -> DataFrame:
    """For each hashed value the distinct owners and repositories that hold it."""
    held = found.select(F.explode("found.value").alias("value"), "owner", "repository")
    return (
        held.groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value").agg(
            F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories")
        )
    )


def scan(
    docs: DataFrame, text="text", doc_id="doc_id",
    owner: Column | None = None, repository: Column | None = None,
    max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Spans of every row, how many of them are live, and how many copied examples."""
    found = stage(find_secrets(docs, text, doc_id, owner, repository), "secrets")
    each = found.select(ROW, F.explode("found").alias("f")).select(ROW, "f.*")
    few = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    live = F.col("random") & few
    shown = F.when((F.col("kind") < 3) | live, F.struct("start", "kind", "end"))
    judged = (
        each.join(ownership(found), "value")
        .groupBy(ROW).agg(
            F.collect_list(shown).alias("shown"),
            F.count_if(live).alias("n_live"),
            F.count_if(~few & (F.col("kind") < 3)).alias("n_copied"),
            F.count_if(live & (F.col("kind") == 3)).alias("n_opaque"),
        )
    )
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return found.drop("found", "owner", "repository").join(judged, ROW, "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        S.joined_column(F.coalesce("shown", nothing), KINDS).alias("spans"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_copied", "n_opaque")],
    )
