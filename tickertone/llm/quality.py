"""Quality rules: statistics of each text, and lines that too many documents of a host share.

A line is normalised (A to Z in lower case, digits as 0, words joined by one space) and hashed.
For every host the distinct documents that hold a line are counted; a line in more than
``max(min_docs, share * documents of the host)`` of them is boilerplate. A document that loses
more than half of its words with those lines is depleted and rejected.

Defined cases: a null text counts as empty (all statistics 0, base_failed, not kept). Rows
without a host form one host. Rows are never merged: a repeated row is one more document, with
a result of its own. Lines without a word are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import words as W
from .frames import ROW, each_batch, rows_of

MIN_DOCS = 20        # a line in at most so many documents of a host always stays
SHARE = 0.01         # ... and so does one in at most this share of the host's documents
LEAST_LEFT = 0.5     # share of a document's words that must remain
MIN_WORDS = 50
MAX_REPEATED = 0.5   # share of words inside repeated windows of three words

_NORMAL = W.lowered(np.arange(256, dtype=np.uint8))
_NORMAL[48:58] = 48
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATISTICS = (
    "__row long, doc_id long, host string, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<int>"
)


def _repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text: its words in windows of three that the text holds more than once."""
    n, texts = len(hashes), len(first) - 1
    if n < 3:
        return np.zeros(texts, dtype=np.int64)
    owner = np.repeat(np.arange(texts), np.diff(first))
    whole = owner[:-2] == owner[2:]
    windows = W.mixed(W.runs_of(hashes, 3) + owner[:-2].astype(np.uint64))[whole]
    at = np.flatnonzero(whole)
    _, group, count = np.unique(windows, return_inverse=True, return_counts=True)
    found = at[count[group] > 1]
    inside = np.zeros(n, dtype=bool)
    for k in range(3):
        inside[found + k] = True
    return W.counts_between(inside, first)


def _lines(part: W.Texts, starts: np.ndarray, normal: np.ndarray):
    """For each line with a word: its text, the hash of its bytes and of its words, its words."""
    data, at = part.data, part.offsets
    edges = np.unique(np.concatenate([at, np.flatnonzero(data == 10) + 1]))
    begins, ends = edges[:-1], edges[1:]
    word_edges = np.searchsorted(starts, edges)
    holds = np.diff(word_edges) > 0
    begins, ends = begins[holds], ends[holds]
    stop = np.where(data[ends - 1] == 10, ends - 1, ends)
    owner = np.searchsorted(at, begins, side="right") - 1
    raw = W.span_hashes(data, begins, stop)
    lows, highs = word_edges[:-1][holds], word_edges[1:][holds]
    return owner, raw, W.span_hashes(normal, lows, highs), highs - lows


def _statistics(batch: pa.RecordBatch):
    row, doc, host, text = batch.columns
    for part in W.texts(text):
        n = len(part)
        starts, ends, first = W.split_words(part)
        hashes = W.span_hashes(part.data, starts, ends)
        normal = W.span_hashes(_NORMAL[part.data], starts, ends)
        owner, raw, lines, count = _lines(part, starts, normal)
        raw_key = W.mixed(raw ^ W.mixed(owner.astype(np.uint64)))
        _, once = np.unique(raw_key, return_index=True)
        repeats = np.bincount(owner, minlength=n) - np.bincount(owner[once], minlength=n)
        key = W.mixed(lines ^ W.mixed(owner.astype(np.uint64)))
        _, picked, group = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(group, weights=count, minlength=len(picked))
        order = np.argsort(owner[picked], kind="stable")
        picked, total = picked[order], total[order]
        lengths = np.bincount(owner[picked], minlength=n)
        letter = W.characters(part.data) & ~W.spaces(part.data)
        some = slice(part.first, part.first + n)
        yield pa.RecordBatch.from_arrays(
            [
                row[some], doc[some], host[some],
                pa.array(np.diff(first)),
                pa.array(W.counts_between(letter, part.offsets)),
                pa.array(W.counts_between(_SYMBOL[part.data], part.offsets)),
                pa.array(repeats.astype(np.int64)),
                pa.array(_repeated_words(hashes, first)),
                W.lists(lines[picked].view(np.int64), lengths, pa.int64()),
                W.lists(total.astype(np.int32), lengths, pa.int32()),
            ],
            names=[c.split()[0] for c in STATISTICS.split(", ")],
        )


def text_statistics(docs: DataFrame, text="text", doc_id="doc_id", host="source") -> DataFrame:
    """One row per row of ``docs``: counts of the whole text, and its distinct lines."""
    rows = rows_of(
        docs, doc_id=F.col(doc_id).cast("long"), host=F.col(host).cast("string"),
        text=F.col(text).cast("string"),
    )
    return each_batch(rows, _statistics, STATISTICS)


def common_lines(stats: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """Lines (keys of host and line) in too many distinct documents of a host."""
    key = F.xxhash64("host", "line").alias("key")
    counted = (
        stats.select("host", F.explode("lines").alias("line")).select("host", key)
        .groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.first("host").alias("host"))
        .where(F.col("docs") > min_docs)
    )
    hosts = stats.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    limit = F.greatest(F.lit(float(min_docs)), F.col("host_docs") * share)
    joined = counted.alias("c").join(hosts.alias("h"), F.expr("c.host <=> h.host"))
    return joined.where(F.col("docs") > limit).select("key", "docs")


def quality(
    docs: DataFrame, text="text", doc_id="doc_id", host="source",
    min_docs: int = MIN_DOCS, share: float = SHARE, least_left: float = LEAST_LEFT,
) -> DataFrame:
    """Statistics, words lost with common lines, and the verdict of every row of ``docs``."""
    stats = stage(text_statistics(docs, text, doc_id, host), "lines")
    common = common_lines(stats, min_docs, share)
    pairs = F.explode(F.arrays_zip("lines", "line_words")).alias("p")
    held = stats.select(ROW, "host", pairs).select(
        ROW, F.xxhash64("host", F.col("p.lines").alias("line")).alias("key"),
        F.col("p.line_words").alias("n"),
    )
    lost = held.join(common, "key").groupBy(ROW).agg(F.sum("n").alias("lost"))
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < MIN_WORDS) | (repeated > MAX_REPEATED * n)
    left = n - F.col("n_common_words")
    return (
        stats.drop("lines", "line_words").join(lost, ROW, "left")
        .withColumn("n_common_words", F.coalesce("lost", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (left >= least_left * n))
        .drop(ROW, "lost", "host")
    )
