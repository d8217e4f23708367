"""Benchmark decontamination by latent semantic retrieval.

* One pass over all texts counts in how many of them each hashed term occurs, and adds the
  passages' term counts, with random signs, into a few rows: a randomised range finder for the
  passage-term matrix. Both are sums of vectors of fixed length.
* The rows, weighted by inverse document frequency, and those of the benchmark's passages are
  decomposed on the driver (a matrix of some hundred rows). Its right singular vectors are the
  latent space; the benchmark's own directions are weighted up so that they are kept.
* A second pass compares every window of 64 words (a step of 16 words apart) with every
  benchmark passage in that space: how much of the passage it covers, and by cosine. A sparse
  bound on the first is taken before, and only windows that can reach it are projected.
  Weights of rare words dominate there, so windows around which enough of a passage's words
  stand in order, whatever their weight, are candidates as well.
  Candidates are checked in place on their words: the
  longest common subsequence with the benchmark passage decides, and in the range of
  paraphrases the words of the answer must be there as well.

Benchmark passages are searched ITEMS at a time, each time against all texts, so what is sent to
the tasks is bounded (TERMS rows of about ITEMS + RANGE numbers) whatever the benchmark's size.

Defined cases: null or empty texts match nothing. Benchmark items that are null or shorter than
SHORTEST words are not searched; long ones are cut into passages of 64 words, any of these may
match, and the item's answer is looked for as far away as the item is long. Without an answer column the last sentence is taken as the answer. Repeated rows and
ids are searched one by one; a match of the same id and item is returned once. Rows without an id
are searched but left out of ``matches``. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .frames import VECTOR, each_batch, pieces, summed_vector, tidied, vector_rows

TERMS = 1 << 16
RANGE = 32           # rows of the range finder
ITEMS = 192          # benchmark passages that are searched in one pass
STEP, STEPS = 16, 4  # words of a block, and blocks of a window
SEGMENT = 16         # windows whose words are compared with a passage's at once
SHORTEST = 8
LITTLE = 0.005                   # share of a passage that one word covers and that is not listed
COSINE, COVERED = 0.3, 0.3       # what makes a window a candidate
COPIED, PARAPHRASED, ANSWERED = 0.8, 0.5, 0.8


@dataclass
class Passage:
    """A benchmark passage: its words and those of its item's answer, as hashes."""

    item: int
    words: np.ndarray
    answer: Counter
    reach: int  # words of the whole item: so far on either side the answer may stand


def _hashes(text: str) -> np.ndarray:
    part = next(W.texts(pa.array([text], pa.string())))
    starts, ends, _ = W.split_words(part)
    return W.span_hashes(W.lowered(part.data), starts, ends)


def passages(item: int, text: str, answer: str | None = None) -> list[Passage]:
    found = _hashes(text)
    if len(found) < SHORTEST:
        return []
    if answer is None:
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s]
        answer = sentences[-1]
    wanted = Counter(_hashes(answer).tolist()) if answer.strip() else Counter()
    whole = STEP * STEPS
    edges = [*range(0, max(1, len(found) - whole // 2), whole), len(found)]
    if len(edges) == 2:
        return [Passage(item, found, wanted, len(found))]
    return [
        Passage(item, found[a:b], wanted, len(found)) for a, b in zip(edges, edges[1:], strict=False)
    ]


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(TERMS - 1)).astype(np.int64)


def _blocks(count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of each block of ``size`` words; the last of a text may be shorter."""
    blocks = -(-count // size)
    owner = np.repeat(np.arange(len(count)), blocks)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    first = np.cumsum(count) - count
    return first[owner] + inside * size, owner


def corpus_range(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """The range finder's rows (RANGE, TERMS), texts with each term, and the number of texts."""
    def count(batches):
        frequency = np.zeros(TERMS + 1)
        rows = np.zeros(RANGE * TERMS)
        for batch in batches:
            for part in W.texts(batch.column(0)):
                starts, ends, first = W.split_words(part)
                hashes = W.span_hashes(W.lowered(part.data), starts, ends)
                terms = _terms(hashes)
                n = np.diff(first)
                owner = np.repeat(np.arange(len(part)), n)
                once = np.unique(owner * TERMS + terms)
                frequency[:-1] += np.bincount(once & (TERMS - 1), minlength=TERMS)
                frequency[-1] += int((n > 0).sum())
                begin, _ = _blocks(n, STEP * STEPS)
                seeds = W.mixed(hashes[begin] + np.uint64(1)) if len(begin) else hashes[:0]
                size = np.diff(np.append(begin, len(hashes)))
                row = (seeds % np.uint64(RANGE)).astype(np.int64)
                sign = 1.0 - 2.0 * ((seeds >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
                np.add.at(rows, np.repeat(row, size) * TERMS + terms, np.repeat(sign, size))
        total = np.concatenate([rows, frequency])
        yield from vector_rows(pieces(total, TaskContext.get().partitionId()))

    length = RANGE * TERMS + TERMS + 1
    total = summed_vector(docs.mapInArrow(tidied(count), VECTOR), length)
    return total[:RANGE * TERMS].reshape(RANGE, TERMS), total[RANGE * TERMS:-1], float(total[-1])


@dataclass
class Space:
    """The latent space of some benchmark passages: loadings of the terms that matter."""

    passages: list[Passage]
    row: np.ndarray        # of each term in ``loading``, -1 where it has none
    loading: np.ndarray    # (terms that matter, dimensions)
    items: np.ndarray      # (dimensions, passages), of length one
    norms: np.ndarray      # lengths of the projected passages
    edges: np.ndarray      # of each term's entries in ``entry_item`` and ``entry``
    entry_item: np.ndarray
    entry: np.ndarray      # what one occurrence of the term covers of the passage, if not little
    little: np.ndarray     # the most an occurrence covers of any passage besides
    held: np.ndarray       # how often each term is in each passage
    least: np.ndarray      # words of each passage that a leak has at least


def latent_space(some: list[Passage], rows: np.ndarray, frequency: np.ndarray, texts: float) -> Space:
    # A term of every text weighs little, but not nothing: a corpus may be a single text.
    idf = np.log((1.0 + texts) / (1.0 + frequency)) + 0.01
    matter = np.unique(np.concatenate([_terms(p.words) for p in some]))
    held = np.stack([
        np.bincount(np.searchsorted(matter, _terms(p.words)), minlength=len(matter)) for p in some
    ])
    own = held * idf[matter]
    own_scaled = 4.0 * own / np.linalg.norm(own, axis=1, keepdims=True)
    corpus = rows * idf
    scale = np.linalg.norm(corpus, axis=1, keepdims=True)
    corpus /= np.where(scale > 0, scale, 1.0)
    # Left singular vectors of all rows; the right ones are needed for the terms that matter only.
    stacked = np.concatenate([own_scaled, corpus[:, matter]])
    gram = stacked @ stacked.T
    gram[len(some):, len(some):] = corpus @ corpus.T
    values, left = np.linalg.eigh(gram)
    keep = values > 1e-9 * float(values[-1])
    basis = (stacked.T @ left[:, keep]) / np.sqrt(values[keep])
    loading = basis * idf[matter][:, None]
    row = np.full(TERMS, -1, dtype=np.int32)
    row[matter] = np.arange(len(matter))
    items = own @ basis
    norms = np.linalg.norm(items, axis=1)
    unit = items / np.where(norms > 0, norms, 1.0)[:, None]
    covers = loading @ unit.T / np.where(norms > 0, norms, np.inf)[None, :]
    listed = covers >= LITTLE
    term, item = np.nonzero(listed)
    return Space(
        some, row, loading.astype(np.float32), unit.T.astype(np.float32), norms,
        np.searchsorted(term, np.arange(len(matter) + 1)), item, covers[term, item],
        np.where(listed, 0.0, np.maximum(covers, 0.0)).max(axis=1, initial=0.0),
        np.ascontiguousarray(held.T.astype(np.uint8)),
        np.array([int(np.ceil(PARAPHRASED * len(p.words))) for p in some]),
    )


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers first, first + 1, ... of each range, and the range each belongs to."""
    which = np.repeat(np.arange(len(count)), count)
    return np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which], which


def _over_windows(blocks: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Sums over each block and the following ones of its window, within a text."""
    out = blocks.copy()
    for k in range(1, STEPS):
        same = owner[k:] == owner[:-k]
        out[:-k][same] += blocks[k:][same]
    return out


def _worth_projecting(space: Space, rows: np.ndarray, block: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Windows that may cover enough of a passage. Each occurrence of a term counts for the
    passages it covers noticeably; for all others the most it can add is added to the sum, so
    that no window that does cover enough is left out."""
    n = len(owner)
    count = np.diff(space.edges)[rows]
    at, which = _spread(space.edges[rows], count)
    cell = block[which] * len(space.passages) + space.entry_item[at]
    covered = np.bincount(cell, weights=space.entry[at], minlength=n * len(space.passages))
    covered = _over_windows(covered.reshape(n, -1), owner).max(axis=1)
    rest = _over_windows(np.bincount(block, weights=space.little[rows], minlength=n), owner)
    return np.flatnonzero(covered + rest >= COVERED * (1 - 1e-6))


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit by bit along ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for x in b.tolist():
        if x in masks:
            hit = state & masks[x]
            state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def _judge(p: Passage, region: np.ndarray, around: np.ndarray) -> tuple[float, float, bool]:
    """Shares of the passage in the region and of its answer around it, and whether that is a leak."""
    share = common_subsequence(p.words, region) / len(p.words)
    if share < PARAPHRASED:
        return share, 0.0, False
    held = Counter(around.tolist())
    wanted = sum(p.answer.values())
    answer = sum(min(n, held[x]) for x, n in p.answer.items()) / wanted if wanted else 0.0
    return share, answer, share >= COPIED or answer >= ANSWERED


def _sharing(space: Space, hashes, row, used, begin, owner, first):
    """(windows, passage) of SEGMENT windows in a row around which enough of the passage's words
    stand in order, whatever their weight: no window that _judge accepts is missing."""
    n = np.diff(np.searchsorted(owner, np.arange(len(first))))
    head, text = _blocks(n, SEGMENT)                # first window of each segment
    tail = np.minimum(head + SEGMENT, np.cumsum(n)[text])
    around = max(len(p.words) for p in space.passages)
    low = np.maximum(begin[head] - around, first[text])
    high = np.minimum(begin[tail - 1] + STEP * STEPS + around, first[text + 1])
    a, b = np.searchsorted(used, low), np.searchsorted(used, high)
    filled = np.flatnonzero(b - a >= space.least.min())
    if not len(filled):
        return
    at, which = _spread(a[filled], (b - a)[filled])
    terms = len(space.held)
    which, term = np.divmod(np.unique(which * terms + row[used[at]]), terms)
    starts = np.searchsorted(which, np.arange(len(filled)))
    held = np.add.reduceat(space.held[term], starts, axis=0, dtype=np.uint8)
    for k, j in zip(*np.nonzero(held >= space.least[None, :]), strict=True):
        p, segment = space.passages[j], filled[k]
        words = used[a[segment]:b[segment]]
        words = words[space.held[row[words], j] > 0]
        if len(words) < space.least[j] or common_subsequence(p.words, hashes[words]) < space.least[j]:
            continue
        windows = np.arange(head[segment], tail[segment])
        there = np.searchsorted(words, begin[windows] + STEP * STEPS + len(p.words))
        there -= np.searchsorted(words, begin[windows] - len(p.words))
        if (there >= space.least[j]).any():
            yield windows[there >= space.least[j]], j


def _search(part: W.Texts, space: Space):
    """(text, item, cosine, shared, answered) of the leaks in some texts."""
    starts, ends, first = W.split_words(part)
    if not len(starts):
        return
    hashes = W.span_hashes(W.lowered(part.data), starts, ends)
    count = np.diff(first)
    begin, owner = _blocks(count, STEP)
    row = space.row[_terms(hashes)]
    used = np.flatnonzero(row >= 0)
    rows = row[used]
    best: dict[tuple[int, int], tuple] = {}

    def projected(windows: np.ndarray) -> np.ndarray:
        low = np.searchsorted(used, begin[windows])
        high = np.searchsorted(used, np.minimum(begin[windows] + STEP * STEPS, first[owner[windows] + 1]))
        at, which = _spread(low, high - low)
        out = np.zeros((len(windows), space.loading.shape[1]), dtype=np.float32)
        filled = np.flatnonzero(high > low)
        if len(filled):
            starts = (np.cumsum(high - low) - (high - low))[filled]
            out[filled] = np.add.reduceat(space.loading[rows[at]], starts, axis=0)
        return out

    def judge(w: int, j: int, window: np.ndarray) -> None:
        p = space.passages[j]
        text = owner[w]
        region, around = (
            hashes[max(first[text], begin[w] - n):min(first[text + 1], begin[w] + STEP * STEPS + n)]
            for n in (len(p.words), p.reach)
        )
        share, answer, leak = _judge(p, region, around)
        if leak:
            length = float(np.linalg.norm(window))
            cosine = float(window @ space.items[:, j]) / length if length else 0.0
            key = (int(text), p.item)
            best[key] = max(best.get(key, (0.0,)), (share, answer, cosine))

    some = _worth_projecting(space, rows, np.searchsorted(begin, used, side="right") - 1, owner)
    if len(some):
        window = projected(some)
        length = np.linalg.norm(window, axis=1)
        along = window @ space.items
        near = (along >= COSINE * length[:, None]) & (along >= COVERED * space.norms[None, :])
        for k, j in zip(*np.nonzero(near), strict=True):
            judge(some[k], j, window[k])
    for windows, j in _sharing(space, hashes, row, used, begin, owner, first):
        for w, window in zip(windows, projected(windows), strict=True):
            judge(w, j, window)
    for (text, item), (share, answer, cosine) in sorted(best.items()):
        yield text, item, cosine, share, answer


def benchmark_passages(benchmark: DataFrame, item_id="item_id", text="text", answer: str | None = None):
    """Lists of at most ITEMS passages, so that only so many are on the driver at a time."""
    held: list[Passage] = []
    rows = benchmark.select(
        F.col(item_id).cast("long").alias("item"), F.col(text).cast("string").alias("text"),
        (F.col(answer) if answer else F.lit(None)).cast("string").alias("answer"),
    ).where("item is not null and text is not null").orderBy("item", "text")
    for r in rows.toLocalIterator():
        held += passages(r.item, r.text, r.answer)
        while len(held) >= ITEMS:
            yield held[:ITEMS]
            held = held[ITEMS:]
    if held:
        yield held


FOUND = "item_id long, cosine double, shared double, answered double"


def with_leaks(docs: DataFrame, benchmark: DataFrame, text="text", out="leaks", **columns) -> DataFrame:
    """``docs`` with the leaks of each row in the array ``out``, searched in whole texts."""
    docs = docs.drop(out)
    spark = docs.sparkSession
    groups = list(benchmark_passages(benchmark, **columns))
    schema = T.StructType([
        *docs.schema.fields, T.StructField(out, T.ArrayType(T.StructType.fromDDL(FOUND)))
    ])
    if not groups:
        return docs.withColumn(out, F.array().cast(schema[out].dataType))
    corpus = corpus_range(docs.select(F.col(text).cast("string")))
    shared = [spark.sparkContext.broadcast(latent_space(g, *corpus)) for g in groups]
    at = docs.columns.index(text)
    kind = pa.list_(pa.struct([
        ("item_id", pa.int64()), ("cosine", pa.float64()), ("shared", pa.float64()),
        ("answered", pa.float64()),
    ]))

    def find(batch: pa.RecordBatch):
        held = pa.Table.from_batches([batch])
        for part in W.texts(batch.column(at).cast(pa.string())):
            found: list[list[dict]] = [[] for _ in range(len(part))]
            for space in shared:
                for i, item, cosine, share, answer in _search(part, space.value):
                    found[i].append({
                        "item_id": item, "cosine": cosine, "shared": share, "answered": answer,
                    })
            some = held.slice(part.first, len(part)).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(found, kind)], names=[*some.schema.names, out]
            )

    return each_batch(docs, find, schema)


def matches(docs: DataFrame, benchmark: DataFrame, text="text", doc_id="doc_id", **columns) -> DataFrame:
    """One row per document and benchmark item that leaked into it."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    found = with_leaks(rows, benchmark, "text", "leaks", **columns).where("doc_id is not null")
    return found.select("doc_id", F.inline("leaks")).groupBy("doc_id", "item_id").agg(
        F.max("shared").alias("shared"), F.max("answered").alias("answered"),
        F.max("cosine").alias("cosine"),
    )
