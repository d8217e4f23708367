"""Substring dedup: words covered by a window of 20 words that also starts earlier.

The work is cut by content. Of every window the smallest six-word hash is its anchor, so equal
windows have equal anchors, and the neighbouring windows of a text with one anchor form a run.
Anchors that occur once in the corpus are dropped after a count. Equal runs are folded into the
first of them (all windows of the others start earlier), which takes exact copies and shared
passages out whatever their number.

What is left are anchors with several different runs: the reference shards. A suffix automaton is
built over the runs of a shard, in the order of their places in the corpus, and every run is
streamed through it. The state that holds a window knows where the window first ends; a window
whose first place is not its own starts earlier, too. Automata are built where the shard's runs
meet, and not sent to all tasks: the reference here is the corpus itself, which no broadcast can
hold, and an anchor says which shard a window can match.

An anchor with more than SHARD runs is dealt on by the windows themselves, so that no shard grows
with the corpus. Anchors and runs are compared by 64-bit hashes each, words in the automata by
themselves.

Defined cases: places are ordered by document id (null last, those by a hash of the text), then text
hash, then start. Rows of one id and text are one document: none is earlier than the other, and each
gets the result. Texts are looked up by id and text hash, so many rows without an id, or with one id,
cost no more than others. A null text has no words. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import words as W
from .frames import IdFilter, each_batch

if TYPE_CHECKING:
    import pandas as pd

WINDOW = 20
ANCHOR = 6
SPREAD = WINDOW - ANCHOR + 1  # places of an anchor in a window, and windows of a run at most
SHARD = 20_000                # different runs of one anchor that one automaton takes
SHARD_RUNS = 4000             # runs of a shard, on average
LAST = (1 << 63) - 1          # rows without an id come last: they get numbers from here down, by their text

RUNS = "anchor long, run long, doc long, text_hash int, start int, windows int"


class SuffixAutomaton:
    """All substrings of the sequences added so far, and where each first ends."""

    def __init__(self):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]
        self.last, self.size = 0, 0

    def add(self, symbol: int) -> None:
        step, link, length, first = self.step, self.link, self.length, self.first
        new = len(step)
        step.append({})
        length.append(length[self.last] + 1)
        first.append(self.size)
        link.append(0)
        self.size += 1
        at = self.last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = new
            at = link[at]
        if at >= 0:
            old = step[at][symbol]
            if length[at] + 1 == length[old]:
                link[new] = old
            else:
                copy = len(step)
                step.append(dict(step[old]))
                length.append(length[at] + 1)
                first.append(first[old])
                link.append(link[old])
                while at >= 0 and step[at].get(symbol) == old:
                    step[at][symbol] = copy
                    at = link[at]
                link[old] = link[new] = copy
        self.last = new

    def statistics(self, sequence: list[int]):
        """For each end in ``sequence``: the longest match there, and its state."""
        at, matched = 0, 0
        for symbol in sequence:
            while at and symbol not in self.step[at]:
                at = self.link[at]
                matched = self.length[at]
            if symbol in self.step[at]:
                at = self.step[at][symbol]
                matched += 1
            yield matched, at

    def first_end(self, state: int, n: int) -> int:
        """Where the last ``n`` symbols of a match in ``state`` first end."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return self.first[state]


def repeated_windows(runs: list[list[bytes]]) -> list[int]:
    """For each run, in the order of their places: bits of its windows that start earlier."""
    numbers: dict[bytes, int] = {}
    coded = [[numbers.setdefault(w, len(numbers)) for w in run] for run in runs]
    automaton, begins = SuffixAutomaton(), []
    for i, run in enumerate(coded):
        begins.append(automaton.size)
        for symbol in run:
            automaton.add(symbol)
        automaton.add(-1 - i)  # no match goes on into the next run
    out = []
    for run, begin in zip(coded, begins, strict=True):
        bits = 0
        for end, (matched, state) in enumerate(automaton.statistics(run)):
            if matched >= WINDOW and automaton.first_end(state, WINDOW) < begin + end:
                bits |= 1 << (end - WINDOW + 1)
        out.append(bits)
    return out


def _text_hashes(part: W.Texts) -> np.ndarray:
    """32 bits are enough to tell texts of one id apart."""
    whole = W.span_hashes(part.data, part.offsets[:-1], part.offsets[1:])
    return (whole >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _runs_of(part: W.Texts):
    """Anchor, hash, text, first word (of the text) and windows of every run."""
    starts, ends, first = W.split_words(part)
    hashes = W.span_hashes(part.data, starts, ends)
    count = np.diff(first)
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < WINDOW:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    owner = np.repeat(np.arange(len(part)), count)
    grams = W.runs_of(hashes, ANCHOR)
    smallest = np.lib.stride_tricks.sliding_window_view(grams, SPREAD).argmin(axis=1)
    at = np.flatnonzero(owner[: len(smallest)] == owner[WINDOW - 1:])
    place = at + smallest[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[at[1:]] != owner[at[:-1]])
    begin = at[new]
    windows = np.diff(np.append(np.flatnonzero(new), len(at)))
    content = W.span_hashes(hashes, begin, begin + windows + WINDOW - 1)
    return grams[place[new]], content, owner[begin], begin - first[owner[begin]], windows


def _emit_runs(batch: pa.RecordBatch):
    doc, text = batch.columns
    for part in W.texts(text):
        anchor, content, owner, start, windows = _runs_of(part)
        ids = doc.slice(part.first, len(part))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                ids.take(pa.array(owner)), pa.array(_text_hashes(part)[owner]),
                pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)),
            ],
            names=[c.split()[0] for c in RUNS.split(", ")],
        )


def _emit_words(batch: pa.RecordBatch):
    """The words of some runs of each text, given by their first word and windows."""
    _, text, _, wanted = batch.columns
    for part in W.texts(text):
        rows = []
        some = range(part.first, part.first + len(part))
        for i, row in enumerate(some):
            words = part.raw(i).split()
            for x in wanted[row].as_py():
                span = words[x["start"]:x["start"] + x["windows"] + WINDOW - 1]
                rows.append((x["anchor"], x["run"], b" ".join(span)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.binary())],
            names=["anchor", "run", "words"],
        )


def _shard(group: pd.DataFrame) -> pd.DataFrame:
    """An automaton for each anchor of a shard; runs of different anchors share no window."""
    import pandas as pd  # only here, as each worker pays for it

    group = group.sort_values(["anchor", "doc", "text_hash", "start", "run"])
    spelled = [w.split() for w in group["words"]]
    edges = np.flatnonzero(group["anchor"].diff().ne(0).to_numpy()).tolist()
    bits: list[int] = []
    for low, high in zip(edges, [*edges[1:], len(group)], strict=True):
        bits += repeated_windows(spelled[low:high])
    return pd.DataFrame({"anchor": group["anchor"], "run": group["run"], "bits": bits})


def _rest(batch: pa.RecordBatch):
    """Counts and digest of each text after its repeated windows are taken out."""
    doc, text, missing, found = batch.columns
    for part in W.texts(text):
        ids, n, gone, digests = [], [], [], []
        for i in range(len(part)):
            words = part.raw(i).split()
            keep = np.ones(len(words), dtype=bool)
            for x in found[part.first + i].as_py() or ():
                bits, start = x["bits"], x["start"]
                while bits:
                    low = (bits & -bits).bit_length() - 1
                    keep[start + low:start + low + WINDOW] = False
                    bits &= bits - 1
            kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
            ids.append(None if missing[part.first + i].as_py() else doc[part.first + i].as_py())
            n.append(len(words))
            gone.append(int((~keep).sum()))
            digests.append((hashlib.sha256(kept).hexdigest(), kept.decode()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
             pa.array([d for d, _ in digests], pa.string()),
             pa.array([k for _, k in digests], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


REST = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
OCCURRENCE = ["doc", "text_hash", "start"]


def _by_window(batch: pa.RecordBatch):
    """Runs of a crowded anchor as runs of one window, each its own anchor."""
    doc, text, text_hash, wanted = batch.columns
    for part in W.texts(text):
        rows = []
        starts, ends, first = W.split_words(part)
        hashes = W.span_hashes(part.data, starts, ends)
        for i in range(len(part)):
            for x in wanted[part.first + i].as_py():
                at = first[i] + x["start"] + np.arange(x["windows"])
                for k, h in enumerate(W.span_hashes(hashes, at, at + WINDOW).view(np.int64)):
                    rows.append((x["anchor"], int(h), doc[part.first + i].as_py(), text_hash[part.first + i].as_py(),
                                 x["start"] + k, 1))
        names = [c.split()[0] for c in RUNS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )


def _picked(rows: DataFrame, chosen: IdFilter) -> DataFrame:
    """Rows whose id may be chosen, with the hash of their text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.filter(chosen.holds(batch.column(0)))
        hashes = [_text_hashes(part) for part in W.texts(batch.column(1))]
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(joined)], names=["doc", "text", "missing", "text_hash"]
        )

    return each_batch(rows, work, "doc long, text string, missing boolean, text_hash int")


def _with_texts(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Texts of the documents of ``runs`` with their runs: doc, text, text_hash, wanted."""
    wanted = runs.groupBy("doc", "text_hash").agg(
        F.collect_set(F.struct("anchor", "run", "start", "windows")).alias("wanted")
    )
    picked = _picked(rows, IdFilter(runs.select("doc")))
    return picked.join(wanted, ["doc", "text_hash"]).select("doc", "text", "text_hash", "wanted")


def repeats(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """Windows that start earlier: doc, text_hash, start and bits of the windows from there on.

    ``rows`` has the columns doc (long, not null), text and missing.
    """
    runs = stage(each_batch(rows.select("doc", "text"), _emit_runs, RUNS), "runs")
    # Written, so that both sides of the join are plain shuffles, which Spark splits where skewed.
    anchors = stage(
        runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
        "anchors",
    )
    live = stage(runs.join(anchors, "anchor"), "live-runs")

    def folded(some: DataFrame) -> DataFrame:
        """Different runs with their first place and how many others their anchor has."""
        each = some.groupBy("anchor", "run").agg(
            F.min(F.struct(*OCCURRENCE, "windows")).alias("first")
        ).select("anchor", "run", "first.*")
        return each

    different = stage(folded(live), "different-runs")
    several = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1")
    contested = stage(different.join(several, "anchor"), "contested-runs")
    shards = F.lit(1 + contested.count() // SHARD_RUNS)
    texts = _with_texts(rows, contested.where(F.col("runs") <= shard))
    spelled = each_batch(texts, _emit_words, "anchor long, run long, words binary")
    places = contested.where(F.col("runs") <= shard).drop("runs")
    bits = spelled.dropDuplicates(["anchor", "run"]).join(places, ["anchor", "run"]).groupBy(
        F.pmod(F.xxhash64("anchor"), shards)
    ).applyInPandas(_shard, "anchor long, run long, bits int")

    everything = F.expr("shiftleft(1, windows) - 1")
    crowded = stage(several.where(F.col("runs") > shard).select("anchor"), "crowded")
    first = different.select(
        "anchor", "run", *[F.col(c).alias(f"first_{c}") for c in OCCURRENCE]
    ).join(bits, ["anchor", "run"], "left").join(crowded, "anchor", "left_anti")
    is_first = F.expr(" and ".join(f"{c} = first_{c}" for c in OCCURRENCE))
    found = live.join(first, ["anchor", "run"]).withColumn(
        "bits", F.when(is_first, F.coalesce("bits", F.lit(0))).otherwise(everything)
    ).where("bits > 0").select(*OCCURRENCE, "bits")

    single = each_batch(_with_texts(rows, live.join(crowded, "anchor", "left_semi")), _by_window, RUNS)
    windows = stage(single.distinct(), "crowded-windows")
    origin = folded(windows).select(
        "anchor", "run", *[F.col(c).alias(f"first_{c}") for c in OCCURRENCE]
    )
    later = windows.join(origin, ["anchor", "run"]).where(~is_first).select(
        *OCCURRENCE, F.lit(1).alias("bits")
    )
    return found.unionByName(later)


def without_repeats(docs: DataFrame, text="text", doc_id="doc_id", shard: int = SHARD) -> DataFrame:
    """Every row's words without the repeated windows: counts, digest and the text kept."""
    key, value = F.col(doc_id).cast("long"), F.col(text).cast("string")
    unnamed = F.lit(LAST) - F.pmod(F.xxhash64(value), F.lit(1 << 31))
    rows = docs.select(
        F.coalesce(key, unnamed).alias("doc"), value.alias("text"), key.isNull().alias("missing")
    )
    windows = repeats(rows, shard).distinct()
    found = stage(windows.groupBy("doc", "text_hash").agg(
        F.collect_list(F.struct("start", "bits")).alias("found")
    ), "repeats")
    chosen = IdFilter(found.select("doc"))
    hit = _picked(rows, chosen).join(found, ["doc", "text_hash"], "left").select("doc", "text", "missing", "found")

    def whole(batch: pa.RecordBatch):
        """Texts that surely hold no repeat, in the pass that picks them: one worker per task."""
        batch = batch.filter(pc.invert(chosen.holds(batch.column(0))))
        none = pa.nulls(batch.num_rows, pa.list_(pa.int8()))
        yield from _rest(pa.RecordBatch.from_arrays([*batch.columns, none], names=["doc", "text", "missing", "found"]))

    return each_batch(hit, _rest, REST).unionByName(each_batch(rows, whole, REST))
