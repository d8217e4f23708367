"""Spelling variants of a vocabulary: words one edit apart, by an index of variable-length grams.

1. *Dictionary.* Grams of LEAST to MOST characters are counted over all padded words. A gram is
   extended as long as it is frequent, so common beginnings are told apart by longer grams and rare
   ones stay short. Only the grams that are extended are kept (``Dictionary``).
2. *Decomposition.* From each position the longest gram of the dictionary is taken, unless an
   earlier one covers it (``grams``).
3. *Affected grams.* For each word, how many of its grams one edit can change at most, wherever it
   falls (``affected``): grams that hold the edited character, grams left of it that could grow
   over it, and grams right of it that a gram over it could cover.
4. *Merging lists.* Two words one edit apart share all grams but the affected ones, and in the same
   order of rarity. So one of the ``affected + 1`` rarest grams of either is shared: left of the edit
   with everything before it, right of it with everything behind it. Those are the keys of the
   lists, split by length; only equal lengths and neighbouring ones meet.
5. *Verification.* Candidates whose sets of letters differ by at most two are checked by their edit
   distance; pairs found through several
   lists are merged.

The padding makes every word keep an unaffected gram (``padding``), so no word needs another path and
no link is lost. Bounds: the dictionary holds at most ``MOST - LEAST`` times ``most_frequent`` grams,
since a frequent gram occurs more than ``characters / most_frequent`` times; rarity comes from a table
of COUNTERS counters, whatever the vocabulary's size (any order of the grams is exact). A list is never
gathered: it is a join on the key.

Defined cases: a null word is dropped; words shorter than ``least_length`` are kept without links;
repeated rows of a word are added up; ties between forms go to the smaller word; an empty vocabulary
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .frames import VECTOR, Batches, each_batch, pieces, summed_vector, vector_rows

LEAST, MOST = 2, 4       # characters of a gram
LEAST_LENGTH = 5         # of the words that are linked
RARE = 30                # a gram that occurs so often at most is never extended
MOST_FREQUENT = 200_000  # frequent grams of one length, whatever the vocabulary's size
COUNTERS = 1 << 20
RATIO = 2                # a form is at least so many times as frequent as its variant
START, END = "\x01", "\x02"


def padding(least_length: int) -> int:
    """Characters before and after a word. An edit reaches grams less than MOST characters away, so
    one of the first and the last gram is out of reach if 2 * MOST characters lie in between."""
    return max(1, -(-(2 * MOST - least_length) // 2))


def _slot(gram: str) -> int:
    return zlib.crc32(gram.encode()) & (COUNTERS - 1)


@dataclass
class Dictionary:
    """The grams that are extended, and how often decomposed words hold each gram."""

    grows: set[str]
    pad: int
    counts: np.ndarray | None = None
    tails: set[str] = field(init=False)  # endings of the extended grams, without their first characters

    def __post_init__(self):
        self.tails = {g[k:] for g in self.grows for k in range(1, len(g))}

    def padded(self, word: str) -> str:
        return START * self.pad + word + END * self.pad

    def grams(self, s: str) -> list[tuple[int, int]]:
        """The longest gram at each position of a padded word, those inside an earlier one left out."""
        found, covered, n = [], 0, len(s)
        for start in range(n - LEAST + 1):
            end = start + LEAST
            while end < n and end - start < MOST and s[start:end] in self.grows:
                end += 1
            if end > covered:
                found.append((start, end))
                covered = end
        return found

    def affected(self, s: str, grams: list[tuple[int, int]]) -> int:
        """The most grams of a padded word that one edit of its characters can change."""
        worst, n = 0, len(s)
        for at in range(self.pad, n - self.pad + 1):
            left = max(0, at - MOST + 1)  # grams from here to the edit may grow over it
            while left <= at - LEAST and s[left:at] not in self.grows:
                left += 1
            for width in (0, 1):  # a character put in before ``at``; the one there replaced or taken out
                if width and at == n - self.pad:
                    continue
                first = at + width
                right = min(first + MOST - 1, n)  # grams up to here may be covered by one over the edit
                while right >= first + LEAST and s[first:right - 1] not in self.tails:
                    right -= 1
                worst = max(worst, sum(
                    left <= start if end <= at else start < first or end <= right
                    for start, end in grams
                ))
        return worst

    def rarity(self, s: str, gram: tuple[int, int]) -> tuple:
        """Sorts grams: those with padding last, since what lies before or behind them is short."""
        text = s[gram[0]:gram[1]]
        padded = text[0] == START or text[-1] == END
        return padded, self.counts[_slot(text)], text, gram

    def keys(self, word: str) -> Iterator[tuple[bool, str]]:
        """(left, text): everything up to the end of a gram, and everything from its start."""
        s = self.padded(word)
        grams = self.grams(s)
        chosen = sorted(grams, key=lambda gram: self.rarity(s, gram))[:self.affected(s, grams) + 1]
        for start, end in chosen:
            yield True, s[:end]
            yield False, s[start:]


def _pieces(word: Column, pad: int) -> Column:
    """All grams of a word that could be extended, as often as they occur."""
    s = F.concat(F.lit(START * pad), word, F.lit(END * pad))
    return F.flatten(F.array(*[
        F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i, n=n: F.substring(s, i, F.lit(n)))
        for n in range(LEAST, MOST)
    ]))


def dictionary(
    words: DataFrame, least_length: int = LEAST_LENGTH, rare: int = RARE, most_frequent: int = MOST_FREQUENT
) -> Dictionary:
    """Learned from distinct words (column ``word``)."""
    pad = padding(least_length)
    total = words.agg(F.sum(F.length("word") + 2 * pad)).first()[0] or 0
    frequent = (
        words.select(F.explode(_pieces(F.col("word"), pad)).alias("gram"))
        .groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(rare, total // most_frequent))
    )
    found = Dictionary({row.gram for row in frequent.collect()}, pad)

    def count(batches: Batches) -> Batches:
        seen: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                s = found.padded(word)
                seen.update(s[start:end] for start, end in found.grams(s))
        total = np.zeros(COUNTERS)
        for gram, n in seen.items():
            total[_slot(gram)] += n
        yield from vector_rows(pieces(total, TaskContext.get().partitionId()))

    found.counts = summed_vector(words.select("word").mapInArrow(count, VECTOR), COUNTERS).astype(np.float32)
    return found


def _letters(word: str) -> int:
    """The letters of a word as bits; an edit changes two at most."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits - (bits >> 63 << 64)


def near(words: DataFrame, found: Dictionary) -> DataFrame:
    """Each unordered pair of ``words`` (word, n; distinct) one edit apart: a, a_n, b, b_n."""
    shared = words.sparkSession.sparkContext.broadcast(found)

    def listed(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            (w, n, _letters(w), left, text)
            for w, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for left, text in shared.value.keys(w)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["word", "n", "letters", "left", "text"],
        )

    lists = stage(
        each_batch(words.select("word", "n"), listed, "word string, n long, letters long, left boolean, text string")
        .select(F.xxhash64("left", "text").alias("list"), F.length("word").alias("size"), "word", "n", "letters"),
        "gram-lists",
    )
    a = lists.select(
        "list", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("size"),
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("size").alias("a_size"),
        F.col("letters").alias("a_letters"),
    )
    b = lists.select("list", "size", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("letters").alias("b_letters"))
    alike = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2
    once = (F.col("size") > F.col("a_size")) | (F.col("a") < F.col("b"))
    apart = F.levenshtein("a", "b", 1) == 1
    return a.join(b, ["list", "size"]).where(alike & once & apart).select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form. A form is more frequent than its word, so there are
    no rings; with RATIO 2 a chain has at most 62 steps and is followed in six rounds."""
    now = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left")
        now = stage(
            moved.select("word", F.coalesce("next", "root").alias("root"),
                         F.col("next").isNotNull().alias("moved")), "forms",
        )
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(
    vocabulary: DataFrame, word="word", n="n", ratio: int = RATIO, least_length: int = LEAST_LENGTH,
    rare: int = RARE, most_frequent: int = MOST_FREQUENT,
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every distinct word of a counted vocabulary."""
    words = stage(
        vocabulary.where(F.col(word).isNotNull())
        .groupBy(F.col(word).cast("string").alias("word")).agg(F.sum(n).cast("long").alias("n")),
        "vocabulary",
    )
    long = words.where(F.length("word") >= least_length)
    pairs = stage(near(long, dictionary(long, least_length, rare, most_frequent)), "near-words")
    rows = (
        words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
        .unionAll(pairs.select("a", "a_n", "b", "b_n")).unionAll(pairs.select("b", "b_n", "a", "a_n"))
    )
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("less"), "other")))
    found = stage(
        rows.groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
        .withColumn("fits", -F.col("best.less") >= ratio * F.col("n"))
        .select("word", "n", "n_near", F.when(F.col("fits"), F.col("best.other")).alias("form"),
                F.when(F.col("fits"), -F.col("best.less")).alias("form_n")),
        "word-forms",
    )
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def runs(text: Column, letters: str = r"[A-Za-zÀ-ÿ]+") -> Column:
    """A row for each maximal run of letters."""
    return F.explode(F.regexp_extract_all(text, F.lit(letters), F.lit(0)))


def lowered(word: Column) -> Column:
    """A to Z in lower case, other letters as they are."""
    plain = F.octet_length(word) == F.length(word)
    return F.when(plain, F.lower(word)).otherwise(
        F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def without_character(word: Column, at: Column) -> Column:
    """``word`` without the code point ``at``, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def counted(words: DataFrame, least_length: int = LEAST_LENGTH, least_n: int = 3) -> DataFrame:
    """Occurrences (rows of ``word``) added up: words long and frequent enough."""
    return (
        words.where(F.length("word") >= least_length).groupBy("word")
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)
    )
