"""Language of a text by rank-order profiles of character n-grams.

A profile ranks the PROFILE most frequent n-grams (one to three characters of a word, whose
edges count as a character) of a language's documents. A text is ranked in the same way, all of
it, and the language with the smallest out-of-place distance is predicted: for each n-gram of
the text the difference of the two ranks, or PROFILE if the profile lacks it. The score is
one minus the distance, as a share of the greatest possible one.

Profiles are learned from all documents with an id, a text and a language that are not held out.
The language, the source and the id are never inputs of a prediction.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every
text if nothing could be learned. Ties go to the language that sorts first. A row without an id is not held out and not
learned from. A repeated row has its own result. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .frames import each_batch

PROFILE = 400
MARGIN = 0.8   # of the lowest score of a labelled document: what other texts must reach
UNKNOWN = "und"
_BITS = 10
_letters: list[np.ndarray] = []


def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 unless it is a letter, else 1 to 1023."""
    if not _letters:
        table = np.zeros(0x110000, dtype=np.int32)
        for point in range(0x110000):
            if chr(point).isalpha():
                table[point] = 1 + point % 1021
        _letters.append(table)
    return _letters[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every n-gram of every text as a number, and the index of its text."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le"), dtype=np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), lengths)])
    symbol = _symbols()[points]
    keep = symbol != 0
    keep[1:] |= symbol[:-1] != 0  # runs of other characters become one edge
    keep[0] = True
    symbol, owner = symbol[keep], owner[keep]
    one = symbol > 0
    a, b, c = symbol[:-2], symbol[1:-1], symbol[2:]
    middle = b > 0
    pair = (symbol[:-1] > 0) | (symbol[1:] > 0)
    at = np.where(symbol[1:] > 0, owner[1:], owner[:-1])
    top = 1 << (3 * _BITS)
    codes = np.concatenate([
        (a[middle] << (2 * _BITS)) | (b[middle] << _BITS) | c[middle],
        top | (symbol[:-1][pair] << _BITS) | symbol[1:][pair],
        top | (1 << (2 * _BITS)) | symbol[one],
    ])
    return codes.astype(np.int64), np.concatenate([owner[1:-1][middle], at[pair], owner[one]])


def _ranked(codes: np.ndarray, owner: np.ndarray, profile: int):
    """The most frequent n-grams of every text with their ranks; ties go to the smaller code."""
    key = np.sort((owner.astype(np.int64) << 31) | codes)
    if not len(key):
        return owner[:0], codes[:0], codes[:0]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(edge, len(key)))
    key = key[edge]
    who, code = key >> 31, key & ((1 << 31) - 1)
    rest = (1 << 19) - 1
    order = np.sort((who << 50) | ((rest - np.minimum(count, rest)) << 31) | code)
    who, code = order >> 50, order & ((1 << 31) - 1)
    first = np.searchsorted(who, who)
    rank = np.arange(len(who)) - first
    near = rank < profile
    return who[near], code[near], rank[near]


class Profiles:
    """Ranks of n-grams in every language."""

    def __init__(self, ranks: dict[str, dict[int, int]], size: int = PROFILE):
        self.size = size
        self.languages = sorted(ranks)
        known = {code for of in ranks.values() for code in of}
        self.codes = np.array(sorted(known), dtype=np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.languages)), -1, dtype=np.int32)
        for j, language in enumerate(self.languages):
            for code, rank in ranks[language].items():
                self.ranks[np.searchsorted(self.codes, code), j] = rank

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        names, scores = [UNKNOWN] * n, np.zeros(n)
        if not self.languages or not n:
            return names, scores
        who, code, rank = _ranked(*ngrams(texts), self.size)
        if not len(who):
            return names, scores
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        at = np.where(self.codes[at] == code, at, len(self.codes))
        theirs = self.ranks[at]
        away = np.where(theirs < 0, self.size, np.abs(theirs - rank[:, None]))
        edge = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        total = np.add.reduceat(away, edge, axis=0)
        best = total.argmin(axis=1)
        count = np.diff(np.append(edge, len(who)))
        for i, j, distance, m in zip(who[edge], best, total.min(axis=1), count, strict=True):
            names[i] = self.languages[j]
            scores[i] = 1.0 - distance / (m * self.size)
        return names, scores


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _count(batch: pa.RecordBatch):
    language, text = batch.columns
    for part in W.texts(text):
        names = language.slice(part.first, len(part)).to_pylist()
        codes, owner = ngrams([part.raw(i).decode() for i in range(len(part))])
        own = {name: j for j, name in enumerate(sorted(set(names)))}
        label = np.array([own[name] for name in names], dtype=np.int64)
        key, count = np.unique((label[owner] << 31) | codes, return_counts=True)
        listed = sorted(own)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([listed[j] for j in key >> 31], pa.string()),
                pa.array(key & ((1 << 31) - 1)), pa.array(count.astype(np.int64)),
            ],
            names=["lang", "code", "n"],
        )


def labelled(docs: DataFrame, text="text", doc_id="doc_id", lang="lang") -> DataFrame:
    """What is learned from: (lang, text) of every document that has an id, both of these, and is not
    held out."""
    rows = docs.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.col(doc_id).cast("long").alias("id"),
    )
    return rows.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull()
        & ~held_out(F.col("id"))
    ).select("lang", "text")


def learn(
    docs: DataFrame, text="text", doc_id="doc_id", lang="lang", profile: int = PROFILE,
) -> Profiles:
    """Profiles of the languages of ``docs``."""
    grams = each_batch(labelled(docs, text, doc_id, lang), _count, "lang string, code long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = (
        grams.groupBy("lang", "code").agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < profile)
    )
    ranks: dict[str, dict[int, int]] = {}
    for row in top.collect():  # ``profile`` rows per language
        ranks.setdefault(row.lang, {})[row.code] = row.rank
    return Profiles(ranks, profile)


def with_language(
    docs: DataFrame, profiles: Profiles, text="text",
    out: str = "lang_pred", score: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language and its score; columns of these names are replaced."""
    docs = docs.drop(out, score)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    at = docs.columns.index(text)

    def predict(batch: pa.RecordBatch):
        held = pa.Table.from_batches([batch])
        for part in W.texts(batch.column(at).cast(pa.string())):
            some = held.slice(part.first, len(part)).combine_chunks().to_batches()[0]
            names, scores = shared.value.predict(
                [part.raw(i).decode() for i in range(len(part))]
            )
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(names, pa.string()), pa.array(scores)],
                names=[*some.schema.names, out, score],
            )

    added = [T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())]
    return each_batch(docs, predict, T.StructType([*docs.schema.fields, *added]))


def least_score(
    docs: DataFrame, profiles: Profiles, text="text", doc_id="doc_id", lang="lang", margin: float = MARGIN,
) -> float:
    """A score that every text in a learned language should reach: ``margin`` times the lowest of all
    labelled documents that are told right. 0 without any."""
    told = with_language(labelled(docs, text, doc_id, lang), profiles, "text", "said", "score")
    return margin * (told.where(F.col("said") == F.col("lang")).agg(F.min("score")).first()[0] or 0.0)


def identify(docs: DataFrame, text="text", doc_id="doc_id", lang="lang", **options) -> DataFrame:
    """Learn from the documents not held out, predict all of them."""
    profiles = learn(docs, text, doc_id, lang, **options)
    id_ = F.col(doc_id).cast("long")
    rows = docs.select(
        id_.alias("doc_id"), held_out(id_).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    )
    return with_language(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")
