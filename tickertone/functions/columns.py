"""Column helpers: time, text, class scores, guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a whitespace split breaks on, Unicode spaces included. The
# rare ones sit behind one range check, so that an ordinary letter costs two tests, not ten.
SPACES = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]+"
)
PAD, UNKNOWN, FIRST_WORD = 0, 1, 2
LONGEST_PLAIN_KEY = 64


def utc_wall_time(ts: Column) -> Column:
    """An instant as zone-less UTC wall time, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr("TIMESTAMP_NTZ'1970-01-01'"))


def epoch_seconds_to_wall_time(seconds: Column) -> Column:
    return F.timestamp_add(
        "SECOND", seconds.cast("bigint"), F.expr("TIMESTAMP_NTZ'1970-01-01'")
    )


def epoch_nanos_to_wall_time(nanos: Column) -> Column:
    micros = (nanos - F.pmod(nanos, F.lit(1000))) / 1000
    return F.timestamp_add(
        "MICROSECOND", micros.cast("bigint"), F.expr("TIMESTAMP_NTZ'1970-01-01'")
    )


def day(ts: Column) -> Column:
    return F.to_date(ts)


def no_nan(col: Column) -> Column:
    """Missing numbers are null inside Spark, never NaN."""
    return F.nanvl(col, F.lit(None).cast("double"))


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def words(text: Column, at_most: int | None = None) -> Column:
    """Lower-cased words of the text, without empty ones: all, or the first ``at_most``."""
    lowered = F.lower(text_or_empty(text))
    if at_most is None:
        return F.array_remove(F.split(lowered, SPACES), "")
    # Splitting stops early: the words, maybe an empty piece before them, and the rest.
    return F.slice(F.array_remove(F.split(lowered, SPACES, at_most + 2), ""), 1, at_most)


def word_key(word: Column) -> Column:
    """Join key of bounded size that is equal exactly when the words are.

    Words never hold a space, so a long word's digest after a space cannot meet a
    plain word.
    """
    return F.when(F.length(word) <= LONGEST_PLAIN_KEY, word).otherwise(
        F.concat(F.lit(" "), F.sha2(word, 256))
    )


def pad_ids(ids: Column, size: int) -> Column:
    cut = F.slice(ids, 1, size)
    return F.concat(cut, F.array_repeat(F.lit(PAD), F.lit(size) - F.size(cut)))


def softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores)
    weights = [F.exp(s - top) for s in scores]
    total = sum(weights[1:], weights[0])
    return [w / total for w in weights]


def argmax_class(scores: list[Column]) -> Column:
    """0-based index of the largest score; the first of equals."""
    arr = F.array(*scores)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def class_from_logit(logit: Column) -> Column:
    """sigmoid(logit) > 0.5, without the exponential."""
    return (logit > 0).cast("int")


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def softplus(z: Column) -> Column:
    return F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confidence(*scores: Column) -> Column:
    return F.greatest(*[no_nan(s) for s in scores])


def bucket_percent(key: Column) -> Column:
    """0..99 from a hash of the key: stable under any partitioning."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % 100
