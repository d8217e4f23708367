"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field.

Four kinds follow fixed patterns (``email``, ``ip``, ``card``, ``phone``) and are always reported.
The field looks at the text around digits and at signs. It scores whole spans of up to MAX_TOKENS
tokens (digit counts, check digit, separators, what stands on either side) and transitions
between kinds, and a dynamic program over bounded spans picks boundaries and kinds together,
over the whole of each region with digits or at signs, however long it is.
Spans it finds beyond the fixed ones, and apart from them, are added.

Its weights are fitted here, by gradient steps on the conditional likelihood, on the stretches
of a sample: at most ``max_documents`` documents and ``max_stretches`` stretches, taken by a hash
of the document's id. The fixed patterns label them. Everything else covers all rows.

Defined cases: a null text is empty (no spans). A row without an id is scanned, and may be in
the sample. A repeated row has its own result. Without any labelled span only the fixed patterns
are reported. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .frames import each_batch

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 14
MAX_DOCUMENTS, MAX_STRETCHES = 5000, 400  # bounds of the sample the weights are fitted on
AROUND = 24                               # characters on either side of a digit or at sign
STRETCH = 512                             # characters of a stretch of the sample, at most
PIECE = 512                               # tokens of a region that are scored at a time

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[\x09-\x0D\x20]+|.", re.DOTALL)
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[S.Span]:
    """From each at sign outwards, which finds the leftmost matches in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, 0, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[S.Span]:
    if not _TRIGGER.search(text):
        return []
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_only_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Where the text has digits or at signs, with some characters around them."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        start, end = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and start <= out[-1][1] and end - out[-1][0] <= STRETCH:
            out[-1] = (out[-1][0], end)
        elif not out or m.end() > out[-1][1]:
            out.append((max(start, out[-1][1]) if out else start, end))
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that touch in one, so that no span is cut where a stretch is full."""
    out: list[tuple[int, int]] = []
    for start, end in stretches(text):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


FEATURES = (
    "any", "one at sign", "dot after at", "12 to 19 digits", "9 to 15 digits", "plus first",
    "check digit", "four parts", "space inside", "letter inside", "joined on the left",
    "joined on the right", "digit last", "letter last", "digit first", "letter first",
    "other sign", "digits only", "2 to 4 tokens", "5 tokens and more", "parts below 256",
)
LABELS = len(KINDS) + 1  # the last one is outside


class Stretch:
    """Tokens of a stretch and the features of every span of at most MAX_TOKENS tokens."""

    def __init__(self, text: str, start: int, end: int):
        piece = text[start:end]
        self.tokens = _TOKEN.findall(piece)
        n = len(self.tokens)
        lengths = np.fromiter(map(len, self.tokens), np.int64, n)
        self.edges = start + np.concatenate([[0], np.cumsum(lengths)])
        first = [t[0] for t in self.tokens]
        digit = np.fromiter(("0" <= c <= "9" for c in first), bool, n)
        letter = np.fromiter((c.isascii() and c.isalpha() for c in first), bool, n)
        space = np.fromiter((c in " \t\n\r\v\f" for c in first), bool, n)
        at = np.fromiter((c == "@" for c in first), bool, n)
        dot = np.fromiter((c == "." for c in first), bool, n)
        plain = np.fromiter((c in "@.+-_%()" for c in first), bool, n)

        def summed(x):
            return np.concatenate([[0], np.cumsum(x)])

        begin = np.arange(n)[:, None]
        stop = np.minimum(begin + np.arange(1, MAX_TOKENS + 1)[None, :], n)
        inside = begin + np.arange(1, MAX_TOKENS + 1)[None, :] <= n

        def count(x):
            s = summed(x)
            return s[stop] - s[begin]

        digits, ats, dots = count(digit * lengths), count(at), count(dot)
        last_at = np.maximum.accumulate(np.where(at, np.arange(n), -1))
        dots_so_far = summed(dot)
        last = last_at[stop - 1]
        dot_after = (last >= begin) & (dots_so_far[stop] > dots_so_far[np.maximum(last, 0)])
        before = np.concatenate([[False], digit | letter | np.isin(first, list("@+-_%"))])[begin]
        after = np.concatenate([digit | letter | np.isin(first, list("@_")), [False]])[stop]
        other = count(~(digit | letter | space | plain))
        f = np.zeros((n, MAX_TOKENS, len(FEATURES)), dtype=bool)
        groups = count(digit)
        size = stop - begin
        four = (dots == 3) & (groups == 4) & (size == 7) & digit[begin]
        f[..., 0] = True
        f[..., 1] = ats == 1
        f[..., 2] = dot_after
        f[..., 3] = (digits >= 12) & (digits <= 19)
        f[..., 4] = (digits >= 9) & (digits <= 15)
        f[..., 5] = np.fromiter((c == "+" for c in first), bool, n)[begin]
        f[..., 7] = four
        f[..., 8] = count(space) > 0
        f[..., 9] = count(letter) > 0
        f[..., 10] = before
        f[..., 11] = after
        f[..., 12] = digit[stop - 1]
        f[..., 13] = letter[stop - 1]
        f[..., 14] = digit[begin]
        f[..., 15] = letter[begin]
        f[..., 16] = other > 0
        f[..., 17] = groups == size
        f[..., 18] = (size >= 2) & (size <= 4)
        f[..., 19] = size >= 5
        numeric = f[..., 3] & ~f[..., 9] & digit[begin] & digit[stop - 1] & inside
        for i, k in zip(*np.nonzero(numeric), strict=True):
            f[i, k, 6] = luhn(_only_digits("".join(self.tokens[i:i + k + 1])))
        for i, k in zip(*np.nonzero(four & inside), strict=True):
            f[i, k, 20] = all(len(t) <= 3 and int(t) <= 255 for t in self.tokens[i:i + k + 1:2])
        # A span of interest holds a digit or an at sign, starts and ends with no space.
        self.open = inside & ((groups > 0) | (ats > 0)) & ~space[begin] & ~space[stop - 1]
        self.features = f

    def __len__(self) -> int:
        return len(self.tokens)


class Weights:
    """Weights of span features per kind, and of a kind that follows another."""

    def __init__(self, spans: np.ndarray, steps: np.ndarray):
        self.spans, self.steps = spans, steps

    @staticmethod
    def zero() -> Weights:
        return Weights(np.zeros((len(FEATURES), LABELS)), np.zeros((LABELS, LABELS)))

    def scores(self, x: Stretch) -> np.ndarray:
        """(tokens, length, label); spans that cannot be are minus infinity."""
        out = x.features.astype(np.float64) @ self.spans
        out[..., :-1][~x.open] = -np.inf
        out[:, 1:, -1] = -np.inf  # outside goes token by token
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - safe).sum(axis=axis)) + np.squeeze(safe, axis)


def _expected(x: Stretch, w: Weights):
    """Log of the partition sum, and how often each span and step is expected."""
    n, s = len(x), w.scores(x)
    alpha = np.full((n + 1, LABELS), -np.inf)   # of prefixes that end with a span of a label
    enter = np.zeros((n + 1, LABELS))           # the same, ready for the next label
    start = np.zeros(LABELS)
    for end in range(1, n + 1):
        ks = np.arange(min(MAX_TOKENS, end))
        into = np.stack([start if end - k - 1 == 0 else enter[end - k - 1] for k in ks])
        alpha[end] = _log_sum(into + s[end - ks - 1, ks], 0)
        enter[end] = _log_sum(alpha[end][:, None] + w.steps, 0)
    total = _log_sum(alpha[n], 0)
    beta = np.full((n + 1, LABELS), -np.inf)    # of what follows a span of a label
    beta[n] = 0.0
    leave = np.full((n + 1, LABELS), -np.inf)   # of suffixes that begin with a label
    for begin in range(n - 1, -1, -1):
        ks = np.arange(min(MAX_TOKENS, n - begin))
        leave[begin] = _log_sum(s[begin, ks] + beta[begin + ks + 1], 0)
        if begin:
            beta[begin] = _log_sum(w.steps + leave[begin][None, :], 1)
    spans = np.zeros_like(s)
    for begin in range(n):
        ks = np.arange(min(MAX_TOKENS, n - begin))
        into = start if begin == 0 else enter[begin]
        spans[begin, ks] = np.exp(into[None, :] + s[begin, ks] + beta[begin + ks + 1] - total)
    steps = np.zeros((LABELS, LABELS))
    for i in range(1, n):
        steps += np.exp(alpha[i][:, None] + w.steps + leave[i][None, :] - total)
    return total, spans, steps


def _labelled(x: Stretch, spans: Sequence[S.Span]) -> list[tuple[int, int, int]] | None:
    """The stretch as (token, length, label), or None if a span does not fit into it."""
    at = {int(e): i for i, e in enumerate(x.edges)}
    taken, out, i = sorted(spans), [], 0
    for start, kind, end in taken:
        if end <= x.edges[0] or start >= x.edges[-1]:
            continue
        first, last = at.get(start), at.get(end)
        if first is None or last is None or last - first > MAX_TOKENS:
            return None
        if first < i:
            continue  # overlaps the one before, which starts further left
        out += [(k, 0, LABELS - 1) for k in range(i, first)]
        out.append((first, last - first - 1, kind))
        i = last
    return out + [(k, 0, LABELS - 1) for k in range(i, len(x))]


def fit(samples: Sequence[tuple[str, list[S.Span]]], rounds: int = 12, rate: float = 0.5) -> Weights:
    """Weights of greatest conditional likelihood, by adaptive gradient steps."""
    w = Weights.zero()
    ready = []
    for text, spans in samples:
        x = Stretch(text, 0, len(text))
        gold = _labelled(x, spans)
        if gold and all(label == LABELS - 1 or x.open[i, k] for i, k, label in gold):
            observed, steps = np.zeros_like(w.spans), np.zeros_like(w.steps)
            for j, (i, k, label) in enumerate(gold):
                observed[:, label] += x.features[i, k]
                if j:
                    steps[gold[j - 1][2], label] += 1
            ready.append((x, observed, steps))
    held_spans, held_steps = np.full_like(w.spans, 1e-6), np.full_like(w.steps, 1e-6)
    for _ in range(rounds):
        for x, observed, steps in ready:
            _, spans, pairs = _expected(x, w)
            flat = x.features.reshape(-1, len(FEATURES)).astype(np.float64)
            g = observed - flat.T @ spans.reshape(-1, LABELS) - 1e-3 * w.spans
            h = steps - pairs - 1e-3 * w.steps
            held_spans += g * g
            held_steps += h * h
            w.spans += rate * g / np.sqrt(held_spans)
            w.steps += rate * h / np.sqrt(held_steps)
    return w


def decode(x: Stretch, w: Weights) -> list[S.Span]:
    """The best segmentation's spans of a kind."""
    return _best(x.edges, [w.scores(x)], w)


def decode_region(text: str, start: int, end: int, w: Weights) -> list[S.Span]:
    """The same for a region of any length, of which PIECE tokens are scored at a time."""
    lengths = np.fromiter((len(m[0]) for m in _TOKEN.finditer(text, start, end)), np.int64)
    edges = start + np.concatenate([[0], np.cumsum(lengths)])
    n = len(lengths)

    def blocks():
        for first in range(0, n, PIECE):
            # The token before and those that spans reach, and one more, decide on the features.
            low, high = max(0, first - 1), min(n, first + PIECE + MAX_TOKENS + 1)
            s = w.scores(Stretch(text, int(edges[low]), int(edges[high])))
            yield s[first - low:first - low + min(PIECE, n - first)]

    return _best(edges, blocks(), w)


def _best(edges: np.ndarray, blocks: Iterable[np.ndarray], w: Weights) -> list[S.Span]:
    """Spans of the best segmentation; ``blocks`` are the scores of successive first tokens."""
    n = len(edges) - 1
    enter = np.zeros((n + 1, LABELS))
    came = np.zeros((n + 1, LABELS), dtype=np.int8)
    back = np.zeros((n + 1, LABELS), dtype=np.int8)
    best, done = np.zeros(LABELS), 0
    held = np.zeros((0, MAX_TOKENS, LABELS))
    for block in blocks:
        s, low = np.concatenate([held, block]), done - len(held)
        for end in range(done + 1, done + len(block) + 1):
            ks = np.arange(min(MAX_TOKENS, end))
            into = enter[end - ks - 1] + s[end - ks - 1 - low, ks]
            back[end] = into.argmax(axis=0)
            best = into.max(axis=0)
            moves = best[:, None] + w.steps
            came[end], enter[end] = moves.argmax(axis=0), moves.max(axis=0)
        done += len(block)
        held = s[1 - MAX_TOKENS:]
    out, end, label = [], n, int(best.argmax())
    while end > 0:
        begin = end - int(back[end][label]) - 1
        if label < LABELS - 1:
            out.append((int(edges[begin]), label, int(edges[end])))
        label, end = int(came[begin][label]), begin
    return out[::-1]


def all_spans(text: str, w: Weights | None) -> tuple[list[S.Span], list[S.Span]]:
    """The fixed spans, and those with the field's further ones."""
    base = base_spans(text)
    if w is None:
        return base, base
    more, covered = [], S.Taken(base)
    for start, end in regions(text):
        for s, kind, e in decode_region(text, start, end, w):
            if not covered.touches(s, e):
                more.append((s, kind, e))
    return base, base + more


SAMPLE = "ordering long, text string, starts array<int>, kinds array<int>, ends array<int>"


def _sample(batch: pa.RecordBatch):
    for part in S.sliced(batch):
        rows = []
        for key, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
            spans = sorted(base_spans(text or ""))
            starts = [s for s, _, _ in spans]
            reached = list(accumulate((e for _, _, e in spans), max, initial=0))
            for start, end in stretches(text or ""):
                low, high = bisect_left(starts, start), bisect_left(starts, end)
                if reached[low] > start or any(e > end for _, _, e in spans[low:high]):
                    continue  # a span runs into it, or out of it
                own = [(s - start, k, e - start) for s, k, e in spans[low:high]]
                rows.append((key ^ start, text[start:end], *map(list, zip(*own, strict=True)))
                            if own else (key ^ start, text[start:end], [], [], []))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        numbers = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(
                columns, [pa.int64(), pa.string(), numbers, numbers, numbers], strict=True)],
            names=["ordering", "text", "starts", "kinds", "ends"],
        )


def fit_on(
    docs: DataFrame, text="text", doc_id="doc_id",
    max_documents: int = MAX_DOCUMENTS, max_stretches: int = MAX_STRETCHES,
) -> Weights | None:
    """Weights fitted on a sample of ``docs``; None where the sample has no labelled span."""
    value = F.col(text).cast("string")
    order = {"ordering": F.xxhash64(F.col(doc_id).cast("long")), "text_hash": F.xxhash64(value)}
    keyed = docs.select(*[c.alias(n) for n, c in order.items()], value.alias("text"))
    chosen = keyed.select(*order).distinct().orderBy(*order).limit(max_documents)
    # A repeated row counts once, however often it is there.
    picked = keyed.join(F.broadcast(chosen), [*order]).groupBy(*order).agg(F.first("text").alias("text"))
    found = each_batch(picked.select("ordering", "text"), _sample, SAMPLE)
    kinds = F.size("kinds")
    # Half of the stretches with a span, half without.
    some = [
        found.where(F.expr(side)).orderBy("ordering", "text").limit(max_stretches // 2)
        for side in ("size(kinds) > 0", "size(kinds) = 0")
    ]
    rows = some[0].unionByName(some[1]).withColumn("n", kinds).collect()
    if not any(r.n for r in rows):
        return None
    return fit([(r.text, list(zip(r.starts, r.kinds, r.ends, strict=True))) for r in rows])


RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, n_added long"
)


def scan(docs: DataFrame, text="text", doc_id="doc_id", weights: Weights | None = None, **sample) -> DataFrame:
    """Fixed and added spans of every row."""
    w = fit_on(docs, text, doc_id, **sample) if weights is None else weights

    def find(batch: pa.RecordBatch):
        for part in S.sliced(batch):
            rows = []
            for key, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
                base, every = all_spans(value or "", w)
                rows.append((key, *S.counts(base, 4), S.digest(base, KINDS),
                             S.joined(every, KINDS), len(every) - len(base)))
            long, string = pa.int64(), pa.string()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True),
                    [long, long, long, long, long, string, string, long], strict=True)],
                names=[c.split()[0] for c in RESULT.split(", ")],
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return each_batch(rows, find, RESULT)
