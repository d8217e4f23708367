import hashlib
import random
import re
import time
from collections import defaultdict

import pyarrow as pa
import pytest
from corpus import ODD, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from tickertone.llm import personal, secrets
from tickertone.llm.spans import Taken

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def plain_secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]


def plain_personal(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19),
                                     (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or personal.luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return out


PIECES = st.lists(st.sampled_from([
    "password", "Token", "api_key", '"', "'", " ", "=", ":", "abcdef012345", "AKIA", "AKIAABCDEFGHIJKLMN",
    "ſecret", "deadbeefdeadbeef", "0", "é", "@", ".", "-", "a", "b.c", "com", "+", "1", "255", "256", "(", ")",
    "4111111111111111", "1.2.3.4", "+1 (377) 555-0271", "\n", "00000000000000000001",
]), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(PIECES)
def test_fixed_spans_are_those_of_the_patterns(text):
    assert sorted(s for s, _ in secrets.base_spans(text)) == sorted(plain_secrets(text))
    assert sorted(personal.base_spans(text)) == sorted(plain_personal(text))


def test_long_runs_take_linear_time():
    for text in ("9" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+" * 200_000, "@a" * 50_000):
        personal.base_spans(text)
        secrets.base_spans(text)


def test_ownership_separates_copied_from_live(spark):
    live, copied = "f3ef4d6b2755a36d7d9c25bd72c4d5f6", "04dbebab91ab85687d33eeaaf9ac699e"
    opaque = "zX9-kQ27_wLm4Tn8RvB3yH"
    texts = [f"token = {live}", f"again {live}"] + [f"see {copied}"] * 6 + [f"id {opaque}", f"id {opaque}"]
    sources = ["a", "a", *"bcdefg", "a", "b"]
    got = {r.doc_id: r for r in secrets.scan(documents(spark, texts, source=sources)).collect()}
    assert got[0].n_live == 2 and got[0].n_copied == 0
    assert all(got[i].n_copied == 1 and got[i].n_live == 0 for i in range(2, 8))
    assert got[8].spans == f"opaque:3:{3 + len(opaque)}" and got[8].n_opaque == 1
    assert got[0].spans == "assign:0:40,hex:8:40"
    assert got[0].base_sha256 == hashlib.sha256(got[0].spans.encode()).hexdigest()


def test_field_is_a_distribution_and_finds_the_best_segmentation():
    import itertools

    import numpy as np

    x = personal.Stretch("a 12.3@b", 0, 8)
    r = np.random.default_rng(1)
    w = personal.Weights(r.normal(size=(len(personal.FEATURES), personal.LABELS)),
                         r.normal(size=(personal.LABELS, personal.LABELS)))
    s, n = w.scores(x), len(x)
    total, best = [], (-np.inf, None)
    cuts = [c for k in range(n) for c in itertools.combinations(range(1, n), k)]
    for cut in cuts:
        edges = [0, *cut, n]
        spans = list(zip(edges, edges[1:], strict=False))
        for labels in itertools.product(range(personal.LABELS), repeat=len(spans)):
            score = sum(s[a, b - a - 1, y] for (a, b), y in zip(spans, labels, strict=True))
            score += sum(w.steps[p, q] for p, q in zip(labels, labels[1:], strict=False))
            if np.isfinite(score):
                total.append(score)
                best = max(best, (score, [(int(x.edges[a]), y, int(x.edges[b])) for (a, b), y
                                          in zip(spans, labels, strict=True) if y < personal.LABELS - 1]))
    log_total, spans, _ = personal._expected(x, w)
    assert log_total == pytest.approx(np.log(np.exp(total).sum()))
    covered = sum(spans[i, k].sum() * (k + 1) for i in range(n) for k in range(min(personal.MAX_TOKENS, n - i)))
    assert covered == pytest.approx(n)
    assert personal.decode(x, w) == best[1]


def test_field_adds_what_the_patterns_leave(spark):
    card = "4111111111111111"
    texts = [f"words here {card} and more words" for _ in range(30)]
    texts += [f"number {i}{i}{i} is none" for i in range(10)] + [f"two {card} {card} at once"]
    got = {r.doc_id: r for r in personal.scan(documents(spark, texts)).collect()}
    assert got[0].spans == "card:11:27" and got[0].n_card == 1
    assert got[40].n_card == 0 and got[40].spans == "card:4:20,card:21:37" and got[40].n_added == 2
    assert all(got[i].spans == "" for i in range(30, 40))


def card_numbers(n):
    out = []
    for i in range(n):
        stem = f"4{i * 7919 + 10**13:014d}"
        out.append(next(stem + d for d in "0123456789" if personal.luhn(stem + d)))
    return out


def test_field_finds_every_number_of_a_long_list(spark):
    numbers = card_numbers(1030)
    texts = [f"words here {n} and more words" for n in numbers[:30]]
    texts += [f"number {i}{i}{i} is none" for i in range(10)]
    w = personal.fit_on(documents(spark, texts))
    listed = " ".join(numbers[30:])
    [got] = personal.scan(documents(spark, [listed]), weights=w).collect()
    assert got.spans == ",".join(f"card:{17 * i}:{17 * i + 16}" for i in range(1000))


def test_pieces_of_a_region_are_decoded_as_one(monkeypatch):
    import numpy as np

    r = np.random.default_rng(2)
    text = " ".join(r.choice(["4111111111111111", "1.2.3.4", "a@b.com", "+1 (377)", "12", "x-"], 200))
    assert personal.regions(text) == [(0, len(text))] and len(personal.stretches(text)) > 1
    for _ in range(5):
        w = personal.Weights(r.normal(size=(len(personal.FEATURES), personal.LABELS)),
                             r.normal(size=(personal.LABELS, personal.LABELS)))
        whole = personal.decode(personal.Stretch(text, 0, len(text)), w)
        for piece in (3, 16, 101):
            monkeypatch.setattr(personal, "PIECE", piece)
            assert personal.decode_region(text, 0, len(text), w) == whole


@pytest.mark.parametrize("scan", [secrets.scan, personal.scan])
def test_odd_rows(odd, nothing, scan):
    got = scan(odd).collect()
    assert len(got) == len(ODD) + 3 and scan(nothing).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert [r.base_sha256 for r in got if r.doc_id is None] == [empty]


def test_many_spans_of_one_text_take_little_time():
    """100,000 spans in one text, each compared with the others by a search."""
    hexes = [f"{i:016x} {'Zz' * 20}{i}" for i in range(50_000)]
    start = time.perf_counter()
    text = " ".join(hexes)
    base = [s for s, _ in secrets.base_spans(text)]
    assert len(base) == 50_000 and len(secrets.opaque_spans(text, base)) == 50_000
    numbers = " ".join(f"10.{i % 256}.{i // 256 % 256}.7, mail{i}@x.org;" for i in range(50_000))
    base, every = personal.all_spans(numbers, None)
    assert len(base) == len(every) == 100_000
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([numbers])], names=["ordering", "text"])
    assert sum(b.num_rows for b in personal._sample(batch)) > 0
    assert time.perf_counter() - start < 60


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 2), st.integers(1, 9))), st.integers(0, 45), st.integers(1, 9))
def test_taken(spans, start, length):
    spans = [(s, k, s + n) for s, k, n in spans]
    wanted = any(s < start + length and start < e for s, _, e in spans)
    assert Taken(spans).touches(start, start + length) == wanted


def test_sample_is_bounded_without_ids(spark):
    rows = documents(spark, [f"call 555-{i:04d} now" for i in range(60)] * 3, doc_id=[None] * 180)
    seen = []
    keep = personal.each_batch

    def watched(df, work, schema):
        seen.append(df.count())
        return keep(df, work, schema)

    personal.each_batch = watched
    try:
        personal.fit_on(rows, max_documents=25)
    finally:
        personal.each_batch = keep
    assert seen == [25]


def plain_scan(rows, owners, repositories):
    """Owners, repositories and what is live, with dictionaries."""
    found, held, places = [], defaultdict(set), defaultdict(set)
    for doc, text, source, lang in rows:
        base = secrets.base_spans(text or "")
        each = base + secrets.opaque_spans(text or "", [s for s, _ in base])
        found.append((doc, base, each))
        for _, value in each:
            held[value].add(source)
            places[value].add((source, lang))
    out = {}
    for doc, base, each in found:
        few = {v: len(held[v]) <= owners and len(places[v]) <= repositories for _, v in each}
        live = [s for s, v in each if few[v] and secrets.looks_random(v)]
        shown = sorted({s for s, _ in base} | set(live))
        copied = sum(not few[v] for (_, k, _), v in each if k < 3)
        out[doc] = (len(live), copied, sum(k == 3 for _, k, _ in live), ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in shown))
    return out


def test_ownership_against_dictionaries(spark):
    r = random.Random(6)
    alphabet = "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    values = ["".join(r.choice(alphabet) for _ in range(r.choice([14, 24, 36, 44]))) for _ in range(25)]
    values += ["".join(r.choice("0123456789abcdef") for _ in range(32)) for _ in range(8)] + ["AKIA" + "X7Q2" * 4, "aaaaaaaaaaaaaaaa"]
    texts = []
    for i in range(160):
        some = [r.choice(values[: 4 if r.random() < 0.4 else len(values)]) for _ in range(r.randrange(4))]
        texts.append(prose(i, 5) + " " + " ".join(r.choice(["token = '{}'", "{}", "x {} y", "password:{}"]).format(v) for v in some))
    sources = [r.choice(["a", "b", "c", "d", "e"]) for _ in texts]
    langs = [r.choice(["en", "de"]) for _ in texts]
    wanted = plain_scan(list(zip(range(160), texts, sources, langs, strict=True)), 2, 3)
    rows = documents(spark, texts, source=sources, lang=langs)
    got = secrets.scan(rows, max_owners=2, max_repositories=3).collect()
    assert {x.doc_id: (x.n_live, x.n_copied, x.n_opaque, x.spans) for x in got} == wanted
    assert sum(x.n_live for x in got) > 5 and sum(x.n_copied for x in got) > 5 and sum(x.n_opaque for x in got) > 5
