"""Benchmark decontamination, training order and the pipeline."""

import json
import random

import numpy as np
import pytest
from corpus import ODD, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tickertone.llm import decontaminate, training_order
from tickertone.llm import words as W

LAYOUT = training_order.Layout(tokens=64, per_shard=16)
needs_ranks = pytest.mark.skipif(
    not __import__("os").path.exists(LAYOUT.ranks), reason="no vocabulary file here"
)


def plain_subsequence(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, best[j] = best[j], max(best[j], best[j - 1], before + (x == y))
    return best[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=20), st.lists(st.integers(0, 4), max_size=30))
def test_common_subsequence(a, b):
    got = decontaminate.common_subsequence(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    assert got == plain_subsequence(a, b)


def benchmark(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_leaks_and_paraphrases_are_found(spark):
    r = random.Random(1)
    items = [f"{prose(f'b{i}', r.randrange(12, 50), 5000)}. {prose(f'a{i}', 4, 5000)}" for i in range(40)]
    items.append(prose("long", 200, 5000))
    texts, wanted = [prose(i, r.randrange(0, 400), 3000) for i in range(150)], set()
    for i, item in enumerate(items):
        words = item.split()
        inside = words[60:130] if i == 40 else words
        texts.append(" ".join([prose(i, r.randrange(200), 3000), *inside, prose(i + 99, r.randrange(200), 3000)]))
        wanted.add((len(texts) - 1, i))
    for i in range(0, 40, 2):  # every fourth word before the answer is another one, one is put in
        words = items[i].split()
        words = [f"x{i}" if j % 4 == 2 and j < len(words) - 4 else w for j, w in enumerate(words)]
        words.insert(len(words) // 2, "between")
        texts.append(" ".join([prose(i + 7, 100, 3000), *words, prose(i + 8, 50, 3000)]))
        wanted.add((len(texts) - 1, i))
    texts.append(items[0].upper() + "  " + items[1].replace(" ", "\n"))
    wanted |= {(len(texts) - 1, 0), (len(texts) - 1, 1)}
    docs = documents(spark, texts + ODD)
    got = decontaminate.matches(docs, benchmark(spark, items + ODD)).collect()
    assert {(x.doc_id, x.item_id) for x in got if x.doc_id < len(texts)} == wanted


def test_copies_without_their_rarest_words_are_found(spark):
    r = random.Random(4)
    common = [f"c{i}" for i in range(30)]
    items = [
        " ".join([*(w for i, c in enumerate(r.sample(common, 12)) for w in (c, f"r{k}x{i}"))])
        + ". " + " ".join(r.sample(common, 4)) for k in range(5)
    ]
    texts = [prose(i, 80, 3000) + " " + " ".join(common) for i in range(60)]
    for k, item in enumerate(items):
        copy = [f"other{k}x{i}" if w.startswith("r") else w for i, w in enumerate(item.split())]
        texts.append(" ".join([prose(k, 90, 3000), *copy, prose(k + 9, 90, 3000)]))
    got = decontaminate.matches(documents(spark, texts), benchmark(spark, items)).collect()
    assert {(60 + k, k) for k in range(5)} == {(x.doc_id, x.item_id) for x in got}


def test_no_window_that_would_be_judged_a_leak_is_missing():
    r = random.Random(6)
    some = [p for i in range(12) for p in decontaminate.passages(i, prose(f"b{i}", r.choice([9, 30, 150]), 20))]
    space = decontaminate.latent_space(
        some, np.zeros((decontaminate.RANGE, decontaminate.TERMS)), np.ones(decontaminate.TERMS), 9.0)
    part = next(W.texts(__import__("pyarrow").array([prose(i, 300 * i, 24) for i in range(4)])))
    starts, ends, first = W.split_words(part)
    hashes = W.span_hashes(W.lowered(part.data), starts, ends)
    size, want = decontaminate.STEP * decontaminate.STEPS, set()
    begin, owner = decontaminate._blocks(np.diff(first), decontaminate.STEP)
    for b, text in zip(begin, owner, strict=True):
        for p in some:
            region, around = (
                hashes[max(first[text], b - n):min(first[text + 1], b + size + n)]
                for n in (len(p.words), p.reach))
            if decontaminate._judge(p, region, around)[2]:
                want.add((text, p.item))
    got = {(text, item) for text, item, *_ in decontaminate._search(part, space)}
    assert got == want and want


def test_paraphrases_of_long_items_are_found(spark):
    item = f"{prose('long', 194, 5000)}. {prose('answer', 6, 5000)}"
    words = item.split()
    # A third of the words before the answer are others; once the answer is there, once it is not.
    words = [f"x{j}" if j % 3 == 1 and j < 194 else w for j, w in enumerate(words)]
    texts = [
        " ".join([prose(i, 80, 3000), *words[:194], *end, prose(i + 9, 80, 3000)])
        for i, end in enumerate((words[194:], [f"y{j}" for j in range(6)]))
    ]
    texts += [prose(i, 300, 3000) for i in range(20, 40)]
    got = decontaminate.matches(documents(spark, texts), benchmark(spark, [item])).collect()
    assert [(r.doc_id, r.item_id, r.answered) for r in got] == [(0, 0, 1.0)]
    assert 0.5 <= got[0].shared < 0.8


def test_benchmarks_are_searched_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 3)
    items = [prose(f"b{i}", 20, 5000) for i in range(8)]
    docs = documents(spark, [prose(i, 50) + " " + t for i, t in enumerate(items)] + ["none of it"])
    got = decontaminate.matches(docs, benchmark(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(8)]


def test_the_bound_leaves_no_candidate_out():
    r = np.random.default_rng(3)
    some = [p for i in range(30) for p in decontaminate.passages(i, prose(f"b{i}", 20, 300))]
    space = decontaminate.latent_space(
        some, r.normal(size=(decontaminate.RANGE, decontaminate.TERMS)),
        r.integers(0, 50, decontaminate.TERMS).astype(float), 100.0)
    part = next(W.texts(__import__("pyarrow").array([prose("t", 5000, 300)])))
    starts, ends, first = W.split_words(part)
    hashes = W.span_hashes(W.lowered(part.data), starts, ends)
    begin, owner = decontaminate._blocks(np.diff(first), decontaminate.STEP)
    row = space.row[decontaminate._terms(hashes)]
    used = np.flatnonzero(row >= 0)
    kept = decontaminate._worth_projecting(
        space, row[used], np.searchsorted(begin, used, side="right") - 1, owner)
    size = decontaminate.STEP * decontaminate.STEPS
    whole = {
        k for k, b in enumerate(begin)
        if ((space.loading[row[b:b + size][row[b:b + size] >= 0]].sum(axis=0) @ space.items)
            >= decontaminate.COVERED * space.norms).any()
    }
    assert whole <= set(kept.tolist()) and len(whole) > 0


def test_decontaminate_odd_rows(odd, nothing, spark):
    items = benchmark(spark, [prose("q", 20), None, "short one"])
    found = decontaminate.with_leaks(odd, items, out="__leak")
    assert found.count() == odd.count() and found.where(F.size("__leak") > 0).count() == 0
    assert decontaminate.matches(nothing, items).count() == 0
    assert decontaminate.matches(odd, items.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_slots_are_a_permutation(n, key):
    slots = training_order.feistel_slots(np.arange(n), n, key)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 1000:
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.2


def plain_tokens(texts):
    encoder = training_order._encoder(training_order.load_ranks(LAYOUT.ranks), LAYOUT.pattern, "plain")
    return {i: encoder.encode_ordinary(t) + [LAYOUT.end] for i, t in texts.items() if t is not None}


def from_shards(folder, manifest):
    """Every document's tokens, put together again from the shards."""
    n = len(manifest)
    whole = training_order.read_slots(folder, 0, n)
    assert whole.shape == (n, LAYOUT.tokens)
    parts = {}
    for r in manifest:
        for s in r.segments:
            parts.setdefault(s.doc_id, []).append((r, s, whole[r.slot][s["at"]:s["at"] + s.n].tolist()))
    return parts


@needs_ranks
def test_round_trip(spark, tmp_path):
    texts = {i: prose(i, (i * 37) % 300) for i in range(80)} | {80 + i: t for i, t in enumerate(ODD)}
    folder = f"file://{tmp_path}/shards"
    docs = documents(spark, list(texts.values()))
    manifest = training_order.write_shards(docs, folder, LAYOUT).collect()
    assert sorted(r.slot for r in manifest) == list(range(len(manifest)))
    parts, wanted = from_shards(folder, manifest), plain_tokens(texts)
    assert set(parts) == set(wanted)
    for doc_id, tokens in wanted.items():
        pieces = sorted(sum((p for _, _, p in parts[doc_id]), []))
        assert pieces == sorted(tokens)
        if len(parts[doc_id]) == 1:
            assert parts[doc_id][0][2] == tokens
    for r in manifest:
        assert r.shard == r.slot // 16 and r.byte_offset == r.slot % 16 * 128
        assert r.n_tokens == sum(s.n for s in r.segments) <= 64
    assert (training_order.read_slots(folder, 14, 5) == training_order.read_slots(folder, 0, 30)[14:19]).all()
    layout = json.loads((tmp_path / "shards" / "layout.json").read_text())
    assert layout["sequences"] == len(manifest) and layout["stride"] == 128
    files = sorted(p.name for p in (tmp_path / "shards").iterdir() if p.suffix != ".json")
    assert files == [f"shard-{i:08d}.bin" for i in range(-(-len(manifest) // 16))]


def _encode(text):
    ranks = training_order.load_ranks(LAYOUT.ranks)
    encoders = [training_order._encoder(ranks, p, f"test {p}") for p in (training_order.PLAIN, LAYOUT.pattern)]
    pieces = training_order.cut_at_spaces(text)
    return [x for blank, piece in pieces for x in encoders[not blank].encode(piece, disallowed_special=())], encoders[1]


@needs_ranks
@pytest.mark.parametrize("run", [" " * 12_000, "\n" * 10_001, " \t" * 9_000, "\u3000\x85" * 6_000, "\x1c" * 11_000, " " * 9_999])
def test_long_white_space_is_cut_where_the_pattern_cuts(run):
    r = random.Random(4)
    for before, after in (("", ""), ("word", ""), ("", "word"), ("it's 12", "'s"), ("!", "\x1cx"), ("a ", "é 1")):
        text = before + run + after + prose(r.random(), 30) + run + "end" + run[:r.randrange(len(run))]
        got, plain = _encode(text)
        assert got == plain.encode(text, disallowed_special=())


@needs_ranks
def test_ten_million_characters_of_each_sort(spark, tmp_path):
    texts = [c * 10_000_000 for c in (" ", "a", "1", "!")] + ["a" + "\n" * 3_000_000 + "b"]
    folder = f"file://{tmp_path}/long"
    manifest = training_order.write_shards(documents(spark, texts), folder, training_order.Layout()).collect()
    tokens = {i: sum(s.n for r in manifest for s in r.segments if s.doc_id == i) for i in range(len(texts))}
    assert tokens[0] == 10_000_001 and tokens[4] == 2 + 1 + 1_500_000 + 1
    assert tokens[1] == tokens[2] == 2_500_001 and tokens[3] == 1_250_001


@needs_ranks
def test_order_odd_rows(odd, nothing, tmp_path):
    got = training_order.write_shards(odd, str(tmp_path / "a"), LAYOUT).collect()
    assert {s.doc_id for r in got for s in r.segments} == {*range(1, len(ODD))}  # a null text is skipped
    assert training_order.write_shards(nothing, str(tmp_path / "b"), LAYOUT).count() == 0


@needs_ranks
def test_pipeline(spark, tmp_path):
    """Each stage takes its decisions, and keeps columns and all other rows."""
    items = [prose(f"b{i}", 20, 5000) for i in range(5)]
    texts = [prose(i, 80, 2000) for i in range(60)]
    texts += [texts[3], texts[3] + " more", texts[5].upper(), prose(70, 50) + " " + items[2], "123 456", None]
    ids = [*range(60), 60, 61, 62, 63, 64, 65]
    docs = documents(spark, texts, doc_id=ids, lang=["en", "de"] * 33,
                     source=[f"src{i % 6}" for i in range(66)]).withColumn("extra", F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark(spark, items).write.parquet(f"{tmp_path}/benchmark.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    gone = [{64, 65}, {60, 61, 62}, {63}]
    kept = set(ids)
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        done = step(spark, left, str(tmp_path))
        if i < 4:
            assert done.columns == docs.columns
            done.write.parquet(f"{tmp_path}/stage{i}")
            done = spark.read.parquet(f"{tmp_path}/stage{i}")
        if i < 3:
            kept -= gone[i]
            assert sorted(r.doc_id for r in done.collect()) == sorted(kept)
        left = done
    mixed = [r.doc_id for r in spark.read.parquet(f"{tmp_path}/stage3").collect()]
    assert set(mixed) <= kept and max(mixed.count(i) for i in kept) <= 2
    assert {s.doc_id for r in left.collect() for s in r.segments} == set(mixed)
    for name in ("documents", "benchmark"):
        empty = spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0)
        empty.write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
