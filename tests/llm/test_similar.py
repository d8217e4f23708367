"""N-gram Jaccard join and substring dedup against brute force."""

import hashlib
import itertools
import random

import pytest
from corpus import ODD, documents, prose

from tickertone.llm import jaccard, substrings
from tickertone.llm.components import components


def plain_set(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def plain_classes(rows, rule):
    """Sizes, components and links by comparing all pairs."""
    sets = [plain_set(t, rule.words) for _, t in rows]
    ids = [i for i, _ in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and rule.den * common >= rule.num * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    return [
        (ids[i], len(sets[i]),
         min((ids[j] for j in range(len(rows)) if find(j) == find(i) and ids[j] is not None), default=None),
         links[i])
        for i in range(len(rows))
    ]


def near_copies(seed, n, words=60, changes=3):
    r = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(r.randrange(changes + 1)):
            own[r.randrange(words)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def corpus():
    texts = near_copies(1, 40) + near_copies(2, 6, 200, 8) + [prose(i, 30 + i) for i in range(20)]
    texts += [texts[0]] * 5 + [prose(99, 50) + " " + prose(i, 20) for i in range(100, 110)]
    texts += ["one two", "One TWO", "two one", "", None, " \n", "É x", "é x"]
    random.Random(5).shuffle(texts)
    return texts


@pytest.mark.parametrize("paired, block", [(32, 512), (4, 8)])
def test_jaccard_is_exact(spark, monkeypatch, paired, block):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = corpus()
    rule = jaccard.Rule(words=4, num=85, den=100)
    got = jaccard.jaccard_classes(documents(spark, texts), rule).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == sorted(
        plain_classes(list(enumerate(texts)), rule)
    )
    first = {r["__row"]: r.doc_id for r in got}
    assert all(first[r.first_row] == r.component_id for r in got)


def template_copies():
    """A pair that shares rare words before those of a template of 42 other texts."""
    template = [f"t{i}" for i in range(86)]
    shared = [f"s{i}" for i in range(10)]
    texts = [" ".join([*shared, *template, *(f"{side}{i}" for i in range(4))]) for side in "ab"]
    return texts + [" ".join([*template, *(f"o{k}x{i}" for i in range(10))]) for k in range(42)]


@pytest.mark.parametrize("sketch", [1 << 22, 1 << 10])
def test_jaccard_counts_rare_words_before_frequent_ones(spark, monkeypatch, sketch):
    monkeypatch.setattr(jaccard, "SKETCH", sketch)
    rule = jaccard.Rule(words=1, num=85, den=100)
    for texts in (template_copies(), template_copies() + corpus()):
        got = jaccard.jaccard_classes(documents(spark, texts), rule).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == sorted(
            plain_classes(list(enumerate(texts)), rule)
        )


def test_one_of_each_component_stays(spark):
    base = near_copies(7, 5, 100, 2)
    texts = [*base, base[0], base[0].upper(), prose(1, 50), prose(1, 50), "", "", None, prose(2, 60), prose(2, 60)]
    ids = [9, 8, 7, 6, 5, 5, None, 20, 20, 21, 21, 22, None, None]
    docs = documents(spark, texts, doc_id=ids).selectExpr("*", "1 as __own", "2 as set_id")
    out = jaccard.one_per_component(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in out.collect())
    # id 5 has two near copies, of which one stays; repeated rows without a text all stay.
    assert [g[0] for g in got] == [-1, 5, 20, 21, 21, 22]
    assert got[0][1] == prose(2, 60) and got[2][1] == prose(1, 50)


def test_jaccard_odd_rows(odd, nothing):
    assert jaccard.one_per_component(nothing).count() == 0
    assert jaccard.one_per_component(odd).columns == odd.columns
    rule = jaccard.Rule()
    got = jaccard.jaccard_classes(odd, rule).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    key = str
    assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got], key=key) == sorted(
        plain_classes(rows, rule), key=key
    )
    assert jaccard.jaccard_classes(nothing).count() == 0


def test_prefix_and_overlap_are_tight():
    rule = jaccard.Rule(4, 85, 100)
    for a in range(1, 60):
        least = min(k for k in range(a + 1) if any(100 * k >= 85 * (a + b - k) for b in range(k, 100)))
        assert rule.prefix(a) == a - least + 1
        for b in range(1, 60):
            fits = [k for k in range(min(a, b) + 1) if 100 * k >= 85 * (a + b - k)]
            if fits:
                assert rule.overlap(a, b) == fits[0]


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(3, 3), (5, 4), (4, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in [7, *range(200, 240)]} == {7}
    assert got[4] == got[5] == 4 and 3 not in got
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_rest(rows, n=20):
    """What is left of each text; ``rows`` in the order of their places."""
    first = {}
    for place, (_, text) in enumerate(rows):
        words = (text or "").encode().split()
        for i in range(len(words) - n + 1):
            first.setdefault(tuple(words[i:i + n]), (place, i))
    out = []
    for place, (key, text) in enumerate(rows):
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for i in range(len(words) - n + 1):
            if first[tuple(words[i:i + n])] < (place, i):
                keep[i:i + n] = [False] * n
        kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
        out.append((key, len(words), keep.count(False), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [20_000, 2])
def test_substrings_are_exact(spark, shard):
    r = random.Random(3)
    passages = [prose(i, 60) for i in range(4)]
    texts = near_copies(1, 12, 80) + [prose(i, 25 * (i % 4)) for i in range(12)]
    for _ in range(30):
        a, b = r.choice(passages).split(), r.choice(passages).split()
        low = r.randrange(30)
        texts.append(" ".join([prose(r.random(), 10), *a[low:low + 30], prose(r.random(), 9), *b[low:]]))
    texts += [texts[0]] * 3 + ["r " * 100, "p q " * 40, None, "", "short text"]
    r.shuffle(texts)
    got = substrings.without_repeats(documents(spark, texts), shard=shard).collect()
    assert sorted((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got) == sorted(
        plain_rest(list(enumerate(texts)))
    )
    assert all(hashlib.sha256(x.kept_text.encode()).hexdigest() == x.kept_sha256 for x in got)


def test_substrings_odd_rows(odd, nothing):
    got = substrings.without_repeats(odd).collect()
    assert len(got) == len(ODD) + 3 and sum(r.doc_id is None for r in got) == 1
    assert substrings.without_repeats(nothing).count() == 0


def test_many_texts_without_an_id(spark):
    """2,000 rows without an id and 300 with one id: each is looked up by its own text."""
    r = random.Random(8)
    passages = [prose(i, 40) for i in range(30)]
    texts = [f"{r.choice(passages)} {prose(i, 8)}" for i in range(2300)] + [passages[0]] * 50
    ids = [None] * 2000 + [(1 << 63) - 1] * 300 + [None] * 50
    rows = documents(spark, texts, doc_id=ids)
    got = substrings.without_repeats(rows).collect()
    assert len(got) == 2350 and sum(x.doc_id is None for x in got) == 2050
    assert {x.doc_id for x in got if x.doc_id is not None} == {(1 << 63) - 1}
    # All copies of a passage but the first go, whatever the order of rows without an id.
    whole = sum(x.n_removed == 0 for x in got)
    assert whole <= 30 + 2 and sum(x.n_removed >= 40 for x in got) >= 2350 - 50 - 32


def test_automaton_knows_first_places():
    r = random.Random(1)
    for _ in range(60):
        runs = [[r.choice("abc").encode() for _ in range(r.randrange(4, 14))] for _ in range(4)]
        automaton, text = substrings.SuffixAutomaton(), []
        for i, run in enumerate(runs):
            for x in [*(ord(c) for c in run), -1 - i]:
                automaton.add(x)
                text.append(x)
        for run in runs:
            codes = [ord(c) for c in run]
            for end, (matched, state) in enumerate(automaton.statistics(codes)):
                assert matched == end + 1
                for n in range(1, matched + 1):
                    wanted = codes[end + 1 - n:end + 1]
                    first = next(i for i in range(len(text)) if text[i:i + n] == wanted)
                    assert automaton.first_end(state, n) == first + n - 1
