"""Spelling variants against brute force."""

import random
from collections import Counter

import pytest

from tickertone.llm import spelling


def apart(a, b):
    """One code point put in, taken out or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain(counts, ratio=2, least=5):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if apart(w, x)] if len(w) >= least else []
        near = [x for x in near if len(x) >= least]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        out[w] = (n, len(near), best if best and counts[best] >= ratio * n else None)

    def root(w):
        return root(out[w][2]) if out[w][2] else w

    return {w: (n, k, f, counts[f] if f else None, root(w)) for w, (n, k, f) in out.items()}


def words(seed, n, letters="abé", sizes=(5, 9)):
    r = random.Random(seed)
    found = Counter()
    for _ in range(n):
        found["".join(r.choice(letters) for _ in range(r.randint(*sizes)))] += r.choice([1, 3, 9, 40])
    return dict(found)


@pytest.mark.parametrize(("counts", "rare"), [
    (words(1, 300), 5), (words(2, 250, "ab", (5, 12)), 3), (words(3, 200, "abcdefgh", (3, 7)), 100),
    ({"aaaaa": 9, "aaaaaa": 4, "aaaaaaa": 2, "aaaa": 7, "x" * 3000: 1, "x" * 2999: 8, "a😀aaa": 1}, 1),
    ({w: 5 for w in words(4, 150, "th", (5, 8))}, 2),
])
def test_links_forms_and_roots(spark, counts, rare):
    rows = [(w, n, i) for i, (w, n) in enumerate(counts.items())]
    table = spark.createDataFrame(rows, "word string, n long, form int").repartition(3)
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(table, rare=rare).collect()}
    assert got == plain(counts)


def test_every_edit_leaves_the_promised_grams():
    r = random.Random(5)
    vocabulary = [*words(6, 400, "abc"), *words(7, 200, "ab", (5, 6))]
    pad = spelling.padding(5)
    for rare in (2, 10, 60):
        seen = Counter()
        for w in vocabulary:
            s = "\x01" * pad + w + "\x02" * pad
            seen.update(s[i:i + k] for k in (2, 3) for i in range(len(s) - k + 1))
        found = spelling.Dictionary({g for g, n in seen.items() if n > rare}, pad)
        for w in vocabulary:
            s = found.padded(w)
            grams = found.grams(s)
            worst = found.affected(s, grams)
            assert worst < len(grams)
            for _ in range(12):
                i, c = r.randrange(len(w) + 1), r.choice("abcz")
                other = r.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
                t = found.padded(other)
                theirs = found.grams(t)
                left = {t[:b] for _, b in theirs}
                right = {t[a:] for a, _ in theirs}
                kept = sum(s[:b] in left or s[a:] in right for a, b in grams)
                assert other == w or kept >= len(grams) - worst


def test_runs_and_lost_characters(spark):
    rows = spark.createDataFrame([(1, "Ähm Don't ÀB×cĀd 😀x"), (2, None), (3, "")], "doc_id long, text string")
    read = rows.select(spelling.runs(rows.text).alias("w"))
    assert [r.w for r in read.select(spelling.lowered(read.w).alias("w")).collect()] == ["Ähm", "don", "t", "Àb×c", "d", "x"]
    some = spark.createDataFrame([("héllo", 0), ("héllo", 1), ("héllo", 4), ("h", 0)], "w string, i int")
    assert [r[0] for r in some.select(spelling.without_character(some.w, some.i)).collect()] == ["éllo", "hllo", "héll", ""]


def test_odd_vocabularies(spark):
    table = spark.createDataFrame([(None, 3), ("abcde", 1), ("abcde", 2), ("abcdx", 9), ("", 4)], "word string, n long")
    got = {r.word: (r.n, r.n_near, r.form, r.root) for r in spelling.variants(table).collect()}
    assert got == {"abcde": (3, 1, "abcdx", "abcdx"), "abcdx": (9, 1, None, "abcdx"), "": (4, 0, None, "")}
    assert spelling.variants(table.where("false")).count() == 0
