"""The conversation trie against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickertone.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, owner long"


@pytest.fixture
def pieces(spark):
    """Ranges as the session plans them, so that conversations are cut."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        built[c] = convs.get(base, [])[:h] + own[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        below = [out[x] for x in children.get(p, [])]
        words = len((p[-1][1] if p else "").encode().split())
        ends = ",".join(str(c) for c in sorted(members[p]) if len(built[c]) == len(p))
        out[p] = (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below),
            sum(x[5] for x in below) or 1, sum(x[6] for x in below) + (len(members[p]) - 1) * words,
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def run(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    conv = F.col("conv")
    found = trie.prefix_trie(
        table, base=conv - conv % 20, head=F.crc32(conv.cast("string").cast("binary")) % 4
    )
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)


def talks(seed, convs, most, texts):
    r = random.Random(seed)
    return [
        (c, t, r.choice(["user", "bot", None]) if r.random() < 0.2 else ["user", "bot"][t % 2], r.choice(texts))
        for c in convs for t in range(r.randint(0, most))
    ]


@pytest.mark.parametrize("rows", [
    talks(1, range(90), 5, ["a b", "c", "", None, "d  e\tf"]),
    talks(2, range(-45, 30), 4, ["x", "x y"]),
    talks(3, range(20, 25), 9, ["hi"]) + [(0, None, "user", "first"), (0, 0, "user", "next"), (0, 0, "user", "next")],
    [(c, 0, "user", "one text") for c in range(700)] + [(c, 1, "bot", f"{c % 3}") for c in range(0, 700, 2)],
    [(None, 1, "user", "x"), (7, 1, "user", "y" * 9000), (7, 1, "user", "y" * 9001), (2**63 - 1, 0, "u", "v")],
])
def test_trie(spark, pieces, rows):
    assert run(spark, rows) == plain(rows)


def test_a_hot_and_deep_conversation(spark, pieces):
    rows = [(40, t, "user", f"w{t % 7} x") for t in range(3000)]
    rows += [(41, t, "user", f"w{t % 7} x") for t in range(2500)] + talks(5, range(60, 80), 3, ["w0 x", "w1 x"])
    assert run(spark, rows) == plain(rows)


def test_no_rows(spark):
    assert run(spark, []) == [] and run(spark, [(None, 0, "user", "x")]) == []


def test_unequal_turns_of_one_product_are_seen(spark):
    turns = spark.createDataFrame([(0, "u", "x"), (1, "u", "x"), (2, "u", "y")], "__row long, role string, text string")
    for refs, same in (((0, 1), True), ((0, 2), False)):
        members = spark.createDataFrame(
            [(c, 1, 5, 6, 1, 0, 1, 0, ref, 1, 1) for c, ref in enumerate(refs)], trie.MEMBERS
        )
        assert trie._all_equal(turns, members, trie._nodes(members)) is same
    members = spark.createDataFrame([(c, 2, 5, 6, c, 0, 1, 0, 0, 2, 2) for c in (0, 1)], trie.MEMBERS)
    assert not trie._all_equal(turns, members, trie._nodes(members))


def test_products():
    h = np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64)
    maps = trie.drawn(h)
    a, b = trie.products(maps)
    p = (np.array([1], np.uint64), np.array([0], np.uint64))
    for i in range(50):
        p = trie.times(p, (maps[0][i:i + 1], maps[1][i:i + 1]))
        assert p[0][0] == a[i] and p[1][0] == b[i]
        one = trie.times(p, trie.inverse(p))
        assert one[0][0] == 1 and one[1][0] == 0
