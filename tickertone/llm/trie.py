"""The prefix trie of rebuilt conversations, from fingerprints that are multiplied, not texts.

A rebuilt conversation is the first turns of another one (its base) followed by its own later turns.
No rebuilt text is ever made:

1. *Turns.* Each turn is stored once with a reference, and has a fingerprint: a map ``x -> a x + b``
   over 64-bit numbers, with ``a`` odd, drawn from a hash of its role and text. Such maps form a
   group; the fingerprint of a sequence is the product of its turns.
2. *Prefix products* of all original conversations come from one pass over ranges of sorted turns.
   Ranges end anywhere, also inside a conversation: a task multiplies what it holds, and the
   products of a conversation's earlier ranges, two small rows per range, are put before it.
3. *Rebuilding* is symbolic: product of the base's head, times the inverse of the product of the
   replaced turns, times an own prefix product (``_linked``). One multiplication per turn.
4. *Nodes* are groups of equal depth and product. All conversations of a node must have the same
   parent product, and the stored turns that the node's references name must be equal; if a group
   fails, the fingerprints are drawn anew. So equal nodes are equal sequences, not equal hashes.
5. *Subtrees without a walk.* Let a node belong to its smallest conversation. Along a conversation
   the nodes it owns are the last ones, so the words it shares below a depth are a difference of two
   prefix sums, and a childless node is counted once, at its owner. Sums over the members of a node
   are then sums over its subtree, whatever its depth.

Everything is a grouping or a join on unique keys; a hot conversation is cut by ranges, a hot node
is summed before it is shuffled. The digest of a node's ends is sequential by nature: ids are joined
to strings of CHUNK in parallel, and one task per node reads those strings in order.

Defined cases: rows without a conversation id are dropped; a null role or text is empty; rows of one
conversation and turn (a null turn comes first) are ordered by role, the first START characters of the
text, a hash of it, and rows that are repeated stay; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .frames import ROW, Batches, each_batch, rows_of
from .words import mixed

MOST_HEAD = 3   # turns a base can give
START = 64      # characters of a text that order equal turns
CHUNK = 256     # ids in one string
DRAWS = 8       # of the fingerprints, before giving up
WORDS = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "a", "b"]

Map = tuple[np.ndarray, np.ndarray]


def times(p: Map, q: Map) -> Map:
    """First ``p``, then ``q``."""
    return p[0] * q[0], p[1] * q[0] + q[1]


def inverse(p: Map) -> Map:
    a = p[0]
    x = (a * np.uint64(3)) ^ np.uint64(2)  # right in five bits; each step doubles them
    for _ in range(4):
        x = x * (np.uint64(2) - a * x)
    return x, np.uint64(0) - p[1] * x


def drawn(hashes: np.ndarray) -> Map:
    """The fingerprint of each turn."""
    return mixed(hashes) | np.uint64(1), mixed(hashes ^ np.uint64(0x9E3779B97F4A7C15))


def products(maps: Map) -> Map:
    """Products of all prefixes of a sequence of maps."""
    a = np.multiply.accumulate(maps[0])
    back = inverse((a, np.zeros_like(a)))[0]
    return a, a * np.cumsum(maps[1] * back, dtype=np.uint64)


def _u(column: pa.Array) -> np.ndarray:
    return np.asarray(column).astype(np.int64).view(np.uint64)


def _long(numbers: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(numbers).view(np.int64))


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])


SCAN = (
    "conv long, piece int, i long, a long, b long, before_a long, before_b long, "
    "words long, until long, ref long"
)


def _scan(batches: Batches) -> Batches:
    """Position, product and words of each turn within its conversation, as far as this task goes."""
    last, held = None, (0, np.uint64(1), np.uint64(0), 0)
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        conv, hashes, words, ref = batch.columns
        convs, counts = np.asarray(conv), np.asarray(words).astype(np.int64)
        new = np.r_[convs[0] != last if last is not None else True, convs[1:] != convs[:-1]]
        if not new[0]:  # the conversation goes on from the last batch
            lead = held
        else:
            lead = (0, np.uint64(1), np.uint64(0), 0)
        begins = np.flatnonzero(np.r_[True, new[1:]])
        group = np.searchsorted(begins, np.arange(n), side="right") - 1
        whole = products(drawn(_u(hashes)))
        first = tuple(np.r_[one, x[:-1]] for one, x in zip((np.uint64(1), np.uint64(0)), whole, strict=True))
        back = inverse((first[0][begins], first[1][begins]))
        at_lead = group == 0
        lead_map = (np.where(at_lead, lead[1], np.uint64(1)), np.where(at_lead, lead[2], np.uint64(0)))
        link = times(lead_map, (back[0][group], back[1][group]))
        after, before = times(link, whole), times(link, first)
        sums = np.cumsum(counts)
        until = sums - (sums[begins] - counts[begins])[group] + np.where(at_lead, lead[3], 0)
        i = np.arange(n) - begins[group] + 1 + np.where(at_lead, lead[0], 0)
        last, held = convs[-1], (int(i[-1]), after[0][-1], after[1][-1], int(until[-1]))
        piece = np.full(n, TaskContext.get().partitionId(), dtype=np.int32)
        yield _batch(SCAN, [
            conv, pa.array(piece), pa.array(i), _long(after[0]), _long(after[1]),
            _long(before[0]), _long(before[1]), pa.array(counts), pa.array(until), ref,
        ])


def _carried(scan: DataFrame) -> DataFrame:
    """What a conversation's earlier pieces held, for pieces that go on with one: at most two rows
    per piece, folded on the driver."""
    spark = scan.sparkSession
    edges = sorted(tuple(r) for r in scan.groupBy("piece").agg(F.min("conv"), F.max("conv")).collect())
    lasts = {}
    split = set()
    for _, low, high in edges:
        if low in lasts:
            split.add(low)
        lasts = {high: True} if high != low else {low: True}
    chosen = F.broadcast(spark.createDataFrame([(c,) for c in split], "conv long"))
    ends = scan.join(chosen, "conv").groupBy("conv", "piece").agg(
        F.max("i").alias("n"), F.max_by("a", "i").alias("a"), F.max_by("b", "i").alias("b"),
        F.max("until").alias("until"),
    )
    rows, so_far = [], {}
    for r in sorted(ends.collect(), key=lambda r: r.piece):
        n, p, words = so_far.get(r.conv, (0, (np.array([1], np.uint64), np.array([0], np.uint64)), 0))
        if n:
            rows.append((r.conv, r.piece, n, *(int(x.view(np.int64)[0]) for x in p), words))
        mine = tuple(np.array([x], np.int64).view(np.uint64) for x in (r.a, r.b))
        so_far[r.conv] = (n + r.n, times(p, mine), words + r.until)
    return spark.createDataFrame(rows, "conv long, piece int, lead_n long, lead_a long, lead_b long, lead_words long")


PLACED = "conv long, i long, a long, b long, before_a long, before_b long, words long, until long, ref long"


def _place(batch: pa.RecordBatch) -> pa.RecordBatch:
    conv, i, a, b, before_a, before_b, words, until, ref, n, lead_a, lead_b, lead_words = batch.columns
    lead = (_u(lead_a), _u(lead_b))
    after, before = times(lead, (_u(a), _u(b))), times(lead, (_u(before_a), _u(before_b)))
    return _batch(PLACED, [
        conv, pa.array(np.asarray(i) + np.asarray(n)), *map(_long, (*after, *before)), words,
        pa.array(np.asarray(until) + np.asarray(lead_words)), ref,
    ])


def placed(turns: DataFrame, draw: int) -> DataFrame:
    """Every original turn with its position and the product and words of everything up to it."""
    keys = turns.select(
        "conv", "turn", "role", F.substring("text", 1, START).alias("start"),
        F.xxhash64(F.lit(draw), "role", "text").alias("hash"), F.col(ROW).alias("ref"),
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"),
    )
    order = ["conv", "turn", "role", "start", "hash", "ref"]
    ordered = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    scan = stage(ordered.select("conv", "hash", "words", "ref").mapInArrow(_scan, SCAN), "turn-products")
    lead = {"lead_n": 0, "lead_a": 1, "lead_b": 0, "lead_words": 0}
    joined = scan.join(F.broadcast(_carried(scan)), ["conv", "piece"], "left")
    plain = PLACED.replace(" long", "").split(", ")
    return each_batch(
        joined.select(*plain, *[F.coalesce(c, F.lit(x).cast("long")).alias(c) for c, x in lead.items()]),
        _place, PLACED,
    )


LINKED = "conv long, skip long, shift long, link_a long, link_b long, more_words long"


def _link(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The map that own prefix products are put behind: the base's head, without the replaced turns."""
    conv, skip, k, head_a, head_b, head_words, own_a, own_b, own_words = batch.columns
    link = times((_u(head_a), _u(head_b)), inverse((_u(own_a), _u(own_b))))
    return _batch(LINKED, [
        conv, skip, pa.array(np.asarray(k) - np.asarray(skip)), _long(link[0]), _long(link[1]),
        pa.array(np.asarray(head_words) - np.asarray(own_words)),
    ])


def _linked(rows: DataFrame, base: Column, head: Column) -> DataFrame:
    """One row per conversation: its base's head turns, and the link to its own later ones."""
    first = F.when(F.col("i") <= MOST_HEAD, F.struct("i", "a", "b", "before_a", "before_b", "words", "until", "ref"))
    own = stage(
        rows.groupBy("conv").agg(
            F.max("i").alias("n"), F.max("until").alias("total"), F.sort_array(F.collect_list(first)).alias("first")
        ).withColumn("base", base).withColumn("h", head.cast("int")), "conversations",
    )
    bases = own.select(F.col("conv").alias("base"), F.col("first").alias("heads"))
    both = own.join(bases, "base", "left").withColumn(
        "heads", F.slice(F.coalesce("heads", F.slice("first", 1, 0)), F.lit(1), F.col("h"))
    )

    def at(pieces: str, place: Column, name: str, none: int) -> Column:
        return F.coalesce(F.try_element_at(pieces, place.cast("int"))[name], F.lit(none).cast("long"))

    skip, k = F.least("h", F.size("first")), F.size("heads")
    one = F.lit(1)
    facts = both.select(
        "conv", skip.cast("long").alias("skip"), k.cast("long").alias("k"),
        *[at("heads", F.greatest(k, one), c, x).alias(f"head_{c}") for c, x in (("a", 1), ("b", 0), ("until", 0))],
        *[F.when(skip > 0, at("first", F.greatest(skip, one), c, x)).otherwise(F.lit(x).cast("long")).alias(f"own_{c}")
          for c, x in (("a", 1), ("b", 0), ("until", 0))],
    )
    links = each_batch(facts, _link, LINKED)
    joined = both.select("conv", "heads", "n", "total").join(links, "conv")
    return stage(
        joined.withColumn("len", F.col("n") + F.col("shift")).withColumn("total", F.col("total") + F.col("more_words")),
        "rebuilt",
    )


MEMBERS = (
    "conv long, depth long, a long, b long, above_a long, above_b long, words long, before long, ref long, "
    "len long, total long"
)


def _join_on(batch: pa.RecordBatch) -> pa.RecordBatch:
    conv, i, a, b, before_a, before_b, words, until, ref, shift, link_a, link_b, more, length, total = batch.columns
    link = (_u(link_a), _u(link_b))
    after, before = times(link, (_u(a), _u(b))), times(link, (_u(before_a), _u(before_b)))
    return _batch(MEMBERS, [
        conv, pa.array(np.asarray(i) + np.asarray(shift)), *map(_long, (*after, *before)), words,
        pa.array(np.asarray(until) - np.asarray(words) + np.asarray(more)), ref, length, total,
    ])


def _members(rows: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(conversation, depth) for every rebuilt turn and the root, with the product up to it."""
    own = rows.join(rebuilt.drop("heads", "n"), "conv").where(F.col("i") > F.col("skip"))
    later = each_batch(
        own.select("conv", "i", "a", "b", "before_a", "before_b", "words", "until", "ref", "shift",
                   "link_a", "link_b", "more_words", "len", "total"), _join_on, MEMBERS,
    )
    no, nothing = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = F.struct(
        no.alias("i"), F.lit(1).cast("long").alias("a"), no.alias("b"), nothing.alias("before_a"),
        nothing.alias("before_b"), no.alias("words"), no.alias("until"), nothing.alias("ref"),
    )
    head = rebuilt.select("conv", "len", "total", F.explode(F.concat(F.array(root), "heads")).alias("t")).select(
        "conv", F.col("t.i").alias("depth"), "t.a", "t.b", F.col("t.before_a").alias("above_a"),
        F.col("t.before_b").alias("above_b"), "t.words", (F.col("t.until") - F.col("t.words")).alias("before"),
        "t.ref", "len", "total",
    )
    return stage(later.unionByName(head), "trie-members")


def _all_equal(turns: DataFrame, members: DataFrame, nodes: DataFrame) -> bool:
    """Whether every node stands for one sequence: one parent, and equal stored turns."""
    def differ(low: str, high: str) -> Column:
        return F.col(low) != F.col(high)

    if not nodes.where(differ("above_a", "most_a") | differ("above_b", "most_b")).isEmpty():
        return False
    several = nodes.where(differ("ref", "most_ref")).select(*NODE)
    named = members.select(*NODE, "ref").join(several, NODE).distinct()
    stored = named.join(turns.select(F.col(ROW).alias("ref"), "role", "text"), "ref")
    seen = stored.groupBy(*NODE).agg(
        F.min("role").alias("role"), F.max("role").alias("most_role"),
        F.min("text").alias("text"), F.max("text").alias("most_text"),
    )
    return seen.where(differ("role", "most_role") | differ("text", "most_text")).isEmpty()


ENDS = "depth long, a long, b long, first long, ids string"


def _chunks(batches: Batches) -> Batches:
    """Ids of sorted rows as strings of at most CHUNK ids of one node."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = [np.asarray(c) for c in batch.columns[:3]]
        new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        groups = np.r_[0, np.flatnonzero(new) + 1, batch.num_rows]
        starts = np.concatenate([np.arange(x, y, CHUNK) for x, y in zip(groups[:-1], groups[1:], strict=True)])
        ids = batch.column(3).to_pylist()
        texts = [",".join(map(str, ids[x:y])) for x, y in zip(starts, [*starts[1:], len(ids)], strict=True)]
        yield _batch(ENDS, [pa.array(k[starts]) for k in [*keys, np.asarray(batch.column(3))]] + [pa.array(texts)])


DIGESTS = "depth long, a long, b long, ends_sha256 string"


def _digests(batches: Batches) -> Batches:
    def done() -> Iterator[pa.RecordBatch]:
        if key is not None:
            yield _batch(DIGESTS, [pa.array([k], pa.int64()) for k in key] + [pa.array([digest.hexdigest()])])

    key, digest = None, hashlib.sha256()
    for batch in batches:
        for depth, a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
            if (depth, a, b) == key:
                digest.update(b",")
            else:
                yield from done()
                key, digest = (depth, a, b), hashlib.sha256()
            digest.update(ids.encode())
    yield from done()


def _ends(members: DataFrame) -> DataFrame:
    """The digest of the ids of conversations that end at a node."""
    ended = members.where(F.col("depth") == F.col("len")).select(*NODE, "conv")
    chunks = ended.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(_chunks, ENDS)
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_digests, DIGESTS)


def _nodes(members: DataFrame) -> DataFrame:
    return stage(
        members.groupBy(*NODE).agg(
            F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("len").alias("longest"),
            F.min("before").alias("before"),
            F.min("above_a").alias("above_a"), F.max("above_a").alias("most_a"),
            F.min("above_b").alias("above_b"), F.max("above_b").alias("most_b"),
            F.min("ref").alias("ref"), F.max("ref").alias("most_ref"),
        ), "trie-nodes",
    )


def prefix_trie(
    conversations: DataFrame, base: Column, head: Column, conv="conv_id", turn="turn", role="role", text="text"
) -> DataFrame:
    """One row per node. ``base`` and ``head`` (0 to MOST_HEAD) are expressions of a column ``conv``."""
    turns = stage(
        rows_of(
            conversations, conv=F.col(conv).cast("long"), turn=F.col(turn).cast("long"),
            role=F.coalesce(F.col(role).cast("string"), F.lit("")),
            text=F.coalesce(F.col(text).cast("string"), F.lit("")),
        ).where(F.col("conv").isNotNull()), "turns",
    )
    for draw in range(DRAWS):
        rows = placed(turns, draw)
        members = _members(rows, _linked(rows, base, head))
        nodes = _nodes(members)
        if _all_equal(turns, members, nodes):
            break
    else:
        raise RuntimeError(f"{DRAWS} draws of fingerprints gave equal products of different turns")

    owners = nodes.groupBy(F.col("owner").alias("conv")).agg(
        F.min("depth").alias("own"), F.min("before").alias("shared"),
        F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"),
    )
    tail = F.coalesce("shared", "total") - F.col("before")
    sums = members.join(owners, "conv", "left").groupBy(*NODE).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.sum(F.when(F.col("own").isNull() | (F.col("depth") < F.col("own")), tail).otherwise(0)).alias("saved_tokens"),
    )
    above = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("above_a").alias("a"), F.col("above_b").alias("b")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("above_a"), F.col("b").alias("above_b"),
        F.col("owner").alias("parent_conv_id"),
    )
    found = nodes.select(*NODE, "owner", "n_convs", "above_a", "above_b").join(
        parents, ["depth", "above_a", "above_b"], "left"
    )
    return (
        found.join(sums, NODE).join(above, NODE, "left").join(_ends(members), NODE, "left")
        .select(
            F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
