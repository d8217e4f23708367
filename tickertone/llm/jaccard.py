"""N-gram Jaccard join: all pairs of texts whose shingle sets are alike, by prefix filtering.

The shingles of a text are ordered by how rare they are in the corpus. Two sets that are alike
enough must share a shingle of their prefixes, so only prefixes are joined; length, position and
suffix filters drop most pairs that cannot reach the threshold, and each of the others is
verified once, on the whole sets.

* Equal sets are one node, however many documents have them; nothing is paired among copies.
* Rarity comes from one counter table over all documents (SKETCH counters, a fixed 4 MB when
  broadcast). Any common order gives exact results; a coarser one only gives longer lists.
* A shingle of at most PAIRED nodes makes pairs, so their number is bounded by the postings. The
  nodes of a more frequent one (near copies by the thousand, common passages) are cut into blocks
  of bounded size, and two blocks at a time are verified in one task, which returns the number
  of links of each node and one edge per node, never the pairs. A pair belongs to the first
  frequent shingle that both prefixes hold, or to the pairs if they share none.

Shingles are 64-bit hashes. Two texts of some thousand shingles are misjudged with a probability
below 2**-40; sets are identified by 128 bits.

Defined cases: a null text, or one without words, has an empty set, is linked with nothing and is
its own component. A text of fewer words than a shingle has one: all its words. Repeated rows are copies. A row without an id
takes part in links, and gets the smallest id among the others of its component, if any. An
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from . import words as W
from .components import components
from .frames import (
    ROW, VECTOR, IdFilter, each_batch, give_back, pieces, rows_of, summed_vector, tidied, unused,
    vector_rows,
)

SKETCH = 1 << 22
PAIRED = 32            # nodes of a shingle that are still paired one by one
BLOCK = 512            # nodes of a block, on average
BLOCK_BYTES = 8 << 20  # ... and bytes of their sets
LAST = (1 << 63) - 1   # stands for a missing id where the smallest is looked for
PROFILE = 64           # parts of the hash space that the suffix filter counts


@dataclass(frozen=True)
class Rule:
    """Shingle length, and the similarity ``num / den`` from which two sets are linked."""

    words: int = 5
    num: int = 80
    den: int = 100

    def prefix(self, n):
        return n - -(-self.num * n // self.den) + 1

    def overlap(self, a, b):
        """Least intersection of linked sets of sizes ``a`` and ``b``."""
        return -(-self.num * (a + b) // (self.num + self.den))


def shingles(part: W.Texts, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle, in the order of the texts."""
    starts, ends, first = W.split_words(part)
    hashes = W.span_hashes(W.lowered(part.data), starts, ends)
    count = np.diff(first)
    n = rule.words
    owner = np.repeat(np.arange(len(part)), count)
    if len(hashes) >= n:
        whole = owner[: len(hashes) - n + 1] == owner[n - 1:]
        long, of_long = W.runs_of(hashes, n)[whole], owner[: len(hashes) - n + 1][whole]
    else:
        long, of_long = hashes[:0], owner[:0]
    short = np.flatnonzero((count > 0) & (count < n))
    brief = W.mixed(~W.span_hashes(hashes, first[short], first[short + 1]))
    return np.concatenate([long, brief]), np.concatenate([of_long, short])


def distinct_sets(part: W.Texts, rule: Rule, rarity: np.ndarray | None = None):
    """Distinct shingles of each text, rarest first (by hash alone without ``rarity``), and
    where each text's begin."""
    hashes, owner = shingles(part, rule)
    if rarity is None:
        order = np.lexsort((hashes, owner))
    else:
        order = np.lexsort((hashes, rarity[_slot(hashes, len(rarity))], owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(part) + 1))


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - slots.bit_length() + 1)).astype(np.int64)


def set_ids(hashes: np.ndarray, edges: np.ndarray) -> pa.Array:
    """128 bits for each set that depend on its members only; null for an empty set."""
    halves = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(W.mixed(hashes ^ np.uint64(salt)), out=sums[1:])
        halves.append(sums[edges[1:]] - sums[edges[:-1]])
    ids = np.stack(halves, axis=1)
    filled = np.diff(edges) > 0
    return pa.array([i.tobytes() if ok else None for i, ok in zip(ids, filled, strict=True)], pa.binary())


def rarities(docs: DataFrame, rule: Rule) -> np.ndarray:
    """A class of frequency for each slot of the counter table, over all texts."""
    slots = SKETCH

    def count(batches):
        total = np.zeros(slots, dtype=np.int32)
        for batch in batches:
            for part in W.texts(batch.column(0)):
                np.add.at(total, _slot(shingles(part, rule)[0], slots), 1)
        yield from vector_rows(pieces(total, TaskContext.get().partitionId()))

    counts = summed_vector(docs.mapInArrow(tidied(count), VECTOR), slots)
    return np.floor(4 * np.log2(1 + counts)).astype(np.uint8)


SETS = (
    "__row long, doc_id long, n int, set_id binary, prefix array<long>, profile array<short>"
)


def sets_of(docs: DataFrame, rule: Rule, rarity: np.ndarray) -> DataFrame:
    """Size, identity, prefix and suffix profile of every row's set. ``docs``: __row, doc_id, text."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def build(batch: pa.RecordBatch):
        row, doc, text = batch.columns
        for part in W.texts(text):
            n = len(part)
            hashes, edges = distinct_sets(part, rule, shared.value)
            size = np.diff(edges)
            length = np.where(size > 0, rule.prefix(size), 0)
            owner = np.repeat(np.arange(n), size)
            rank = np.arange(len(hashes)) - edges[owner]
            near = rank < length[owner]
            parts = (hashes >> np.uint64(64 - PROFILE.bit_length() + 1)).astype(np.int64)
            profile = np.bincount(owner * PROFILE + parts, minlength=n * PROFILE)
            some = slice(part.first, part.first + n)
            yield pa.RecordBatch.from_arrays(
                [
                    row[some], doc[some], pa.array(size.astype(np.int32)), set_ids(hashes, edges),
                    W.lists(hashes[near].view(np.int64), length, pa.int64()),
                    W.lists(np.minimum(profile, 32767).astype(np.int16), np.full(n, PROFILE), pa.int16()),
                ],
                names=[c.split()[0] for c in SETS.split(", ")],
            )

    return each_batch(docs, build, SETS)


def _overlap(a: Column, b: Column, rule: Rule) -> Column:
    return F.ceil(rule.num * (a + b) / (rule.num + rule.den))


def _in_length(a: Column, b: Column, rule: Rule) -> Column:
    return rule.num * F.greatest(a, b) <= rule.den * F.least(a, b)


def paired(live: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of nodes to verify: those that share a rare shingle and no frequent one."""
    own = live.where(F.col("holders") <= PAIRED).select("token", "node", "pos").join(
        members.select("node", "n", "frequent", "profile"), "node"
    )
    a, b = own.alias("a"), own.alias("b")
    na, nb = F.col("a.n"), F.col("b.n")
    wanted = _overlap(na, nb, rule)
    reach = 1 + F.least(na - F.col("a.pos"), nb - F.col("b.pos")) - 1
    common = F.aggregate(
        F.zip_with("a.profile", "b.profile", lambda x, y: F.least(x, y).cast("int")),
        F.lit(0), lambda x, y: x + y,
    )
    full = F.array_contains("a.profile", 32767) | F.array_contains("b.profile", 32767)
    return a.join(b, (
        (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node"))
        & _in_length(na, nb, rule) & (reach >= wanted)
        & ~F.arrays_overlap("a.frequent", "b.frequent")
        & ((common >= wanted) | full)
    )).select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()


def _hits(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted arrays of distinct numbers."""
    both = np.sort(np.concatenate([a, b]))
    return int((both[1:] == both[:-1]).sum())


def verified_pairs(pairs: DataFrame, held: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose whole sets are alike enough, as (u, v)."""
    def check(batch: pa.RecordBatch):
        u, v, first, second = batch.columns
        keep = []
        for x, y in zip(first, second, strict=True):
            x = np.frombuffer(x.as_buffer(), dtype=np.uint64)
            y = np.frombuffer(y.as_buffer(), dtype=np.uint64)
            common = _hits(x, y)
            keep.append(rule.den * common >= rule.num * (len(x) + len(y) - common))
        mask = pa.array(keep, pa.bool_())
        return pa.RecordBatch.from_arrays([u.filter(mask), v.filter(mask)], names=["u", "v"])

    sets = held.select("node", "members")
    both = (
        pairs.join(sets.select(F.col("node").alias("u"), F.col("members").alias("x")), "u")
        .join(sets.select(F.col("node").alias("v"), F.col("members").alias("y")), "v")
        .select("u", "v", "x", "y")
    )
    return each_batch(both, check, "u long, v long")


def _common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, some columns at a time."""
    m = len(sets)
    every = np.concatenate(sets)
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    keep = shared[column]
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((m, m), dtype=np.float32)
    step = 4096
    for low in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(column, [low, low + step])
        block = np.zeros((m, step), dtype=np.float32)
        block[owner[a:b], column[a:b] - low] = 1.0
        out += block @ block.T
    return out


LINKS = "node long, other long, weight long"


def _links(node: np.ndarray, other: np.ndarray, weight: np.ndarray) -> pa.Table:
    return pa.table({"node": pa.array(node, pa.int64()), "other": pa.array(other, pa.int64()),
                     "weight": pa.array(weight, pa.int64())})


def _block_links(group: pa.Table, rule: Rule) -> pa.Table:
    """Links among the nodes of two blocks that share a frequent shingle."""
    m = group.num_rows
    token, low, high = (group[c][0].as_py() for c in ("token", "low", "high"))
    nodes, copies, n, pos = (group[c].to_numpy() for c in ("node", "copies", "n", "pos"))
    home = group["block"].to_numpy() == low
    frequent = group["frequent"].to_pylist()
    wanted = -(-rule.num * (n[:, None] + n[None, :]) // (rule.num + rule.den))
    open_ = rule.num * np.maximum.outer(n, n) <= rule.den * np.minimum.outer(n, n)
    # Rare shingles that both share may come before this one, so what precedes it counts as well.
    left = n - pos
    open_ &= np.minimum.outer(pos, pos) + np.minimum.outer(left, left) >= wanted
    np.fill_diagonal(open_, False)
    if low != high:
        open_ &= home[:, None] != home[None, :]
    earlier = [f[: f.index(token)] for f in frequent]
    known = {t: i for i, t in enumerate(sorted({t for f in earlier for t in f}))}
    if known:
        before = np.zeros((m, len(known)), dtype=np.float32)
        for i, f in enumerate(earlier):
            before[i, [known[t] for t in f]] = 1.0
        open_ &= (before @ before.T) == 0  # the pair belongs to an earlier shingle
    if not open_.any():
        return _links(nodes[:0], nodes[:0], nodes[:0])
    common = _common_counts([np.frombuffer(s, dtype=np.uint64) for s in group["members"].to_pylist()])
    linked = open_ & (common >= wanted)
    root = np.arange(m)
    while True:  # the smallest index each node can reach
        least = np.minimum(root, np.where(linked, root[None, :], m).min(axis=1))
        least = least[least]
        if (least == root).all():
            break
        root = least
    some = linked.any(axis=1)
    return _links(nodes[some], nodes[root[some]], (linked[some] * copies[None, :]).sum(axis=1))


def block_links(live: DataFrame, members: DataFrame, held: DataFrame, rule: Rule) -> DataFrame:
    """Links of nodes that share a frequent shingle: (node, other, weight)."""
    frequent = live.where(F.col("holders") > PAIRED).select("token", "node", "pos").join(
        members.select("node", "n", "copies", "frequent"), "node"
    )
    by_count = F.ceil(F.count(F.lit(1)) / BLOCK)
    by_bytes = F.ceil(F.sum("n") * 8 / BLOCK_BYTES)
    sizes = frequent.groupBy("token").agg(F.greatest(by_count, by_bytes).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        frequent.join(sizes, "token").withColumn("block", block)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with"))
        .join(held.select("node", "members"), "node")
        .select("token", "low", "high", "block", "node", "n", "pos", "copies", "frequent", "members")
    )
    def work(group: pa.Table) -> pa.Table:
        found = _block_links(group, rule)
        give_back()
        return found

    return dealt.groupBy("token", "low", "high").applyInArrow(work, LINKS)


def needed_sets(docs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """(node, members) of the nodes to verify: whole sets, built again from the texts.

    Texts are picked by a filter of ids first, so that few of them are worked on.
    """
    chosen = IdFilter(members.select("doc_id"))

    def build(batch: pa.RecordBatch):
        batch = batch.filter(chosen.holds(batch.column(0)))
        for part in W.texts(batch.column(1)):
            hashes, edges = distinct_sets(part, rule)
            yield pa.RecordBatch.from_arrays(
                [
                    set_ids(hashes, edges),
                    pa.array([hashes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)],
                             pa.binary()),
                ],
                names=["set_id", "members"],
            )

    built = each_batch(docs.select("doc_id", "text"), build, "set_id binary, members binary")
    wanted = members.select("set_id", "node")
    return built.join(wanted, "set_id").groupBy("node").agg(F.first("members").alias("members"))


def jaccard_classes(
    docs: DataFrame, rule: Rule = Rule(), text="text", doc_id="doc_id"
) -> DataFrame:
    """One row per row of ``docs``: __row, doc_id, set_id, n_shingles, component_id, n_links,
    first_row. ``first_row`` is the row of each component with the smallest id."""
    rows = rows_of(docs, doc_id=F.col(doc_id).cast("long"), text=F.col(text).cast("string"))
    rarity = rarities(rows.select("text"), rule)
    sets = stage(sets_of(rows, rule, rarity), "sets")
    classes = stage(
        sets.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
            F.min(ROW).alias("node"), F.min("doc_id").alias("doc_id"),
            F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), ROW)).alias("first"),
            F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
            F.first("prefix").alias("prefix"), F.first("profile").alias("profile"),
        ), "classes",
    )
    postings = classes.select("node", F.posexplode("prefix").alias("pos", "token"))
    holders = postings.groupBy("token").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    live = stage(postings.join(holders, "token"), "postings")
    often = F.when(F.col("holders") > PAIRED, F.struct("pos", "token"))
    lists = live.groupBy("node").agg(
        F.transform(F.array_sort(F.collect_list(often)), lambda s: s["token"]).alias("frequent")
    )
    members = stage(classes.drop("prefix", "first").join(lists, "node"), "members")
    pairs = stage(paired(live, members, rule), "pairs")
    in_blocks = F.size("frequent") > 0
    in_pairs = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = members.join(in_pairs.withColumn("paired", F.lit(True)), "node", "left").where(
        in_blocks | F.col("paired")
    )
    held = stage(needed_sets(rows.select("doc_id", "text"), wanted, rule), "members-sets")
    copies = members.select("node", "copies")
    found = stage(verified_pairs(pairs, held, rule), "linked-pairs")
    both = found.select("u", "v").unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
    of_pairs = both.join(copies, F.col("v") == F.col("node")).select(
        F.col("u").alias("node"), F.col("v").alias("other"), F.col("copies").alias("weight")
    )
    links = stage(of_pairs.unionByName(block_links(live, members, held, rule)), "links")
    roots = components(links.select(F.col("node").alias("u"), F.col("other").alias("v")))
    counted = links.groupBy("node").agg(F.sum("weight").alias("links"))
    ids = classes.select("set_id", "node", "doc_id", "first", "copies").join(roots, "node", "left")
    ids = ids.withColumn("root", F.coalesce("root", "node")).join(counted, "node", "left")
    least = ids.groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.min("first").alias("least")
    )
    by_set = ids.join(least, "root").select(
        "set_id", F.col(f"least.{ROW}").alias("first_row"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return sets.select(ROW, "doc_id", F.col("n").cast("long").alias("n_shingles"), "set_id").join(
        by_set, "set_id", "left"
    ).select(
        ROW, "doc_id", "set_id", "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("first_row", ROW).alias("first_row"),
    )


def one_per_component(docs: DataFrame, rule: Rule = Rule(), text="text", doc_id="doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest
    id stays (one of those with that id and set, if it is repeated).

    Only rows whose id is among those of components with several rows are looked at again; all
    others go straight through, so few texts are shuffled.
    """
    found = jaccard_classes(docs, rule, text, doc_id).where("n_links > 0")
    decided = stage(
        found.groupBy("doc_id", "set_id")
        .agg(F.max(F.col("first_row") == F.col(ROW)).alias("stays")), "decided",
    )
    chosen = IdFilter(decided.select("doc_id"))
    own = unused(docs, "__own")
    at_text, at_id = docs.columns.index(text), docs.columns.index(doc_id)

    def involved(batch: pa.RecordBatch) -> pa.Array:
        return chosen.holds(batch.column(at_id).cast(pa.int64()))

    def clear(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pc.invert(involved(batch)))

    def marked(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.filter(involved(batch))
        texts = batch.column(at_text).cast(pa.string())
        ids = [set_ids(*distinct_sets(part, rule)) for part in W.texts(texts)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.concat_arrays(ids) if ids else pa.array([], pa.binary())],
            names=[*batch.schema.names, f"{own}_set"],
        )

    schema = T.StructType([*docs.schema.fields, T.StructField(f"{own}_set", T.BinaryType())])
    looked_at = each_batch(docs, marked, schema).withColumn(f"{own}_id", F.col(doc_id).cast("long"))
    judged = looked_at.join(
        decided.toDF(f"{own}_r_id", f"{own}_r_set", f"{own}_stays"),
        [F.col(f"{own}_{c}").eqNullSafe(F.col(f"{own}_r_{c}")) for c in ("id", "set")], "left",
    ).where(F.coalesce(f"{own}_stays", F.lit(True)))
    # Of a repeated row that stays, one does; rows of no component all stay as they are.
    apart = F.when(F.col(f"{own}_stays"), F.lit(-1)).otherwise(F.monotonically_increasing_id())
    kept = judged.withColumn(f"{own}_apart", apart).dropDuplicates(
        [f"{own}_id", f"{own}_set", f"{own}_apart"]
    )
    return each_batch(docs, clear, docs.schema).unionByName(kept.select(*docs.columns))
