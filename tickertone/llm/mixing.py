"""Mixing sources to target weights: budgets down a tree of domain, language and source.

Capacities (tokens times the allowed epochs; none for a leaf with a weight of zero above it) are added
up from the leaves. The budget then goes
down level by level: a node's tokens are dealt to its children by weight, none above its
capacity, and what a short child cannot take goes to its siblings. Only a shortage of the whole
node, which is a capped capacity one level up, goes to the node's own siblings.

A leaf takes as many whole epochs as its budget holds, and of the next epoch the shortest prefix
of its documents that reaches the rest, in the order of md5(seed:epoch:document). The prefix ends
at one key per leaf. Keys are uniform, so a leaf is cut into stretches of keys with about
STRETCH_DOCS documents each; only the stretch with the end is put in order, and no task holds a
whole leaf.

Tokens are words, as in the other operators. Defined cases: a missing domain, language or source
is the empty name. A null text has no tokens. Rows without an id, or with one that is repeated, share their key and are taken together.
A node of weight zero, or without tokens, gets nothing. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .frames import unused

STRETCH_DOCS = 1024
LEVELS = ("domain", "lang", "source")
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass
class Mix:
    """Target weights per level (1 where none is named), share of all tokens, epochs, seed."""

    weights: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    share: float = 0.6
    max_epochs: int = 2
    seed: int = 7


def domain_of_source(source: Column) -> Column:
    """Sources fall into four domains by the number at their end."""
    number = F.regexp_extract(source, "([0-9]+)$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.cast("decimal(38,0)") % 4).cast("string")))


def leaf_columns(doc_id="doc_id", lang="lang", source="source", domain: Column | None = None):
    domain = domain_of_source(F.col(source)) if domain is None else domain
    named = {"domain": domain, "lang": F.col(lang), "source": F.col(source)}
    return {
        **{name: F.coalesce(c.cast("string"), F.lit("")) for name, c in named.items()},
        "id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
    }


def _weight(mix: Mix, level: str) -> Column:
    known = mix.weights.get(level, {})
    if not known:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for k, v in known.items() for x in (k, float(v))])
    return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(1.0))


def _deal(nodes: DataFrame, parents: DataFrame, level: int, mix: Mix) -> DataFrame:
    """Budgets of one level's nodes (with ``cap``) from their parents' (with ``budget``)."""
    above, own = list(LEVELS[:level]), list(LEVELS[:level + 1])
    family = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
    before = family.orderBy("ratio", LEVELS[level]).rowsBetween(Window.unboundedPreceding, -1)
    dealt = parents.withColumnRenamed("budget", "given")
    children = nodes.join(dealt, above) if above else nodes.crossJoin(F.broadcast(dealt))
    weighed = (
        children.withColumn("w", _weight(mix, LEVELS[level]))
        .where((F.col("w") > 0) & (F.col("cap") > 0))
        .withColumn("ratio", F.col("cap") / F.col("w"))
    )
    rest = F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("w").over(family) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    full = weighed.withColumn("full", F.col("ratio") * weight_left <= rest)
    short = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(family)
    others = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(family)
    part = F.floor(F.col("w") * (F.col("given") - short) / others + 1e-6).cast("long")
    budget = F.when(F.col("full"), F.col("cap")).otherwise(F.least(part, F.col("cap")))
    return full.withColumn("budget", budget).select(*own, "budget")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Leaves (domain, lang, source, tokens, docs) with the tokens they are to give."""
    wanted = reduce(Column.__and__, [_weight(mix, level) > 0 for level in LEVELS])
    capped = leaves.withColumn("cap", F.when(wanted, F.col("tokens") * mix.max_epochs).otherwise(0).cast("long"))
    whole = capped.agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("cap"),
                       F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    target = F.floor(F.col("tokens") * mix.share).cast("long")
    given = whole.select(F.least(target, F.col("cap")).alias("budget"))
    for level in range(len(LEVELS)):
        nodes = capped.groupBy(*LEVELS[:level + 1]).agg(F.sum("cap").alias("cap"))
        given = _deal(nodes, given, level, mix)
    return leaves.join(given, list(LEVELS))


def _key(mix: Mix, epoch: Column, id_: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), id_))


def plan(docs: DataFrame, mix: Mix, text="text", **columns) -> DataFrame:
    """One row per leaf that gives anything: whole epochs, and the last key of the next one."""
    leaf = list(LEVELS)
    tokens = F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")
    named = leaf_columns(**columns)
    rows = stage(
        docs.select(*[c.alias(n) for n, c in named.items()], tokens.alias("tokens")), "mix-rows"
    )
    leaves = rows.groupBy(*leaf).agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")
    )
    given = stage(
        budgets(leaves, mix).where("budget > 0")
        .withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
        .withColumn("stretches", F.ceil(F.col("docs") / STRETCH_DOCS))
        .select(*leaf, "budget", "epochs", "rest", "stretches"), "mix-budgets",
    )
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("stretches")
    keyed = (
        rows.join(given.where("rest > 0"), leaf)
        .withColumn("key", _key(mix, F.col("epochs"), F.col("id")))
        .withColumn("stretch", F.shiftright(place, 32))
    )
    in_leaf = Window.partitionBy(*leaf).orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        keyed.groupBy(*leaf, "stretch").agg(F.sum("tokens").alias("n"))
        .withColumn("until", F.sum("n").over(in_leaf))
        .withColumn("before", F.col("until") - F.col("n"))
        .join(given.select(*leaf, "rest"), leaf)
        .where("before < rest and until >= rest").select(*leaf, "stretch", "before")
    )
    inside = Window.partitionBy(*leaf).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        keyed.join(ends, [*leaf, "stretch"])
        .groupBy(*leaf, "rest", "before", "key").agg(F.sum("tokens").alias("n"))
        .withColumn("taken", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .where("taken < rest").groupBy(*leaf).agg(F.max("key").alias("last_key"))
    )
    return stage(
        given.join(last, leaf, "left").select(*leaf, "budget", "epochs", "last_key"), "mix-plan"
    )


def select(docs: DataFrame, planned: DataFrame, mix: Mix, out: str, **columns) -> DataFrame:
    """The documents that are taken, with the struct ``out``: their leaf, its budget, and
    ``copies``, how many epochs take each of them."""
    own, leaf = unused(docs, "__own"), unused(docs, "__leaf")
    named = leaf_columns(**columns)
    marked = docs.select("*", F.struct(*[c.alias(n) for n, c in named.items()]).alias(own))
    planned = planned.select(F.struct("*").alias(leaf), *[F.col(c).alias(f"{leaf}_{c}") for c in LEVELS])
    marked = marked.select("*", *[F.col(f"{own}.{c}").alias(f"{own}_{c}") for c in LEVELS])
    match = [F.col(f"{own}_{c}") == F.col(f"{leaf}_{c}") for c in LEVELS]
    epochs = F.col(f"{leaf}.epochs")
    more = F.coalesce(_key(mix, epochs, F.col(f"{own}.id")) <= F.col(f"{leaf}.last_key"), F.lit(False))
    copies = (epochs + more.cast("long")).alias("copies")
    taken = F.struct(*[F.col(f"{leaf}.{c}").alias(c) for c in (*LEVELS, "budget")], copies)
    return (
        marked.join(planned, match).select(*docs.columns, taken.alias(out))
        .where(F.col(f"{out}.copies") > 0)
    )


def mixture(docs: DataFrame, mix: Mix, **columns) -> DataFrame:
    """Each taken document once per epoch that takes it, with the columns of ``docs``."""
    out = unused(docs, "__taken")
    taken = select(docs, plan(docs, mix, **columns), mix, out, **columns)
    # Epoch after epoch, so that copies of a text are not next to each other.
    epochs = [
        taken.where(F.col(f"{out}.copies") >= epoch).drop(out)
        for epoch in range(1, mix.max_epochs + 1)
    ]
    return reduce(DataFrame.unionByName, epochs)
