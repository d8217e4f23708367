"""Preference pairs: the longest common prefix of turns once as prompt, then two completions.

Everything works on turns, not on gathered conversations: the first turn in which the two sides
differ is a minimum over aggregated rows. Only the rendered strings gather turns, at most those
with PIECE_TURNS consecutive turn numbers per row, so a conversation of any length stays bounded;
an ordinary one is a single piece.

Rendering is ``<|role|>``, a line feed, the text, ``<|end|>`` and a line feed. A mask lists the
spans of a completion that are trained on, as ``start:end`` in code points: text and end mark of
the assistant's turns.

Defined cases: rows without a conversation or pair are left out. A missing turn number counts as
-1, a missing role as ``unknown``, a missing text as empty. Repeated rows count once; several
rows of one turn are ordered by role and text. A pair with equal sides is all prompt, with empty
completions. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

PIECE_TURNS = 4096
ASSISTANT = "assistant"


def clean_turns(turns: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    return turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.coalesce(F.col(turn).cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).distinct()


def _pair(kind: str, chosen: Column, rejected: Column) -> list[Column]:
    return [F.lit(kind).alias("kind"), chosen.alias("chosen_id"), rejected.alias("rejected_id")]


PAIR = ["kind", "chosen_id", "rejected_id"]


def stale_replies(turns: DataFrame) -> DataFrame:
    """Each conversation up to its last reply, against itself with that reply replaced by its
    first one (or by its opening, if there is no earlier reply)."""
    is_reply = F.col("role") == ASSISTANT
    facts = turns.groupBy("conv").agg(
        F.max(F.when(is_reply, F.col("turn"))).alias("last"),
        F.min(F.when(is_reply, F.struct("turn", "text"))).alias("reply"),
        F.min(F.struct("turn", "role", "text")).alias("opening"),
    ).where(F.col("last").isNotNull())
    first = F.when(F.col("reply.turn") < F.col("last"), F.col("reply.text"))
    stale = F.when(
        is_reply & (F.col("turn") == F.col("last")), F.coalesce(first, F.col("opening.text"))
    ).otherwise(F.col("text"))
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
        F.struct(F.lit("rejected").alias("side"), stale.alias("text")),
    )
    return (
        turns.join(facts, "conv").where(F.col("turn") <= F.col("last"))
        .select(*_pair("stale", F.col("conv"), F.col("conv")), "turn", "role", F.inline(sides))
    )


def same_openings(turns: DataFrame) -> DataFrame:
    """Conversations that open alike: each against the one with the smallest id."""
    openings = turns.groupBy("conv").agg(F.min(F.struct("turn", "role", "text")).alias("o"))
    keyed = openings.select("conv", F.md5(F.concat_ws("\n", "o.role", "o.text")).alias("key"))
    heads = keyed.groupBy("key").agg(
        F.min("conv").alias("head"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    pairs = keyed.join(heads, "key").where("conv <> head").select(
        *_pair("opening", F.col("head"), F.col("conv"))
    )
    columns = [*PAIR, "turn", "role", "side", "text"]
    out = []
    for side in ("chosen", "rejected"):
        own = pairs.join(turns, F.col(f"{side}_id") == F.col("conv"))
        out.append(own.withColumn("side", F.lit(side)).select(*columns))
    return out[0].unionByName(out[1])


def _rendered(turns: Column) -> tuple[Column, Column]:
    """The string of sorted (turn, role, text) and the spans of it that are trained on."""
    shown = F.transform(
        turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n"))
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(done: Column, t: Column) -> Column:
        begin = done["at"] + F.length(t["role"]) + 5
        end = begin + F.length(t["text"]) + 7
        span = F.array(F.concat_ws(":", begin.cast("string"), end.cast("string")))
        spans = F.when(t["role"] == ASSISTANT, F.concat(done["spans"], span))
        return F.struct((end + 1).alias("at"), spans.otherwise(done["spans"]).alias("spans"))

    return F.array_join(shown, ""), F.array_join(F.aggregate(turns, start, step)["spans"], ",")


def preferences(sides: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """Rendered pairs from rows (kind, chosen_id, rejected_id, side, turn, role, text)."""
    rows = sides.withColumn("piece", F.floor(F.greatest("turn", F.lit(0)) / piece_turns))
    sign = F.when(F.col("side") == "chosen", 1).otherwise(-1)
    per_piece = (
        rows.groupBy(*PAIR, "piece", "turn", "role", F.md5("text").alias("text"))
        .agg(F.sum(sign).alias("surplus"))
        .groupBy(*PAIR, "piece").agg(F.min(F.expr("if(surplus <> 0, turn, null)")).alias("cut"))
    )
    cuts = per_piece.groupBy(*PAIR).agg(F.min("cut").alias("cut"))
    cut_of_piece = per_piece.drop("cut").join(cuts, PAIR)
    common = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))
    turn = F.struct("turn", "role", "text")
    parts = {
        "prompt": common & (F.col("side") == "chosen"),
        "chosen": ~common & (F.col("side") == "chosen"),
        "rejected": ~common & (F.col("side") == "rejected"),
    }
    gathered = rows.join(cut_of_piece, [*PAIR, "piece"]).groupBy(*PAIR, "piece").agg(*[
        F.array_sort(F.collect_list(F.when(of, turn))).alias(f"{name}_turns")
        for name, of in parts.items()
    ])
    strings = {}
    for name in parts:
        strings[name], mask = _rendered(F.col(f"{name}_turns"))
        if name != "prompt":
            strings[f"{name}_mask"] = mask
    return gathered.select(
        *PAIR, "piece", F.size("prompt_turns").cast("long").alias("n_prompt_turns"),
        *[column.alias(name) for name, column in strings.items()],
    )


def format_preferences(conversations: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """Both sorts of pairs of a table of conversations, rendered."""
    turns = stage(clean_turns(conversations), "turns")  # read five times
    sides = stage(stale_replies(turns).unionByName(same_openings(turns)), "sides")  # three times
    return preferences(sides, piece_turns)
