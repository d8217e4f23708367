"""Window work along one key's time series, whole or cut into segments.

A daily series holds at most one row per key and calendar day, so a plain window per
key is small (a century is 36,525 rows) and costs one shuffle. Callers that can prove
it pass ``daily=True``. Any other series is cut into segments of equal row count, whatever its
length; it is at least WIDER times as long as the columns look back (or ahead). A segment also gets
copies of the rows just before (and after) it, as many as the columns look back (ahead), so no task
ever holds a whole long series. A series that fits into one segment is neither copied nor completed:

* sliding frames are exact, since every row they reach is in the segment;
* a smoothing average forgets its start by (1 - alpha) per row, and the copied rows are
  enough for the rest to be below a double's rounding;
* running totals and last-seen values are finished with one small row per segment, and only then
  looked at by columns that are made from them.

How many rows are copied follows from the columns: a column that looks back over another one reaches
as far as both together (``reach_of``).
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import estimated_bytes, stage

SEGMENT_ROWS = 65_536
WIDER = 4  # at most a quarter of a segment's rows are copied
TASK_BYTES = 8 << 20  # of the files that dealt daily series come from, for one task
BLOCK_ROWS = 2048
# exp(-39) is below a double's relative rounding; exp(600) is far from overflow.
FORGOTTEN, OVERFLOW = 39.0, 600.0

Stages = list[dict[str, Column]]


@dataclass
class SeriesContext:
    """Window building blocks for one series; notes how far its columns reach."""

    keys: tuple[str, ...]
    order: str
    split: bool
    back: int = 0
    ahead: int = 0
    blocks: dict[str, Column] = field(default_factory=dict)
    totals: list[str] = field(default_factory=list)
    seen: list[str] = field(default_factory=list)
    looks: list[tuple[str, int, int]] = field(default_factory=list)  # text of a window, rows back and ahead
    spans: dict[str, tuple[int, int]] = field(default_factory=dict)  # smoothed: own reach, at least that of its input
    _window: WindowSpec | None = None

    row = property(lambda self: F.col("__row"))

    def _parts(self) -> list[str]:
        return [*self.keys, "__seg"] if self.split else list(self.keys)

    def _block_column(self, block: int, start: int) -> str:
        name = f"__blk_{block}_{start}"
        if name not in self.blocks:
            self.blocks[name] = F.floor((F.col("__pos") - start) / block)
        return name

    def _along(self) -> WindowSpec:
        if self._window is None:
            self._window = Window.partitionBy(*self._parts()).orderBy(self.order)
        return self._window

    def _look(self, column: Column, back: int = 0, ahead: int = 0) -> Column:
        self.looks.append((_text(column), back, ahead))
        return column

    def lag(self, col: Column, n: int = 1) -> Column:
        return self._look(F.lag(col, n).over(self._along()), back=n)

    def lead(self, col: Column, n: int = 1) -> Column:
        return self._look(F.lead(col, n).over(self._along()), ahead=n)

    def frame(self, agg: Column, first: int, last: int) -> Column:
        window = agg.over(self._along().rowsBetween(first, last))
        return self._look(window, max(0, -first), max(0, last))

    def mean(self, col: Column, n: int) -> Column:
        return self.frame(F.avg(col), -(n - 1), 0)

    def running_sum(self, name: str, step: Column) -> Column:
        whole = self._along().rowsBetween(Window.unboundedPreceding, 0)
        if self.split:
            step = F.when(F.col("__own"), step)
            self.totals.append(name)
        return F.sum(step).over(whole)

    def last_seen(self, name: str, value: Column, along_blocks: bool = False) -> Column:
        """``along_blocks`` asks for the sort order that the last smoothing average left."""
        order = [self.order]
        if along_blocks and self.blocks:
            order = [next(reversed(self.blocks)), self.order]
        whole = Window.partitionBy(*self._parts()).orderBy(*order)
        if self.split:
            value = F.when(F.col("__own"), value)
            self.seen.append(name)
        return F.last(value, ignorenulls=True).over(
            whole.rowsBetween(Window.unboundedPreceding, 0)
        )

    @staticmethod
    def smoothing_reach(alpha: float, first: int) -> int:
        """Rows after which a smoothing average has forgotten what was before."""
        return 0 if alpha >= 1.0 else math.ceil(FORGOTTEN / -math.log1p(-alpha)) + first + 1

    def smooth(
        self, name: str, x: str, alpha: float, n: int, first: int, after: int = 0
    ) -> Stages:
        """e[t] = e[t-1] + alpha * (x[t] - e[t-1]), seeded at row ``first`` with the mean
        of the ``n`` values that end there; null before. ``x`` is SQL text and looks back
        ``after`` rows itself. Two stages:

        1. the discounted sum of what the row's block has seen so far, the seed included;
        2. plus what the end of the block before is still worth.

        Blocks are long enough for older ones to be worth nothing, and short enough for
        the growing weights (1 - alpha)**-k to stay finite. Ordering the second window by
        block first lets both share one sort.
        """
        if alpha >= 1.0:
            self.spans[name] = (0, after)
            return [{}, {name: F.expr(f"CASE WHEN __row >= {first} THEN {x} END")}]
        decay = -math.log1p(-alpha)
        block, start = BLOCK_ROWS, 0
        if not FORGOTTEN <= block * decay <= OVERFLOW:
            block = 2 ** int(math.log2(OVERFLOW / decay))
        if first >= block:  # keep the whole seed in one block
            start = first - n + 1
        blk = self._block_column(block, start)
        local, keep = f"__{name}_local", f"{1.0 - alpha!r}D"
        seed_weight = (1.0 - alpha) ** -float(first - start) / n
        k = f"double(pmod(__pos - {start}, {block}))"
        parts, order = ", ".join(f"`{p}`" for p in self._parts()), f"`{self.order}`"
        self.spans[local] = (self.smoothing_reach(alpha, first), after)
        weighted = f"""CASE WHEN __row <= {first - n} THEN 0D
            WHEN __row <= {first} THEN ({x}) * {seed_weight!r}D
            WHEN __pos = 0 THEN ({x}) * pow({keep}, -{k})
            ELSE ({x}) * {alpha!r}D * pow({keep}, -{k}) END"""
        seen = f"""sum({weighted}) OVER (PARTITION BY {parts}, {blk} ORDER BY {order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
        before = f"""last(CASE WHEN {k} = {block - 1} THEN `{local}` END, true) OVER (
            PARTITION BY {parts} ORDER BY {blk}, {order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
        done = f"`{local}` + coalesce({before}, 0D) * pow({keep}, {k} + 1)"
        return [
            {local: F.expr(f"{seen} * pow({keep}, {k})")},
            {name: F.expr(f"CASE WHEN __row >= {first} THEN {done} END")},
        ]


def in_step(*plans: Stages) -> Stages:
    """Run several stage lists side by side, so that equal windows are shared."""
    out: Stages = []
    for i in range(max((len(p) for p in plans), default=0)):
        merged: dict[str, Column] = {}
        for plan in plans:
            if i < len(plan):
                merged.update(plan[i])
        out.append(merged)
    return out


def _text(column: Column) -> str:
    return str(column)[len("Column<'"):-len("'>")]


def _looks_at(text: str, names: Iterable[str]) -> list[str]:
    """Which of the columns ``names`` an expression's text mentions."""
    words = set(re.findall(r"\w+", text))
    return [n for n in names if (n in words if n.isidentifier() else n in text)]


def reach_of(ctx: SeriesContext, stages: Stages) -> tuple[int, int]:
    """Rows before and after that the farthest chain of columns looks at.

    A column's reach is that of its own windows plus that of the columns it is made from: those of
    earlier stages that its text mentions.
    """
    reach: dict[str, tuple[int, int]] = {}
    for columns in stages:
        found = {}
        for name, column in columns.items():
            text = _text(column)
            own = [(back, ahead) for window, back, ahead in ctx.looks if window in text]
            before = [reach[other] for other in _looks_at(text, reach)]
            back, ahead = (max((r[i] for r in own), default=0) for i in (0, 1))
            deep, far = (max((r[i] for r in before), default=0) for i in (0, 1))
            if name in ctx.spans:
                span, at_least = ctx.spans[name]
                back, deep = max(back, span), max(deep, at_least)
            found[name] = back + deep, ahead + far
        reach.update(found)
    return max((r[0] for r in reach.values()), default=0), max((r[1] for r in reach.values()), default=0)


def _phases(ctx: SeriesContext, stages: Stages) -> list[Stages]:
    """The stages, cut before one that looks at a running column that is not finished yet."""
    phases: list[Stages] = [[]]
    running: set[str] = set()
    for columns in stages:
        if any(_looks_at(_text(c), running) for c in columns.values()):
            phases.append([])
            running = set()
        phases[-1].append(columns)
        running |= set(columns) & {*ctx.totals, *ctx.seen}
    return phases


def _placed(df: DataFrame, keys: Sequence[str], order: str) -> tuple[DataFrame, DataFrame]:
    """The rows, written in ranges of (key, order) with their place ``__at`` in all of them, and one row
    per key and range: what to add for the place in the key's series, and the length of that series."""
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    by = [*keys, order, "__tie"]
    placed = stage(
        df.withColumn("__tie", F.xxhash64(*hashed))
        .repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("__at", F.monotonically_increasing_id()).drop("__tie"),
        "numbered",
    ).withColumn("__part", F.shiftright("__at", 33))
    own = [*keys, "__part"]
    series = Window.partitionBy(*keys)
    earlier = series.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*own)
        .agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
        .select(*own, (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first"))
                .alias("__shift"), F.sum("__n").over(series).alias("__length"))
    )
    return placed, starts


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str = "date", out: str = "row"
) -> DataFrame:
    """0-based position of each row in its key's series, without gathering the series.

    The rows are written once, sorted in ranges of (key, order); equal times are told apart
    by a hash of the row, so that a range ends anywhere, also inside a burst. A row's place in
    its range comes with the writing, and the rows of a key in earlier ranges are added up
    from one small row per key and range.
    """
    placed, starts = _placed(df, keys, order)
    return (
        placed.join(starts, [*keys, "__part"]).withColumn(out, F.col("__at") + F.col("__shift"))
        .drop("__at", "__part", "__shift", "__length")
    )


def _size(segment: int, back: int, ahead: int) -> int:
    return max(segment, WIDER * back, WIDER * ahead)


def _segments(numbered: DataFrame, ctx: SeriesContext, segment: int) -> DataFrame:
    """Rows that know their number ``__row`` and their series' ``__length``, with copies where a
    neighbouring segment needs them."""
    size = _size(segment, ctx.back, ctx.ahead)
    own = F.floor(F.col("__row") / size)
    reaches = (own + 1) * size - F.col("__row") <= ctx.back
    following = F.when(reaches & ((own + 1) * size < F.col("__length")), own + 1)
    previous = F.when((own > 0) & (F.col("__row") - own * size < ctx.ahead), own - 1)
    copies = F.array_compact(F.array(own, following, previous))
    return (
        numbered.withColumn("__home", own)
        .withColumn("__seg", F.explode(copies))
        .withColumn("__own", F.col("__seg") == F.col("__home"))
        .withColumn(
            "__pos",
            F.col("__row") - F.greatest(F.col("__seg") * size - ctx.back, F.lit(0)),
        )
        .drop("__home")
    )


def _finish(df: DataFrame, ctx: SeriesContext, keep: Sequence[str] = ()) -> DataFrame:
    """Add to each segment what its running columns brought along from earlier ones. ``keep`` names
    the temporary columns that a later phase looks at."""
    own = df.where("__own").drop(*ctx.blocks)
    carried_on = [*ctx.totals, *ctx.seen]
    if not carried_on:
        return own
    own = stage(own.drop(*[c for c in own.columns if c.startswith("__")
                           and c not in ("__seg", "__row", "__length", *keep)]), "segments")
    parts = [*ctx.keys, "__seg"]
    at_end = own.groupBy(*parts).agg(*[
        F.max_by(name, F.when(F.col(name).isNotNull(), F.col("__row"))).alias(f"__t_{name}")
        for name in carried_on
    ])
    earlier = Window.partitionBy(*ctx.keys).orderBy("__seg").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Written, so that Spark sees how few they are: then the segments need no further shuffle.
    carried = stage(at_end.select(
        *parts,
        *[F.sum(f"__t_{n}").over(earlier).alias(f"__c_{n}") for n in ctx.totals],
        *[F.last(f"__t_{n}", ignorenulls=True).over(earlier).alias(f"__c_{n}") for n in ctx.seen],
    ), "carried")
    done = own.join(carried, parts)
    for name in ctx.totals:
        start = F.coalesce(F.col(f"__c_{name}"), F.lit(0.0))
        done = done.withColumn(name, F.col(name) + start)
    for name in ctx.seen:
        done = done.withColumn(name, F.coalesce(F.col(name), F.col(f"__c_{name}")))
    return done


def along_series(
    df: DataFrame,
    build: Callable[[SeriesContext], Stages],
    keys: Sequence[str] = ("ticker",),
    order: str = "date",
    daily: bool = False,
    segment: int = SEGMENT_ROWS,
    dealt: bool | int = False,
) -> DataFrame:
    """Add the columns ``build`` describes to every row of every key's series.

    Rows without a key belong to no series and are left out. ``daily`` states that a key
    has at most one row per day, which bounds the series; any other is cut into segments. ``dealt``
    deals daily series to as many tasks as their files ask for, so that a task's memory does not grow; a
    number deals them to so many.
    """
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    ctx = SeriesContext(tuple(keys), order, not daily)
    stages = build(ctx)
    if ctx.split:
        laid = _cut(df, ctx, stages, segment)
    else:
        if dealt:
            df = dealt_out(df, keys) if dealt is True else df.repartition(dealt, *keys)
        plain = Window.partitionBy(*keys).orderBy(order)
        laid = df.withColumn("__row", (F.row_number().over(plain) - 1).cast("bigint"))
        laid = _staged(laid.withColumn("__pos", F.col("__row")), ctx, stages)
    return laid.drop(*[c for c in laid.columns if c.startswith("__")])


def dealt_tasks(df: DataFrame) -> int:
    """A task for every TASK_BYTES of the files, one for every core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, estimated_bytes(df) // TASK_BYTES)


def dealt_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dealt by key to a task for every TASK_BYTES of its files, where the session plans fewer tasks."""
    tasks = estimated_bytes(df) // TASK_BYTES
    planned = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys) if tasks > planned else df


def _staged(laid: DataFrame, ctx: SeriesContext, stages: Stages) -> DataFrame:
    if ctx.blocks:
        laid = laid.withColumns(ctx.blocks)
    for columns in stages:
        if columns:
            laid = laid.withColumns(columns)
    return laid


def _cut(df: DataFrame, ctx: SeriesContext, stages: Stages, segment: int) -> DataFrame:
    """All stages on series of any length: those that fit into one segment are laid out whole, longer ones
    in segments. Rows are written and numbered once."""
    placed, starts = _placed(df, ctx.keys, ctx.order)
    starts = stage(starts, "starts")
    keys, size = [*ctx.keys], _size(segment, *reach_of(ctx, stages))
    cut = F.col("__length") > size
    found = starts.agg(F.count_if(cut).alias("cut"), F.count_if(~cut).alias("whole")).first()
    if not found.cut:
        return _whole(placed, ctx, stages)
    numbered = placed.join(starts.where(cut), [*keys, "__part"]).withColumn("__row", F.col("__at") + F.col("__shift"))
    laid = _in_segments(numbered.drop("__at", "__part", "__shift"), ctx, stages, segment)
    if not found.whole:
        return laid
    short = placed.join(starts.where(~cut).select(*keys, "__part"), [*keys, "__part"])
    columns = [c for c in laid.columns if not c.startswith("__")]
    return laid.select(*columns).unionAll(_whole(short, ctx, stages).select(*columns))


def _whole(placed: DataFrame, ctx: SeriesContext, stages: Stages) -> DataFrame:
    """Each series as its own only segment: nothing is copied, nothing is left to be completed."""
    whole = placed.drop("__part").withColumn("__seg", F.lit(0).cast("bigint")).withColumn("__own", F.lit(True))
    place = F.row_number().over(Window.partitionBy(*ctx.keys, "__seg").orderBy(ctx.order, "__at"))
    numbered = whole.withColumn("__row", (place - 1).cast("bigint")).drop("__at")
    return _staged(numbered.withColumn("__pos", F.col("__row")), ctx, stages)


def _in_segments(df: DataFrame, ctx: SeriesContext, stages: Stages, segment: int) -> DataFrame:
    """All stages on segments; after each phase its running columns are finished."""
    phases = _phases(ctx, stages)
    made: list[str] = []
    for i, part in enumerate(phases):
        names = {name for columns in part for name in columns}
        back, ahead = reach_of(ctx, part)
        now = replace(
            ctx, back=back, ahead=ahead,
            totals=[n for n in ctx.totals if n in names], seen=[n for n in ctx.seen if n in names],
        )
        made += [n for n in names if n.startswith("__")] if i < len(phases) - 1 else []
        df = _finish(_staged(_segments(df, now, segment), now, part), now, made)
        if i < len(phases) - 1:
            df = df.drop("__seg", "__own", "__pos")
    return df
