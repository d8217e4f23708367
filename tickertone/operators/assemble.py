"""Joins, fills, labels and scaling that turn bars into the training table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import NOT_FEATURES
from ..functions.columns import day, no_nan
from .series import SeriesContext, Stages, along_series

# A day without news is neutral.
NO_NEWS = {"pos": 0.0, "neg": 0.0, "neu": 1.0}


def with_market_index(bars: DataFrame, index: DataFrame, value: str = "vix") -> DataFrame:
    """Left join the market-wide daily value.

    The index is reduced to one row per day first, so what is broadcast is bounded by the
    calendar (a century is 36,525 rows) however many bars there are.
    """
    by_day = index.groupBy(day(F.col("date")).alias("date")).agg(F.max(no_nan(F.col(value))).alias(value))
    return bars.join(F.broadcast(by_day), "date", "left")


def with_daily_tone(
    bars: DataFrame, tone: DataFrame, missing: Mapping[str, float] = NO_NEWS
) -> DataFrame:
    """Left join one tone row per (ticker, day); fill the named columns where none is."""
    return bars.join(tone, ["ticker", "date"], "left").fillna(dict(missing))


def with_daily_tone_zero_filled(bars: DataFrame, tone: DataFrame, keyed: bool = False) -> DataFrame:
    """Left join, then 0 for every missing number of the whole row. ``keyed`` states that every row has a
    ticker: it stays the column that the rows may be dealt by."""
    joined = bars.join(tone, ["ticker", "date"], "left")
    return joined.fillna(0, [c for c in joined.columns if c != "ticker"] if keyed else None)


def fill_forward_stages(ctx: SeriesContext, col: str) -> Stages:
    return [{col: ctx.last_seen(col, F.col(col))}]


def next_day_stages(ctx: SeriesContext) -> Stages:
    return [{"next_close": ctx.lead(F.col("close"), 1)}]


def fill_forward(df: DataFrame, col: str = "vix", **series) -> DataFrame:
    return along_series(df, lambda ctx: fill_forward_stages(ctx, col), **series)


def with_next_close(bars: DataFrame, **series) -> DataFrame:
    return along_series(bars, next_day_stages, **series)


def with_direction(df: DataFrame) -> DataFrame:
    """label = 1 when the next close is higher; rows without a next close are dropped."""
    return df.where(F.col("next_close").isNotNull()).withColumn(
        "label", (F.col("next_close") > F.col("close")).cast("int")
    )


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def feature_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in NOT_FEATURES]


def fit_min_max(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The factor and shift that map every column's minimum to 0 and maximum to 1, in one
    row (or one row per ``by`` key). A constant column keeps its unit and becomes 0."""
    ends = [
        f"{fn}(nanvl(double(`{c}`), NULL)) AS `{c}__{fn}`" for c in columns for fn in ("min", "max")
    ]
    bounds = df.groupBy(*by).agg(*map(F.expr, ends)) if by else df.selectExpr(*ends)
    factors = [
        f"coalesce(1D / nullif(`{c}__max` - `{c}__min`, 0D), 1D) AS `{c}__factor`" for c in columns
    ]
    shifts = [f"-`{c}__min` * `{c}__factor` AS `{c}__shift`" for c in columns]
    return bounds.selectExpr("*", *factors).selectExpr(
        *by, *[f"`{c}__factor`" for c in columns], *shifts
    )


def scale_min_max(
    df: DataFrame, bounds: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """One multiplication and one addition per value; nulls stay null."""
    joined = df.join(bounds, list(by), "left") if by else df.crossJoin(F.broadcast(bounds))
    return joined.selectExpr(*[
        f"`{c}` * `{c}__factor` + `{c}__shift` AS `{c}`" if c in columns else f"`{c}`"
        for c in df.columns
    ])
