"""Technical indicators as Spark columns, looked up by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from .series import SeriesContext, Stages, along_series, in_step

Builder = Callable[..., Stages]
_BUILDERS: dict[str, Builder] = {}


def register_indicator(name: str, builder: Builder) -> None:
    """Make ``builder(ctx, out, **params)`` available under ``name``.

    A builder returns stages: dicts of column name -> Column. A later stage may use the
    columns of an earlier one. Names that start with two underscores are temporary.
    """
    _BUILDERS[name.upper()] = builder


def indicator_builder(name: str) -> Builder:
    try:
        return _BUILDERS[name.upper()]
    except KeyError:
        raise ValueError(f"unknown indicator: {name}") from None


# A missing number is null, never NaN.
CLOSE = "nanvl(double(close), NULL)"
VOLUME = "nanvl(double(volume), NULL)"


def _close() -> Column:
    return F.expr(CLOSE)


def sma(ctx: SeriesContext, out: str, timeperiod: int = 30) -> Stages:
    return [{out: F.when(ctx.row >= timeperiod - 1, ctx.mean(_close(), timeperiod))}]


def ema(ctx: SeriesContext, out: str, timeperiod: int = 30) -> Stages:
    # The empty first stage puts the sums next to those that need a stage before them.
    return [{}, *ctx.smooth(out, CLOSE, 2.0 / (timeperiod + 1), timeperiod, timeperiod - 1)]


def rsi(ctx: SeriesContext, out: str, timeperiod: int = 14) -> Stages:
    """The share of gains in the smoothed moves.

    While the close does not move, both averages shrink alike and their ratio stays as it is,
    so it is taken at the first full row and wherever the close moves, and carried over the
    rows between. A series that has not moved at all is at 0.
    """
    up, down, moved = f"__{out}_up", f"__{out}_down", f"__{out}_moved"
    change = _close() - ctx.lag(_close())
    moves = {
        up: F.greatest(change, F.lit(0.0)),
        down: F.greatest(-change, F.lit(0.0)),
    }
    wilder = dict(alpha=1.0 / timeperiod, n=timeperiod, first=timeperiod, after=1)
    averages = in_step(
        ctx.smooth(f"{up}_avg", f"`{up}`", **wilder),
        ctx.smooth(f"{down}_avg", f"`{down}`", **wilder),
    )
    gain, loss = F.col(f"{up}_avg"), F.col(f"{down}_avg")
    strength = F.when(gain + loss == 0, 0.0).otherwise(gain * 100.0 / (gain + loss))
    moves_here = F.col(up) + F.col(down) > 0
    known = (ctx.row == timeperiod) | ((ctx.row > timeperiod) & moves_here)
    return [
        moves, *averages, {moved: F.when(known, strength)},
        {out: ctx.last_seen(out, F.col(moved), along_blocks=True)},
    ]


def macd(
    ctx: SeriesContext, out: str,
    fastperiod: int = 12, slowperiod: int = 26, signalperiod: int = 9,
) -> Stages:
    """Line, signal and histogram. Both averages start at the slow one's first row."""
    if slowperiod < fastperiod:
        fastperiod, slowperiod = slowperiod, fastperiod
    start = slowperiod - 1
    ready = start + signalperiod - 1
    fast, slow, line, signal = (f"__{out}_{p}" for p in ("fast", "slow", "line", "signal"))
    lines = in_step(
        ctx.smooth(fast, CLOSE, 2.0 / (fastperiod + 1), fastperiod, start),
        ctx.smooth(slow, CLOSE, 2.0 / (slowperiod + 1), slowperiod, start),
    )
    # Rows before the start carry no weight in the signal, but must not be null there.
    full_line = f"coalesce(`{line}`, 0D)"
    signals = ctx.smooth(
        signal, full_line, 2.0 / (signalperiod + 1), signalperiod, ready,
        after=ctx.smoothing_reach(2.0 / (slowperiod + 1), start),
    )
    shown = F.when(ctx.row >= ready, F.col(line))
    return [
        {},
        *lines,
        {line: F.col(fast) - F.col(slow)},
        *signals,
        {out: shown, f"{out}_signal": F.col(signal), f"{out}_hist": shown - F.col(signal)},
    ]


def mom(ctx: SeriesContext, out: str, timeperiod: int = 10) -> Stages:
    return [{out: _close() - ctx.lag(_close(), timeperiod)}]


def obv(ctx: SeriesContext, out: str) -> Stages:
    step = f"__{out}_step"
    close, volume, before = _close(), F.expr(VOLUME), ctx.lag(_close())
    signed = (
        F.when(ctx.row == 0, volume)
        .when(close > before, volume)
        .when(close < before, -volume)
        .otherwise(0.0)
    )
    return [{step: signed}, {out: ctx.running_sum(out, F.col(step))}]


for _name, _builder in (
    ("SMA", sma), ("EMA", ema), ("RSI", rsi), ("MACD", macd), ("MOM", mom), ("OBV", obv),
):
    register_indicator(_name, _builder)


def with_indicators(
    bars: DataFrame,
    indicators: Mapping[str, tuple[str, dict]] | None = None,
    **series,
) -> DataFrame:
    """Add every indicator of the mapping ``{column: (indicator, params)}`` per ticker."""
    chosen = Settings().indicators if indicators is None else indicators

    def build(ctx: SeriesContext) -> Stages:
        return in_step(
            *[indicator_builder(kind)(ctx, out, **params) for out, (kind, params) in chosen.items()]
        )

    full = along_series(bars, build, **series)
    first = [*bars.columns, *indicator_columns(full.columns, chosen)]
    return full.select(*first, *[c for c in full.columns if c not in first])


def indicator_columns(
    columns: list[str], indicators: Mapping[str, tuple[str, dict]] | None = None
) -> list[str]:
    """The indicator columns among ``columns``, in registry order; MACD makes three."""
    chosen = Settings().indicators if indicators is None else indicators
    names: list[str] = []
    for out, (kind, _) in chosen.items():
        names.append(out)
        if kind.upper() == "MACD":
            names += [f"{out}_signal", f"{out}_hist"]
    return [c for c in names if c in columns]
