"""Plain-loop doubles of the recurrences, and small bar frames."""

import datetime as dt

import numpy as np
import pandas as pd

DAY0 = dt.date(2020, 1, 1)
BARS = "date date, ticker string, open double, high double, low double, close double, volume double"


def bars_frame(spark, closes, ticker="T", volume=None, gap=1):
    rows = [
        (DAY0 + dt.timedelta(days=i * gap), ticker, c, c, c, c,
         float(volume[i]) if volume is not None else float(10 + i))
        for i, c in enumerate(map(float, closes))
    ]
    return spark.createDataFrame(rows, BARS)


def rows_by_date(df):
    return df.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)


def smooth_loop(x, n, alpha, first):
    out = np.full(len(x), np.nan)
    if len(x) > first:
        out[first] = e = x[first - n + 1:first + 1].mean()
        for i in range(first + 1, len(x)):
            e += alpha * (x[i] - e)
            out[i] = e
    return out


def indicator_loops(close, volume):
    """All ten columns for one ticker, row by row."""
    x, v = np.asarray(close, float), np.asarray(volume, float)
    change = np.diff(x, prepend=np.nan)
    gain = smooth_loop(np.where(change > 0, change, 0.0), 14, 1 / 14, 14)
    loss = smooth_loop(np.where(change < 0, -change, 0.0), 14, 1 / 14, 14)
    with np.errstate(invalid="ignore"):
        rsi = np.where(gain + loss == 0, 0.0, 100 * gain / (gain + loss))
    rsi[np.isnan(gain)] = np.nan
    line = smooth_loop(x, 12, 2 / 13, 25) - smooth_loop(x, 26, 2 / 27, 25)
    signal = smooth_loop(line, 9, 0.2, 33)
    shown = line.copy()
    shown[:33] = np.nan
    past = np.concatenate([np.full(14, np.nan), x])[: len(x)]
    steps = np.where(change > 0, v, np.where(change < 0, -v, 0.0))
    steps[:1] = v[:1]
    return {
        "SMA_5": pd.Series(x).rolling(5).mean().to_numpy(),
        "SMA_30": pd.Series(x).rolling(30).mean().to_numpy(),
        "EMA_12": smooth_loop(x, 12, 2 / 13, 11),
        "EMA_26": smooth_loop(x, 26, 2 / 27, 25),
        "RSI": rsi,
        "MACD": shown,
        "MACD_signal": signal,
        "MACD_hist": shown - signal,
        "MOM": x - past,
        "OBV": np.cumsum(steps),
    }


def assert_close(got, want, scale=1.0, tol=1e-9):
    got, want = np.asarray(got, float), np.asarray(want, float)
    assert (np.isnan(got) == np.isnan(want)).all()
    ok = ~np.isnan(want)
    assert not ok.any() or np.abs(got[ok] - want[ok]).max() <= tol * scale
