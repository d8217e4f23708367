"""One settings object for the whole engine."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def _default_indicators() -> dict[str, tuple[str, dict]]:
    # Column name -> (indicator, parameters).
    return {
        "SMA_5": ("SMA", {"timeperiod": 5}),
        "SMA_30": ("SMA", {"timeperiod": 30}),
        "EMA_12": ("EMA", {"timeperiod": 12}),
        "EMA_26": ("EMA", {"timeperiod": 26}),
        "RSI": ("RSI", {"timeperiod": 14}),
        "MACD": ("MACD", {"fastperiod": 12, "slowperiod": 26, "signalperiod": 9}),
        "MOM": ("MOM", {"timeperiod": 14}),
        "OBV": ("OBV", {}),
    }


@dataclass(frozen=True)
class Settings:
    # The study's tickers, period, sample shape and split shares.
    tickers: tuple[str, ...] = ("AAPL", "TSLA", "NVDA", "NFLX", "JNJ")
    start: dt.date = dt.date(2024, 4, 23)
    end: dt.date = dt.date(2026, 4, 23)
    indicators: dict[str, tuple[str, dict]] = field(default_factory=_default_indicators)
    lookback: int = 10
    batch_size: int = 32
    max_epochs: int = 100
    patience: int = 10
    test_share: float = 0.25
    val_share: float = 0.15
    seed: int = 42
    vocab_size: int = 20_000
    max_tokens: int = 64
    holdout_percent: int = 20


# Columns that are never model features.
NOT_FEATURES = (
    "date", "ticker", "label", "next_close",
    "pos", "neg", "neu", "cnn_pos", "cnn_neg", "cnn_neu",
)
