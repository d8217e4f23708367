"""The four programs from landed files to the comparison table."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest

from tickertone import Settings
from tickertone.plans import programs
from tickertone.sources import readers

START = dt.date(2024, 1, 1)
CHOSEN = Settings(tickers=("A", "B"), start=START, end=dt.date(2024, 12, 31))


def model_a():
    def load():
        def scorer(texts):
            up = np.array([t.count("up") for t in texts], float)
            down = np.array([t.count("down") for t in texts], float)
            raw = np.stack([up + 0.1, down + 0.1, np.full(len(texts), 0.2)], axis=1)
            return raw / raw.sum(axis=1, keepdims=True)
        return scorer
    return load


@pytest.fixture(scope="module")
def home(tmp_path_factory):
    """160 days of three tickers, of which two are studied; two feeds with a common part."""
    folder = tmp_path_factory.mktemp("study")
    landing = folder / "landing"
    landing.mkdir()
    rng = np.random.default_rng(1)
    days = pd.date_range(START, periods=160, tz="UTC") + pd.Timedelta(hours=5)
    bars = []
    for t in "ABC":
        close = 100 + np.cumsum(rng.normal(0, 1, 160))
        bars.append(pd.DataFrame({
            "symbol": t, "timestamp": days, "open": close, "high": close + 1, "low": close - 1,
            "close": close, "volume": rng.integers(1, 100, 160)}))
    pd.concat(bars).to_parquet(landing / "bars.parquet", coerce_timestamps="us", index=False)
    pd.DataFrame({"Date": days.tz_localize(None)[5:], "Close": rng.uniform(10, 30, 155)}).to_parquet(
        landing / "vix.parquet", coerce_timestamps="us", index=False)
    word = lambda i: ("up up", "down down", "flat")[i % 3]
    rows = [(t, START + dt.timedelta(days=i), f"{word(i + j)} news {i} {j}") for t in "AB" for i in range(0, 160, 2) for j in range(2)]
    with open(landing / "a.json", "w") as f:
        for t, d, h in rows:
            f.write(json.dumps({"ticker": t, "data": {"news": [{"created_at": f"{d}T08:00:00Z", "headline": h}]}}) + "\n")
    with open(landing / "b.json", "w") as f:
        for t, d, h in rows[:50] + [("A", START, "down only here")]:
            seconds = int(dt.datetime.combine(d, dt.time(8), dt.timezone.utc).timestamp())
            f.write(json.dumps({"ticker": t, "datetime": seconds, "headline": h}) + "\n")
    with open(landing / "corpus.json", "w") as f:
        for i in range(120):
            c = i % 3
            f.write(json.dumps({"train": {"sentence": f"{('down', 'flat', 'up')[c]} report {i}", "label": c}}) + "\n")
    return str(folder)


def test_programs(spark, home):
    files = {n: [f"{home}/landing/{n}.{'json' if n in 'ab' else 'parquet'}"] for n in ("bars", "vix", "a", "b")}
    counts = {r.name: r["rows"] for r in programs.ingest(
        spark, files["bars"], files["vix"], files["a"], files["b"], home, CHOSEN).collect()}
    trouble = {f"feed_{i}_{n}": 0 for i in (0, 1) for n in ("missing_paths", "bad_lines", "skipped_files")}
    assert counts == {"feed_0": 320, "feed_1": 51, "combined": 321, "prices": 320, **trouble}

    dataset = programs.prepare(spark, home, model_a(), CHOSEN)
    assert dataset.count() == 2 * (160 - 34)
    pdf = dataset.toPandas()
    assert np.allclose(pdf[["pos", "neg", "neu"]].sum(axis=1), 1.0)
    assert (pdf.neu == 1).sum() > 0 and (pdf.pos > 0.5).sum() > 0
    scored = readers.read_parquet(spark, f"{home}/processed/news_finbert").toPandas()
    assert len(scored) == 321 and (scored[scored.headline.str.startswith("up")].finbert_pos > 0.5).all()

    with pytest.raises(ValueError):
        programs.evaluate(spark, home, settings=CHOSEN)
    best = programs.score_with_model_b(
        spark, [f"{home}/landing/corpus.json"], home, CHOSEN, fmt="json", features=200, strengths=(0.01,))
    assert best.accuracy > 0.9
    assert {r["class"] for r in best.report.collect()} >= {"neg", "neu", "pos"}
    b = readers.read_parquet(spark, f"{home}/processed/news_cnn").toPandas()
    assert (b[b.headline.str.startswith("down")].cnn_neg > 0.5).all()

    for variant in ("baseline", "cnn_fusion"):
        fitted = programs.train(spark, home, variant, CHOSEN, strengths=(1.0, 0.1))
        history = spark.read.schema(readers.HISTORY).json(f"{home}/results/{variant}_history")
        assert history.count() == fitted.history.count() >= fitted.best_epoch >= 1
    table = {r.model: r for r in programs.evaluate(spark, home, settings=CHOSEN).collect()}
    assert set(table) == {"baseline", "cnn_fusion"}  # the third has not been trained
    csv = spark.read.schema(readers.METRICS).option("header", True).csv(f"{home}/results/comparison").collect()
    assert {r.model: r for r in csv} == table
    report = spark.read.json(f"{home}/results/baseline_report").toPandas()
    assert set(report["class"]) == {"Down", "Up", "accuracy", "macro avg", "weighted avg"}
    cells = spark.read.json(f"{home}/results/baseline_confusion").toPandas()
    dates = sorted(pdf.date.unique())
    n_test = sum(d >= dates[-int(len(dates) * 0.25)] for d in dates)
    assert cells[["pred_0", "pred_1"]].to_numpy().sum() == 2 * (n_test - 10)
