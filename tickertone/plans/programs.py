"""The whole study as four programs that hand over through tables in one folder:

raw/{ohlcv,vix,news} -> processed/{news_finbert,news_cnn,dataset} -> checkpoints, results
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.columns import day
from ..operators.metrics import binary_metrics, class_report, confusion
from ..operators.models import DirectionModel, fit_direction, predict, variant_columns
from ..operators.news import daily_tone, drop_copies, union_feeds
from ..operators.samples import holdout
from ..operators.tone import Scorer, ToneFit, fit_best_tone, score_batches, score_tone
from ..session import sized_shuffles, stage, staging
from ..sources.readers import (
    NEWS,
    filled_files,
    present,
    read_bars,
    read_buckets,
    read_corpus,
    read_news_feed_a,
    read_news_feed_b,
    read_parquet,
    read_vix,
)
from ..sources.writers import load_model, save_model, write_buckets, write_csv, write_json, write_table
from .dataset import build_dataset
from .evaluate import CNN_SCORES, variant_samples

# Table and column names of the hand-over files.
MODEL_A = ("finbert_pos", "finbert_neg", "finbert_neu")
# Headlines have no number of their own: earlier feed, then earlier time, comes first.
ARRIVAL = ("feed", "time", "headline")


def ingest(
    spark: SparkSession, bars: Sequence[str], vix: Sequence[str], feed_a: Sequence[str],
    feed_b: Sequence[str], home: str, settings: Settings = Settings(),
) -> DataFrame:
    """Landed files to three raw tables; returns the counts worth logging: rows of every table, and
    what was missing or unreadable in each feed. They are observed while the tables are written, so
    nothing is read twice; a task that runs again after an executor was lost may count twice."""
    feeds, problems, watches = [], [], []
    for i, (read, paths) in enumerate(((read_news_feed_a, feed_a), (read_news_feed_b, feed_b))):
        there, gone = present(spark, *paths)
        watch = Observation()
        feeds.append(read(spark, *there, tolerant=True, watch=watch) if there else spark.createDataFrame([], NEWS))
        problems.append((f"feed_{i}_missing_paths", len(gone)))
        watches.append((i, feeds[-1], watch if there else None))
    rows, combined, priced = Observation(), Observation(), Observation()
    both = union_feeds(*feeds).observe(
        rows, *[F.count_if(F.col("feed") == i).alias(f"feed_{i}") for i in range(len(feeds))]
    )
    prices = read_bars(
        spark, *bars, tickers=settings.tickers, start=settings.start, end=settings.end
    ).observe(priced, F.count(F.lit(1)).alias("prices"))
    with sized_shuffles(spark, prices, both):
        write_table(prices, f"{home}/raw/ohlcv")
        write_table(read_vix(spark, *vix), f"{home}/raw/vix")
        write_table(
            drop_copies(both).observe(combined, F.count(F.lit(1)).alias("combined")), f"{home}/raw/news"
        )
    for i, feed, watch in watches:
        seen = watch.get if watch else {"bad_lines": 0, "files": 0}
        problems.append((f"feed_{i}_bad_lines", seen["bad_lines"]))
        problems.append((f"feed_{i}_skipped_files", filled_files(feed) - seen["files"] if watch else 0))
    counts = {**rows.get, **combined.get, **priced.get}
    return spark.createDataFrame([*counts.items(), *problems], "name string, rows long")


def prepare(
    spark: SparkSession, home: str, load_a: Callable[[], Scorer], settings: Settings = Settings(),
    batch: int = 16, **options,
) -> DataFrame:
    """Score the headlines with model A and build the dataset; both are written, the dataset in buckets
    by ticker, so that samples are made from it without a shuffle."""
    raw = read_parquet(spark, f"{home}/raw/news")
    # The day is the key of everything that follows; the time only breaks ties.
    news = raw.withColumn("time", F.col("date")).withColumn("date", day(F.col("date")))
    scored = score_batches(news, load_a, news.columns, names=MODEL_A, batch=batch)
    write_table(scored, f"{home}/processed/news_finbert")
    bars = read_parquet(spark, f"{home}/raw/ohlcv")
    a = read_parquet(spark, f"{home}/processed/news_finbert").select(
        "ticker", F.col("time").alias("date"), "headline", "feed",
        *[F.col(f"finbert_{c}").alias(c) for c in ("pos", "neg", "neu")],
    )
    with staging(), sized_shuffles(spark, bars, raw):
        dataset = build_dataset(
            bars, read_parquet(spark, f"{home}/raw/vix"),
            daily_tone(a, tie=ARRIVAL), settings, tickers=settings.tickers, **options,
        )
        write_buckets(dataset, f"{home}/processed/dataset")
    return read_buckets(spark, f"{home}/processed/dataset")


def score_with_model_b(
    spark: SparkSession, corpus: Sequence[str], home: str, settings: Settings = Settings(),
    fmt: str = "parquet", **fit,
) -> ToneFit:
    """Fit model B on the corpus, keep the best, score the headlines with the saved model."""
    sentences = read_corpus(spark, *corpus, fmt=fmt)
    tagged = stage(
        holdout(sentences, "sentence", settings.holdout_percent), "corpus"
    )
    best = fit_best_tone(tagged, **fit)
    save_model(best.model, f"{home}/checkpoints/cnn_sentiment")
    model = load_model(f"{home}/checkpoints/cnn_sentiment")
    scored = score_tone(read_parquet(spark, f"{home}/raw/news"), model)
    write_table(scored, f"{home}/processed/news_cnn")
    return best


def _samples(
    spark: SparkSession, home: str, variant: str, how: str, settings: Settings
) -> DataFrame:
    dataset = read_buckets(spark, f"{home}/processed/dataset")
    scored_b = None
    if variant_columns(variant) == CNN_SCORES:
        scored_b = read_parquet(spark, f"{home}/processed/news_cnn")
    with sized_shuffles(spark, dataset):  # the samples are written inside
        return variant_samples(dataset, variant, scored_b, how, settings, tie=ARRIVAL)


def train(
    spark: SparkSession, home: str, variant: str, settings: Settings = Settings(), **learner
) -> DirectionModel:
    """Fit one variant; its best model and its history are written. ``folder`` makes a linear
    training resumable: it goes on after the last epoch whose state is there."""
    with staging():
        samples = _samples(spark, home, variant, "most_confident", settings)
        fitted = fit_direction(samples, variant, settings, **learner)
        save_model(fitted.model, f"{home}/checkpoints/{variant}_best")
        write_json(fitted.history.coalesce(1), f"{home}/results/{variant}_history")
    return fitted


def evaluate(
    spark: SparkSession, home: str,
    variants: Sequence[str] = ("baseline", "cnn_fusion", "finbert_fusion"),
    settings: Settings = Settings(),
) -> DataFrame:
    """Test metrics and confusion counts of every variant that has been trained, and the
    comparison table; all are written."""
    table = None
    for name in variants:
        if not present(spark, f"{home}/checkpoints/{name}_best/metadata")[0]:
            continue
        samples = _samples(spark, home, name, "mean", settings).where(F.col("split") == "test")
        model = load_model(f"{home}/checkpoints/{name}_best")
        said = stage(
            predict(samples, model, name).select(
                F.lit(name).alias("model"), "ticker", "date", "label", "pred"),
            f"predictions-{name}",
        )
        write_json(binary_metrics(said).coalesce(1), f"{home}/results/{name}_metrics")
        write_json(confusion(said).coalesce(1), f"{home}/results/{name}_confusion")
        write_json(class_report(said).coalesce(1), f"{home}/results/{name}_report")
        table = said if table is None else table.unionByName(said)
    if table is None:
        raise ValueError("no variant has been trained")
    comparison = binary_metrics(table)
    write_csv(comparison.coalesce(1), f"{home}/results/comparison")
    return comparison
