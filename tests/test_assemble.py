import datetime as dt

import pytest
from helpers import DAY0, assert_close, bars_frame, rows_by_date
from pyspark.sql import functions as F

from tickertone import Settings
from tickertone.operators import assemble as asm
from tickertone.operators import news, series
from tickertone.plans.dataset import assemble, build_dataset, scale

D = [DAY0 + dt.timedelta(days=i) for i in range(60)]
SCORED = "news_id long, ticker string, date timestamp_ntz, headline string, pos double, neg double, neu double"


def at(day, hour=12):
    return dt.datetime.combine(day, dt.time(hour))


def tone_frame(spark, rows):
    return spark.createDataFrame(rows, SCORED)


def test_forward_fill_keeps_leading_nulls_and_is_idempotent(spark):
    vix = spark.createDataFrame([(D[2], 20.0), (D[4], 30.0)], "date date, vix double")
    joined = asm.with_market_index(bars_frame(spark, range(6)), vix)
    once = asm.fill_forward(joined, daily=True)
    assert_close(rows_by_date(once)["vix"], [float("nan")] * 2 + [20, 20, 30, 30])
    assert rows_by_date(asm.fill_forward(once, daily=True)).equals(rows_by_date(once))


def test_label_is_strict_and_last_row_goes(spark):
    got = rows_by_date(asm.with_direction(asm.with_next_close(bars_frame(spark, [1, 1, 2, 1]), daily=True)))
    assert list(got["label"]) == [0, 1, 0]


@pytest.mark.parametrize("n,left", [(33, 0), (34, 0), (35, 1), (60, 26)])
def test_warmup_trim(spark, n, left):
    bars = bars_frame(spark, [100 + i % 7 for i in range(n)])
    vix = spark.createDataFrame([], "date date, vix double")
    tone = news.daily_tone(tone_frame(spark, []))
    out = assemble(bars, vix, tone, daily=True)
    assert out.count() == left
    assert out.columns == (
        "date ticker open high low close volume SMA_5 SMA_30 EMA_12 EMA_26 RSI MACD MACD_signal "
        "MACD_hist MOM OBV vix pos neg neu next_close label"
    ).split()
    assert len(asm.feature_columns(out.columns)) == 16


def test_scaler(spark):
    df = spark.createDataFrame(
        [(D[0], "A", 1.0, 5.0, None), (D[1], "A", 3.0, 5.0, 2.0), (D[2], "B", 2.0, 5.0, 4.0)],
        "date date, ticker string, x double, flat double, holes double",
    )
    got = rows_by_date(scale(df))
    assert_close(got["x"], [0, 1, 0.5])
    assert_close(got["flat"], [0, 0, 0])
    assert_close(got["holes"], [float("nan"), 0, 1])
    assert_close(rows_by_date(scale(df, by=("ticker",)))["x"], [0, 1, 0])
    assert_close(rows_by_date(scale(df, fit_on=df.where("ticker = 'A'")))["x"], [0, 1, 0.5])


def test_daily_tone(spark):
    scored = tone_frame(spark, [
        (7, "A", at(D[0]), "x", 0.7, 0.2, 0.1),
        (3, "A", at(D[0], 23), "y", 0.1, 0.7, 0.2),     # tied with 7: the lower key wins
        (1, "A", at(D[0], 0), "z", 0.4, 0.3, 0.3),
        (2, "A", at(D[1]), "u", 0.2, 0.3, 0.5),
        (4, None, at(D[1]), "v", 0.9, 0.1, 0.0),
        (5, "A", at(D[2]), "w", None, None, None),
    ])
    best = rows_by_date(news.daily_tone(scored))
    assert [tuple(r) for r in best[["pos", "neg", "neu"]].to_numpy()] == [(0.1, 0.7, 0.2), (0.2, 0.3, 0.5)]
    mean = rows_by_date(news.daily_tone(scored, "mean"))
    assert_close(mean["pos"], [0.4, 0.2, float("nan")])
    with pytest.raises(ValueError):
        news.daily_tone(scored, "median")


def test_missing_tone_is_neutral_or_zero(spark):
    bars = bars_frame(spark, [1.0]).withColumn("vix", F.lit(None).cast("double"))
    empty = news.daily_tone(tone_frame(spark, []))
    a = asm.with_daily_tone(bars, empty).first()
    assert (a.pos, a.neg, a.neu, a.vix) == (0.0, 0.0, 1.0, None)
    b = asm.with_daily_tone_zero_filled(bars, empty).first()
    assert (b.pos, b.neg, b.neu, b.vix) == (0.0, 0.0, 0.0, 0.0)


def test_union_and_copies(spark):
    cols = "ticker string, date timestamp_ntz, headline string"
    a = spark.createDataFrame([("A", at(D[0]), "x"), ("A", at(D[0]), "x"), ("A", at(D[0]), None)], cols)
    b = spark.createDataFrame([("A", at(D[0]), "x"), ("A", at(D[0]), None), ("A", at(D[1]), "x")], cols)
    both = news.union_feeds(a, b, spark.createDataFrame([], cols))
    assert {r.feed: r["rows"] for r in news.count_by_feed(both).collect()} == {0: 3, 1: 3}
    kept = news.drop_copies(both)
    assert sorted((r.feed, r.headline) for r in kept.collect() if r.headline) == [(0, "x"), (1, "x")]
    assert kept.count() == 3


def test_build_dataset_of_chosen_tickers(spark):
    closes = [100 + (i * 37) % 11 for i in range(50)]
    bars = bars_frame(spark, closes, "A").union(bars_frame(spark, closes[::-1], "B"))
    vix = spark.createDataFrame([(d, float(i)) for i, d in enumerate(D)], "date date, vix double")
    tone = news.daily_tone(tone_frame(spark, [(1, "A", at(D[40]), "h", 0.6, 0.3, 0.1)]))
    both = build_dataset(bars, vix, tone, daily=True)
    assert both.count() == 2 * (50 - 34)
    pdf = rows_by_date(both)
    assert pdf["close"].min() == 0 and pdf["close"].max() == 1
    assert pdf[(pdf.ticker == "A") & (pdf.date == D[40])][["pos", "neg", "neu"]].to_numpy().tolist() == [[0.6, 0.3, 0.1]]
    assert (pdf[pdf.ticker == "B"]["neu"] == 1).all()
    only = build_dataset(bars, vix, tone, tickers=["B", "missing"])
    assert {r.ticker for r in only.select("ticker").distinct().collect()} == {"B"}


def test_hot_day_and_hot_copies(spark):
    """A third of all headlines on one day, and as many copies of one headline."""
    rows = spark.range(30_000).select(
        F.col("id").alias("news_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 50)).alias("ticker"),
        F.when(F.col("id") % 3 == 0, F.lit(str(D[0]))).otherwise(F.lit(str(D[1]))).cast("timestamp_ntz").alias("date"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("headline"),
        (F.col("id") % 7 / 10).alias("pos"), (F.col("id") % 5 / 10).alias("neg"), F.lit(0.05).alias("neu"),
    )
    assert news.drop_copies(rows, carry=("news_id",)).count() == 20_001
    best = {r.ticker: r for r in news.daily_tone(rows).collect()}
    assert len(best) == 51 and (best["HOT"].pos, best["HOT"].neg) == (0.6, 0.1)


def test_settings_defaults():
    assert Settings().lookback == 10 and len(Settings().indicators) == 8


def test_large_daily_series_are_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    """Files of more than the session's tasks' worth: more tasks, none with more tickers, the same rows."""
    bars = spark.range(3000).select(
        F.date_add(F.lit(DAY0), (F.col("id") % 50).cast("int")).alias("date"),
        (F.col("id") / 50).cast("int").alias("ticker"), F.rand(3).alias("close"))
    bars.write.parquet(str(tmp_path / "bars"))
    read = spark.read.parquet(str(tmp_path / "bars"))
    plain = asm.with_next_close(read, daily=True)
    monkeypatch.setattr(series, "TASK_BYTES", 1000)
    dealt = asm.with_next_close(read, daily=True, dealt=True)
    assert rows_by_date(dealt).equals(rows_by_date(plain))
    tasks = dealt.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
