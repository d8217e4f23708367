import os

"""The physical plans the engine relies on."""

from tickertone import session
from tickertone.config import Settings
from pyspark.sql import functions as F

from tickertone.operators import news, samples
from tickertone.operators.assemble import with_direction, with_next_close
from tickertone.operators.indicators import with_indicators
from tickertone.plans import catalog
from tickertone.plans.dataset import assemble, build_dataset
from tickertone.plans.evaluate import fit_variants, variant_samples
from tickertone.sources import readers, views, writers

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bars_file(spark, tmp_path):
    path = str(tmp_path / "bars")
    views.bars(spark, SF).write.parquet(path)
    return readers.read_bars(spark, path)


def test_all_indicators_take_one_shuffle(spark, tmp_path):
    text = plan(with_indicators(bars_file(spark, tmp_path), daily=True))
    assert text.count("Exchange") == 1
    assert "Python" not in text and "ArrowEval" not in text


def test_ticker_filter_goes_below_the_window(spark, tmp_path):
    text = plan(with_indicators(bars_file(spark, tmp_path), daily=True).where("ticker = 3"))
    assert "EqualTo(ticker,3)" in text.split("PushedFilters")[-1]


def test_unused_columns_are_not_read(spark, tmp_path):
    df = with_indicators(bars_file(spark, tmp_path), daily=True).select("date", "ticker", "SMA_5")
    schema = plan(df).split("ReadSchema")[-1]
    assert "close" in schema and "volume" not in schema and "open" not in schema


def test_assembly_has_no_python_and_broadcasts_the_calendar_only(spark):
    best = news.daily_tone(views.scored_headlines(spark, SF))
    text = plan(assemble(views.bars(spark, SF), views.vix(spark, SF), best, Settings(), daily=True))
    assert "Python" not in text and "ArrowEval" not in text and "Cartesian" not in text
    assert text.count("BroadcastExchange") >= 1 and "BroadcastNestedLoopJoin" not in text
    assert "text" not in text.split("documents.parquet")[-1].split("ReadSchema")[1].split("\n")[0]


def test_copies_and_daily_tone_are_combined_before_the_shuffle(spark):
    both = news.union_feeds(views.feed_a(spark, SF), views.feed_b(spark, SF))
    assert "partial_min" in plan(news.drop_copies(both))
    assert "partial_min_by" in plan(news.daily_tone(views.scored_headlines(spark, SF)))


def test_bars_and_tone_meet_without_another_shuffle(spark):
    """Both are aggregates by ticker and day: the join needs no exchange of its own."""
    best = news.daily_tone(views.scored_headlines(spark, SF))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(assemble(views.bars(spark, SF), views.vix(spark, SF), best, daily=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # bars, tone, index (one row per day), and the one along the tickers
    assert text.count("Exchange hashpartitioning") == 4 and "SortMergeJoin" in text


def test_shuffles_and_small_inputs_are_sized(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    docs = views.table(spark, SF, "documents").select("doc_id", "text")
    with session.sized_shuffles(spark, docs) as n:
        assert n == int(before)
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1000)
    with session.sized_shuffles(spark, docs) as n:
        assert n > 100 and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    monkeypatch.setattr(session, "SMALL_INPUT", 1)
    assert "Exchange" not in plan(session.spread(docs, "doc_id"))


def test_staged_tables_go_when_their_reader_is_done(spark):
    kept = session.stage(spark.range(3), "kept")
    with session.staging():
        gone = session.stage(spark.range(3), "gone")
        assert gone.count() == 3
        paths = [f.removeprefix("file:") for f in gone.inputFiles()]
    assert not any(os.path.exists(p) for p in paths) and kept.count() == 3


def test_samples_are_made_from_buckets_without_a_shuffle(spark, tmp_path):
    """Indicators, next close, splits and lookback samples after the one shuffle of the writer."""
    path = str(tmp_path / "bars")
    assert writers.write_buckets(views.bars(spark, SF), path, buckets=4) == 4
    bars = readers.read_buckets(spark, path)
    assert sorted(map(tuple, bars.collect())) == sorted(map(tuple, views.bars(spark, SF).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        full = with_direction(with_next_close(with_indicators(bars, daily=True), daily=True))
        tagged = samples.tag_split(full, samples.split_cutoffs(spark.read.parquet(path)))
        made = samples.lookback_samples(tagged, ["close", "RSI"], ["MOM"], daily=True)
        text = plan(made)
        assert text.count("Window") >= 3 and "Bucketed: true" in text and "SelectedBucketsCount: 4 out of 4" in text
        shuffles = [x for x in text.split("\n") if "Exchange" in x and "Broadcast" not in x]
        assert all("SinglePartition" in x for x in shuffles), shuffles  # of the cut-off days' one row
        counts = bars.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
        assert "Exchange" not in plan(counts)
        writers.write_buckets(views.vix(spark, SF).withColumn("ticker", F.lit(3).cast("long")), str(tmp_path / "b"), buckets=4)
        other = readers.read_buckets(spark, str(tmp_path / "b")).groupBy("ticker").agg(F.max("vix").alias("vix"))
        assert "Exchange" not in plan(counts.join(other, "ticker"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert made.where("size(seq) <> 10").count() == 0


def test_buckets_are_overwritten_and_read_again(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5):
        writers.write_buckets(spark.range(n * 100).select((F.col("id") % 7).alias("ticker"), F.col("id").alias("date")), path, buckets=n)
        assert readers.read_buckets(spark, path).count() == n * 100
    files = [f for f in (tmp_path / "t").iterdir() if f.suffix == ".parquet"]
    assert 1 <= len(files) <= 5


def test_training_stages_no_sequences_and_shuffles_no_series(spark):
    """From the tables to trained models: the bars are dealt by ticker once, steps are written once."""
    said = catalog._model_b(spark, SF)
    first = len(session._staged)
    best = news.daily_tone_most_confident(views.scored_headlines(spark, SF))
    plain = build_dataset(views.bars(spark, SF), views.vix(spark, SF), best, daily=True)
    data = catalog._dataset(spark, SF, in_buckets=True)
    assert sorted(map(tuple, data.collect())) == sorted(map(tuple, plain.select(*data.columns).collect()))
    fitted, test = fit_variants(data, said, settings=Settings(max_epochs=2), daily=True, keyed=True)
    assert set(fitted) == set(test) and all(m.history.count() == 2 for m in fitted.values())
    for path in session._staged[first:]:
        folder = f"{path}/table" if os.path.exists(f"{path}/table") else path
        assert "seq" not in spark.read.parquet(folder).columns
    for made in (test["cnn_fusion"], variant_samples(data, "finbert_fusion", staged=False, daily=True)):
        assert "Bucketed: true" in plan(made) and "Exchange hashpartitioning" not in plan(made)
        counts = plan(made.groupBy("split").agg(F.count(F.lit(1))))
        assert "collect_list" not in counts
