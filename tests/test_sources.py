import datetime as dt
import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tickertone.sources import readers, writers

STAMP = dt.datetime(2024, 5, 1, 23, 30)


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    """Readers must not depend on the session's zone."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bars_with_provider_names(spark, tmp_path, zone):
    frame = pd.DataFrame({
        "symbol": ["A", "B", "A", "A"],
        "timestamp": pd.to_datetime(["2024-05-01 23:30", "2024-05-01 04:00", "2024-05-02 00:00", "2024-06-01 04:00"], utc=True),
        "open": 1.0, "high": 2.0, "low": 0.5, "close": [1.5, 1.5, float("nan"), 1.0], "volume": [10, 11, 12, 13], "vwap": 1.0,
    })
    frame.to_parquet(tmp_path / "b.parquet", coerce_timestamps="us")
    got = readers.read_bars(spark, str(tmp_path / "b.parquet"), tickers=["A"],
                            start=dt.date(2024, 5, 1), end=dt.date(2024, 5, 31))
    rows = sorted(got.collect())
    assert got.columns == ["date", "ticker", "open", "high", "low", "close", "volume"]
    assert [(r.date, r.close, r.volume) for r in rows] == [
        (dt.date(2024, 5, 1), 1.5, 10.0), (dt.date(2024, 5, 2), None, 12.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(symbol" in plan or "EqualTo(symbol" in plan
    assert "GreaterThanOrEqual(timestamp" in plan and "vwap" not in plan


def test_feeds(spark, tmp_path, zone):
    (tmp_path / "a.json").write_text(json.dumps({"ticker": "A", "data": {"news": [
        {"created_at": "2024-05-01T23:30:00Z", "headline": "one"}, {"created_at": "2024-05-01T19:30:00-04:00", "headline": None}]}})
        + "\n" + json.dumps({"ticker": "B", "data": {"news": []}}))
    (tmp_path / "b.json").write_text(json.dumps({"ticker": "A", "datetime": 1714606200, "headline": "two"}))
    a = readers.read_news_feed_a(spark, str(tmp_path / "a.json"))
    b = readers.read_news_feed_b(spark, str(tmp_path / "b.json"))
    assert a.schema == b.schema == readers.NEWS
    assert sorted(tuple(r) for r in a.fillna("").collect()) == [("A", STAMP, ""), ("A", STAMP, "one")]
    assert [tuple(r) for r in b.collect()] == [("A", STAMP, "two")]


def test_missing_feed_is_empty(spark, tmp_path):
    gone = readers.read_or_empty(spark, readers.read_news_feed_a, str(tmp_path / "none"))
    assert gone.schema == readers.NEWS and gone.count() == 0


def test_ticker_from_the_landing_folder(spark, tmp_path):
    for t in ("A", "B"):
        (tmp_path / f"ticker={t}").mkdir()
        (tmp_path / f"ticker={t}" / "x.json").write_text(json.dumps({"datetime": 0, "headline": "h"}))
    got = readers.read_news_feed_b(spark, str(tmp_path))
    assert sorted(r.ticker for r in got.collect()) == ["A", "B"]


def test_vix_header_levels(spark, tmp_path):
    for i, names in enumerate((["Date", "Close", "High"], ["('Date', '')", "('Close', '^VIX')", "('High', '^VIX')"])):
        table = pa.table({names[0]: pa.array([STAMP], pa.timestamp("us")), names[1]: [15.5], names[2]: [16.0]})
        pq.write_table(table, tmp_path / f"v{i}.parquet")
        got = readers.read_vix(spark, str(tmp_path / f"v{i}.parquet"))
        assert [tuple(r) for r in got.collect()] == [(STAMP.date(), 15.5)]


def test_nanosecond_parquet(spark, tmp_path):
    path = str(tmp_path / "n.parquet")
    stamps = [STAMP, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), None]
    pq.write_table(pa.table({"date": pa.array(stamps, pa.timestamp("ns")), "x": [1, 2, 3]}), path, version="2.6")
    with pytest.raises(Exception):
        spark.read.parquet(path).collect()
    try:
        got = readers.read_parquet(spark, path, nanos=["date"]).orderBy("x").collect()
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
    assert [r.date for r in got] == stamps


def test_corpus_and_results(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"train": {"sentence": "s", "label": 2}}))
    assert [tuple(r) for r in readers.read_corpus(spark, str(tmp_path / "c.json"), fmt="json").collect()] == [("s", 2)]
    (tmp_path / "base_history.json").write_text(json.dumps(
        [{"epoch": i, "train_loss": 0.1, "val_loss": 0.2, "val_acc": 0.5} for i in (1, 2)], indent=2))
    rows = readers.read_history(spark, str(tmp_path / "base_history.json")).collect()
    assert [(r.model, r.epoch) for r in rows] == [("base", 1), ("base", 2)]
    (tmp_path / "m.json").write_text(json.dumps({"model": "a", "accuracy": 0.5, "precision": 0, "recall": 0, "f1": 0}, indent=2))
    assert readers.read_metrics(spark, str(tmp_path / "m.json")).first().accuracy == 0.5


def test_backfill_years(spark):
    ranges = spark.createDataFrame(
        [("A", dt.date(2024, 4, 23), dt.date(2026, 4, 23)), ("B", dt.date(2025, 2, 1), dt.date(2025, 2, 1)),
         ("C", dt.date(2025, 2, 2), dt.date(2025, 2, 1))], "ticker string, start date, end date")
    got = sorted(tuple(r) for r in readers.backfill_years(ranges).collect())
    assert got == [
        ("A", 2024, dt.date(2024, 4, 23), dt.date(2024, 12, 31)),
        ("A", 2025, dt.date(2025, 1, 1), dt.date(2025, 12, 31)),
        ("A", 2026, dt.date(2026, 1, 1), dt.date(2026, 4, 23)),
        ("B", 2025, dt.date(2025, 2, 1), dt.date(2025, 2, 1)),
    ]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("B", 2, 1.0), ("A", 1, 2.0)], "ticker string, date int, x double")
    for options in ({}, {"partition_by": ["ticker"]}):
        path = str(tmp_path / f"t{len(options)}")
        writers.write_table(df, path, **options)
        writers.write_table(df, path, **options)
        assert sorted(tuple(r) for r in spark.read.parquet(path).select(*df.columns).collect()) == [("A", 1, 2.0), ("B", 2, 1.0)]
    writers.write_json(df, str(tmp_path / "j"))
    assert spark.read.schema(df.schema).json(str(tmp_path / "j")).count() == 2
    writers.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "c")).count() == 2


def test_one_missing_path_or_bad_line_costs_nothing_else(spark, tmp_path):
    good = {"ticker": "A", "datetime": 0, "headline": "h"}
    (tmp_path / "a.json").write_text(json.dumps(good) + "\n{not json\n" + json.dumps(good) + "\n")
    (tmp_path / "b.json").write_text(json.dumps({**good, "ticker": "B"}) + "\n")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json.gz").write_bytes(b"no gzip at all")
    paths = [str(tmp_path / n) for n in ("a.json", "gone.json", "b.json", "c.json", "d.json.gz")]
    got = readers.read_or_empty(spark, readers.read_news_feed_b, *paths)
    assert sorted(r.ticker for r in got.collect()) == ["A", "A", "B"] and got.count() == 3
    assert readers.feed_problems(spark, readers.FEED_B, *paths) == {
        "missing_paths": 1, "bad_lines": 1, "skipped_files": 1}
    assert readers.read_or_empty(spark, readers.read_news_feed_a, paths[1]).count() == 0
    assert readers.feed_problems(spark, readers.FEED_A, paths[1])["missing_paths"] == 1
    nested = {"ticker": "A", "data": {"news": [{"created_at": "2024-01-01T00:00:00Z", "headline": "h"}]}}
    (tmp_path / "n.json").write_text(json.dumps(nested) + "\n" + json.dumps({**nested, "data": 7}) + "\n")
    assert readers.read_news_feed_a(spark, str(tmp_path / "n.json")).count() == 1


def test_corpus_key_follows_files_and_rows(spark, tmp_path):
    for name, sentences in (("b", ["x", "y"]), ("a", ["u", "v", "w"])):
        train = pa.array([{"sentence": s, "label": 1} for s in sentences])
        pq.write_table(pa.table({"train": train}), tmp_path / f"{name}.parquet")
    got = readers.read_corpus(spark, str(tmp_path), key="row").orderBy("row").collect()
    assert [r.sentence for r in got] == list("uvwxy") and len({r.row for r in got}) == 5


def test_ticker_of_any_root_and_folder(spark, tmp_path):
    for root, name, t in (("one", "A", "A"), ("two", "BRK%2FB", "BRK/B"), ("two", "a+b c", "a+b c"), ("two", "__HIVE_DEFAULT_PARTITION__", None)):
        folder = tmp_path / root / f"ticker={name}" / "2024"
        folder.mkdir(parents=True)
        nested = {"data": {"news": [{"created_at": "2024-01-01T00:00:00Z", "headline": t}]}}
        (folder / "x.json").write_text(json.dumps(nested) + "\n" + json.dumps({**nested, "ticker": "own"}) + "\n")
    paths = [str(tmp_path / "one" / "ticker=A"), str(tmp_path / "two"), str(tmp_path / "two" / "ticker=gone")]
    got = readers.read_or_empty(spark, readers.read_news_feed_a, *paths).collect()
    assert sorted((r.ticker or "", r.headline or "") for r in got if r.ticker != "own") == sorted(
        [("A", "A"), ("BRK/B", "BRK/B"), ("a+b c", "a+b c"), ("", "")])
    assert sum(r.ticker == "own" for r in got) == 4


def test_intake_keeps_every_line_somewhere(spark, tmp_path):
    good = {"ticker": "A", "datetime": 0, "headline": "h"}
    lines = [json.dumps(good), "{cut", json.dumps({**good, "ticker": None}), json.dumps({**good, "datetime": None}),
             json.dumps({**good, "headline": None}), "", json.dumps({**good, "datetime": "soon"})]
    (tmp_path / "b.json").write_text("\n".join(lines) + "\n")
    (tmp_path / "d.json.gz").write_bytes(b"no gzip at all")
    taken = readers.take_in(spark, "b", str(tmp_path / "out"), *[str(tmp_path / n) for n in ("b.json", "d.json.gz", "gone")])
    assert taken.counts == {"missing_paths": 1, "skipped_files": 1, "lines": 6, "good_lines": 2, "lines_put_aside": 4, "rows": 2}
    aside = sorted((r.reason, r.line) for r in taken.quarantine.collect())
    assert [r for r, _ in aside] == ["no ticker", "no time", "not JSON of the schema", "not JSON of the schema"]
    assert "{cut" in [x for _, x in aside] and all(r.file.endswith("b.json") for r in taken.quarantine.collect())
    assert sorted((r.ticker, r.headline or "") for r in taken.rows.collect()) == [("A", ""), ("A", "h")]
    item = {"created_at": "2024-01-01T00:00:00Z", "headline": "x"}
    nested = [{"ticker": "A", "data": {"news": [item, item]}}, {"ticker": "B", "data": {"news": []}}, {"data": {"news": [item]}},
              {"ticker": "C"}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, nested)))
    taken = readers.take_in(spark, "a", str(tmp_path / "out-a"), str(tmp_path / "a.json"))
    assert taken.rows.count() == taken.counts["rows"] == 2 and taken.counts["good_lines"] == 3
    assert [r.reason for r in taken.quarantine.collect()] == ["no ticker"]
    none = readers.take_in(spark, "a", str(tmp_path / "out-n"), str(tmp_path / "gone"))
    assert none.rows.count() == none.quarantine.count() == 0 and none.counts["missing_paths"] == 1
    (tmp_path / "e.json").write_text("")
    empty = readers.take_in(spark, "b", str(tmp_path / "out-e"), str(tmp_path / "e.json"))
    assert empty.counts["lines"] == 0 and empty.rows.count() == 0
