"""Streams fed in parts against the same rows as one table."""

import datetime as dt
import random

from helpers import DAY0

from tickertone.operators import news
from tickertone.streaming import news as streaming

SCHEMA = "news_id long, ticker string, date timestamp_ntz, headline string, feed int, pos double, neg double, neu double"


def rows(seed=1, n=300, days=20):
    r = random.Random(seed)
    start = dt.datetime.combine(DAY0, dt.time(0))
    out = []
    for i in range(n):
        at = start + dt.timedelta(hours=r.randrange(days * 24))
        p = [r.random() for _ in range(3)]
        out.append((i, r.choice("AB"), at, r.choice(["x", "y", None]), r.randrange(2), *[v / sum(p) for v in p]))
    return sorted(out, key=lambda x: x[2])


def fed(spark, tmp_path, parts, close):
    landing, out, state = (str(tmp_path / x) for x in ("landing", "out", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema
    written = []
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        streaming.append_once(close(streaming.landed(spark, landing, schema)), out, state)
        written.append(spark.read.parquet(out).count())
    return spark.read.parquet(out), written


def test_copies_dropped_on_a_stream(spark, tmp_path):
    data = rows()
    copies = [(1000 + r[0], *r[1:4], 1 - r[4], *r[5:]) for r in data[40:90]]
    far = [(9999, "A", data[-1][2] + dt.timedelta(days=30), "end", 0, 1.0, 0.0, 0.0)]
    parts = [data[:100], data[100:220] + copies, data[220:], far]
    got, written = fed(spark, tmp_path, parts, lambda s: streaming.without_copies(s, "20 days", carry=("news_id",)))
    whole = news.drop_copies(spark.createDataFrame(data + copies, SCHEMA), carry=("news_id",))
    key = lambda x: (x.ticker, x.date, x.headline or "", x.feed, x.news_id)
    assert sorted(map(key, got.collect())) == sorted(map(key, whole.collect()))
    assert written[0] < written[-1]  # what is still open is not written yet


def test_days_are_written_once_closed(spark, tmp_path):
    data = rows(2)
    far = [(9999, "A", data[-1][2] + dt.timedelta(days=30), "end", 0, 1.0, 0.0, 0.0)]
    untimed = [(5000, "A", None, "x", 0, 1.0, 0.0, 0.0), (5001, None, data[0][2], "x", 0, 1.0, 0.0, 0.0)]
    got, written = fed(spark, tmp_path, [data[:90] + untimed, data[90:200], data[200:], far],
                       streaming.daily_tone_most_confident)
    whole = news.daily_tone_most_confident(spark.createDataFrame(data, SCHEMA))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    assert 0 < written[0] < written[1] < written[2] <= written[3]
    closed = {r.date for r in spark.createDataFrame(data[:90], SCHEMA).collect()}
    assert written[0] <= 2 * len(closed)


def test_a_table_gives_all_rows_at_once(spark):
    table = spark.createDataFrame(rows(3), SCHEMA)
    one, two = streaming.daily_tone_most_confident(table), news.daily_tone_most_confident(table)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert streaming.without_copies(table).count() == news.drop_copies(table).count()


def test_rows_far_behind_are_dropped(spark, tmp_path):
    data = rows(4)
    late = [(7000, "A", data[0][2], "late", 0, 1.0, 0.0, 0.0)]
    far = [(9999, "A", data[-1][2] + dt.timedelta(days=30), "end", 0, 1.0, 0.0, 0.0)]
    got, _ = fed(spark, tmp_path, [data, data[-5:] + late, far], streaming.without_copies)
    assert got.where("headline = 'late'").count() == 0
    assert got.count() == news.drop_copies(spark.createDataFrame(data, SCHEMA)).count()
