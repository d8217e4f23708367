"""Every operator as a named query over a folder of driver tables."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.columns import argmax_class, class_from_logit, confidence, sigmoid
from ..operators import assemble as asm
from ..operators import metrics, models, news, samples, text, tone
from ..operators.indicators import indicator_builder, mom, register_indicator, sma, with_indicators
from ..operators.series import SeriesContext, Stages, along_series, in_step
from ..session import shared_folder, stage
from ..sources import readers, views, writers
from ..streaming import news as streaming
from .dataset import build_dataset, scale
from .evaluate import fit_variants, variant_samples

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
INDICATORS = Settings().indicators
# A bar is an aggregate by ticker and day, so a series is bounded by the calendar.
DAILY = {"daily": True}
BARS = {**DAILY, "dealt": True}  # straight from the tables, so dealt to tasks by their size


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round for comparing, with the same plain arithmetic as the SQL."""
    one = f"1e{digits}D"
    return df.selectExpr(*[
        f"floor(`{c}` * {one} + 0.5D) / {one} AS `{c}`" if c in columns else f"`{c}`"
        for c in df.columns
    ])


def _clock(col: str = "date") -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss").alias(col)


# Sources and sinks -------------------------------------------------------------------


@query
def bars_daily(spark: SparkSession, sf: str) -> DataFrame:
    return views.bars(spark, sf)


@query
def bars_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Bars as a provider lands them (symbol, zoned timestamp), read back."""
    path = _folder(spark, "bars")
    instant = F.timestamp_seconds(F.datediff("date", F.lit("1970-01-01")) * 86_400)
    landed = views.bars(spark, sf).select(
        F.col("ticker").alias("symbol"), instant.alias("timestamp"),
        "open", "high", "low", "close", "volume",
    )
    writers.write_table(landed, path, cluster_by=("symbol", "timestamp"))
    return readers.read_bars(spark, path)


@query
def vix_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The index with a two-level header, read back."""
    path = _folder(spark, "vix")
    views.vix(spark, sf).select(
        F.col("date").alias("Date"), F.col("vix").alias("('Close', '^VIX')")
    ).write.parquet(path)
    return readers.read_vix(spark, path)


@query
def feed_a_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Nested JSON payloads, one per headline and without a ticker, in one folder per ticker under two
    roots. All folders are named, and one of them is not there."""
    roots = [_folder(spark, "feed-a") for _ in range(2)]
    item = F.struct(
        F.concat(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("created_at"),
        "headline",
    )
    headlines = views.headlines(spark, sf)
    for rest, root in enumerate(roots):
        headlines.where(F.col("ticker") % 2 == rest).select(
            "ticker", F.struct(F.array(item).alias("news")).alias("data")
        ).write.partitionBy("ticker").json(root)
    folders = [f"{roots[t % 2]}/ticker={t}" for t in range(10)]  # as many as the feed has tickers
    found = readers.read_or_empty(spark, readers.read_news_feed_a, *folders, f"{roots[0]}/ticker=none")
    return found.select("ticker", _clock(), "headline")


@query
def feed_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a landed feed that are put aside, by reason, next to what became of the others; some
    headlines are cut off in their line, some have no ticker, some no time."""
    folder = _folder(spark, "feed-b")
    digit = F.substring(F.md5("headline"), 1, 1)
    flat = _flat(views.headlines(spark, sf)).withColumns({
        "ticker": F.when(digit != "1", F.col("ticker")), "datetime": F.when(digit != "2", F.col("datetime")),
    })
    line = F.to_json(F.struct("ticker", "datetime", "headline"))
    flat.select(F.when(digit == "0", F.substring(line, 1, 12)).otherwise(line).alias("value")).write.text(folder)
    taken = readers.take_in(spark, "b", _folder(spark, "intake"), folder)
    lines = taken.quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
    kept = taken.rows.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("lines"))
    counts = [F.lit(taken.counts[c]).cast("long").alias(c) for c in ("rows", "good_lines", "lines_put_aside")]
    return lines.unionByName(kept).select("reason", "lines", F.lit(taken.counts["lines"]).cast("long").alias("landed"), *counts)


@query
def feed_b_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Flat JSON rows with epoch seconds."""
    path = _folder(spark, "feed-b")
    writers.write_json(_flat(views.headlines(spark, sf)), path)
    return readers.read_news_feed_b(spark, path).select("ticker", _clock(), "headline")


def _flat(headlines: DataFrame) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01'"), F.col("date"))
    return headlines.select(F.col("ticker").cast("string"), seconds.alias("datetime"), "headline")


@query
def feed_missing(spark: SparkSession, sf: str) -> DataFrame:
    """One feed is not there; of the other, landed in several paths, one path is missing and one
    has a line that is no JSON: everything else arrives."""
    folder = _folder(spark, "feed-b")
    paths = [f"{folder}/{name}" for name in ("even", "gone", "odd", "bad")]
    gone = readers.read_or_empty(spark, readers.read_news_feed_a, _folder(spark, "gone"))
    headlines = views.headlines(spark, sf)
    for name, rest in (("even", 0), ("odd", 1)):
        writers.write_json(_flat(headlines.where(F.col("news_id") % 2 == rest)), f"{folder}/{name}")
    broken = F.concat(F.lit('{"ticker": "'), F.max("news_id").cast("string"))
    headlines.agg(broken.alias("value")).write.text(f"{folder}/bad")
    there = readers.read_or_empty(spark, readers.read_news_feed_b, *paths)
    return news.union_feeds(gone, there).select("feed", "ticker", _clock(), "headline")


@query
def feed_trouble(spark: SparkSession, sf: str) -> DataFrame:
    """What a landed feed leaves out: some headlines are cut off in its line."""
    folder = _folder(spark, "feed-b")
    line = F.to_json(F.struct(*_flat(views.headlines(spark, sf)).columns))
    whole = views.headlines(spark, sf)
    lines = _flat(whole).withColumn("cut", F.substring(F.md5("headline"), 1, 1) == "0")
    lines.select(
        F.when(F.col("cut"), F.substring(line, 1, 12)).otherwise(line).alias("value")
    ).write.text(folder)
    counts = readers.feed_problems(spark, readers.FEED_B, folder, f"{folder}-gone")
    found = readers.read_or_empty(spark, readers.read_news_feed_b, folder, f"{folder}-gone")
    return found.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", *[F.lit(n).cast("long").alias(name) for name, n in counts.items()]
    )


@query
def bars_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Bars landed in one path per half of the tickers, read for some tickers and a period."""
    folder = _folder(spark, "bars")
    bars = views.bars(spark, sf)
    for rest in (0, 1):
        writers.write_table(
            bars.where(F.col("ticker") % 2 == rest), f"{folder}/{rest}", cluster_by=("ticker", "date")
        )
    return readers.read_bars(
        spark, f"{folder}/0", f"{folder}/1", tickers=[1, 2, 3, 5, 8],
        start=dt.date(1993, 6, 1), end=dt.date(1996, 5, 31),
    )


@query
def corpus_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences nested in a struct column, unwrapped by the reader."""
    return readers.read_corpus(spark, _landed_corpus(spark, sf))


def _landed_corpus(spark: SparkSession, sf: str) -> str:
    """Files and rows in the order of the documents."""
    path = _folder(spark, "corpus")
    in_order = views.corpus(spark, sf).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    in_order.select(F.struct("sentence", "label").alias("train")).write.parquet(path)
    return path


@query
def backfill_years(spark: SparkSession, sf: str) -> DataFrame:
    ranges = views.bars(spark, sf).groupBy("ticker").agg(
        F.min("date").alias("start"), F.max("date").alias("end")
    )
    return readers.backfill_years(ranges)


# Headlines ---------------------------------------------------------------------------


def _feeds(spark: SparkSession, sf: str) -> DataFrame:
    return news.union_feeds(views.feed_a(spark, sf), views.feed_b(spark, sf))


@query
def news_union_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    kept = news.drop_copies(_feeds(spark, sf), carry=("news_id",))
    return kept.select("ticker", _clock(), "headline", "feed", "news_id")


@query
def feed_counts(spark: SparkSession, sf: str) -> DataFrame:
    both = _feeds(spark, sf)
    per_feed = news.count_by_feed(both).select(F.concat(F.lit("feed_"), "feed").alias("name"), "rows")
    combined = news.drop_copies(both).agg(
        F.lit("combined").alias("name"), F.count(F.lit(1)).alias("rows")
    )
    return per_feed.unionByName(combined)


@query
def daily_tone_best(spark: SparkSession, sf: str) -> DataFrame:
    best = news.daily_tone_most_confident(views.scored_headlines(spark, sf))
    return rounded(best, 6, "pos", "neg", "neu")


def _streamed(rows: DataFrame, close) -> DataFrame:
    """``rows`` landed in three parts by time, each followed by a run of the stream ``close``, and then
    a row far ahead of all others, which lets the watermark pass the last of them."""
    spark = rows.sparkSession
    landing, out, state = (_folder(spark, f"stream-{x}") for x in ("landing", "out", "state"))
    rows = stage(rows, "to-land")
    ends = rows.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    place = F.timestamp_diff("MINUTE", "first", "date") * 3 / (F.timestamp_diff("MINUTE", "first", "last") + 1)
    parted = rows.crossJoin(F.broadcast(ends)).withColumn("part", F.floor(place)).drop("first", "last")
    newest = rows.orderBy(F.col("date").desc(), "news_id").limit(1)
    late = newest.withColumn("date", F.timestamp_add("DAY", F.lit(30), "date"))
    for part in range(4):
        some = parted.where(F.col("part") == part).drop("part") if part < 3 else late
        some.write.mode("append").parquet(landing)
        stream = streaming.landed(spark, landing, rows.schema)
        streaming.append_once(close(stream), out, state)
    return spark.read.schema(close(rows).schema).parquet(out)


@query
def stream_news_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds without copies, from files that land in three parts."""
    kept = _streamed(_feeds(spark, sf), lambda s: streaming.without_copies(s, carry=("news_id",)))
    return kept.select("ticker", _clock(), "headline", "feed", "news_id")


@query
def stream_daily_tone(spark: SparkSession, sf: str) -> DataFrame:
    """The most confident headline of every day, written when the day is closed."""
    scored = views.scored_headlines(spark, sf).drop("headline")
    best = _streamed(scored, streaming.daily_tone_most_confident)
    return rounded(best, 6, "pos", "neg", "neu")


@query
def daily_tone_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(news.daily_tone_mean(views.scored_headlines(spark, sf)), 6, "pos", "neg", "neu")


@query
def headline_class(spark: SparkSession, sf: str) -> DataFrame:
    """Most likely class (0 neg, 1 neu, 2 pos) and confidence of every headline."""
    scores = [F.col("neg"), F.col("neu"), F.col("pos")]
    return views.scored_headlines(spark, sf).select(
        "news_id", argmax_class(scores).alias("class"), confidence(*scores).alias("conf")
    )


# Indicators --------------------------------------------------------------------------


def _indicators(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    return with_indicators(views.bars(spark, sf), {n: INDICATORS[n] for n in names}, **BARS)


def _indicator_query(name: str, *names: str, outputs: tuple[str, ...] = ()) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = outputs or names
        return rounded(_indicators(spark, sf, *names).select("date", "ticker", *out), 4, *out)

    QUERIES[name] = run


_indicator_query("sma", "SMA_5", "SMA_30")
_indicator_query("ema", "EMA_12", "EMA_26")
_indicator_query("rsi", "RSI")
_indicator_query("macd", "MACD", outputs=("MACD", "MACD_signal", "MACD_hist"))
_indicator_query("mom", "MOM")
_indicator_query("obv", "OBV")
_indicator_query(
    "indicators_all", *INDICATORS,
    outputs=("SMA_5", "SMA_30", "EMA_12", "EMA_26", "RSI", "MACD", "MACD_signal",
             "MACD_hist", "MOM", "OBV"),
)


TEN = ("SMA_5", "SMA_30", "EMA_12", "EMA_26", "RSI", "MACD", "MACD_signal", "MACD_hist", "MOM", "OBV")


@query
def series_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every ticker cut into segments, with all indicators, forward fill and next close."""
    bars = asm.with_market_index(views.bars(spark, sf), views.vix(spark, sf))

    def build(ctx: SeriesContext) -> Stages:
        chosen = [indicator_builder(kind)(ctx, out, **p) for out, (kind, p) in INDICATORS.items()]
        return in_step(*chosen, asm.fill_forward_stages(ctx, "vix"), asm.next_day_stages(ctx))

    out = along_series(bars, build, segment=128)
    return rounded(out.select("date", "ticker", *TEN, "vix", "next_close"), 4, *TEN)


def _ticks(spark: SparkSession, sf: str, value: Column) -> DataFrame:
    """All events as bars of one ticker."""
    return views.table(spark, sf, "events").select(
        F.col("ts").alias("date"), F.lit("ALL").alias("ticker"),
        value.alias("open"), value.alias("high"), value.alias("low"), value.alias("close"),
        F.lit(1.0).alias("volume"),
    )


def _stamp(col: str = "date") -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(col)


@query
def hot_series(spark: SparkSession, sf: str) -> DataFrame:
    """All events as ticks of one ticker, every indicator over its segments."""
    full = with_indicators(_ticks(spark, sf, F.col("value")), segment=4096)
    return rounded(full, 4, *TEN).select(_stamp(), *TEN)


@query
def rsi_flat(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks that stand still for longer than several blocks and segments, cut in two ways."""
    events = views.table(spark, sf, "events")
    n = events.agg(F.count(F.lit(1)).alias("n"))
    still = F.when(
        (F.col("event_id") >= F.col("n") * 0.2) & (F.col("event_id") < F.col("n") * 0.8), F.lit(50.0)
    ).otherwise(F.col("value"))
    ticks = events.crossJoin(F.broadcast(n)).select(
        F.col("ts").alias("date"), F.lit("ALL").alias("ticker"), still.alias("close")
    )
    only = {"RSI": INDICATORS["RSI"]}
    forms = [
        with_indicators(ticks, only, segment=size).withColumn("form", F.lit(form))
        for form, size in (("long", 4096), ("short", 1024))
    ]
    both = forms[0].unionByName(forms[1])
    return rounded(both, 4, "RSI").select("form", _stamp(), "RSI")


def _past_ratio(ctx: SeriesContext, out: str, gap: int = 100, timeperiod: int = 50) -> Stages:
    """The close against the mean over the closes that lie ``gap`` days back."""
    past = f"__{out}_past"
    return [{past: ctx.lag(F.col("close"), gap)}, {out: F.col("close") / ctx.mean(F.col(past), timeperiod)}]


def _volume_share(ctx: SeriesContext, out: str, timeperiod: int = 30) -> Stages:
    """The last days' share of all volume so far: windows over a running total."""
    total = f"__{out}_total"
    return [
        {total: ctx.running_sum(total, F.col("volume"))},
        {out: (F.col(total) - F.coalesce(ctx.lag(F.col(total), timeperiod), F.lit(0.0))) / F.col(total)},
    ]


@query
def chained_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Registered indicators that look back over columns which look back themselves, on cut series."""
    register_indicator("PAST_RATIO", _past_ratio)
    register_indicator("VOLUME_SHARE", _volume_share)
    chosen = {"past_ratio": ("PAST_RATIO", {}), "volume_share": ("VOLUME_SHARE", {})}
    full = with_indicators(views.bars(spark, sf), chosen, segment=128)
    return rounded(full.select("ticker", "date", *chosen), 6, *chosen)


# Assembly ----------------------------------------------------------------------------


@query
def vix_ffill(spark: SparkSession, sf: str) -> DataFrame:
    joined = asm.with_market_index(
        views.bars(spark, sf).select("date", "ticker", "close"), views.vix(spark, sf)
    )
    return asm.fill_forward(joined, "vix", **BARS)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return asm.with_direction(asm.with_next_close(views.bars(spark, sf), **BARS))


@query
def direction_label(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).select("date", "ticker", "close", "next_close", "label")


@query
def warmup_trim(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that have every indicator and a next close."""
    full = _indicators(spark, sf, *INDICATORS)
    labelled = asm.with_direction(asm.with_next_close(full, **DAILY))
    kept = asm.drop_incomplete(
        labelled, [c for c in labelled.columns if c.split("_")[0] in INDICATORS or c in INDICATORS]
    )
    return kept.select("date", "ticker", "label")


def _tone_b(how: str, spark: SparkSession, sf: str) -> DataFrame:
    scored = views.scored_headlines(spark, sf).withColumnsRenamed(
        {"pos": "cnn_pos", "neg": "cnn_neg", "neu": "cnn_neu"}
    )
    return news.daily_tone(scored, how, scores=("cnn_pos", "cnn_neg", "cnn_neu"))


def _closes_with_vix(spark: SparkSession, sf: str) -> DataFrame:
    return asm.with_market_index(
        views.bars(spark, sf).select("date", "ticker", "close"), views.vix(spark, sf)
    )


@query
def tone_join_fill_a(spark: SparkSession, sf: str) -> DataFrame:
    best = news.daily_tone_most_confident(views.scored_headlines(spark, sf))
    out = asm.with_daily_tone(_closes_with_vix(spark, sf), best)
    out = out.select("date", "ticker", "close", "vix", "pos", "neg", "neu")
    return rounded(out, 6, "pos", "neg", "neu")


def _zero_filled(how: str, spark: SparkSession, sf: str) -> DataFrame:
    out = asm.with_daily_tone_zero_filled(_closes_with_vix(spark, sf), _tone_b(how, spark, sf))
    return rounded(
        out.select("date", "ticker", "close", "vix", "cnn_pos", "cnn_neg", "cnn_neu"),
        6, "cnn_pos", "cnn_neg", "cnn_neu",
    )


@query
def tone_join_fill_b(spark: SparkSession, sf: str) -> DataFrame:
    return _zero_filled("most_confident", spark, sf)


@query
def tone_join_mean_b(spark: SparkSession, sf: str) -> DataFrame:
    return _zero_filled("mean", spark, sf)


@query
def minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    bars = stage(
        asm.with_market_index(views.bars(spark, sf), views.vix(spark, sf)), "bars"
    )
    return rounded(scale(bars), 6, "open", "high", "low", "close", "volume", "vix").select(
        "date", "ticker", "open", "high", "low", "close", "volume", "vix"
    )


@query
def minmax_by_ticker(spark: SparkSession, sf: str) -> DataFrame:
    out = scale(stage(views.bars(spark, sf), "bars"), by=("ticker",))
    return rounded(out, 6, "open", "high", "low", "close", "volume")


def _dataset(spark: SparkSession, sf: str, **options) -> DataFrame:
    best = news.daily_tone_most_confident(views.scored_headlines(spark, sf))
    return build_dataset(views.bars(spark, sf), views.vix(spark, sf), best, **BARS, **options)


@query
def full_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Bars, index and tone to the scaled training table."""
    out = _dataset(spark, sf)
    return rounded(out, 5, *[c for c, t in out.dtypes if t == "double"])


# Splits and samples ------------------------------------------------------------------


def _rule_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled bars with two indicators and tone: input of the sample and metric queries."""
    bars = views.bars(spark, sf)
    best = news.daily_tone_most_confident(views.scored_headlines(spark, sf))

    def build(ctx: SeriesContext) -> Stages:
        return in_step(sma(ctx, "SMA_5", 5), mom(ctx, "MOM", 14), asm.next_day_stages(ctx))

    full = along_series(asm.with_daily_tone(bars, best), build, **BARS)
    return asm.drop_incomplete(asm.with_direction(full), ["SMA_5", "MOM"])


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    frame = stage(_rule_frame(spark, sf), "rules")
    return samples.tag_split(frame, samples.split_cutoffs(frame))


@query
def split_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    return samples.split_cutoffs(_rule_frame(spark, sf))


@query
def split_tag(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged(spark, sf).select("date", "ticker", "split")


@query
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query
def lookback_samples(spark: SparkSession, sf: str) -> DataFrame:
    features = ("close", "volume", "MOM")
    made = samples.lookback_samples(_tagged(spark, sf), features, **DAILY)
    steps = [
        F.col("seq")[i][j].alias(f"{name}_{i}")
        for i in range(Settings().lookback) for j, name in enumerate(features)
    ]
    scores = [F.col("tone")[i].alias(n) for i, n in enumerate(("pos", "neg", "neu"))]
    return made.select("split", "ticker", "date", *steps, *scores, "label")


@query
def class_weight(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(samples.class_weight(_tagged(spark, sf)), 6, "pos_weight")


@query
def label_balance(spark: SparkSession, sf: str) -> DataFrame:
    return samples.label_balance(_labelled(spark, sf))


@query
def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    return samples.holdout(views.corpus(spark, sf), "doc_id").select("doc_id", "label", "part")


# Text --------------------------------------------------------------------------------


@query
def token_frequency(spark: SparkSession, sf: str) -> DataFrame:
    docs = views.table(spark, sf, "documents")
    return text.token_counts(docs, "doc_id", "text").select("word", "cnt")


@query
def vocab_topk(spark: SparkSession, sf: str) -> DataFrame:
    return text.build_vocabulary(views.table(spark, sf, "documents"), "doc_id", "text")


@query
def encode_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The 64 ids of every headline under the corpus vocabulary."""
    vocabulary = text.build_vocabulary(views.corpus(spark, sf), "doc_id", "sentence")
    ids = text.encode(views.headlines(spark, sf), vocabulary, "news_id", "headline")
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return ids.select("news_id", joined.alias("ids"))


@query
def tone_nb_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Word log-probabilities per class, from the landed corpus by the order of its rows."""
    corpus = readers.read_corpus(spark, _landed_corpus(spark, sf), key="row")
    model = tone.fit_word_classes(corpus, key="row")
    return rounded(
        model.vocabulary.select("word", "idx").join(model.word_scores, "idx"),
        6, "lp_neg", "lp_neu", "lp_pos",
    )


def _scored_b(spark: SparkSession, sf: str) -> DataFrame:
    model = tone.fit_word_classes(views.corpus(spark, sf))
    return tone.score_word_classes(views.headlines(spark, sf), model)


@query
def tone_nb_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_scored_b(spark, sf), 6, "neg", "neu", "pos")


@query
def tone_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """What the word-run model counts: the most frequent runs of every size in the training part."""
    parts = samples.holdout(views.corpus(spark, sf), "doc_id")
    train = stage(parts.where(F.col("part") == "train").select("sentence"), "train")
    return tone.run_vocabulary(train)


@query
def tone_pipeline_score(spark: SparkSession, sf: str) -> DataFrame:
    """Fit the word-run model on the training part, save, load, score all headlines."""
    parts = samples.holdout(views.corpus(spark, sf), "doc_id")
    train = stage(parts.where(F.col("part") == "train").select("sentence", "label"), "train")
    path = _folder(spark, "tone-model")
    writers.save_model(tone.fit_tone_pipeline(train), path)
    scored = tone.score_tone(views.headlines(spark, sf), writers.load_model(path))
    return scored.select("news_id", "ticker", _clock(), *[f"cnn_{c}" for c in tone.CLASSES])


@query
def tone_batch_scorer(spark: SparkSession, sf: str) -> DataFrame:
    """A plugged-in batch model; here its scores come from the text's length."""

    def load() -> tone.Scorer:
        def score(texts):
            n = np.array([len(t) for t in texts], dtype="int64")
            raw = np.stack([n % 7 + 1, n % 5 + 1, n % 3 + 1], axis=1).astype("float64")
            return raw / raw.sum(axis=1, keepdims=True)

        return score

    scored = tone.score_batches(views.headlines(spark, sf), load)
    return rounded(scored, 6, "pos", "neg", "neu")


# Metrics -----------------------------------------------------------------------------

# Deterministic stand-ins for trained models.
_RULES = {
    "momentum": "MOM > 0",
    "trend": "close > SMA_5",
    "reversal": "close < SMA_5",
}


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule's prediction for every labelled bar, in one pass."""
    options = [
        F.struct(F.lit(n).alias("model"), F.expr(rule).cast("int").alias("pred"))
        for n, rule in _RULES.items()
    ]
    return _rule_frame(spark, sf).select(
        "ticker", "date", "label", F.explode(F.array(*options)).alias("__m")
    ).select("__m.*", "ticker", "date", "label")


@query
def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.binary_metrics(_predictions(spark, sf))


@query
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion(_predictions(spark, sf))


@query
def confusion_every_class(spark: SparkSession, sf: str) -> DataFrame:
    """Days on which the close rose only: the class that is never true has a row, too."""
    rising = _predictions(spark, sf).where(F.col("label") == 1)
    return metrics.confusion(rising, other=True)


@query
def class_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.class_report(_predictions(spark, sf)), 4, "precision", "recall", "f1")


@query
def class_report_tone(spark: SparkSession, sf: str) -> DataFrame:
    """Three classes: corpus labels against the stand-in scores' best class."""
    said = views.scored_headlines(spark, sf).select(
        F.col("news_id").alias("doc_id"),
        argmax_class([F.col("neg"), F.col("neu"), F.col("pos")]).alias("pred"),
    )
    pairs = views.corpus(spark, sf).select("doc_id", "label").join(said, "doc_id")
    return rounded(
        metrics.class_report(pairs, tone.CLASSES, by=()), 4, "precision", "recall", "f1"
    )


def _logits(spark: SparkSession, sf: str) -> DataFrame:
    return _rule_frame(spark, sf).select(
        "ticker", "date", "label",
        ((F.col("close") - F.col("SMA_5")) / F.col("SMA_5")).alias("logit"),
        F.lit(1.25).alias("pos_weight"),
    )


@query
def logit_class(spark: SparkSession, sf: str) -> DataFrame:
    """Probability and class of every logit."""
    logit = F.col("logit")
    scored = _logits(spark, sf).select(
        "ticker", "date", sigmoid(logit).alias("p"), class_from_logit(logit).alias("pred")
    )
    return rounded(scored, 6, "p")


@query
def weighted_log_loss(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.weighted_log_loss(_logits(spark, sf)), 6, "loss")


@query
def batched_log_loss(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.batched_log_loss(_logits(spark, sf)), 6, "loss")


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """Order values by priority and month, shaped like a training history."""
    orders = views.table(spark, sf, "orders")
    month = F.months_between(F.trunc("o_orderdate", "month"), F.lit("1990-01-01").cast("date"))
    cents = views.mean_cents("o_totalprice")
    by_month = orders.groupBy(
        F.regexp_replace("o_orderpriority", "[^A-Za-z0-9]+", "_").alias("model"),
        month.cast("int").alias("epoch"),
    )
    return by_month.agg(
        (cents / 1e7).alias("val_loss"),
        (cents / 2e7).alias("train_loss"),
        (F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("val_acc"),
    )


@query
def early_stop(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.early_stop(_history(spark, sf))


@query
def history_json(spark: SparkSession, sf: str) -> DataFrame:
    """Histories written as JSON and read back, one path per model and named after it."""
    history = _history(spark, sf).select(
        "model", F.struct("epoch", "train_loss", "val_loss", "val_acc").alias("e")
    )
    # A history is an array of its epochs, as many as the model was trained for.
    arrays = history.groupBy("model").agg(F.to_json(F.sort_array(F.collect_list("e"))).alias("value"))
    back = readers.read_history(spark, *_one_file_per_model(arrays, "history"))
    return back.select("model", "epoch", "train_loss", "val_loss", "val_acc")


def _one_file_per_model(objects: DataFrame, name: str) -> list[str]:
    """Land one JSON text per model; there are only a handful of models."""
    folder = _folder(objects.sparkSession, name)
    objects = stage(objects, name)
    paths = []
    for row in objects.select("model").collect():
        paths.append(f"{folder}/{row.model}_{name}.json")
        objects.where(F.col("model") == row.model).select("value").coalesce(1).write.text(paths[-1])
    return paths


@query
def metrics_json(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of all models written as JSON and read back."""
    table = metrics.binary_metrics(_predictions(spark, sf))
    objects = table.select("model", F.to_json(F.struct(*table.columns)).alias("value"))
    return readers.read_metrics(spark, *_one_file_per_model(objects, "metrics"))


@query
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """The comparison table through its CSV sink."""
    path = _folder(spark, "comparison")
    writers.write_csv(metrics.comparison(_predictions(spark, sf)), path)
    return spark.read.schema(readers.METRICS).option("header", True).csv(path)


# Direction models --------------------------------------------------------------------


def _model_b(spark: SparkSession, sf: str) -> DataFrame:
    scores = _scored_b(spark, sf).withColumnsRenamed(
        {"neg": "cnn_neg", "neu": "cnn_neu", "pos": "cnn_pos"}
    )
    return views.headlines(spark, sf).select("news_id", "ticker", "date").join(scores, "news_id")


def _fitted(spark: SparkSession, sf: str):
    """All variants trained together; the models, the test samples, and the table of samples."""
    dataset = _dataset(spark, sf, in_buckets=True)
    return fit_variants(dataset, stage(_model_b(spark, sf), "scored"), keyed=True, **DAILY)


@query
def direction_fit(spark: SparkSession, sf: str) -> DataFrame:
    """The tone-A variant fitted on its samples: what it was fitted on, and the loss that training
    started from, which is known before any epoch."""
    dataset = _dataset(spark, sf, in_buckets=True)
    made = variant_samples(dataset, "finbert_fusion", staged=False, **DAILY)
    fitted = models.fit_direction(made, "finbert_fusion")
    losses = dict(zip(("train", "val"), fitted.untrained))
    loss = F.coalesce(*[F.when(F.col("split") == k, F.lit(v)) for k, v in losses.items()])
    counts = made.groupBy("split").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(F.col("label") == 1).alias("ups")
    )
    return rounded(counts.withColumn("untrained_loss", loss), 6, "untrained_loss")


@query
def direction_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every epoch of the kept candidate of every variant, next to what early stopping makes of it."""
    fitted, _ = _fitted(spark, sf)
    histories = [m.history.withColumn("model", F.lit(name)) for name, m in fitted.items()]
    history = histories[0].unionAll(histories[1]).unionAll(histories[2])
    return history.join(metrics.early_stop(history), "model")


@query
def direction_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """The comparison table of the three trained variants on the test split."""
    fitted, test = _fitted(spark, sf)
    return models.evaluate_all(test, fitted)


def _rising_models() -> dict:
    """Fixed linear models: the close's change over the lookback, without and with the day's tone."""
    rise = [0.0] * (3 * Settings().lookback)
    rise[0], rise[-3] = -1.0, 1.0  # the close leads each step
    return {
        "baseline": models.linear_model([*rise, 0.5]),
        "finbert_fusion": models.linear_model([*rise, 4000.0, -4000.0, 0.0, 0.25]),
    }


def _fixed_samples(spark: SparkSession, sf: str) -> DataFrame:
    made = samples.lookback_samples(_tagged(spark, sf), ("close", "volume", "MOM"), **DAILY)
    return stage(made.where(F.col("split") == "test"), "test-samples")


@query
def direction_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Logit and class of every test sample under fixed models, saved and loaded again."""
    made, out = _fixed_samples(spark, sf), []
    for name, model in _rising_models().items():
        path = _folder(spark, name)
        writers.save_model(model, path)
        out.append(models.predict(made, writers.load_model(path), name).withColumn("model", F.lit(name)))
    both = out[0].unionByName(out[1]).select("model", "ticker", "date", "label", "logit", "pred")
    return rounded(both, 4, "logit")


@query
def direction_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The comparison table of the fixed models on the test split."""
    made, fixed = _fixed_samples(spark, sf), _rising_models()
    return models.evaluate_all({name: made for name in fixed}, fixed)


@query
def direction_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """All three variants fitted and compared on the test split: how many rows of each true class each
    judged, and whether the metrics and the history of the variant fit together."""
    fitted, test = _fitted(spark, sf)
    said = stage(models.predictions_of(test, fitted), "said")
    return said_against_history(said, {n: (m.history, m.best_epoch) for n, m in fitted.items()})


def said_against_history(said: DataFrame, histories: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """Predictions of every model and true class. ``fits`` tells that the comparison table's accuracy is
    the share of right rows, and that the kept epoch is the first of the lowest validation loss."""
    right = said.groupBy("model").agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("share"))
    history = reduce(DataFrame.unionAll, [
        h.select(F.lit(name).alias("model"), F.lit(best).alias("best"), "epoch", "val_loss")
        for name, (h, best) in histories.items()
    ])
    kept = history.groupBy("model").agg(
        (F.max("best") == F.min_by("epoch", F.struct("val_loss", "epoch"))).alias("kept_is_best")
    )
    fits = metrics.comparison(said).join(right, "model").join(kept, "model").select(
        "model", (F.col("kept_is_best") & (F.abs(F.col("accuracy") - F.col("share")) <= 5.1e-5)).alias("fits")
    )
    cells = metrics.confusion(said).select(
        "model", "label", (F.col("pred_0") + F.col("pred_1")).alias("predictions")
    )
    return cells.join(fits, "model")
