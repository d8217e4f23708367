"""The same results in plain SQL, for checking the catalog's queries.

Written for a SQL engine that has the driver tables as views.
"""

from __future__ import annotations

from ..config import Settings

VOCAB = Settings().vocab_size

# The whitespace class of the word split, as in functions/columns.py.
_SPACES = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

CTE: dict[str, str] = {
    "bars": """
        SELECT date, ticker, (low + high) / 2 AS open, high, low, close, volume FROM (
          SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS ticker,
                 min(l_extendedprice) AS low, max(l_extendedprice) AS high,
                 CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) // count(*) AS DOUBLE)
                   / 100 AS close,
                 sum(l_quantity) AS volume
          FROM lineitem GROUP BY 1, 2)""",
    "vix": """
        SELECT CAST(o_orderdate AS DATE) AS date,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS DOUBLE)
                 / 1000000 AS vix
        FROM orders GROUP BY 1""",
    "headlines": """
        SELECT doc_id AS news_id, doc_id % 10 AS ticker,
               TIMESTAMP '1995-06-01 00:00:00'
                 + to_days(CAST(20 * ((doc_id // 10) % 50) AS INTEGER))
                 + to_hours(doc_id % 24) AS date,
               text AS headline, CAST(substr(source, 4) AS INTEGER) AS source
        FROM documents""",
    "feeds": """
        SELECT 0 AS feed, news_id, ticker, date, headline FROM headlines WHERE source < 12
        UNION ALL
        SELECT 1 AS feed, news_id, ticker, date, headline FROM headlines WHERE source >= 8""",
    "corpus": """
        SELECT d.doc_id, d.text AS sentence,
               CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 1 THEN 2 ELSE 1 END AS label
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
    "scored": """
        SELECT news_id, ticker, date, p / (p + n + u) AS pos, n / (p + n + u) AS neg,
               u / (p + n + u) AS neu
        FROM (SELECT news_id, ticker, date, CAST(news_id * 7 % 11 + 1 AS DOUBLE) AS p,
                     CAST(news_id * 5 % 13 + 1 AS DOUBLE) AS n,
                     CAST(news_id * 3 % 7 + 1 AS DOUBLE) AS u FROM headlines)""",
    "best": """
        SELECT ticker, date, pos, neg, neu FROM (
          SELECT ticker, CAST(date AS DATE) AS date, pos, neg, neu,
                 row_number() OVER (PARTITION BY ticker, CAST(date AS DATE)
                   ORDER BY greatest(pos, neg, neu) DESC, news_id) AS nth
          FROM scored) WHERE nth = 1""",
    "mean_tone": """
        SELECT ticker, CAST(date AS DATE) AS date, avg(pos) AS pos, avg(neg) AS neg,
               avg(neu) AS neu
        FROM scored GROUP BY 1, 2""",
    "numbered": """
        SELECT *, row_number() OVER w - 1 AS rn, lag(close) OVER w AS before,
               lead(close) OVER w AS next_close, lag(close, 14) OVER w AS before14,
               avg(close) OVER (w ROWS 4 PRECEDING) AS a5,
               avg(close) OVER (w ROWS 8 PRECEDING) AS a9,
               avg(close) OVER (w ROWS 11 PRECEDING) AS a12,
               avg(close) OVER (w ROWS 25 PRECEDING) AS a26,
               avg(close) OVER (w ROWS 29 PRECEDING) AS a30
        FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
    "moved": """
        SELECT *, avg(greatest(close - before, 0)) OVER s AS up14,
               avg(greatest(before - close, 0)) OVER s AS down14,
               sum(CASE WHEN rn = 0 THEN volume WHEN close > before THEN volume
                        WHEN close < before THEN -volume ELSE 0 END)
                 OVER (PARTITION BY ticker ORDER BY date) AS obv
        FROM numbered
        WINDOW s AS (PARTITION BY ticker ORDER BY date ROWS 13 PRECEDING)""",
    "smoothed": """
        SELECT ticker, rn, date, CAST(NULL AS DOUBLE) AS e12, CAST(NULL AS DOUBLE) AS e26,
               CAST(NULL AS DOUBLE) AS fast, CAST(NULL AS DOUBLE) AS slow,
               CAST(NULL AS DOUBLE) AS up, CAST(NULL AS DOUBLE) AS down,
               CAST(0 AS DOUBLE) AS lines, CAST(NULL AS DOUBLE) AS signal
        FROM moved WHERE rn = 0
        UNION ALL
        SELECT ticker, rn, date, e12, e26, fast, slow, up, down,
               CASE WHEN rn BETWEEN 25 AND 33 THEN lines + fast - slow ELSE lines END AS lines,
               CASE WHEN rn = 33 THEN (lines + fast - slow) / 9
                    WHEN rn > 33 THEN signal + CAST(0.2 AS DOUBLE) * (fast - slow - signal)
               END AS signal
        FROM (
          SELECT m.ticker, m.rn, m.date,
                 CASE WHEN m.rn = 11 THEN m.a12
                      WHEN m.rn > 11 THEN s.e12 + CAST(2 AS DOUBLE) / 13 * (m.close - s.e12) END AS e12,
                 CASE WHEN m.rn = 25 THEN m.a26
                      WHEN m.rn > 25 THEN s.e26 + CAST(2 AS DOUBLE) / 27 * (m.close - s.e26) END AS e26,
                 CASE WHEN m.rn = 25 THEN m.a12
                      WHEN m.rn > 25 THEN s.fast + CAST(2 AS DOUBLE) / 13 * (m.close - s.fast) END AS fast,
                 CASE WHEN m.rn = 25 THEN m.a26
                      WHEN m.rn > 25 THEN s.slow + CAST(2 AS DOUBLE) / 27 * (m.close - s.slow) END AS slow,
                 CASE WHEN m.rn = 14 THEN m.up14
                      WHEN m.rn > 14 THEN (s.up * 13 + greatest(m.close - m.before, 0)) / 14 END AS up,
                 CASE WHEN m.rn = 14 THEN m.down14
                      WHEN m.rn > 14 THEN (s.down * 13 + greatest(m.before - m.close, 0)) / 14 END AS down,
                 s.lines, s.signal
          FROM smoothed s JOIN moved m ON m.ticker = s.ticker AND m.rn = s.rn + 1)""",
    "signals": """
        SELECT m.date, m.ticker, m.open, m.high, m.low, m.close, m.volume,
               CASE WHEN m.rn >= 4 THEN a5 END AS SMA_5, CASE WHEN m.rn >= 29 THEN a30 END AS SMA_30,
               e12 AS EMA_12, e26 AS EMA_26,
               CASE WHEN up + down = 0 THEN 0 ELSE 100 * up / (up + down) END AS RSI,
               CASE WHEN m.rn >= 33 THEN fast - slow END AS MACD, signal AS MACD_signal,
               CASE WHEN m.rn >= 33 THEN fast - slow - signal END AS MACD_hist,
               close - before14 AS MOM, obv AS OBV, m.rn, m.next_close
        FROM moved m JOIN smoothed s ON s.ticker = m.ticker AND s.rn = m.rn""",
    "with_vix": """
        SELECT b.*, v.vix,
               last_value(v.vix IGNORE NULLS) OVER (PARTITION BY b.ticker ORDER BY b.date
                 ROWS UNBOUNDED PRECEDING) AS filled
        FROM bars b LEFT JOIN vix v ON v.date = b.date""",
    "rules": """
        SELECT n.date, n.ticker, n.close, n.volume, a5 AS SMA_5, close - before14 AS MOM,
               coalesce(t.pos, 0) AS pos, coalesce(t.neg, 0) AS neg, coalesce(t.neu, 1) AS neu,
               CAST(next_close > close AS INTEGER) AS label
        FROM numbered n LEFT JOIN best t ON t.ticker = n.ticker AND t.date = n.date
        WHERE next_close IS NOT NULL AND rn >= 14""",
    "days": """
        SELECT date, row_number() OVER (ORDER BY date DESC) AS back, count(*) OVER () AS n,
               min(date) OVER () AS earliest
        FROM (SELECT DISTINCT date FROM rules)""",
    "cutoffs": """
        SELECT max(n) AS n_dates,
               coalesce(max(CASE WHEN back = floor(n * CAST(0.4 AS DOUBLE)) THEN date END),
                        max(earliest)) AS val_start,
               coalesce(max(CASE WHEN back = floor(n * CAST(0.25 AS DOUBLE)) THEN date END),
                        max(earliest)) AS test_start
        FROM days""",
    "tagged": """
        SELECT r.*, CASE WHEN date >= test_start THEN 'test' WHEN date >= val_start THEN 'val'
                         ELSE 'train' END AS split
        FROM rules r, cutoffs""",
    "predictions": """
        SELECT 'momentum' AS model, ticker, date, label, CAST(MOM > 0 AS INTEGER) AS pred FROM rules
        UNION ALL
        SELECT 'trend', ticker, date, label, CAST(close > SMA_5 AS INTEGER) FROM rules
        UNION ALL
        SELECT 'reversal', ticker, date, label, CAST(close < SMA_5 AS INTEGER) FROM rules""",
    "doc_words": f"""
        SELECT doc_id, pos, word FROM (
          SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM (
            SELECT doc_id, list_filter(string_split_regex(lower(text), '{_SPACES}'),
                                       lambda w: w <> '') AS w FROM documents))""",
    "doc_vocab": f"""
        SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, first_seen) + 1 AS idx FROM (
          SELECT word, count(*) AS cnt, min(CAST(doc_id AS HUGEINT) * 2147483648 + pos) AS first_seen
          FROM doc_words GROUP BY word ORDER BY cnt DESC, first_seen LIMIT {VOCAB})""",
    "vocab": f"""
        SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, first_seen) + 1 AS idx FROM (
          SELECT word, count(*) AS cnt, min(CAST(doc_id AS HUGEINT) * 2147483648 + pos) AS first_seen
          FROM doc_words JOIN corpus USING (doc_id)
          GROUP BY word ORDER BY cnt DESC, first_seen LIMIT {VOCAB})""",
    "ids": """
        SELECT w.doc_id, w.pos, coalesce(v.idx, 1) AS idx
        FROM doc_words w LEFT JOIN vocab v ON v.word = w.word""",
    "word_counts": """
        SELECT idx, count(*) FILTER (label = 0) AS n_neg, count(*) FILTER (label = 1) AS n_neu,
               count(*) FILTER (label = 2) AS n_pos
        FROM ids JOIN corpus USING (doc_id) GROUP BY idx""",
    "totals": """
        SELECT (SELECT count(*) + 1 FROM vocab) AS v, sum(n_neg) AS t_neg, sum(n_neu) AS t_neu,
               sum(n_pos) AS t_pos, (SELECT count(*) FROM corpus) AS d,
               (SELECT count(*) FROM corpus WHERE label = 0) AS d_neg,
               (SELECT count(*) FROM corpus WHERE label = 1) AS d_neu,
               (SELECT count(*) FROM corpus WHERE label = 2) AS d_pos
        FROM word_counts""",
    "word_scores": """
        SELECT idx, ln(CAST(n_neg + 1 AS DOUBLE) / (t_neg + v)) AS lp_neg,
               ln(CAST(n_neu + 1 AS DOUBLE) / (t_neu + v)) AS lp_neu,
               ln(CAST(n_pos + 1 AS DOUBLE) / (t_pos + v)) AS lp_pos
        FROM word_counts, totals""",
    "doc_scores": """
        SELECT doc_id,
               any_value(ln(CAST(d_neg AS DOUBLE) / d)) + coalesce(sum(CASE WHEN i.idx IS NOT NULL
                 THEN coalesce(lp_neg, ln(CAST(1 AS DOUBLE) / (t_neg + v))) END), 0) AS s_neg,
               any_value(ln(CAST(d_neu AS DOUBLE) / d)) + coalesce(sum(CASE WHEN i.idx IS NOT NULL
                 THEN coalesce(lp_neu, ln(CAST(1 AS DOUBLE) / (t_neu + v))) END), 0) AS s_neu,
               any_value(ln(CAST(d_pos AS DOUBLE) / d)) + coalesce(sum(CASE WHEN i.idx IS NOT NULL
                 THEN coalesce(lp_pos, ln(CAST(1 AS DOUBLE) / (t_pos + v))) END), 0) AS s_pos
        FROM documents LEFT JOIN ids i USING (doc_id) LEFT JOIN word_scores USING (idx)
        CROSS JOIN totals GROUP BY doc_id""",
    "history": """
        SELECT regexp_replace(o_orderpriority, '[^A-Za-z0-9]+', '_', 'g') AS model,
               CAST((year(o_orderdate) - 1990) * 12 + month(o_orderdate) - 1 AS INTEGER) AS epoch,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS DOUBLE) / 10000000 AS val_loss,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS DOUBLE) / 20000000 AS train_loss,
               CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) AS val_acc
        FROM orders GROUP BY 1, 2""",
    "losses": """
        SELECT ticker, date,
               1.25 * label * (ln(1 + exp(-abs(z))) + greatest(-z, 0))
                 + (1 - label) * (ln(1 + exp(-abs(z))) + greatest(z, 0)) AS loss
        FROM (SELECT *, (close - SMA_5) / SMA_5 AS z FROM rules)""",
    "counts": """
        SELECT model, count(*) FILTER (label = 1 AND pred = 1) AS tp,
               count(*) FILTER (label = 0 AND pred = 1) AS fp,
               count(*) FILTER (label = 1 AND pred = 0) AS fn,
               count(*) FILTER (label = 0 AND pred = 0) AS tn
        FROM predictions GROUP BY model""",
}

# What each common table reads besides the driver tables.
NEEDS: dict[str, tuple[str, ...]] = {
    "feeds": ("headlines",), "scored": ("headlines",), "best": ("scored",),
    "mean_tone": ("scored",), "numbered": ("bars",), "moved": ("numbered",),
    "smoothed": ("moved",), "signals": ("moved", "smoothed"), "with_vix": ("bars", "vix"),
    "rules": ("numbered", "best"), "days": ("rules",), "cutoffs": ("days",),
    "tagged": ("rules", "cutoffs"), "predictions": ("rules",), "doc_vocab": ("doc_words",),
    "vocab": ("doc_words", "corpus"), "ids": ("doc_words", "vocab"),
    "word_counts": ("ids", "corpus"), "totals": ("word_counts", "vocab", "corpus"),
    "word_scores": ("word_counts", "totals"), "doc_scores": ("ids", "word_scores", "totals"),
    "losses": ("rules",), "counts": ("predictions",),
}


def _with(body: str, *names: str, **instead: str) -> str:
    """``body`` after the common tables it needs; ``instead`` replaces some of them."""
    tables = {**CTE, **instead}
    order: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, ()):
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    parts = ", ".join(
        f"{n} AS {'MATERIALIZED ' if n in ('moved', 'rules', 'ids', 'vocab') else ''}({tables[n]})"
        for n in order
    )
    recursive = "RECURSIVE " if "smoothed" in order else ""
    return f"WITH {recursive}{parts} {body}"


def _round(value: str, digits: int, name: str) -> str:
    """Plain arithmetic, so that both engines round the same way."""
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"floor(({value}) * {scale} + CAST(0.5 AS DOUBLE)) / {scale} AS {name}"


def _rounded(columns: str, digits: int) -> str:
    return ", ".join(_round(c, digits, c) for c in columns.split())


_CLOCK = "strftime(date, '%Y-%m-%d %H:%M:%S') AS date"
_DATASET = (
    "open high low close volume SMA_5 SMA_30 EMA_12 EMA_26 RSI MACD MACD_signal MACD_hist "
    "MOM OBV vix"
)


def _scaled(columns: str, digits: int, over: str = "") -> str:
    return ", ".join(
        _round(
            f"CASE WHEN max({c}) OVER ({over}) > min({c}) OVER ({over}) "
            f"THEN ({c} - min({c}) OVER ({over})) / (max({c}) OVER ({over}) - min({c}) OVER ({over})) "
            f"ELSE {c} - min({c}) OVER ({over}) END", digits, c,
        )
        for c in columns.split()
    )


def _tone_join(tone: str, prefix: str, neu: int, vix: str) -> str:
    return _with(
        f"""SELECT b.date, b.ticker, b.close, {vix} AS vix,
            {_round('coalesce(t.pos, 0)', 6, prefix + 'pos')},
            {_round('coalesce(t.neg, 0)', 6, prefix + 'neg')},
            {_round(f'coalesce(t.neu, {neu})', 6, prefix + 'neu')}
        FROM with_vix b LEFT JOIN {tone} t ON t.ticker = b.ticker AND t.date = b.date""",
        "with_vix", tone,
    )


def _indicators(columns: str) -> str:
    return _with(f"SELECT date, ticker, {_rounded(columns, 4)} FROM signals", "signals")


def _zero(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif({den}, 0), 0)"


_METRICS = f"""
    SELECT model, round({_zero('tp + tn', 'tp + fp + fn + tn')}, 4) AS accuracy,
           round({_zero('tp', 'tp + fp')}, 4) AS precision,
           round({_zero('tp', 'tp + fn')}, 4) AS recall,
           round({_zero('2 * tp', '2 * tp + fp + fn')}, 4) AS f1
    FROM counts"""


def _report(pairs: str, names: list[str], by: str, *needs: str) -> str:
    """Classification report from (by, label, pred) rows."""
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    classes = " UNION ALL ".join(f"SELECT {i} AS c, '{n}' AS class" for i, n in enumerate(names))
    body = f"""
      , names AS ({classes}),
      pairs AS ({pairs}),
      per AS (
        SELECT {lead}c, class, count(*) FILTER (label = c AND pred = c) AS hit,
               count(*) FILTER (pred = c) AS said, count(*) FILTER (label = c) AS support
        FROM pairs CROSS JOIN names GROUP BY {lead}c, class),
      shares AS (
        SELECT {lead}class, hit, support, {_zero('hit', 'said')} AS precision,
               {_zero('hit', 'support')} AS recall, {_zero('2 * hit', 'said + support')} AS f1
        FROM per),
      every AS (
        SELECT {lead}class, precision, recall, f1, support FROM shares
        UNION ALL
        SELECT {lead}'accuracy', {_zero('sum(hit)', 'sum(support)')}, {_zero('sum(hit)', 'sum(support)')},
               {_zero('sum(hit)', 'sum(support)')}, sum(support) FROM shares {group}
        UNION ALL
        SELECT {lead}'macro avg', sum(precision) / {len(names)}, sum(recall) / {len(names)},
               sum(f1) / {len(names)}, sum(support) FROM shares {group}
        UNION ALL
        SELECT {lead}'weighted avg', {_zero('sum(precision * support)', 'sum(support)')},
               {_zero('sum(recall * support)', 'sum(support)')},
               {_zero('sum(f1 * support)', 'sum(support)')}, sum(support) FROM shares {group})
      SELECT {lead}class, {_round('precision', 4, 'precision')}, {_round('recall', 4, 'recall')},
             {_round('f1', 4, 'f1')}, CAST(support AS BIGINT) AS support FROM every"""
    return _with(body, *needs)


# The rows of the training table, and those that have ten more before them in their split.
_LABELLED = """SELECT date, ticker, CAST(next_close > close AS INTEGER) AS label
               FROM numbered WHERE next_close IS NOT NULL AND rn >= 33"""
_SAMPLES = """SELECT split, label FROM tagged
    QUALIFY row_number() OVER (PARTITION BY split, ticker ORDER BY date) > 10"""


def _lookback() -> str:
    features = ("close", "volume", "MOM")
    steps = ", ".join(
        f"lag({f}, {10 - i}) OVER w AS {f}_{i}" for i in range(10) for f in features
    )
    return _with(
        f"""SELECT * EXCLUDE (nth) FROM (
            SELECT split, ticker, date, {steps}, pos, neg, neu, label,
                   row_number() OVER w AS nth
            FROM tagged WINDOW w AS (PARTITION BY split, ticker ORDER BY date))
        WHERE nth > 10""",
        "tagged",
    )


def _fixed_models(body: str) -> str:
    return _with(
        f""", fixed AS (
          SELECT ticker, date, label, model,
                 CASE model WHEN 'baseline' THEN 0.5 - first + last
                      ELSE 0.25 - first + last + 4000 * pos - 4000 * neg END AS logit
          FROM (SELECT split, ticker, date, label, pos, neg, CAST(lag(close, 10) OVER w AS DOUBLE) AS first,
                       CAST(lag(close, 1) OVER w AS DOUBLE) AS last, row_number() OVER w AS nth
                FROM tagged WINDOW w AS (PARTITION BY split, ticker ORDER BY date)),
               (VALUES ('baseline'), ('finbert_fusion')) models(model)
          WHERE split = 'test' AND nth > 10),
        said AS (SELECT *, CAST(logit > 0 AS INTEGER) AS pred FROM fixed),
        counts AS (
          SELECT model, count(*) FILTER (pred = 1 AND label = 1) AS tp, count(*) FILTER (pred = 1 AND label = 0) AS fp,
                 count(*) FILTER (pred = 0 AND label = 1) AS fn, count(*) FILTER (pred = 0 AND label = 0) AS tn
          FROM said GROUP BY model)
        {body}""",
        "tagged",
    )


def _early_stop() -> str:
    return _with(
        """, marked AS (
          SELECT *, min(val_loss) OVER (PARTITION BY model ORDER BY epoch
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM history),
        placed AS (
          SELECT *, max(CASE WHEN low IS NULL OR val_loss < low THEN epoch END)
                   OVER (PARTITION BY model ORDER BY epoch) AS best FROM marked),
        stops AS (
          SELECT model, coalesce(min(CASE WHEN epoch - best >= 10 THEN epoch END), max(epoch)) AS stop_epoch
          FROM placed GROUP BY model)
        SELECT s.model, p.best AS best_epoch, h.val_loss AS best_val_loss, s.stop_epoch
        FROM stops s JOIN placed p ON p.model = s.model AND p.epoch = s.stop_epoch
        JOIN history h ON h.model = s.model AND h.epoch = p.best""",
        "history",
    )


def oracles() -> dict[str, str]:
    bars = _with(
        "SELECT date, ticker, open, high, low, close, volume FROM bars",
        "bars",
    )
    softmax = ", ".join(
        _round(f"exp(s_{c} - top) / (exp(s_neg - top) + exp(s_neu - top) + exp(s_pos - top))", 6, c)
        for c in ("neg", "neu", "pos")
    )
    return {
        "bars_daily": bars,
        "bars_landed": bars,
        "vix_landed": _with("SELECT date, vix FROM vix", "vix"),
        "feed_a_landed": _with(
            f"SELECT CAST(ticker AS VARCHAR) AS ticker, {_CLOCK}, headline FROM headlines", "headlines"
        ),
        "feed_b_landed": _with(
            f"SELECT CAST(ticker AS VARCHAR) AS ticker, {_CLOCK}, headline FROM headlines", "headlines"
        ),
        "feed_missing": _with(
            f"SELECT 1 AS feed, CAST(ticker AS VARCHAR) AS ticker, {_CLOCK}, headline FROM headlines", "headlines"
        ),
        "corpus_landed": _with("SELECT sentence, label FROM corpus", "corpus"),
        "backfill_years": _with(
            """SELECT ticker, CAST(year AS INTEGER) AS year,
                      greatest(first, make_date(year, 1, 1)) AS from_date,
                      least(last, make_date(year, 12, 31)) AS to_date
               FROM (SELECT *, unnest(range(year(first), year(last) + 1)) AS year FROM (
                 SELECT ticker, min(date) AS first, max(date) AS last FROM bars GROUP BY ticker))""",
            "bars",
        ),
        "news_union_dedupe": _with(
            f"""SELECT ticker, {_CLOCK}, headline, feed, news_id FROM (
                SELECT ticker, date, headline, min(feed) AS feed, min(news_id) AS news_id
                FROM feeds GROUP BY ticker, date, headline)""",
            "feeds",
        ),
        "stream_news_dedupe": _with(
            f"""SELECT ticker, {_CLOCK}, headline, min(feed) AS feed, min(news_id) AS news_id
                FROM feeds GROUP BY ticker, feeds.date, headline""",
            "feeds",
        ),
        "stream_daily_tone": _with(f"SELECT ticker, date, {_rounded('pos neg neu', 6)} FROM best", "best"),
        "feed_counts": _with(
            """SELECT 'feed_' || feed AS name, count(*) AS rows FROM feeds GROUP BY feed
               UNION ALL
               SELECT 'combined', count(*) FROM (SELECT DISTINCT ticker, date, headline FROM feeds)""",
            "feeds",
        ),
        "daily_tone_best": _with(f"SELECT ticker, date, {_rounded('pos neg neu', 6)} FROM best", "best"),
        "daily_tone_mean": _with(
            f"SELECT ticker, date, {_rounded('pos neg neu', 6)} FROM mean_tone", "mean_tone"
        ),
        "headline_class": _with(
            """SELECT news_id, CASE WHEN neg >= neu AND neg >= pos THEN 0 WHEN neu >= pos THEN 1
                      ELSE 2 END AS class, greatest(neg, neu, pos) AS conf FROM scored""",
            "scored",
        ),
        "sma": _indicators("SMA_5 SMA_30"),
        "ema": _indicators("EMA_12 EMA_26"),
        "rsi": _indicators("RSI"),
        "macd": _indicators("MACD MACD_signal MACD_hist"),
        "mom": _indicators("MOM"),
        "obv": _indicators("OBV"),
        "indicators_all": _indicators(
            "SMA_5 SMA_30 EMA_12 EMA_26 RSI MACD MACD_signal MACD_hist MOM OBV"
        ),
        "hot_series": _with(
            f"""SELECT strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date,
                       {_rounded('SMA_5 SMA_30 EMA_12 EMA_26 RSI MACD MACD_signal MACD_hist MOM OBV', 4)}
                FROM signals""",
            "signals",
            bars="""SELECT ts AS date, 'ALL' AS ticker, value AS open, value AS high, value AS low,
                           value AS close, CAST(1 AS DOUBLE) AS volume FROM events""",
        ),
        "rsi_flat": _with(
            f"""SELECT form, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date, {_rounded('RSI', 4)}
                FROM signals, (VALUES ('long'), ('short')) forms(form)""",
            "signals",
            bars="""SELECT ts AS date, 'ALL' AS ticker, 0.0::DOUBLE AS open, 0.0::DOUBLE AS high,
                           0.0::DOUBLE AS low,
                           CASE WHEN event_id >= n * 0.2 AND event_id < n * 0.8
                                THEN 50.0::DOUBLE ELSE value END AS close,
                           1.0::DOUBLE AS volume
                    FROM events, (SELECT count(*) AS n FROM events)""",
        ),
        "chained_windows": _with(
            f"""SELECT ticker, date, {_rounded('past_ratio volume_share', 6)} FROM (
                  SELECT ticker, date, close / avg(past) OVER (w ROWS 49 PRECEDING) AS past_ratio,
                         (total - coalesce(lag(total, 30) OVER w, 0)) / total AS volume_share
                  FROM (SELECT ticker, date, close, lag(close, 100) OVER w AS past, sum(volume) OVER w AS total
                        FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date))
                  WINDOW w AS (PARTITION BY ticker ORDER BY date))""",
            "bars",
        ),
        "feed_quarantine": _with(
            """SELECT reason, count(*) AS lines, any_value(landed) AS landed,
                      any_value(good) AS rows, any_value(good) AS good_lines, any_value(landed - good) AS lines_put_aside
               FROM (SELECT *, CASE d WHEN '0' THEN 'not JSON of the schema' WHEN '1' THEN 'no ticker'
                                      WHEN '2' THEN 'no time' ELSE 'kept' END AS reason,
                            count(*) OVER () AS landed, count(*) FILTER (d NOT IN ('0', '1', '2')) OVER () AS good
                     FROM (SELECT substr(md5(headline), 1, 1) AS d FROM headlines))
               GROUP BY reason""",
            "headlines",
        ),
        "series_split": _with(
            f"""SELECT s.date, s.ticker,
                       {_rounded('SMA_5 SMA_30 EMA_12 EMA_26 RSI MACD MACD_signal MACD_hist MOM OBV', 4)},
                       v.filled AS vix, next_close
                FROM signals s JOIN with_vix v ON v.ticker = s.ticker AND v.date = s.date""",
            "signals", "with_vix",
        ),
        "vix_ffill": _with(
            "SELECT date, ticker, close, filled AS vix FROM with_vix", "with_vix"
        ),
        "direction_label": _with(
            """SELECT date, ticker, close, next_close, CAST(next_close > close AS INTEGER) AS label
                FROM numbered WHERE next_close IS NOT NULL""",
            "numbered",
        ),
        "warmup_trim": _with(
            """SELECT date, ticker, CAST(next_close > close AS INTEGER) AS label
               FROM numbered WHERE next_close IS NOT NULL AND rn >= 33""",
            "numbered",
        ),
        "tone_join_fill_a": _tone_join("best", "", 1, "b.vix"),
        "tone_join_fill_b": _tone_join("best", "cnn_", 0, "coalesce(b.vix, 0)"),
        "tone_join_mean_b": _tone_join("mean_tone", "cnn_", 0, "coalesce(b.vix, 0)"),
        "minmax_scale": _with(
            f"SELECT date, ticker, {_scaled('open high low close volume vix', 6)} FROM with_vix", "with_vix"
        ),
        "minmax_by_ticker": _with(
            f"SELECT date, ticker, {_scaled('open high low close volume', 6, 'PARTITION BY ticker')} FROM bars",
            "bars",
        ),
        "full_dataset": _with(
            f"""SELECT date, ticker, {_scaled(_DATASET, 5)}, {_rounded('pos neg neu next_close', 5)}, label
                FROM (SELECT s.*, v.filled AS vix, coalesce(t.pos, 0) AS pos, coalesce(t.neg, 0) AS neg,
                             coalesce(t.neu, 1) AS neu, CAST(s.next_close > s.close AS INTEGER) AS label
                      FROM signals s
                      JOIN with_vix v ON v.ticker = s.ticker AND v.date = s.date
                      LEFT JOIN best t ON t.ticker = s.ticker AND t.date = s.date
                      WHERE s.rn >= 33 AND s.next_close IS NOT NULL)""",
            "signals", "with_vix", "best",
        ),
        "split_cutoffs": _with("SELECT n_dates, val_start, test_start FROM cutoffs", "cutoffs"),
        "split_tag": _with("SELECT date, ticker, split FROM tagged", "tagged"),
        "split_counts": _with("SELECT split, count(*) AS rows FROM tagged GROUP BY split", "tagged"),
        "lookback_samples": _lookback(),
        "class_weight": _with(
            f"""SELECT count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg,
                      {_round('CAST(count(*) FILTER (label = 0) AS DOUBLE) / nullif(count(*) FILTER (label = 1), 0)', 6, 'pos_weight')}
               FROM tagged WHERE split = 'train'""",
            "tagged",
        ),
        "label_balance": _with(
            """SELECT CAST(next_close > close AS INTEGER) AS label, count(*) AS rows
               FROM numbered WHERE next_close IS NOT NULL GROUP BY 1""",
            "numbered",
        ),
        "holdout_split": _with(
            """SELECT doc_id, label,
                      CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20
                           THEN 'val' ELSE 'train' END AS part FROM corpus""",
            "corpus",
        ),
        "token_frequency": _with(
            "SELECT word, count(*) AS cnt FROM doc_words GROUP BY word", "doc_words"
        ),
        "vocab_topk": _with("SELECT word, CAST(idx AS INTEGER) AS idx, cnt FROM doc_vocab", "doc_vocab"),
        "encode_tokens": _with(
            """SELECT doc_id AS news_id,
                      array_to_string(list_resize(coalesce(any_value(l), []), 64, 0), ' ') AS ids
               FROM documents LEFT JOIN (
                 SELECT doc_id, list(idx ORDER BY pos) AS l FROM ids WHERE pos < 64 GROUP BY doc_id)
               USING (doc_id) GROUP BY doc_id""",
            "ids",
        ),
        "tone_nb_fit": _with(
            f"""SELECT word, CAST(idx AS INTEGER) AS idx, {_rounded('lp_neg lp_neu lp_pos', 6)}
                FROM vocab JOIN word_scores USING (idx)""",
            "vocab", "word_scores",
        ),
        "tone_nb_score": _with(
            f"""SELECT doc_id AS news_id, {softmax}
                FROM (SELECT *, greatest(s_neg, s_neu, s_pos) AS top FROM doc_scores)""",
            "doc_scores",
        ),
        "tone_batch_scorer": _with(
            f"""SELECT news_id, {_round('p / (p + n + u)', 6, 'pos')}, {_round('n / (p + n + u)', 6, 'neg')},
                      {_round('u / (p + n + u)', 6, 'neu')}
               FROM (SELECT news_id, CAST(length(headline) % 7 + 1 AS DOUBLE) AS p,
                            CAST(length(headline) % 5 + 1 AS DOUBLE) AS n,
                            CAST(length(headline) % 3 + 1 AS DOUBLE) AS u FROM headlines)""",
            "headlines",
        ),
        "binary_metrics": _with(_METRICS, "counts"),
        "confusion": _with(
            """SELECT model, label, count(*) FILTER (pred = 0) AS pred_0,
                      count(*) FILTER (pred = 1) AS pred_1 FROM predictions GROUP BY model, label""",
            "predictions",
        ),
        "class_report": _report(
            "SELECT model, label, pred FROM predictions", ["Down", "Up"], "model", "predictions"
        ),
        "class_report_tone": _report(
            """SELECT label, CASE WHEN neg >= neu AND neg >= pos THEN 0 WHEN neu >= pos THEN 1
                      ELSE 2 END AS pred FROM corpus JOIN scored ON news_id = doc_id""",
            ["neg", "neu", "pos"], "", "corpus", "scored",
        ),
        "weighted_log_loss": _with(f"SELECT {_round('avg(loss)', 6, 'loss')} FROM losses", "losses"),
        "batched_log_loss": _with(
            f"""SELECT {_round('avg(loss)', 6, 'loss')} FROM (
                 SELECT avg(loss) AS loss FROM (
                   SELECT (row_number() OVER (ORDER BY ticker, date) - 1) // 32 AS batch, loss
                   FROM losses) GROUP BY batch)""",
            "losses",
        ),
        "early_stop": _early_stop(),
        "history_json": _with(
            "SELECT model, epoch, train_loss, val_loss, val_acc FROM history", "history"
        ),
        "model_comparison": _with(_METRICS, "counts"),
        "feed_trouble": _with(
            """SELECT count(*) FILTER (NOT cut) AS rows, 1 AS missing_paths,
                      count(*) FILTER (cut) AS bad_lines, 0 AS skipped_files
               FROM (SELECT substr(md5(headline), 1, 1) = '0' AS cut FROM headlines)""",
            "headlines",
        ),
        "logit_class": _with(
            f"""SELECT ticker, date, {_round('1 / (1 + exp(-z))', 6, 'p')}, CAST(z > 0 AS INTEGER) AS pred
                FROM (SELECT *, (close - SMA_5) / SMA_5 AS z FROM rules)""",
            "rules",
        ),
        "metrics_json": _with(_METRICS, "counts"),
        "bars_filtered": _with(
            """SELECT * FROM bars WHERE ticker IN (1, 2, 3, 5, 8)
               AND date BETWEEN DATE '1993-06-01' AND DATE '1996-05-31'""", "bars",
        ),
        "confusion_every_class": _with(
            """SELECT model, c AS label, count(*) FILTER (label = c AND pred = 0) AS pred_0,
                      count(*) FILTER (label = c AND pred = 1) AS pred_1, 0 AS pred_other
               FROM predictions, (VALUES (0), (1)) classes(c) WHERE label = 1 GROUP BY model, c""",
            "predictions",
        ),
        "tone_vocabulary": _with(
            f"""SELECT CAST(size AS INTEGER) AS size, run, cnt FROM (
                  SELECT size, run, count(*) AS cnt FROM (
                    SELECT size, array_to_string(ws[i:i + size - 1], ' ') AS run FROM (
                      SELECT ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM (
                        SELECT list_filter(string_split_regex(lower(sentence), '{_SPACES}'), lambda x: x <> '') AS ws
                        FROM corpus
                        WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 20),
                        (VALUES (1), (3), (4), (5)) sizes(size)))
                  GROUP BY size, run)
                QUALIFY row_number() OVER (PARTITION BY size ORDER BY cnt DESC, run) <= 20000""",
            "corpus",
        ),
        "direction_fit": _with(
            f"""SELECT split, count(*) AS samples, count(*) FILTER (label = 1) AS ups,
                       {_round("CASE WHEN split <> 'test' THEN ln(2) * avg(CASE WHEN label = 1 THEN pos_weight ELSE 1 END) END", 6, "untrained_loss")}
                FROM ({_SAMPLES}), (SELECT count(*) FILTER (label = 0) / count(*) FILTER (label = 1) AS pos_weight
                                    FROM tagged WHERE split = 'train')
                GROUP BY split""",
            "tagged", rules=_LABELLED,
        ),
        "direction_predict": _fixed_models(
            f"SELECT model, ticker, date, label, {_round('logit', 4, 'logit')}, pred FROM said"),
        "direction_metrics": _fixed_models(_METRICS),
        "direction_evaluate": _with(
            f"""SELECT model, c AS label, count(*) FILTER (label = c) AS predictions, true AS fits
                FROM ({_SAMPLES}), (VALUES (0), (1)) classes(c),
                     (VALUES ('baseline'), ('cnn_fusion'), ('finbert_fusion')) models(model)
                WHERE split = 'test' GROUP BY model, c""",
            "tagged", rules=_LABELLED,
        ),
    }
