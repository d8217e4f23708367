"""URL filter: rules where they fit, gradient-boosted trees over lexical features elsewhere.

1. A URL is cut into host, path and query with string functions. The longest rule whose host is the
   URL's or above it, and whose path the URL's path starts with, decides.
2. The URLs that a rule decides are the labelled ones, or a table of labelled URLs is given. Over
   all different ones it is counted how often each host suffix (one and two labels) and each first
   path segment is blocked. A training row's own label is taken out of its counts again.
3. Trees are boosted on length, depth, digit ratio, entropy, parameter counts, other counts of the
   same sort and the smoothed rates. At most ``sample`` different URLs of each label are learned
   from, those with the smallest hashes; all counts are over all URLs.
4. Every other URL gets the trees' verdict.

DataFrame functions and Spark's own trees only. The counts are staged and joined by key: Spark
broadcasts them while they are small and splits hot suffixes when they are not.

Defined cases: a URL that is null or has no ``://`` has an empty host and path, fits no rule and is
judged by its other features; without any labelled URL every undecided one gets ``default``; labels of
one URL that disagree count as blocked; repeated rows get equal results; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

SAMPLE = 10_000   # different labelled URLs of each label that trees learn from
SMOOTHING = 10.0  # labelled URLs that the overall rate weighs as much as
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SHAPE = (
    "length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio",
    "entropy", "n_params", "param_length", "n_hyphens", "has_extension", "has_fragment", "is_secure",
)
KEYS = ("suffix", "domain", "segment")
FEATURES = (*SHAPE, *[f"{k}_{x}" for k in KEYS for x in ("rate", "support")])


@dataclass(frozen=True)
class Rule:
    """Blocks or allows a host and all below it, for paths that start with ``path``."""

    block: bool
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), *LETTERS), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _first(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits."""
    found = F.lit(None)
    for rule in sorted(set(rules), key=lambda r: (len(r.text), r.text)):
        below = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
        found = F.when(below & F.startswith(path, F.lit(rule.path)), F.lit(value(rule))).otherwise(found)
    return found


def _share(part: Column, whole: Column) -> Column:
    return F.when(F.length(whole) > 0, F.length(part) / F.length(whole)).otherwise(0.0)


def _entropy(text: Column) -> Column:
    """Bits a character, of a text's own distribution of characters."""
    size = F.length(text)
    shares = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size,
    )
    bits = F.aggregate(shares, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(size > 0, bits).otherwise(0.0)


def with_shape(urls: DataFrame) -> DataFrame:
    """``url`` with its parts, the keys of its statistics, and the features of its own text."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    digits = r"[^0-9]"
    labels, parts = F.split("host", r"\."), F.filter(F.split("path", "/"), lambda x: x != "")
    count = {
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "depth": F.size(parts), "host_labels": F.when(host != "", F.size(labels)).otherwise(0),
        "digit_ratio": _share(F.regexp_replace(url, digits, ""), url),
        "host_digit_ratio": _share(F.regexp_replace(host, digits, ""), host),
        "entropy": _entropy(url),
        "n_params": F.size(F.filter(F.split(query, "&"), lambda x: x != "")),
        "param_length": F.length(query), "n_hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit(""))),
        "has_extension": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"),
        "is_secure": F.startswith(url, F.lit("https://")).cast("int"),
    }
    cut = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return cut.withColumns({name: c.cast("double") for name, c in count.items()}).withColumns({
        "suffix": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2),
        "segment": F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")),
    })


def statistics(labelled: DataFrame) -> DataFrame:
    """How many different labelled URLs have each suffix, domain and first segment, and how many
    of them are blocked (kind, key, n, blocked)."""
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in KEYS]))
    return labelled.select("blocked", keys.alias("k")).groupBy("k.kind", "k.key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("blocked")
    )


def with_rates(rows: DataFrame, stats: DataFrame, prior: float, own: Column | None = None) -> DataFrame:
    """The smoothed share of blocked URLs for each key, without the row's own label if it has one."""
    for key in KEYS:
        counts = stats.where(F.col("kind") == key).select(
            F.col("key").alias(key), F.col("n").alias("key_n"), F.col("blocked").alias("key_blocked")
        )
        n, blocked = F.coalesce("key_n", F.lit(0)), F.coalesce("key_blocked", F.lit(0))
        if own is not None:
            n, blocked = n - 1, blocked - own
        rows = rows.join(counts, key, "left").withColumns({
            f"{key}_rate": (blocked + SMOOTHING * prior) / (n + SMOOTHING),
            f"{key}_support": F.log1p(n.cast("double")),
        }).drop("key_n", "key_blocked")
    return rows


def _sampled(labelled: DataFrame, counts: dict[int, int], sample: int) -> DataFrame:
    """At most ``sample`` URLs of each label: the smallest hashes, found among few by a first cut."""
    parts = []
    for label, n in counts.items():
        share = min(1.0, 2.0 * sample / n)
        mine = labelled.where(F.col("blocked") == label).withColumn("hash", F.xxhash64("url"))
        near = mine.where(F.pmod("hash", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
        parts.append(near.orderBy(F.pmod("hash", F.lit(1 << 20)), "hash", "url").limit(sample).drop("hash"))
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


@dataclass(frozen=True)
class Filter:
    """Trees and the statistics they need."""

    model: GBTClassificationModel
    stats: DataFrame
    prior: float

    def score(self, shaped: DataFrame) -> DataFrame:
        """Rows of ``with_shape`` with ``score``, the trees' probability of blocking."""
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
            with_rates(shaped, self.stats, self.prior)
        )
        scored = self.model.transform(rows)
        return scored.withColumn("score", vector_to_array("probability")[1])


def learn(labelled: DataFrame, sample: int = SAMPLE, trees: int = 20, depth: int = 4, seed: int = 7) -> Filter | None:
    """Boosted trees from labelled URLs (url, blocked); nothing if there are none."""
    once = labelled.where("url IS NOT NULL").groupBy("url").agg(F.max(F.col("blocked").cast("int")).alias("blocked"))
    shaped = stage(with_shape(once), "labelled-urls")
    counts = {r.blocked: r.n for r in shaped.where("blocked IS NOT NULL").groupBy("blocked").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    shaped = shaped.where("blocked IS NOT NULL")
    prior = counts.get(1, 0) / sum(counts.values())
    stats = stage(statistics(shaped), "url-statistics")
    rows = with_rates(_sampled(shaped, counts, sample), stats, prior, own=F.col("blocked"))
    rows = stage(rows.select("url", F.col("blocked").cast("double").alias("label"), *FEATURES), "url-sample")
    features = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed).fit(features)
    return Filter(model, stats, prior)


def judge(
    pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, page_id="page_id", url="url",
    default: str = "allow", sample: int = SAMPLE,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' score of every row."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    host, path = F.col("host"), F.col("path")
    ruled = {
        "rule": _first(rules, host, path, lambda r: r.text).cast("string"),
        "rule_blocks": _first(rules, host, path, lambda r: r.block).cast("boolean"),
    }
    if labelled is None:
        cut = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumns(ruled)
        labelled = cut.where("rule IS NOT NULL").select("url", F.col("rule_blocks").alias("blocked"))
    found = learn(labelled, sample)
    shaped = with_shape(rows).withColumns(ruled)
    if found is None:
        scored = shaped.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = found.score(shaped)
    own = F.when(F.col("score").isNull(), F.lit(default)).when(F.col("score") > 0.5, "block").otherwise("allow")
    verdict = F.when(F.col("rule_blocks"), "block").when(~F.col("rule_blocks"), "allow").otherwise(own)
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
