"""Every operator of this folder as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontaminate, jaccard, language, mixing, personal, quality, secrets, spelling, substrings,
    training_order, trie, urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"))


@query
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.scan(table(spark, folder, "documents"))


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op3_chat_preferences(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_preferences(table(spark, folder, "conversations"))


MIX = mixing.Mix(
    weights={
        "domain": {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0},
        "lang": {"en": 4.0, "de": 3.0, "fr": 2.0, "es": 1.0},
    },
    share=0.6, max_epochs=2, seed=7,
)


@query
def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    taken = mixing.select(docs, mixing.plan(docs, MIX), MIX, "taken")
    return taken.select("doc_id", "taken.*").withColumnRenamed("budget", "leaf_budget")


@query
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.jaccard_classes(
        table(spark, folder, "documents"), jaccard.Rule(words=4, num=85, den=100)
    )
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents")).drop("kept_text")


@query
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op1_training_order(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return training_order.write_shards(docs, training_order.new_folder(spark))


URL_RULES = [
    urls.Rule(False, "com", "/"), urls.Rule(True, "example.com", "/en/"), urls.Rule(False, "www.example.com", "/en/"),
    urls.Rule(True, "net", "/es/"), urls.Rule(True, "net", "/fr/"),
]


@query
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


@query
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    conv = F.col("conv")
    head = F.crc32(conv.cast("string").cast("binary")) % 4
    return trie.prefix_trie(table(spark, folder, "conversations"), base=conv - conv % 20, head=head)


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words with a few letters lost: one code point of each run whose checksum 97 divides."""
    docs = table(spark, folder, "documents")
    run, size = F.col("run"), F.length("run")
    check = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    read = docs.select("doc_id", spelling.runs(F.col("text")).alias("run")).where(size >= spelling.LEAST_LENGTH)
    read = read.withColumn("run", spelling.lowered(run))
    lost = spelling.without_character(run, F.pmod("check", size).cast("int"))
    words = read.withColumn("check", check).select(F.when(F.col("check") % 97 == 0, lost).otherwise(run).alias("word"))
    found = spelling.variants(spelling.counted(words))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
