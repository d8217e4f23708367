"""A corpus from documents to training order, one operator per stage.

Every stage takes whole tables and whole texts, and every stage but the last returns the columns
of ``documents``. Defined cases: an empty table passes through; rows without an id, repeated rows
and further columns are kept like others; a row without a text goes in the first stage, as its
language is unknown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertone.llm import decontaminate, jaccard, language, mixing, training_order
from tickertone.llm.catalog import MIX
from tickertone.llm.frames import unused
from tickertone.session import stage

RULE = jaccard.Rule(words=5, num=80, den=100)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; those without a letter go, and those further from every
    language than the labelled documents that it is learned from."""
    name = unused(docs, "__language")
    profiles = language.learn(docs)
    least = language.least_score(docs, profiles)
    found = language.with_language(docs, profiles, out=name, score=f"{name}_score")
    known = (F.col(name) != language.UNKNOWN) & (F.col(f"{name}_score") >= least)
    return found.where(known).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return jaccard.one_per_component(docs, RULE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    name = unused(docs, "__leaks")
    found = decontaminate.with_leaks(docs, benchmark, out=name)
    return found.where(F.size(name) == 0).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mixture, once per epoch that takes them."""
    return mixing.mixture(docs, MIX)


def in_training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; their manifest is returned."""
    return training_order.write_shards(docs, training_order.new_folder(spark))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID binary output", in_training_order),
]

ORACLE_SQL = None  # models and token files are beyond SQL; tests/llm holds it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``, each to what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
