import pytest
from corpus import DOCS, ODD, documents
from pyspark.sql import functions as F


@pytest.fixture
def odd(spark):
    """Odd rows, with a missing id, language and source, repeated rows and clashing columns."""
    docs = documents(
        spark, ODD + ODD[5:8], doc_id=[None, *range(1, len(ODD)), *range(5, 8)],
        lang=["en", None] + ["de"] * (len(ODD) + 1), source=[None, "src1"] + ["x"] * (len(ODD) + 1),
    )
    clashing = ["__row", "n", "key", "score", "taken", "leaks", "slot", "__leaks", "__language", "domain", "copies"]
    return docs.select("*", *[F.lit(1).alias(c) for c in clashing])


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCS)
