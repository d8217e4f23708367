"""Small tables of documents."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **columns):
    """Texts as rows of documents; ``columns`` gives lists for other columns than the text."""
    rows = [
        (
            columns.get("doc_id", range(len(texts)))[i], t, columns.get("lang", ["en"] * len(texts))[i],
            columns.get("source", ["src0"] * len(texts))[i], None if t is None else len(t),
        )
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def prose(seed, n, words=400):
    """``n`` words of a small made-up language."""
    r = random.Random(seed)
    lexicon = [f"w{i}" for i in range(words)]
    return " ".join(r.choice(lexicon) for _ in range(n))


#: Nulls, empty and odd texts, which every operator takes.
ODD = [None, "", " \t\n", "\n\n", "a", "é ß 😀", "x" * 5000, "A b C", "\x00 \x1c y", "1 2 3 4 " * 2000]
