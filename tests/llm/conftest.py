import random

import pytest
from pyspark.sql import types as T
from samples import ODD, prose

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("id", T.StringType()),  # clashes with names used inside the operators
    T.StructField("count", T.StringType()),
    *(T.StructField(c, T.StringType()) for c in ("_gone", "_p", "_keep", "_lang", "_trusted", "_own_byte", "row", "keep")),
])


@pytest.fixture
def docs(spark):
    """A documents frame from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None if r[1] is None else len(r[1]), "x", None, *["own"] * 8) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def sf_dir(tmp_path, docs):
    """Writes tables to a folder and returns its path."""

    def write(rows, **tables):
        docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def corpus():
    """Invented documents with exact and near copies, shared passages and odd texts."""
    rng = random.Random(7)
    rows = [prose(rng, rng.randrange(1, 120)) for _ in range(50)]
    shared = [prose(rng, 30) for _ in range(4)]
    for i in range(20):
        base = rows[rng.randrange(50)]
        words = base.split()
        words[rng.randrange(len(words))] = "changed"
        rows.append(base if i % 2 else " ".join(words))
        rows.append(prose(rng, 20) + " " + shared[i % 4] + " " + prose(rng, 15))
    rows += ODD
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))
