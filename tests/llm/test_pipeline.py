import random

import corpus_pipeline
import numpy as np
from samples import prose

from test_decontaminate import brute as brute_hits
from test_secrets_scan import brute as brute_spans
from test_simhash import brute as brute_groups

from tollgate.llm import kneser_ney, queries


def test_stages_equal_brute_force(spark, sf_dir, docs, corpus):
    rng = random.Random(6)
    clean = [(i, f"{t} password=abcdef0123456789" if i % 9 == 0 else t) for i, t in corpus]
    rows = clean + [(500 + i, prose(rng, 50)) for i in range(60)] + [(800 + i, "BUY NOW!! " * 30) for i in range(5)]
    items = [(i, " ".join(t.split()[:20])) for i, t in clean[:3] if t]
    labels = spark.createDataFrame([(500 + i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    path = sf_dir(rows, benchmark=spark.createDataFrame(items, "item_id long, text string"), labels=labels)

    frame = spark.read.parquet(f"{path}/documents.parquet")
    left = [(r["doc_id"], r["text"]) for r in kneser_ney.keep_good(frame, labels).collect()]
    assert not any(i >= 800 for i, _ in left) and all(i in dict(left) for i in range(500, 560))
    group = brute_groups(left)
    left = [(i, t) for i, t in left if group[i][1] == i]
    hits = brute_hits(left, items)
    left = [(i, t) for i, t in left if not hits[i][4]]

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(got) == {i for i, _ in left}
    codec = queries.sentencepiece_codec.Codec(open(queries.MODEL_FILE, "rb").read(), 1)
    for i, text in left:
        said = codec.decode(got[i]["ids"])
        assert got[i]["parity"]
        if not brute_spans(text):
            assert said == codec.decode(np.frombuffer(codec.encode([text or ""])[0], "<i4"))
        else:
            assert not brute_spans(said)


def test_stages_keep_the_columns_of_documents(spark, sf_dir, docs):
    rows = [(1, "a b c", "en"), (1, "a b c", "en"), (None, None, None), (3, "x y z", "de")]
    bench = spark.createDataFrame([], "item_id long, text string")
    path = sf_dir(rows, benchmark=bench, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    frame = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, path)
        assert out.columns == frame.columns and out.count() == 4
    assert corpus_pipeline.run(spark, path).count() == 4
    assert len(corpus_pipeline.STAGES) == 5
