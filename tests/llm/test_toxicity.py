import math
import zlib

import numpy as np

from loomprep.llm import toxicity as T
from loomprep.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_score_equals_a_plain_sum_over_distinct_features(spark):
    texts = [None, "", "You IDIOT, you idiot!", "a b a b a b", "été été — été", "x " * 5000]
    df = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)],
                               "doc_id long, text string, weights long")
    rows = T.distinct_features([(t or "").encode() for t in texts])
    rng = np.random.default_rng(1)
    weights = {0: -0.5} | {int(c): float(np.float32(rng.normal())) for r in rows for c in r}
    got = {r.doc_id: r.score for r in T.score(df, weights).collect()}
    for k, row in enumerate(rows):
        total = weights[0] + sum(weights[int(c)] for c in row)
        assert abs(got[k] - 1 / (1 + math.exp(-total))) < 1e-5
    assert got[0] == got[1]


def test_learned_only_from_rows_not_held_out(spark):
    """Labels of held-out rows are turned around; nothing changes."""
    rows, labels, turned = [], [], []
    for k in range(300):
        bad = k % 5 == 0
        rows.append((k, ("good words here " + ("awful " if bad else "") + f"n{k % 7}") if k else None))
        labels.append((k, int(bad)))
        held = zlib.crc32(str(k).encode()) % 3 == 1
        turned.append((k, int(bad != held)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    schema = "doc_id long, toxic int"
    a = T.fit(docs, spark.createDataFrame(labels + [(1, None), (None, 1)], schema))
    b = T.fit(docs, spark.createDataFrame(turned, schema))
    assert a == b and a
    got = {r.doc_id: r.score for r in T.score(docs, a).collect()}
    assert all((got[k] > 0.7) == bool(y) for k, y in labels if k)


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in T.score(docs, T.fit(docs, labels)).collect()] == [0.5]
    assert T.score(docs.limit(0), {}).count() == 0


def test_held_out_accuracy(spark):
    out = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    above = sum((a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean)
    assert above / (len(toxic) * len(clean)) > 0.97
    assert sum(r.predicted for r in toxic) > 0.65 * len(toxic)
    assert sum(r.predicted for r in clean) < 0.005 * len(clean)


def test_query_columns(spark):
    out = QUERIES["op5_toxicity"](spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
