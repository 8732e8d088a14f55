import math
import random

import pytest
from pyspark.sql import functions as F

from loomprep.llm import hard_negatives as H
from loomprep.sources.tables import table


def brute(rows, is_anchor, lower=80, upper=100, positives=5, negatives=5, scale=256):
    """rows: (vec_id, label, vector); plain loops over integers."""
    whole = []
    for i, y, v in rows:
        if i is None or y is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, y, tuple(math.floor(scale * x) for x in v))
        if row not in whole:
            whole.append(row)
    sizes = [len(r[2]) for r in whole]
    whole = [r for r in whole if len(r[2]) == max(sizes, key=lambda n: (sizes.count(n), n))]
    out = []
    for i, y, v in whole:
        if not is_anchor(i):
            continue
        scored = [(-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j, z)
                  for j, z, w in whole]
        mine = sorted(s for s in scored if s[2] == y and s[1] != i)[:positives]
        for p, j, _ in mine:
            window = sorted(s for s in scored if s[2] != y and lower * -p <= 100 * -s[0] <= upper * -p)
            out += [(i, j, k + 1, n[1], -p, -n[0]) for k, n in enumerate(window[:negatives])]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(df, **kw):
    every = kw.pop("every", 3)
    return sorted(tuple(r[c] for c in COLUMNS)
                  for r in H.mine_hard_negatives(df, F.col("vec_id") % every == 0, **kw).collect())


def random_rows(n, d, labels, seed, spread=1.0):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, spread) for _ in range(d)] for _ in range(labels)]
    out = []
    for i in range(n):
        y = rng.randrange(labels)
        out.append((i, y, [c + rng.gauss(0, 1) for c in centre[y]]))
    return out


@pytest.mark.parametrize("group_rows", [7, 40, 10_000])
def test_against_plain_loops(spark, group_rows):
    rows = random_rows(120, 6, 3, 1, 0.3)
    rows += [(i + 500, y, [float(round(x)) for x in v]) for i, y, v in random_rows(60, 6, 4, 2, 0.1)]   # many ties
    df = spark.createDataFrame([(i, y, v, 1, "a") for i, y, v in rows],
                               "vec_id long, label int, embedding array<double>, score int, slot string")
    want = brute(rows, lambda i: i % 3 == 0)
    assert len(want) > 100
    assert mined(df, group_rows=group_rows) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (0, 1, [0.5, 0.0]), (0, 2, [0.9, 0.0]), (1, 1, [1.0, 2.0]),
            (2, 2, [0.9, 0.1]), (2, 2, [0.9, 0.1]), (3, 2, [0.95, 0.0]), (4, None, [1.0, 1.0]), (5, 1, None),
            (6, 2, [nan, 1.0]), (7, 2, [inf, 1.0]), (8, 2, [None, 1.0]), (9, 2, []), (10, 2, [1.0]),
            (None, 2, [0.9, 0.0]), (12, 3, [0.0, 0.0]), (15, 3, [0.0, 0.0]), (16, 1, [-1.0, 0.0]),
            (18, 4, [1.0, 1.0]), (19, 2, [1e308, 0.0])]
    schema = "vec_id long, label int, embedding array<double>"
    rows_known = [r for r in rows if r[0] != 19]            # 256e308 is no double: takes no part
    assert mined(spark.createDataFrame(rows, schema)) == brute(rows_known, lambda i: i % 3 == 0)
    assert mined(spark.createDataFrame([], schema)) == []
    assert mined(spark.createDataFrame([(1, None, None)], schema)) == []
    # integers beyond a double's precision, and scores beyond a long
    rows = [(0, 1, [3e6, 1.0]), (1, 1, [3e6, 0.5]), (2, 2, [3e6, 0.25]), (4, 2, [2.9e6, -7.5]), (5, 1, [2.9e6, -8.0])]
    assert mined(spark.createDataFrame(rows, schema)) == brute(rows, lambda i: i % 3 == 0)
    rows = [(0, 1, [3e12]), (1, 1, [2e12]), (2, 2, [1.9e12]), (3, 1, [-2e12])]
    got = mined(spark.createDataFrame(rows, schema))
    assert got and all(r[4] == 2**63 - 1 for r in got)


def test_other_windows(spark):
    rows = random_rows(90, 4, 3, 8, 0.5)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for lower, upper in ((50, 95), (90, 130), (33, 67)):
        assert mined(df, lower=lower, upper=upper, positives=4, negatives=7) == brute(
            rows, lambda i: i % 3 == 0, lower, upper, 4, 7)


def test_query(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in table(spark, path, "embeddings").collect()]
    got = H.op13_hard_negatives(spark, path)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int",
                                "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == brute(rows, lambda i: i % 100 == 0)
