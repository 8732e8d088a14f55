import random

import duckdb
import pytest
from pyspark.sql import functions as F

from loomprep.llm import mixing


def water_fill(sizes, weights=(5, 2, 1), repeats=3):
    """Reshare step by step, as the contract words it."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, float(sum(sizes.values()))
    while True:
        left = total - sum(capped.values())
        rest = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[t] for t in rest) for s in rest}
        over = {s: float(repeats * sizes[s]) for s in rest if share[s] > repeats * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def rows(seed=1, n=400):
    rng = random.Random(seed)
    names = ["b", "a", "Z", "é", "日", None, "tiny", "none"]
    out = [(1, None, "none", 3), (2, "", "none", 4), (None, "x y", "a", 0), (None, None, None, 0)]
    for k in range(n):
        s = rng.choices(names[:7], [40, 10, 5, 5, 2, 3, 1])[0]
        out.append((100 + k, "w x " * rng.choice([0, 1, 3, 20, 400]) + "\tq\x0b", s, k))
    return out + rng.sample(out, 20)


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_reaches_the_targets(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, "doc_id long, text string, source string, target long")
    got = mixing.mix_sizes(df).collect()
    assert len(got) == len(data)
    sizes: dict = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = water_fill(sizes)
    for s, size in sizes.items():
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {size}
        assert own[0].target == pytest.approx(want[s])
        assert all(r.taken <= 3 * r["size"] for r in own)
        slack = max([r["size"] for r in own], default=0) * 2
        assert abs(sum(r.taken for r in own) - want[s]) <= slack
    again = mixing.mix_sizes(df.orderBy(F.rand(7))).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies for r in got)


def test_mix_matches_sql(spark):
    data = rows(5)
    df = spark.createDataFrame(data, "doc_id long, text string, source string, target long")
    con = duckdb.connect()
    frame = df.toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con.register("documents", frame)
    have = mixing.mix_sizes(df).select("doc_id", "size", "source_size", "target", "taken")
    want = con.execute(mixing.OP4_SQL).fetchall()
    key = lambda r: (str(r[0]), r[1], r[2], round(r[3], 6), r[4])
    assert sorted(map(key, have.collect())) == sorted(map(key, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sizes(df).count() == 0
    assert mixing.mix_documents(df).count() == 0
