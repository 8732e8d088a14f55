import numpy as np

from loomprep.llm import vector_search as V


def brute(rows, every=20, top=20):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i, tuple(v)] = np.array(v, np.float64)
    size = max({len(v) for v in good.values()}, key=lambda d: sum(len(v) == d for v in good.values()),
               default=0)
    good = {k: v for k, v in good.items() if len(v) == size}
    out = {}
    for (q, _), v in good.items():
        if q % every == 0:
            best: dict = {}
            for (i, _), w in good.items():
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float(v @ w))
            out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:top]
    return out


def check(got, want, least):
    by: dict = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    hit = total = 0
    for q, best in want.items():
        own = sorted(by.pop(q, []), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(own) + 1))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        scores = dict(best)
        assert len(own) == len(best)
        hit += sum(r.vec_id in scores for r in own)
        total += len(best)
        assert all(abs(r.score - scores[r.vec_id]) < 1e-12 for r in own if r.vec_id in scores)
    assert not by
    assert hit >= least * total


def test_recall_and_exact_scores_on_a_table(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = V.op3_vector_search(spark, path).collect()
    assert len(got) == 20 * sum(i % 20 == 0 for i, _ in rows)
    check(got, brute(rows), 0.95)


def test_unequal_norms_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(V, "LIST_ROWS", 30)
    monkeypatch.setattr(V, "QUERY_ROWS", 7)
    rng = np.random.default_rng(4)
    rows = [(None, [1.0] * 8), (20, None), (40, []), (60, [0.0] * 8), (80, [1.0, None] + [1.0] * 6),
            (100, [float("nan")] * 8), (120, [float("inf")] + [1.0] * 7), (140, [1.0] * 3)]
    rows += [(200 + k, [float(np.float32(x)) for x in rng.normal(size=8) * rng.choice([0.1, 1, 9])])
             for k in range(300)]
    rows += [(1000 + k, rows[30][1]) for k in range(30)] + rows[20:30]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "vec_id long, embedding array<float>, list int, bound int")
    check(V.search(df).collect(), brute(rows), 0.95)


def test_every_query_gets_its_number(spark, monkeypatch):
    """Lists smaller than the result, of which one is probed: the rest is found again."""
    centres = V.Index._centres
    monkeypatch.setattr(V.Index, "_centres", lambda self, lists, rng: centres(self, 60, rng))
    monkeypatch.setattr(V.Index, "_probes", lambda self, sample, rng: 1)
    rng = np.random.default_rng(6)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=12)]) for k in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check(V.search(df).collect(), brute(rows), 0.5)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert V.search(spark.createDataFrame([], schema)).count() == 0
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    got = [tuple(r) for r in V.search(spark.createDataFrame(rows, schema)).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 65)) @ np.linalg.qr(rng.normal(size=(65, 65)))[0]
    q = rng.normal(size=(50, 65))
    far = V.distances(q, x)
    bound = np.partition(far, 19, axis=1)[:, 19]
    a, b = V.adaptive_scan(q, bound, x)
    kept = set(zip(a.tolist(), b.tolist()))
    near = np.argsort(far, axis=1)[:, :20]
    assert sum((i, j) in kept for i in range(50) for j in near[i].tolist()) > 0.95 * 1000
    assert len(kept) <= 1000 + 5
