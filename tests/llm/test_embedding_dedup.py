import math

import numpy as np
import pytest

from loomprep.llm import embedding_dedup as E


def brute(rows, threshold):
    ok = [k for k, (i, v, l) in enumerate(rows)
          if i is not None and l is not None and v and all(
              x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in range(len(rows))}
    for a in ok:
        for b in ok:
            x, y = rows[a], rows[b]
            if a < b and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, w = np.array(x[1], np.float64), np.array(y[1], np.float64)
                if u @ w / np.linalg.norm(u) / np.linalg.norm(w) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(links[k]), least, i is None or i == least))
    return sorted(out, key=repr)


def vectors(seed, n=260, d=24):
    rng = np.random.default_rng(seed)
    f = lambda v: [float(np.float32(x)) for x in v]
    rows = [(None, f(np.ones(d)), 1), (900, None, 1), (901, [], 1), (902, [0.0] * d, 1),
            (903, [1.0, None] + [1.0] * (d - 2), 1), (904, [float("nan")] + [1.0] * (d - 1), 1),
            (905, [float("inf")] + [1.0] * (d - 1), 1), (906, f(np.ones(d)), None),
            (907, f(np.ones(d)), 1), (908, f(np.ones(d) * 2), 1), (907, f(np.ones(d)), 1),
            (909, [1.0] * 7, 1), (910, [1.0] * 7, 1), (911, [-0.0, 1.0], 2), (912, [0.0, 1.0], 2)]
    base = rng.normal(size=(12, d))
    ids = rng.permutation(5000)
    for k in range(n):
        v = rng.normal(size=d) if rng.random() < 0.4 else (
            base[rng.integers(12)] + rng.normal(size=d) * rng.choice([0, 0.05, 0.2]))
        rows.append((int(ids[k]) * 2 + 5000, f(v), int(rng.integers(3))))
    return rows + rows[40:60]


@pytest.mark.parametrize("block", [2048, 16])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "GROUP_ROWS", 800)
    rows = vectors(3)
    schema = "vec_id long, embedding array<float>, label int, n int, rep int"
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], schema)
    got = E.link_vectors(df, 0.93, 1e-6)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 0.93)


def test_empty_and_all_unusable(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert E.link_vectors(spark.createDataFrame([], schema)).count() == 0
    got = E.link_vectors(spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], schema)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = E.hadamard(x) / 4
    assert np.allclose(y @ y.T, x @ x.T)
    assert np.allclose(E.hadamard(y) / 4, x)


def test_recall_on_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(2, 3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b = 0.93 * a + math.sqrt(1 - 0.93 ** 2) * b / np.linalg.norm(b, axis=1)[:, None]
    tables = E.tables_needed(64, 2, 0.93, E.MISS)
    label = np.zeros(3000, np.int64)
    x, y = E.buckets(a, label, tables, 2), E.buckets(b, label, tables, 2)
    assert (x[:, :, None] == y[:, None, :]).any((1, 2)).mean() > 0.99


def test_query_matches_all_pairs_on_a_table(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in
            spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = sorted(map(tuple, E.op10_embedding_dedup(spark, path).collect()), key=repr)
    labels = np.array([r[2] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = (x @ x.T >= 0.93) & (labels[:, None] == labels) & ~np.eye(len(x), dtype=bool)
    assert {r[0]: r[1] for r in got} == {r[0]: int(n) for r, n in zip(rows, link.sum(1))}


def test_memory_follows_the_rows_of_a_block(monkeypatch):
    """Many near vectors in one bucket: all pairs are linked, few are held at a time."""
    import tracemalloc

    import pyarrow as pa
    monkeypatch.setattr(E, "PENDING", 20_000)
    rng = np.random.default_rng(2)
    n, d = 3000, 16
    x = (np.ones(d) + rng.normal(size=(n, d)) * 1e-3).astype("<f4")
    label = np.zeros(n, np.int64)
    at = E.buckets(x.astype(np.float64), label, 2, 1)
    bucket, count = np.unique(at, return_counts=True)
    everywhere = bucket[count == n]
    assert len(everywhere)
    zero = [0] * n
    rows = pa.table({"bucket": [int(everywhere[0])] * n, "label": label, "rep": range(n), "n": [1] * n,
                     "vector": [v.tobytes() for v in x], "block": zero, "block_a": zero, "block_b": zero})
    tracemalloc.start()
    got = E._verify(2, 1, 0.93, "<f4")(None, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(got["links"].to_pylist()) == {n - 1} and set(got["root"].to_pylist()) == {0}
    assert peak < 128 << 20                  # all 4,498,500 pairs at once take several times as much
