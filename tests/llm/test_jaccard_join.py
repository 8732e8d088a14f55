import random
import re

import numpy as np
import pytest

from loomprep.llm import jaccard_join as J
from loomprep.llm.graph import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, n=5):
    w = WORD.findall(text or "")
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0]) and (
                    len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])):
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        copies = [rows[j][0] for j in links[k] | {k} if sets[j] == sets[k]] if sets[k] and i else [i]
        out.append((i, None if i is None else min(rows[j][0] for j in seen), len(links[k]),
                    min(copies) if i is not None else None))
    return sorted(out, key=repr)


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["été", "日本"]
    base = [rng.choices(vocabulary, k=rng.choice([3, 8, 40, 120, 400])) for _ in range(20)]
    rows = [(None, "a b c d e f"), (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a"), (6, "a b"),
            (7, "a b c d"), (8, "a  b\nc d"), (9, "x " * 3000), (10, "x " * 40)]
    for k in range(n):
        words = list(rng.choice(base)) if rng.random() < 0.7 else rng.choices(vocabulary, k=60)
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((100 + k, rng.choice([" ", "\n"]).join(words)))
    rows += rng.sample(rows[11:], 10)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "doc_id long, text string, key string, n int")
    got = J.jaccard_join(df, miss=1e-5)
    assert got.columns == ["doc_id", "class_id", "n_links", "copy_of"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_blocks_by_members_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(J, "DOCS", 5)
    monkeypatch.setattr(J, "PENDING", 3)
    rows = corpus(seed=2, n=80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.jaccard_join(df, miss=1e-5).collect()), key=repr) == brute(rows)


def test_memory_follows_the_rows_of_a_block():
    import tracemalloc

    import pyarrow as pa
    n = 2000
    sets = [np.sort(np.array([*range(45), 1000 + k], np.uint64)).tobytes() for k in range(n)]
    zero = [0] * n
    rows = pa.table({"rep": list(range(n)), "n": [1] * n, "group": zero, "block": zero,
                     "block_a": zero, "block_b": zero, "shingles": sets})
    tracemalloc.start()
    got = J._verify(0.8)(None, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(got["links"].to_pylist()) == {n - 1} and set(got["root"].to_pylist()) == {0}
    assert peak < 32 << 20


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_join(df).count() == 0


def test_query_on_a_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert sorted(map(tuple, J.op7_jaccard_join(spark, path).collect()), key=repr) == brute(rows)


def test_banding_reaches_its_recall():
    for threshold, miss in ((0.8, 0.005), (0.5, 0.01), (0.95, 1e-4)):
        bands, rows = J.banding(threshold, miss)
        assert (1 - threshold ** rows) ** bands <= miss
    bands, rows = J.banding(0.8, 0.005)
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(400):
        common = rng.integers(0, 2 ** 63, 80).astype(np.uint64)
        extra = rng.integers(0, 2 ** 63, 20).astype(np.uint64)
        h = J.band_hashes([np.concatenate((common, extra[:10])),
                           np.concatenate((common, extra[10:]))], bands, rows)
        met += (h[0] == h[1]).any()
    assert met >= 0.98 * 400


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(100, 140)] + [(rng.randrange(80), rng.randrange(80))
                                                     for _ in range(60)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    label = {v: v for e in links for v in e}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_that_collide_in_a_polynomial_hash_stay_apart(spark):
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    rows = [(1, f"one two three four {a}"), (2, f"one two three four {b}"), (3, f"one two three four {a}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from loomprep.llm import jaccard_join as J
    got = {r.doc_id: (r.class_id, r.n_links, r.copy_of) for r in J.jaccard_join(df).collect()}
    assert got[1][0] == got[3][0] == 1 and got[2] == (2, 0, 2)
