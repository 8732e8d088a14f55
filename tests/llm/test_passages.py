"""Substring and suffix-array dedup against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from loomprep.llm import passages, substring_dedup as sd, suffix_array_dedup as sa

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_words(rows, window):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in texts:
        if i is None:
            continue
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def brute_bytes(rows, window):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k:k + window] for _, b in texts for k in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - window + 1):
            if count[b[k:k + window]] > 1:
                gone[k:k + window] = [True] * window
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "été", "naïve", "x1", "日本"] + [f"w{k}" for k in range(60)]
    common = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 60))) for _ in range(12)]
    rows = [(None, common[0]), (5, None), (6, ""), (7, "  \t\n "), (8, common[1]), (8, common[1]),
            (9, "a " * 90), (10, "a\n" * 40 + "b " * 50), (11, "z" * 700), (12, "xyz" * 300)]
    for k in range(n):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 25)))
                 if rng.random() < 0.6 else rng.choice(common) for _ in range(rng.randint(1, 6))]
        rows.append((rng.randint(20, 20 + 4 * n), rng.choice([" ", "\n", "  ", "\t "]).join(parts)))
    rows += rng.sample(rows, 15)
    rng.shuffle(rows)
    return rows


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(passages, "CHUNK", 6000)
    monkeypatch.setattr(passages, "BUCKET", 5000)


@pytest.mark.parametrize("hot,segment", [(256, 1 << 20), (1, 1 << 20), (256, 7)])
def test_substring_dedup_matches_brute_force(spark, small_chunks, monkeypatch, hot, segment):
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "SEGMENT", segment)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'c' chunk", "1 kind", "2 bucket")
    got = sd.substring_dedup(df).collect()
    have = sorted(((r.doc_id, r.n_words, sum(b - a for a, b in r.removed), r.kept) for r in got),
                  key=repr)
    assert have == sorted(brute_words(rows, 13), key=repr)
    assert sum(r[2] for r in have) > 300


@pytest.mark.parametrize("hot,window,gram,segment", [(256, 200, 16, 1 << 20), (1, 40, 8, 1 << 20),
                                                     (256, 40, 8, 100), (1, 200, 16, 64)])
def test_suffix_array_dedup_matches_brute_force(spark, small_chunks, monkeypatch, hot, window, gram,
                                                segment):
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "SEGMENT", segment)
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sa.suffix_array_dedup(df, window, gram).collect()
    have = sorted(((r.doc_id, r.n_bytes, sum(b - a for a, b in r.removed), len(r.removed),
                    bytes(r.kept)) for r in got), key=repr)
    assert have == sorted(brute_bytes(rows, window), key=repr)
    assert sum(r[2] for r in have) > 300


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sd.substring_dedup(df).count() == 0
    assert sa.suffix_array_dedup(df).count() == 0


def test_queries_match_brute_force_on_a_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in sd.op1_substring_dedup(spark, path).collect()}
    assert got == {i: (n, g, hashlib.sha256(k.encode()).hexdigest())
                   for i, n, g, k in brute_words(rows, 13)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in sa.op6_suffix_array_dedup(spark, path).collect()}
    assert got == {i: (n, g, s, hashlib.sha256(k).hexdigest())
                   for i, n, g, s, k in brute_bytes(rows, 200)}


def test_two_stage_sort_orders_all_suffixes():
    rng = np.random.default_rng(3)
    for alphabet in (2, 4, 200):
        text = np.concatenate((rng.integers(1, 1 + alphabet, 400), [5] * 30, [0])).astype(np.uint8)
        order = sa.two_stage_sort(text, np.ones(len(text), bool), len(text))
        data = text.tobytes()
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        lcp = sa.common_prefix(text, order, 50)
        for k in range(len(order) - 1):
            x, y = data[order[k]:][:50], data[order[k + 1]:][:50]
            n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert lcp[k] == n or n == len(y)


@pytest.mark.parametrize("scheme", [sa.scheme(40, 8), sd.scheme()])
def test_pieces_do_not_depend_on_the_order_of_texts(monkeypatch, scheme):
    """Each step reads a chunk anew, and a shuffle gives its rows in any order."""
    monkeypatch.setattr(passages, "SEGMENT", 50)
    texts = [(t or "").encode() for _, t in corpus(4)]

    def pieces(texts):
        out = Counter()
        for a, b in passages.chunks(texts, 3000):
            part = scheme.part(texts[a:b])
            for anchor, doc, first, count in scheme.pieces(part):
                ends = part.ends(first + count + scheme.window - 2)
                out.update(zip(anchor.tolist(), count.tolist(),
                               [part.buffer[x:y] for x, y in zip(part.begins(first), ends)]))
        return out

    have = pieces(texts)
    assert have and have == pieces(texts[::-1]) == pieces(sorted(texts))


def by_bucket(messages, step):
    return pa.concat_tables([step([pa.scalar(b)], messages.filter(pc.equal(messages["bucket"], b)))
                             for b in sorted(set(messages["bucket"].to_pylist()))])


@pytest.mark.parametrize("unit,scheme,finish", [("z", sa.scheme(), sa._finish),
                                                ("a ", sd.scheme(), sd._finish)])
def test_long_run_takes_little_memory(unit, scheme, finish):
    """The steps of one chunk on a run of 2 million units: every window is a piece of its own."""
    n, key = 2 << 20, [pa.scalar(0)]
    rows = pa.table({"doc_id": pa.array([5, 7], pa.int64()), "text": [unit * n, unit * 300],
                     "chunk": pa.array([0, 0], pa.int32())})
    tracemalloc.start()
    shared = by_bucket(passages._anchors(scheme, 2)(key, rows), passages._shared)
    pieces = passages._send(scheme, 2)(key, rows, shared)
    answers = by_bucket(pieces, passages._resolve(scheme))
    out = passages._apply(scheme, 2, finish)(key, rows, pa.concat_tables([shared, answers]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 * n
    assert out["n_units"].to_pylist() == [n, 300]
    if scheme.by_doc:      # the smaller document keeps its words
        assert [len(k) for k in out["kept"].to_pylist()] == [2 * n - 1, 0]
        assert out["spans"].to_pylist() == [[], [[0, 300]]]
    else:
        assert out["kept"].to_pylist() == [b"", b""]
        assert out["spans"].to_pylist() == [[[0, n]], [[0, 300]]]
