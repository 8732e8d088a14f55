"""Each distinct shared passage is sent once, whatever the number of chunks that hold it."""

import random

import pytest

from loomprep.llm import distinct_passages as dp, passages, suffix_array_dedup as sa

from .test_passages import brute_bytes, corpus


def shuffled(df, metric: str) -> int:
    """Sum of a metric of the shuffles of a collected frame."""
    def walk(node) -> int:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get(metric)
        own = own.get().value() if name == "ShuffleExchangeExec" else 0
        below = node.children()
        return own + sum(walk(below.apply(k)) for k in range(below.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def dedup(spark, rows, window=200, gram=16, metric="dataSize"):
    """Rows as brute_bytes gives them, and the bytes shuffled, by default before they are
    compressed."""
    df = sa.suffix_array_dedup(spark.createDataFrame(rows, "doc_id long, text string"), window, gram)
    got = [(r.doc_id, r.n_bytes, sum(b - a for a, b in r.removed), len(r.removed), bytes(r.kept))
           for r in df.collect()]
    return sorted(got, key=repr), shuffled(df, metric)


@pytest.mark.parametrize("hot", [0, 2])
@pytest.mark.parametrize("window,gram", [(200, 16), (40, 8), (40, 40)])
def test_hot_halves_match_brute_force(spark, monkeypatch, hot, window, gram):
    monkeypatch.setattr(passages, "CHUNK", 6000)
    monkeypatch.setattr(dp, "HOT", hot)
    rows = corpus(5, 60)
    have, _ = dedup(spark, rows, window, gram)
    assert have == sorted(brute_bytes(rows, window), key=repr)
    assert sum(r[2] for r in have) > 300


def letters(rng, n):
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))


def test_common_phrase_is_not_sent_window_by_window(spark, monkeypatch):
    """A phrase in over 256 chunks, each time in another context, and so no window twice."""
    monkeypatch.setattr(passages, "CHUNK", 550)
    monkeypatch.setattr(passages, "BUCKET", 5500)
    rng = random.Random(9)
    phrase = letters(rng, 150)
    rows = [(k, letters(rng, 200) + phrase + letters(rng, 200)) for k in range(600)]
    have, moved = dedup(spark, rows)
    assert have == sorted(brute_bytes(rows, 200), key=repr)
    assert sum(r[2] for r in have) == 0
    assert 0 < moved < 5 * sum(len(t) for _, t in rows)


def test_copies_are_sent_once(spark, monkeypatch):
    """Texts that many chunks hold, a few bytes apart, beside some that are held once."""
    monkeypatch.setattr(passages, "CHUNK", 20000)
    rng = random.Random(10)
    texts = [letters(rng, 3000) for _ in range(12)]
    rows = [(k, letters(rng, 3) + rng.choice(texts) + letters(rng, 3)) for k in range(240)]
    rows += [(1000 + k, letters(rng, 3000)) for k in range(12)]
    have, moved = dedup(spark, rows, metric="shuffleBytesWritten")
    assert have == sorted(brute_bytes(rows, 200), key=repr)
    assert sum(r[2] for r in have) >= 240 * 3000
    assert 0 < moved < 1.8 * sum(len(t) for _, t in rows)
