import hashlib
import random
import re
import zlib

import numpy as np

from loomprep.llm import periodic_runs as P
from loomprep.sources.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1)
                if all(words[i] == words[i + q] for i in range(len(words) - q)))


def brute_runs(words):
    """Every stretch on every diagonal, its period tested from 1 up."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and smallest_period(words[i:i + length]) == q:
                out.append((i, length, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q or (
                n * best[2] == best[1] * q and (s, q) < (best[0], best[2])):
            best = (s, n, q)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def compare(rows, texts):
    want = sorted((brute_row(i, t) for i, t in texts), key=repr)
    got = sorted((tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                       "runs_sha256", "collapsed_sha256")) for r in rows), key=repr)
    assert got == want


def test_runs_of_many_small_sequences():
    rng = random.Random(3)
    texts = []
    for k in range(1500):
        words = []
        while len(words) < rng.randint(0, 120):
            piece = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 14))]
            words += piece * rng.choice([1, 1, 2, 4, 5, 7])
            if rng.random() < 0.3:
                words = words[:-1]
        texts.append(words)
    names = {w: k for k, w in enumerate("abc")}
    number = np.array([names[w] for t in texts for w in t], np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    found: dict = {}
    for s, n, q in P.find_runs(number, doc).tolist():
        found.setdefault(int(doc[s]), []).append((s - int(first[doc[s]]), n, q))
    for k, t in enumerate(texts):
        assert found.get(k, []) == brute_runs(t), t


def test_long_periods_with_repeats_inside():
    rng = random.Random(5)
    for q in (9, 16, 24, 25, 37, 57):
        half = [rng.choice("ab") for _ in range(q // 2)]
        words = (half + half + ["c"]) * 5 + half + list("xyz") + (["d"] * 5 + ["e"]) * 4
        number = np.array([ord(w) for w in words], np.int64)
        runs = [tuple(r) for r in P.find_runs(number, np.zeros(len(words), np.int64)).tolist()]
        assert runs == brute_runs(words)


def test_odd_rows(spark):
    texts = [(None, "a a a a a a a b"), (1, None), (2, ""), (3, " \t\n"), (4, "a " * 5), (5, "a " * 6),
             (5, "a " * 6), (6, "A a " * 9), (7, "x y  " * 4), (8, "\x1c b " * 4), (10, "é è " * 3 + "é")]
    texts += [(i, "p q r s t u v w x y z " * 3) for i in range(100, 160)]
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in texts], "doc_id long, text string, n long, runs string")
    compare(query_of(P.with_repeated_tails(df)).collect(), texts)
    rows = P.collapse_runs(df).collect()
    assert {r.text for r in rows if r.doc_id == 5} == {"a"}
    assert [r.n_words for r in rows if r.doc_id == 1] == [0]
    assert P.collapse_runs(df.limit(0)).count() == 0


def query_of(docs):
    """The query's columns over given documents."""
    class Session:
        pass
    original, P.table = P.table, lambda *a: docs
    try:
        with_tails, P.with_repeated_tails = P.with_repeated_tails, lambda d: d
        try:
            return P.op12_periodic_runs(Session(), "")
        finally:
            P.with_repeated_tails = with_tails
    finally:
        P.table = original


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in table(spark, path, "documents").collect()]
    short = [(i, t) for i, t in texts if len(t or "") < 12_000]
    rows = [r for r in P.op12_periodic_runs(spark, path).collect()]
    assert len(rows) == len(texts)
    ids = {i for i, _ in short}
    compare([r for r in rows if r.doc_id in ids], short)
    assert sum(r.n_runs > 0 for r in rows) > 5


def test_a_very_long_run_and_a_very_long_text():
    number = np.zeros(400_000, np.int64)
    number[200_000:] = np.arange(200_000) % 7 + 1
    runs = P.find_runs(number, np.zeros(len(number), np.int64)).tolist()
    assert runs == [[0, 200_000, 1], [200_000, 200_000, 7]]
    count, runs, owner, text = P._answer([("ab cd " * 150_000).encode(), b"z"])
    assert count.tolist() == [300_000, 1] and runs.tolist() == [[0, 300_000, 2]] and text == [b"ab cd", b"z"]
