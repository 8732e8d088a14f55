import random
import zlib

import numpy as np
import pytest

from loomprep.llm import packing as P
from loomprep.llm import word_tokens as W


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.default_tokenizer())


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def odd_texts():
    rng = random.Random(2)
    bits = ["the", "The", "THE", ".", ",", "don't", "it's.", "I'll", "'s", "a1b2", "été", "ÉTÉ", "ÉT",
            "İ", "ſ", "—", "x—.", "日本", "　", " ", " ", "<|endoftext|>", "<|EndOfText|>",
            "<|startoftext|>x.", "!?", "end!?", "end!", "q.", "q..", "ß;", "z:", "\x1c", "\u0085", "oḱ.",
            "ΑΣ", "ΑΣ.", "İ.", "K", "'", "''s", "re'", "'RE", "😀", "😀."]
    out = [None, "", " \t\n", "a", ".", "word " * 9000]
    for _ in range(600):
        out.append("".join(rng.choice(bits) + rng.choice(["", " ", "\n", "  ", "\t"])
                           for _ in range(rng.randint(1, 12))))
    return out


def test_words_give_the_ids_of_the_whole_text(tokenizer, spark):
    texts = odd_texts() + [r.text for r in spark.read.parquet(
        "/root/testdata/sf0.001/documents.parquet").collect()]
    own = W.WordTokenizer(P.default_tokenizer(), 2)
    raw = [(t or "").encode() for t in texts]
    for lo in range(0, len(raw), 100):
        ids, begin = own.encode(raw[lo:lo + 100])
        for k, t in enumerate(texts[lo:lo + 100]):
            assert ids[begin[k]:begin[k + 1]].tolist() == whole(tokenizer, t), repr(t)


def check_pieces(rows, texts, tokenizer, length, most_padding):
    """texts: list of (doc_id, text); every id in one piece, sequences gapless."""
    want: dict = {}
    for i, t in texts:
        ids = whole(tokenizer, t)
        key = (i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        want[key] = want.get(key, 0) + 1
    encoded = {}
    for i, t in texts:
        encoded.setdefault(i, []).append(np.array(whole(tokenizer, t), "<u4"))
    covered: dict = {}
    by_sequence: dict = {}
    for r in rows:
        assert any(r.doc_tokens == len(e) and zlib.crc32(e[r.start:r.start + r.length].tobytes())
                   == r.ids_crc32 for e in encoded[r.doc_id])
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, docs in encoded.items():
        cells = sorted(c for a, n in covered[i] for c in range(a, a + n))
        assert cells == sorted(c for e in docs for c in range(len(e)))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at <= length
        padding += length - at if at & (at - 1) else 0
    assert padding <= most_padding * length * len(by_sequence)


def test_packing_odd_rows(spark, tokenizer):
    texts = list(enumerate(odd_texts()[:200])) + [(None, "a b c"), (None, None), (7, "dup dup"),
                                                  (7, "dup dup")]
    texts += [(1000 + k, "x y z " * (k % 40 + 1)) for k in range(300)]
    df = spark.createDataFrame([(*r, "c", 3) for r in texts],
                               "doc_id long, text string, size_class string, length int")
    rows = P.pack(df, length=256, step=4).collect()
    check_pieces(rows, texts, tokenizer, 256, 0.05)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert P.pack(df.limit(0)).count() == 0


def test_query_packs_a_table(spark, tokenizer):
    path = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    check_pieces(P.op9_packing(spark, path).collect(), texts, tokenizer, 4096, 0.03)


def test_knapsack_and_cutting_stock():
    rng = np.random.default_rng(1)
    for _ in range(20):
        size = np.unique(rng.integers(1, 30, 6))
        price = rng.random(len(size))
        value, numbers = P.knapsack(price, size, 40)
        best = np.zeros(41)
        for w in range(1, 41):
            best[w] = max([best[w - 1]] + [best[w - s] + p for s, p in zip(size, price) if s <= w])
        assert abs(value - best[40]) < 1e-9
        assert numbers @ size <= 40 and abs(numbers @ price - value) < 1e-9
        demand = rng.integers(0, 500, len(size))
        patterns, times = P.cutting_stock(demand, size, 40)
        assert (times @ patterns == demand).all() and (patterns @ size <= 40).all()
        # the linear program's bound, and at most one more for each class
        assert times.sum() <= demand @ size / 40 * 1.35 + len(size) + 1


def test_parts_are_told_apart_by_their_bytes(tokenizer):
    # words that polynomial hashes modulo 2**64 cannot tell apart
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    texts = [f"{a} {b}", f"{b} {a} {a}.", "éa ea Éa ÉA", "x1y22 ab--cd ab- -", "a×b a÷b ÀÖØÞ ßÿ", "|| a|b <|x|>"]
    ids, begin = W.WordTokenizer(P.default_tokenizer(), 2).encode([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert ids[begin[k]:begin[k + 1]].tolist() == whole(tokenizer, t)


def test_both_generations_of_parts(tokenizer, monkeypatch):
    monkeypatch.setattr(W, "CACHE_PARTS", 10)
    own = W.WordTokenizer(P.default_tokenizer(), 2)
    rng = random.Random(4)
    for _ in range(40):
        texts = [" ".join(f"w{rng.choice('abcdef')}{rng.choice('xyz')}" for _ in range(12)) for _ in range(3)]
        ids, begin = own.encode([t.encode() for t in texts])
        for k, t in enumerate(texts):
            assert ids[begin[k]:begin[k + 1]].tolist() == whole(tokenizer, t)
    assert len(own.known) < 60


def test_distinct_ranges_without_a_hash(monkeypatch):
    from loomprep.llm import hashing as H
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    start = rng.integers(0, 4900, 3000)
    end = start + rng.integers(1, 40, 3000)
    for code in (H.mix, lambda x: x * np.uint64(0)):         # also if all codes are equal
        monkeypatch.setattr(H, "mix", code)
        number, rows = H.distinct_ranges(data, start, end)
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(start, end)]
        assert len(set(words)) == len(rows)
        assert all(words[rows[n]] == w for n, w in zip(number, words))
