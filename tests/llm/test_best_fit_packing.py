import random
import zlib

import numpy as np
import pytest

from loomprep.llm import best_fit_packing as B
from loomprep.llm import word_tokens as W
from loomprep.sources.tables import table


def plain_best_two_fit(sizes, capacity):
    """The same method with lists and all pairs."""
    left, out = sorted(sizes, reverse=True), []

    def fill(held, room):
        while True:
            fits = [s for s in left if s <= room]
            if not fits:
                return room
            left.remove(fits[0])
            held.append(fits[0])
            room -= fits[0]
    while left:
        held = []
        room = fill(held, capacity)
        while room and len(held) > 1:
            short = min(held)
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1:]
                     if short < a + b <= room + short]
            if not pairs:
                break
            total, a, b = max(pairs)
            held.remove(short)
            left.remove(a)
            left.remove(b)
            left.append(short)
            left.sort(reverse=True)
            held += [a, b]
            room = fill(held, room + short - total)
        out.append(held)
    return out


def test_best_two_fit_is_the_plain_method():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([10, 30, 64])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 40))]
        got = B.best_two_fit(np.array(sizes, np.int64), capacity)
        assert sorted(map(sorted, got)) == sorted(map(sorted, plain_best_two_fit(sizes, capacity)))
        assert sorted(s for b in got for s in b) == sorted(sizes)


def test_swaps_save_sequences():
    # the longest first leaves gaps of 2 and 1; two shorter pieces fill them
    assert len(B.best_two_fit(np.array([6, 3, 2, 2, 5, 2], np.int64), 10)) == 2
    rng = np.random.default_rng(4)
    for _ in range(5):
        sizes = rng.integers(300, 2500, 3000)
        best = -(-int(sizes.sum()) // 4096)
        assert len(B.best_two_fit(sizes, 4096)) <= best * 1.005 + 1


def check(rows, texts, tokenizer, length, end_id=1):
    encoded = [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id], "<u4"))
               for i, t in texts]
    want = sorted((i if i is not None else -1, k, k * length, len(e[k * length:(k + 1) * length]),
                   zlib.crc32(e[k * length:(k + 1) * length].tobytes()))
                  for i, e in encoded for k in range(-(-len(e) // length)))
    assert want == sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32)
                          for r in rows)
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
    return len(by_sequence), sum(len(e) for _, e in encoded)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(W.default_tokenizer())


def test_odd_rows(spark, tokenizer):
    texts = [(None, "a b"), (None, None), (1, ""), (2, " \n"), (3, "x " * 100), (3, "x " * 100), (4, "it's " * 70)]
    texts += [(10 + k, "y z " * (k % 30)) for k in range(200)]
    df = spark.createDataFrame([(i, t, 5, "p", 2) for i, t in texts],
                               "doc_id long, text string, row int, part string, piece int")
    rows = B.pack_whole(df, length=64).collect()
    bins, tokens = check(rows, texts, tokenizer, 64)
    assert bins <= -(-tokens // 64) * 1.03 + 1
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert B.pack_whole(df.limit(0)).count() == 0
    # more blocks: the same pieces, a little more room lost
    rows = B.pack_whole(df, length=64, block=40, with_ids=False).collect()
    assert check(rows, texts, tokenizer, 64)[0] <= bins + 8


def test_equal_rows_are_dealt_over_blocks(spark):
    df = spark.range(3000).selectExpr("7L as doc_id", "'same text' as text")
    rows = B.pack_whole(df, length=16, block=500, with_ids=False).collect()
    blocks = [r.sequence_id >> 32 for r in rows]
    assert len(set(blocks)) == 6 and max(map(blocks.count, set(blocks))) < 700


def test_query(spark, tokenizer):
    path = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in table(spark, path, "documents").collect()]
    bins, tokens = check(B.op11_best_fit_packing(spark, path).collect(), texts, tokenizer, 4096)
    assert bins <= tokens / 4096 * 1.01 + 1
