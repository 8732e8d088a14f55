"""Suffix-array dedup: two-stage sorting of the suffixes of shared passages.

Bytes that lie in a string of ``window`` bytes which also starts anywhere else
are removed.  Shared passages (see ``distinct_passages``) of one bucket are sorted
in two stages: suffixes that are smaller than their successors are sorted
directly; every other suffix starts with a byte that is not smaller than the
next one, so it is placed by scanning the byte buckets in ascending order,
after the place of its successor.  Common prefixes of adjacent suffixes then
show which strings occur again.

Sorted are the suffixes at which a window starts, up to the end of their run
of larger-than-successor bytes; comparisons stop after ``window`` bytes, as
longer matches remove nothing more.

Defined cases: null and empty texts have no bytes; repeated rows repeat all
their strings, so both lose them; a null doc_id stays null; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .distinct_passages import remove_repeats
from .passages import Scheme, gone_spans

WINDOW = 200
GRAM = 16


def two_stage_sort(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes in ``wanted`` (a mask that, for each suffix larger
    than its successor, includes the successor), compared by their first
    ``depth`` bytes at least.  ``text`` ends with a byte smaller than or equal
    to all others, which counts as smaller than its successor."""
    n = len(text)
    # smaller than the successor: the next different byte is larger
    change = np.flatnonzero(text[1:] != text[:-1])
    nxt = np.searchsorted(change, np.arange(n))
    padded = np.concatenate((change, [n - 1]))
    ahead = np.minimum(padded[nxt] + 1, n - 1)
    smaller = text <= text[ahead]
    smaller[-1] = True
    buffer = text.tobytes()
    direct = np.flatnonzero(smaller & wanted)
    keys = [buffer[i:i + depth] for i in direct.tolist()]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)]
    del keys
    rank = np.zeros(n, np.int64)           # place of a suffix once it is known
    placed, done = [], 0
    rest = np.flatnonzero(~smaller & wanted)
    by_byte = rest[np.argsort(text[rest], kind="stable")]
    rest_at = np.searchsorted(text[by_byte], np.arange(257))
    direct_at = np.searchsorted(text[direct], np.arange(257))
    for c in range(256):
        bucket = by_byte[rest_at[c]:rest_at[c + 1]]
        # successors in earlier buckets first, then runs of the same byte
        layer = bucket[text[bucket + 1] < c]
        inside = np.zeros(0, np.int64)
        if len(layer) < len(bucket):
            inside = bucket[text[bucket + 1] == c]
        while len(layer):
            layer = layer[np.argsort(rank[layer + 1], kind="stable")]
            rank[layer] = done + np.arange(len(layer))
            done += len(layer)
            placed.append(layer)
            if not len(inside):
                break
            ready = np.isin(inside + 1, layer)
            layer, inside = inside[ready], inside[~ready]
        own = direct[direct_at[c]:direct_at[c + 1]]
        rank[own] = done + np.arange(len(own))
        done += len(own)
        placed.append(own)
    return np.concatenate(placed) if placed else np.zeros(0, np.int64)


def common_prefix(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the next one, up to ``depth``."""
    out = np.zeros(max(len(order) - 1, 0), np.int64)
    if not len(out):
        return out
    padded = np.concatenate((text, np.zeros(depth + 8, np.uint8)))
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view("<u8")
    eight = eight.ravel()
    a, b = order[:-1], order[1:]
    open_ = np.arange(len(out))
    for at in range(0, depth, 8):
        x = eight[a[open_] + at] ^ eight[b[open_] + at]
        differ = x != 0
        low = x[differ] & (~x[differ] + np.uint64(1))
        out[open_[differ]] = at + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        open_ = open_[~differ]
        if not len(open_):
            break
    out[open_] = depth
    return np.minimum(out, depth)


def resolve(texts: list, counts: np.ndarray, window: int = WINDOW) -> list:
    """For each window of each piece: 2 if its string occurs again, else 1."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    # a 0xFF byte never occurs in UTF-8 and parts the pieces; no window spans it
    text = np.frombuffer(b"\xff".join(texts) + b"\xff\x00", np.uint8)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    starts = sizes - window + 1
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + starts, -1)
    window_at = np.cumsum(edge[:-1]) > 0
    # successors of larger suffixes, to the end of their descent
    drop = np.zeros(len(text), bool)
    drop[:-1] = text[:-1] >= text[1:]
    wanted, grow = window_at.copy(), window_at
    while True:
        grow = np.concatenate(([False], (grow & drop)[:-1])) & ~wanted
        if not grow.any():
            break
        wanted |= grow
    order = two_stage_sort(text, wanted, window)
    order = order[window_at[order]]
    same = common_prefix(text, order, window) >= window
    run = np.concatenate(([0], np.cumsum(~same))) if len(order) else order
    piece = np.searchsorted(begin, order, "right") - 1
    total = np.bincount(run, counts[piece]) if len(order) else np.zeros(0)
    value = np.zeros(len(text), np.int8)
    value[order] = np.minimum(total[run], 2)
    return [value[b:b + s] for b, s in zip(begin.tolist(), starts.tolist())]


def _finish(part, lo: int, hi: int, gone: np.ndarray):
    text = part.buffer[lo:hi]
    if not gone.any():
        return hi - lo, [], text
    return hi - lo, gone_spans(gone), np.frombuffer(text, np.uint8)[~gone].tobytes()


def scheme(window: int = WINDOW, gram: int = GRAM) -> Scheme:
    return Scheme(window, min(gram, window), False, False,
                  lambda texts, counts: resolve(texts, counts, window), np.int8)


def suffix_array_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, removed (array of [start, end) in bytes), kept (the
    remaining bytes); one row for each input row."""
    out = remove_repeats(docs, scheme(window, gram), _finish)
    return out.select("doc_id", F.col("n_units").alias("n_bytes"),
                      F.col("spans").alias("removed"), "kept")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_array_dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
