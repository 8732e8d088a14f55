"""Vectorised hashing helpers used inside Arrow tasks.

All functions work on one chunk of texts (about a MB), so a task's memory does
not depend on the size of its partition.  Hashes are 64-bit and only ever
*select candidates*; the operators decide on the words, bytes or vectors
themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash

CHUNK_BYTES = 1 << 20        # a chunk's arrays take about 80 bytes for each byte of text
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Invertible 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B**i`` and ``B**-i`` modulo 2**64 for i < n."""
    if len(_POW[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _POW[k] = np.multiply.accumulate(table)
    return _POW[0][:n], _POW[1][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * B**i``; see :func:`range_hash`."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent hash of ``values[start:end]``."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values."""
    return gram_hashes(prefix_sums(values), k)


def gram_hashes(sums: np.ndarray, k: int) -> np.ndarray:
    """The same, of values whose prefix sums are given."""
    if len(sums) <= k:
        return np.zeros(0, np.uint64)
    _, down = powers(len(sums))
    return mix((sums[k:] - sums[:-k]) * down[:len(sums) - k])


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def distinct_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """``(number of each byte range, one range for each number)``: ranges have one
    number only if their bytes are equal.  Ranges up to 24 bytes are compared as
    three 8-byte words, longer ones as Python bytes; nothing is left to a hash."""
    size = end - start
    number = np.zeros(len(start), np.int64)
    short = np.flatnonzero(size <= 24)
    rows = np.zeros(0, np.int64)
    if len(short):
        padded = np.concatenate((data, np.zeros(32, np.uint8)))
        word_at = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
        keys = [size[short].astype(np.uint64)]
        for k in range(0, 24, 8):
            held = np.clip(size[short] - k, 0, 8)
            keys.append(word_at[np.where(held > 0, start[short] + k, 0)] & _LOW_BYTES[held])
        code = keys[0]
        for key in keys[1:]:
            code = mix(code ^ key) + _BASE
        number[short] = pd.factorize(code)[0]
        rows = _first_of(number[short], short)
        if any((key != _spread(key, number[short])).any() for key in keys):   # one code, two ranges
            order = np.lexsort(keys)
            new = np.ones(len(short), bool)
            new[1:] = np.any([key[order][1:] != key[order][:-1] for key in keys], axis=0)
            number[short[order]] = np.cumsum(new) - 1
            rows = _first_of(number[short], short)
    long = np.flatnonzero(size > 24)
    if len(long):
        whole, known = data.tobytes(), {}
        number[long] = [known.setdefault(whole[a:b], len(rows) + len(known))
                        for a, b in zip(start[long].tolist(), end[long].tolist())]
        rows = np.concatenate((rows, _first_of(number[long] - len(rows), long)))
    return number, rows


def _first_of(number: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The first entry of ``index`` for each number."""
    out = np.zeros(int(number.max()) + 1, np.int64)
    out[number[::-1]] = index[::-1]
    return out


def _spread(values: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Each entry's value replaced by that of the first entry with its number."""
    return values[_first_of(number, np.arange(len(number)))][number]


def chunks(texts: list, limit: int = CHUNK_BYTES):
    """``(first, last)`` index ranges of about ``limit`` bytes each."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


class Words:
    """The words (maximal runs without \\x20 and \\x09-\\x0D) of some texts.

    ``buffer`` holds them in order, each followed by one space;
    ``start``/``end``: byte ranges there; ``doc``: index of the text;
    ``first``: index of each text's first word (and the total at the end).
    """

    def __init__(self, texts: list):
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        sep = SEPARATOR[raw]
        keep = ~sep
        keep[1:] |= ~sep[:-1]
        self.data = np.where(sep, np.uint8(32), raw)[keep]
        self.buffer = self.data.tobytes()
        self.end = np.flatnonzero(sep[keep])
        self.start = np.concatenate(([0], self.end[:-1] + 1)) if len(self.end) else self.end
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        word_ends = np.flatnonzero(sep[1:] & ~sep[:-1]) + 1
        self.first = np.searchsorted(word_ends, offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return range_hash(prefix_sums(BYTE_VALUE[self.data]), self.start, self.end)

    def digests(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes that is no polynomial: words made to collide in
        :meth:`hashes` differ here.  Each distinct word is hashed once."""
        if not len(self):
            return np.zeros(0, np.uint64)
        number, rows = distinct_ranges(self.data, self.start, self.end)
        own = np.fromiter((xxhash.xxh3_64_intdigest(self.buffer[a:b]) for a, b in zip(
            self.start[rows].tolist(), self.end[rows].tolist())), np.uint64, len(rows))
        return own[number]

    def __len__(self) -> int:
        return len(self.start)
