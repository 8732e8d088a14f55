"""Shared passages of a corpus, each distinct one sent once.

Used by the suffix-array dedup.  Windows are anchored and cut into pieces as in
``passages``.  The windows of a piece differ only in how far the anchor lies
from their start; the near ones and the far ones are kept apart, so that all
windows of a *half* hold one more string than the anchor, more than half a
window long.  Its hash is the half's *key*: equal windows lie in halves of the
same key, and few other halves have it.  The corpus is dealt into chunks of a
few MB, and keys and pieces into as many buckets:

1. each chunk offers the keys and digests of its distinct halves to the buckets
   of the keys;
2. a bucket answers each chunk with the keys that occur more than once, with a
   number for each distinct half that has one, and with which chunk sends it;
3. halves of a key with more than ``HOT`` distinct halves are cut into single
   windows, which are offered and answered in the same way, each under a key of
   its own, so that no bucket gathers all contexts of a frequent phrase;
4. each chunk sends how often it holds a number, and the bytes of those it was
   chosen for;
5. a bucket *resolves* the distinct pieces with their total counts (the
   operator's own method, exact on the bytes) and answers each chunk with one
   value for each window;
6. each chunk applies the answers to its texts.

So a passage's bytes are moved once, however many chunks hold it, and not at all
where a phrase is common but its context is not.  Copies are told by 128 bits of
BLAKE2b, made so that nobody can find two texts that share them; all other
hashes only select candidates.  Only chunk- and bucket-sized arrays are held by a
task, the driver sees none of them, and all of it is one plan: a lost executor's
part is computed again from its inputs, whatever the order of its rows.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passages
from .hashing import chunks, mix, range_hash
from .passages import _MESSAGE, Part, Scheme, _rows, _split, _table

HOT = 4096               # distinct halves of a key before they are cut into windows
_BLOCK = 1 << 16
#: Kinds of messages: by level (0: halves, 1: single windows) offers and pieces,
#: then what a bucket chose, then its values.
CHOSEN, VALUES = 2, 4


def halves(scheme: Scheme, part: Part):
    """(key, first window, windows) of the halves of all pieces, as arrays for one
    segment at a time, ascending by the first window."""
    window = scheme.window
    spread = window - scheme.gram + 1              # places of an anchor in a window
    step = -(-spread // 2)
    for lo, sums, g, _, _, first, count in scheme.segments(part):
        first = first - lo
        inside = np.lib.stride_tricks.sliding_window_view(g, spread)
        place = np.zeros(len(first), np.int64)
        for at in range(0, len(first), 4096):
            begin = first[at:at + 4096]
            place[at:at + 4096] = begin + inside[begin].argmin(axis=1)
        found = []
        for near in range(0, spread, step):
            far = min(near + step, spread) - 1
            begin = np.maximum(first, place - far)
            end = np.minimum(first + count, place - near + 1)
            some = np.flatnonzero(begin < end)
            p = place[some]
            key = range_hash(sums, p - near, p - far + window)
            found.append((key, begin[some], end[some] - begin[some]))
        key, begin, size = map(np.concatenate, zip(*found))
        order = np.argsort(begin, kind="stable")
        yield key[order], lo + begin[order], size[order]


def digests(part: Part, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """128 bits, as two numbers, for the bytes from unit ``first`` to ``last``."""
    out = np.zeros((len(first), 2), np.uint64)
    for at in range(0, len(first), _BLOCK):
        block = slice(at, at + _BLOCK)
        got = [blake2b(part.buffer[a:b], digest_size=16).digest() for a, b in
               zip(part.begins(first[block]).tolist(), part.ends(last[block]).tolist())]
        out[block] = np.frombuffer(b"".join(got), np.uint64).reshape(-1, 2)
    return out


class Held:
    """The distinct pieces of a chunk."""

    def __init__(self):
        self.index: dict = {}              # number of each digest
        self.rows: list = []               # key, part, first, windows of the new ones
        self.times = np.zeros(0, np.int64)

    def add(self, key, digest, part: int, first, count) -> np.ndarray:
        """The number of each piece."""
        index, raw, known = self.index, digest.tobytes(), len(self.index)
        number = np.fromiter((index.setdefault(raw[i:i + 16], len(index))
                              for i in range(0, len(raw), 16)), np.int32, len(key))
        new = np.flatnonzero(number >= known)
        new = new[np.unique(number[new], return_index=True)[1]]
        self.rows.append((key[new], np.full(len(new), part), first[new], count[new]))
        self.times = np.concatenate((self.times, np.zeros(len(index) - known, np.int64)))
        self.times += np.bincount(number, minlength=len(index))
        return number

    def close(self, buckets: int) -> list:
        """(bucket, numbers by key and digest) for each bucket of the pieces' keys."""
        if not self.rows:
            self.rows = [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
        self.key, self.part, self.first, self.count = map(np.concatenate, zip(*self.rows))
        self.digest = np.frombuffer(b"".join(self.index), np.uint64).reshape(-1, 2)
        self.rows.clear()
        self.index.clear()
        order = np.lexsort((self.digest[:, 1], self.digest[:, 0], self.key))
        bucket = (self.key[order] % np.uint64(buckets)).astype(np.int64)
        return [(b, order[i]) for b, i in _split(bucket)]


class Known:
    """What the buckets chose for a chunk: by level the keys that occur more than once
    (for halves also whether they are hot), and by bucket the numbers of its pieces."""

    def __init__(self, answers: pa.Table):
        keys = [[np.zeros(0, np.uint64)] for _ in range(2)]
        hot = [[np.zeros(0, np.uint8)] for _ in range(2)]
        self.numbers: dict = {}
        self.values: dict = {}
        for kind, bucket, payload in zip(answers["kind"].to_pylist(), answers["bucket"].to_pylist(),
                                         answers["payload"].to_pylist()):
            if kind >= VALUES:
                self.values[kind - VALUES, bucket] = payload
            elif kind >= CHOSEN:
                n = int(np.frombuffer(payload, np.int64, 1)[0])
                keys[kind - CHOSEN].append(np.frombuffer(payload, np.uint64, n, 8))
                hot[kind - CHOSEN].append(np.frombuffer(payload, np.uint8, n, 8 + 8 * n))
                self.numbers[kind - CHOSEN, bucket] = np.frombuffer(payload, np.uint32,
                                                                    offset=8 + 9 * n)
        keys, hot = [np.concatenate(x) for x in keys], [np.concatenate(x) for x in hot]
        order = [np.argsort(k) for k in keys]
        self.keys = [k[i] for k, i in zip(keys, order)]
        self.hot = [h[i] > 0 for h, i in zip(hot, order)]

    def find(self, level: int, key: np.ndarray):
        """Which of the keys are shared, and which of those are hot."""
        keys = self.keys[level]
        if not len(keys):
            return np.zeros(len(key), bool), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        there = keys[at] == key
        return there, there & self.hot[level][at]


def _windows(scheme: Scheme, part: Part, first: np.ndarray, count: np.ndarray):
    """First units and digests of the single windows of some halves, a block at a time."""
    for at in range(0, len(first), _BLOCK // scheme.window + 1):
        block = slice(at, at + _BLOCK // scheme.window + 1)
        times = count[block]
        one = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        one += np.repeat(first[block], times)
        yield one, digests(part, one, one + scheme.window - 1)


def _look(scheme: Scheme, number: int, part: Part, known: Known, held: list):
    """(level, first window, windows, numbers) of the shared pieces, a segment at a time."""
    for key, first, count in halves(scheme, part):
        there, hot = known.find(0, key)
        cold = np.flatnonzero(there & ~hot)
        begin, size = first[cold], count[cold]
        digest = digests(part, begin, begin + size + scheme.window - 2)
        yield 0, begin, size, held[0].add(key[cold], digest, number, begin, size)
        for one, digest in _windows(scheme, part, first[hot], count[hot]):
            there = known.find(1, digest[:, 0])[0]
            one, digest = one[there], digest[there]
            size = np.ones(len(one), np.int64)
            yield 1, one, size, held[1].add(digest[:, 0], digest, number, one, size)


def _offer(chunk: int, level: int, held: Held, buckets: int) -> list:
    rows = []
    for bucket, i in held.close(buckets):
        times = np.minimum(held.times[i], 2).astype(np.uint8)
        rows.append((chunk, level, bucket, b"".join((held.key[i].tobytes(),
                                                     held.digest[i].tobytes(), times.tobytes()))))
    return rows


def offer_halves(scheme: Scheme, buckets: int):
    def run(key, table):
        _, _, texts = _rows(table)
        held = Held()
        for number, (a, b) in enumerate(chunks(texts)):
            part = scheme.part(texts[a:b])
            for k, first, count in halves(scheme, part):
                held.add(k, digests(part, first, first + count + scheme.window - 2),
                         number, first, count)
        return _table(_offer(key[0].as_py(), 0, held, buckets))
    return run


def offer_windows(scheme: Scheme, buckets: int):
    def run(key, table, answers):
        known, held = Known(answers), Held()
        if not known.hot[0].any():
            return _table([])
        _, _, texts = _rows(table)
        for number, (a, b) in enumerate(chunks(texts)):
            part = scheme.part(texts[a:b])
            for k, first, count in halves(scheme, part):
                hot = known.find(0, k)[1]
                for one, digest in _windows(scheme, part, first[hot], count[hot]):
                    held.add(digest[:, 0], digest, number, one, np.ones(len(one), np.int64))
        return _table(_offer(answers["chunk"][0].as_py(), 1, held, buckets))
    return run


def choose(most: int, hot_only: bool = False):
    """A bucket's answers to offers of one level; the order of the offers changes none.
    Keys of more than ``most`` distinct halves are hot (``hot_only``: no others are told)."""
    def run(key, table):
        level = table["kind"][0].as_py()
        senders = table["chunk"].to_pylist()
        h, d, times, sender = [], [], [], []
        for k, payload in enumerate(table["payload"].to_pylist()):
            n = len(payload) // 25
            h.append(np.frombuffer(payload, np.uint64, n))
            d.append(np.frombuffer(payload, np.uint64, 2 * n, 8 * n).reshape(-1, 2))
            times.append(np.frombuffer(payload, np.uint8, n, 24 * n))
            sender.append(np.full(n, k))
        h, d, times, sender = map(np.concatenate, (h, d, times, sender))
        # of the chunks that hold a piece, the first by this sends it
        turn = mix(d[:, 0] ^ mix(np.array(senders, np.uint64))[sender])
        order = np.lexsort((turn, d[:, 1], d[:, 0], h))
        h, d, times, sender = h[order], d[order], times[order], sender[order]
        new_key = np.concatenate(([True], h[1:] != h[:-1]))
        new = new_key | np.concatenate(([True], (d[1:] != d[:-1]).any(axis=1)))
        at = np.flatnonzero(new_key)
        own = np.cumsum(new_key) - 1
        shared = np.add.reduceat(times, at, dtype=np.int64) > 1
        hot = shared & (np.add.reduceat(new, at, dtype=np.int64) > most) & (level == 0)
        cold = (shared & ~hot)[own]
        shared, hot = shared[own], hot[own]
        number = np.cumsum(new & cold) - 1
        code = (2 * number + new).astype(np.uint32)          # odd: to be sent
        rows, bucket = [], key[0].as_py()
        for k, i in _split(sender):
            i = i[hot[i] if hot_only else shared[i]]
            if not len(i):
                continue
            first = i[np.concatenate(([True], h[i][1:] != h[i][:-1]))]
            payload = (np.array([len(first)]), h[first], hot[first].astype(np.uint8),
                       code[i[cold[i]]])
            rows.append((senders[k], CHOSEN + level, bucket,
                         b"".join([x.tobytes() for x in payload])))
        return _table(rows)
    return run


def _pack(numbers, times, keys, texts) -> bytes:
    sizes = np.fromiter(map(len, texts), np.int32, len(texts))
    head = np.array([len(numbers), len(texts)], np.int64)
    return b"".join([x.tobytes() for x in (head, times, keys, numbers, sizes)] + texts)


def _unpack(payload: bytes):
    n, m = np.frombuffer(payload, np.int64, 2).tolist()
    times = np.frombuffer(payload, np.int64, n, 16)
    keys = np.frombuffer(payload, np.uint64, m, 16 + 8 * n)
    numbers = np.frombuffer(payload, np.uint32, n, 16 + 8 * (n + m))
    sizes = np.frombuffer(payload, np.int32, m, 16 + 12 * n + 8 * m)
    ends = 16 + 12 * (n + m) + np.cumsum(sizes, dtype=np.int64)
    texts = [payload[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]
    return numbers, times, keys, texts


def send(scheme: Scheme, buckets: int):
    def run(key, table, answers):
        known, held, parts = Known(answers), [Held(), Held()], []
        if not len(answers):
            return _table([])
        _, _, texts = _rows(table)
        for number, (a, b) in enumerate(chunks(texts)):
            parts.append(scheme.part(texts[a:b]))
            for _ in _look(scheme, number, parts[-1], known, held):
                pass
        chunk, rows = answers["chunk"][0].as_py(), []
        for level, own in enumerate(held):
            for bucket, i in own.close(buckets):
                code = known.numbers[level, bucket]
                assert len(code) == len(i)
                mine = i[(code & np.uint32(1)) > 0]
                first, last = own.first[mine], own.first[mine] + own.count[mine] + scheme.window - 2
                pieces = []
                for p, x, y in zip(own.part[mine].tolist(), first.tolist(), last.tolist()):
                    part = parts[p]
                    pieces.append(part.buffer[int(part.begins(x)):int(part.ends(y))])
                rows.append((chunk, level, bucket,
                             _pack(code, own.times[i], own.key[mine], pieces)))
        return _table(rows)
    return run


def _values(scheme: Scheme, payloads: list) -> list:
    """For each message the values of all windows of its pieces, as bytes."""
    sent = [_unpack(p) for p in payloads]
    total = 1 + max(int(numbers.max()) for numbers, *_ in sent) // 2
    counts, route = np.zeros(total, np.int64), np.zeros(total, np.uint64)
    texts: list = [None] * total
    for numbers, times, keys, pieces in sent:
        at = (numbers >> np.uint32(1)).astype(np.int64)
        counts[at] += times                # each number is once in a message
        mine = at[(numbers & np.uint32(1)) > 0]
        route[mine] = keys
        for k, t in zip(mine.tolist(), pieces):
            texts[k] = t
    answers: list = []
    size = np.cumsum(np.fromiter(map(len, texts), np.int64, total))
    # all pieces of a key stay together; they follow each other
    ends = np.append(np.flatnonzero(route[1:] != route[:-1]) + 1, total)
    begin = 0
    while begin < total:
        before = int(size[begin - 1]) if begin else 0
        enough = np.searchsorted(size[ends - 1], before + scheme.batch)
        end = int(ends[min(enough, len(ends) - 1)])
        got = scheme.resolve(texts[begin:end], counts[begin:end])
        answers += [x.astype(scheme.answer).tobytes() for x in got]
        begin = end
    return [b"".join([answers[k] for k in (numbers >> np.uint32(1)).tolist()])
            for numbers, *_ in sent]


def resolve(scheme: Scheme):
    def run(key, table):
        rows, bucket = [], key[0].as_py()
        kinds, senders = np.array(table["kind"].to_pylist()), table["chunk"].to_pylist()
        payloads = table["payload"].to_pylist()
        for level in (0, 1):
            own = np.flatnonzero(kinds == level).tolist()
            if own:
                got = _values(scheme, [payloads[k] for k in own])
                rows += [(senders[k], VALUES + level, bucket, p) for k, p in zip(own, got)]
        return _table(rows)
    return run


def apply(scheme: Scheme, buckets: int, finish):
    def run(key, table, answers):
        _, _, texts = _rows(table)
        known, held, parts = Known(answers), [Held(), Held()], []
        for number, (a, b) in enumerate(chunks(texts)):
            part, found = scheme.part(texts[a:b]), []
            for level, first, count, numbers in _look(scheme, number, part, known, held):
                found.append((level, first.astype(np.int32), count.astype(np.int32), numbers))
            parts.append((a, b, part, found))
        width, values = np.dtype(scheme.answer).itemsize, []
        for level, own in enumerate(held):
            own_values: list = [None] * len(own.times)
            for bucket, i in own.close(buckets):       # as they were sent
                payload = known.values[level, bucket]
                ends = np.cumsum(own.count[i]) * width
                assert ends[-1] == len(payload)
                for k, x, y in zip(i.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                    own_values[k] = payload[x:y]
            values.append(own_values)
        known.values.clear()
        out = []
        for a, b, part, found in parts:
            edge = np.zeros(int(part.text_first[-1]) + 1, np.int32)
            while found:
                level, first, count, numbers = found.pop()
                if not len(first):
                    continue
                own_values = values[level]
                value = np.frombuffer(b"".join([own_values[k] for k in numbers.tolist()]),
                                      scheme.answer)
                window = np.repeat(first - (np.cumsum(count) - count), count)
                window += np.arange(len(window))
                window = window[value > 1]
                lo = int(first[0])
                times = np.bincount(window - lo)
                edge[lo:lo + len(times)] += times
                edge[lo + scheme.window:lo + scheme.window + len(times)] -= times
            gone = np.cumsum(edge, out=edge)[:-1] > 0
            for d in range(b - a):
                lo, hi = int(part.text_first[d]), int(part.text_first[d + 1])
                out.append(finish(part, lo, hi, gone[lo:hi]))
        return pa.table({
            "doc_id": table["doc_id"].cast(pa.int64()),
            "n_units": pa.array([n for n, _, _ in out], pa.int64()),
            "spans": pa.array([s for _, s, _ in out], pa.list_(pa.list_(pa.int64()))),
            "kept": pa.array([k for _, _, k in out], pa.binary())})
    return run


def remove_repeats(docs: DataFrame, scheme: Scheme, finish) -> DataFrame:
    """Columns doc_id, n_units, spans (removed runs, in units), kept (bytes);
    one row for each row of ``docs`` (columns doc_id and text are used)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = n_chunks = int(size // passages.CHUNK) + 1
    by_chunk = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int")).groupBy("chunk")
    offers = by_chunk.applyInArrow(offer_halves(scheme, buckets), _MESSAGE).groupBy("bucket")
    hot = offers.applyInArrow(choose(HOT, hot_only=True), _MESSAGE)
    cut = by_chunk.cogroup(hot.groupBy("chunk")).applyInArrow(
        lambda key, a, b: offer_windows(scheme, buckets)(key, a, b), _MESSAGE).groupBy("bucket")
    chosen = offers.applyInArrow(choose(HOT), _MESSAGE).unionByName(
        cut.applyInArrow(choose(HOT), _MESSAGE))
    pieces = by_chunk.cogroup(chosen.groupBy("chunk")).applyInArrow(
        lambda key, a, b: send(scheme, buckets)(key, a, b), _MESSAGE)
    values = pieces.groupBy("bucket").applyInArrow(resolve(scheme), _MESSAGE)
    return by_chunk.cogroup(chosen.unionByName(values).groupBy("chunk")).applyInArrow(
        lambda key, a, b: apply(scheme, buckets, finish)(key, a, b),
        "doc_id long, n_units long, spans array<array<long>>, kept binary")
