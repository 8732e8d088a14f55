"""Shared search for passages that occur more than once in a corpus.

Used by the substring dedup; the suffix-array dedup shares the pieces, and
sends them in another way (see ``distinct_passages``).  A passage is a window
of a fixed number of units (words or bytes).  Every window is anchored at the
smallest hash among the grams it contains, so equal windows have equal
anchors; consecutive windows with one anchor form a *piece*, and every
occurrence of a window lies in pieces of the same anchor.  The corpus is
dealt into chunks of a few MB, and hashes and pieces into buckets:

1. each chunk sends the distinct anchors it holds to their buckets;
2. a bucket answers each chunk with those that occur more than once;
3. each chunk sends the distinct pieces around such anchors to their buckets;
4. a bucket *resolves* its pieces (the operator's own method, exact on the
   words or bytes) and answers each chunk with one value for each window;
5. each chunk applies the answers to its texts.

Copies are merged within a chunk before anything is shuffled, so a hot anchor
arrives at most once from each chunk; anchors that more than ``HOT`` chunks
hold are sent as single windows dealt by the window's own hash, so that no
bucket gathers all contexts of a frequent phrase.  Only chunk- and
bucket-sized arrays are held by a task, the driver sees none of them, and all
of it is one plan: a lost executor's part is computed again from its inputs.
Long texts are looked at in overlapping segments, and each distinct piece is
kept once, so a long run of one letter, of which every window is a piece, takes
a few numbers for each window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import (BYTE_VALUE, Words, chunks, gram_hashes, prefix_sums, range_hash,
                      window_min)

CHUNK = 4 << 20          # bytes of text in a chunk, about
BUCKET = 1 << 20         # bytes of text for each bucket
HOT = 256                # chunks that may hold an anchor before its pieces are cut up
SEGMENT = 1 << 20        # windows of a long text whose anchors are found at a time
_MESSAGE = "chunk int, kind int, bucket int, payload binary"
NO_DOC = np.iinfo(np.int64).max


@dataclass
class Part:
    """Units (words or bytes) of some texts, in one buffer."""

    buffer: bytes
    text_first: np.ndarray              # first unit of each text, then the total
    start: np.ndarray | None = None     # byte range of each unit (None: each byte is one)
    end: np.ndarray | None = None

    def begins(self, unit: np.ndarray) -> np.ndarray:
        return unit if self.start is None else self.start[unit]

    def ends(self, unit: np.ndarray) -> np.ndarray:
        return unit + 1 if self.end is None else self.end[unit]

    def values(self, lo: int, hi: int) -> np.ndarray:
        """A hash of each of the units lo .. hi - 1."""
        if self.start is None:
            return BYTE_VALUE[np.frombuffer(self.buffer, np.uint8, hi - lo, lo)]
        a, b = int(self.start[lo]), int(self.end[hi - 1])
        sums = prefix_sums(BYTE_VALUE[np.frombuffer(self.buffer, np.uint8, b - a, a)])
        return range_hash(sums, self.start[lo:hi] - a, self.end[lo:hi] - a)

    def texts_of(self, unit: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.text_first, unit, "right") - 1

    def texts(self, lo: int, hi: int) -> np.ndarray:
        """The text of each of the units lo .. hi - 1."""
        a, b = self.texts_of(np.array([lo, hi - 1])).tolist()
        return np.repeat(np.arange(a, b + 1),
                         np.diff(np.clip(self.text_first[a:b + 2], lo, hi)))


@dataclass
class Scheme:
    """``window``, ``gram``: in units; ``words`` or else bytes are the units.

    ``resolve(texts, values)`` gets distinct pieces with their merged value
    (the smallest doc_id if ``by_doc``, else the number of occurrences) and
    returns an array for each, one entry for each window."""

    window: int
    gram: int
    words: bool
    by_doc: bool
    resolve: Callable[[list, np.ndarray], list]
    answer: type = np.int64
    batch: int = 1 << 19     # bytes of pieces resolved at a time

    def part(self, texts: list) -> Part:
        if self.words:
            w = Words(texts)
            return Part(w.buffer, w.first, w.start, w.end)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return Part(b"".join(texts), np.concatenate(([0], np.cumsum(sizes))))

    def pieces(self, part: Part):
        """(anchor, text, first window, windows) of the pieces, as arrays for one
        segment at a time.  Only texts longer than ``SEGMENT`` are cut, at places
        counted from their own start: the order of the texts, which may differ
        from one run of a task to the next, changes no piece."""
        for _, _, _, *piece in self.segments(part):
            yield tuple(piece)

    def segments(self, part: Part):
        """For each segment its first unit, prefix sums of its units' hashes, hashes
        of its grams, and the arrays of :meth:`pieces`."""
        sizes = np.diff(part.text_first)
        cuts = [0]
        for k in np.flatnonzero(sizes > SEGMENT).tolist():
            begin = int(part.text_first[k])
            cuts += range(begin, begin + int(sizes[k]), SEGMENT)
        windows = int(part.text_first[-1]) - self.window + 1
        for lo, end in zip(cuts, [*cuts[1:], windows]):
            n = min(end, windows) - lo
            if n <= 0:
                continue
            hi = lo + n + self.window - 1
            sums = prefix_sums(part.values(lo, hi))
            g = gram_hashes(sums, self.gram)
            m = window_min(g, self.window - self.gram + 1)
            doc = part.texts(lo, hi)
            valid = doc[:n] == doc[self.window - 1:]
            new = ~valid
            new[0] = True
            # a new piece where the smallest hash changes or its leftmost place is left
            new[1:] |= (m[1:] != m[:-1]) | (g[:n - 1] == m[:-1]) | ~valid[:-1]
            breaks = np.flatnonzero(new)
            length = np.diff(np.concatenate((breaks, [n])))
            ok = valid[breaks]
            yield lo, sums, g, m[breaks[ok]], doc[breaks[ok]], lo + breaks[ok], length[ok]

    def windows(self, text: bytes) -> int:
        units = text.count(b" ") + 1 if self.words else len(text)
        return units - self.window + 1


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    """ids (null: the largest), whether they are given, texts as bytes (null: empty)."""
    ids = table["doc_id"].combine_chunks()
    known = ~np.asarray(ids.is_null())
    values = np.asarray(ids.fill_null(NO_DOC), np.int64)
    texts = [t or b"" for t in table["text"].combine_chunks().cast(pa.binary()).to_pylist()]
    return values, known, texts


def _table(rows: list) -> pa.Table:
    chunk, kind, bucket, payload = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"chunk": pa.array(chunk, pa.int32()), "kind": pa.array(kind, pa.int32()),
                     "bucket": pa.array(bucket, pa.int32()),
                     "payload": pa.array(payload, pa.binary())})


def _split(bucket: np.ndarray):
    """(bucket, indices) for each bucket that occurs, indices ascending."""
    order = np.argsort(bucket, kind="stable")
    at = np.flatnonzero(np.diff(bucket[order])) + 1
    for idx in np.split(order, at) if len(order) else []:
        yield int(bucket[idx[0]]), idx


def _pack(routes, texts, values) -> bytes:
    head = np.array([len(texts)], np.int64)
    sizes = np.fromiter(map(len, texts), np.int32, len(texts))
    return b"".join((head.tobytes(), routes.tobytes(), values.tobytes(), sizes.tobytes(), *texts))


def _unpack(payload: bytes):
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    routes = np.frombuffer(payload, np.uint64, n, 8)
    values = np.frombuffer(payload, np.int64, n, 8 + 8 * n)
    sizes = np.frombuffer(payload, np.int32, n, 8 + 16 * n)
    ends = 8 + 20 * n + np.cumsum(sizes, dtype=np.int64)
    return routes, values, [payload[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]


def _distinct(h: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Distinct hashes with their smallest ``low`` and largest ``high``."""
    if not len(h):
        return h, low, high
    order = np.argsort(h, kind="stable")
    h = h[order]
    at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return h[at], np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at)


def _anchors(scheme: Scheme, buckets: int):
    def run(key, table):
        ids, _, texts = _rows(table)
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        seen = 0
        for a, b in chunks(texts):
            for anchor, doc, _, _ in scheme.pieces(scheme.part(texts[a:b])):
                # whose it is: the document, or each piece on its own
                owner = ids[a:b][doc] if scheme.by_doc else np.arange(seen, seen + len(doc))
                seen += len(doc)
                found.append(_distinct(anchor, owner, owner))
        h, low, high = _distinct(*map(np.concatenate, zip(*found)))
        several = low < high
        rows = [(key[0].as_py(), 0, b, h[i].tobytes() + several[i].astype(np.uint8).tobytes())
                for b, i in _split((h % np.uint64(buckets)).astype(np.int64))]
        return _table(rows)
    return run


def _shared(key, table):
    senders = table["chunk"].to_pylist()
    hashes, flags, sender = [], [], []
    for k, payload in enumerate(table["payload"].to_pylist()):
        n = len(payload) // 9
        hashes.append(np.frombuffer(payload, np.uint64, n))
        flags.append(np.frombuffer(payload, np.uint8, n, 8 * n))
        sender.append(np.full(n, k))
    h, flag, sender = np.concatenate(hashes), np.concatenate(flags), np.concatenate(sender)
    _, where, times = np.unique(h, return_inverse=True, return_counts=True)
    several = np.bincount(where, flag) > 0
    keep = (several | (times > 1))[where]
    h, sender, hot = h[keep], sender[keep], (times > HOT)[where][keep]
    bucket = key[0].as_py()
    return _table([(senders[k], 1, bucket, h[i].tobytes() + hot[i].astype(np.uint8).tobytes())
                   for k, i in _split(sender)])


def _known(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shared anchors of a chunk, and which of them are hot."""
    h, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for kind, payload in zip(answers["kind"].to_pylist(), answers["payload"].to_pylist()):
        if kind == 1:
            n = len(payload) // 9
            h.append(np.frombuffer(payload, np.uint64, n))
            hot.append(np.frombuffer(payload, np.uint8, n, 8 * n))
    h, hot = np.concatenate(h), np.concatenate(hot)
    order = np.argsort(h)
    return h[order], hot[order] > 0


def _pieces(scheme: Scheme, part: Part, known: np.ndarray, hot: np.ndarray):
    """(text, first window, windows) of the shared pieces, as arrays for each
    segment, and an iterator over their (route, bytes)."""
    if not len(known):
        return
    for anchor, doc, first, count in scheme.pieces(part):
        at = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
        picked = np.flatnonzero(known[at] == anchor)
        single = hot[at[picked]]
        times = np.where(single, count[picked], 1)      # hot pieces go window by window
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        first = np.repeat(first[picked], times) + within
        count = np.repeat(np.where(single, 1, count[picked]), times)
        yield (np.repeat(doc[picked], times), first, count,
               _routes(part, np.repeat(anchor[picked], times), np.repeat(single, times),
                       part.begins(first), part.ends(first + count + scheme.window - 2)))


def _routes(part: Part, anchor, single, begin, end):
    buffer = part.buffer
    for at in range(0, len(anchor), 1 << 16):
        block = slice(at, at + (1 << 16))
        for h, alone, a, b in zip(anchor[block].tolist(), single[block].tolist(),
                                  begin[block].tolist(), end[block].tolist()):
            text = buffer[a:b]
            yield (hash_bytes(text) if alone else h), text


def _numbers(index: dict, keys, n: int) -> np.ndarray:
    """The number of each key in ``index``; new ones are added."""
    return np.fromiter((index.setdefault(k, len(index)) for k in keys), np.int32, n)


def hash_bytes(text: bytes) -> int:
    from xxhash import xxh3_64_intdigest
    return xxh3_64_intdigest(text)


def _send(scheme: Scheme, buckets: int):
    def run(key, table, answers):
        ids, _, texts = _rows(table)
        known, hot = _known(answers)
        index: dict = {}
        merged = np.zeros(0, np.int64)
        for a, b in chunks(texts):
            for doc, first, _, keys in _pieces(scheme, scheme.part(texts[a:b]), known, hot):
                number = _numbers(index, keys, len(first))
                fresh = np.full(len(index) - len(merged), NO_DOC if scheme.by_doc else 0, np.int64)
                merged = np.concatenate((merged, fresh))
                if scheme.by_doc:
                    np.minimum.at(merged, number, ids[a:b][doc])
                else:
                    merged += np.bincount(number, minlength=len(merged))
        order = sorted(index)
        routes = np.fromiter((r for r, _ in order), np.uint64, len(order))
        values = merged[np.fromiter(map(index.__getitem__, order), np.int64, len(order))]
        index.clear()
        chunk = (answers["chunk"] if len(answers) else table["chunk"])[0].as_py()
        return _table([(chunk, 0, b, _pack(routes[i], [order[k][1] for k in i], values[i]))
                       for b, i in _split((routes % np.uint64(buckets)).astype(np.int64))])
    return run


def _resolve(scheme: Scheme):
    def run(key, table):
        index: dict = {}
        values: list = []
        sent = []
        for payload in table["payload"].to_pylist():
            routes, vals, texts = _unpack(payload)
            own = []
            for r, v, t in zip(routes.tolist(), vals.tolist(), texts):
                k = index.setdefault((r, t), len(values))
                if k == len(values):
                    values.append(v)
                else:
                    values[k] = min(values[k], v) if scheme.by_doc else values[k] + v
                own.append(k)
            sent.append(own)
        keys = list(index)
        order = sorted(range(len(keys)), key=lambda k: keys[k][0])
        answers: list = [None] * len(keys)
        group, size = [], 0
        for n, k in enumerate(order):      # all pieces of a route stay together
            group.append(k)
            size += len(keys[k][1])
            last = n + 1 == len(order)
            if last or size >= scheme.batch and keys[order[n + 1]][0] != keys[k][0]:
                got = scheme.resolve([keys[g][1] for g in group],
                                     np.array([values[g] for g in group], np.int64))
                for g, x in zip(group, got):
                    answers[g] = x.astype(scheme.answer).tobytes()
                group, size = [], 0
        bucket = key[0].as_py()
        return _table([(c, 2, bucket, b"".join(answers[k] for k in own))
                       for c, own in zip(table["chunk"].to_pylist(), sent)])
    return run


def _apply(scheme: Scheme, buckets: int, finish):
    def run(key, table, answers):
        ids, given, texts = _rows(table)
        known, hot = _known(answers)
        parts = []
        index: dict = {}
        for a, b in chunks(texts):
            part, found = scheme.part(texts[a:b]), []
            for _, first, count, keys in _pieces(scheme, part, known, hot):
                number = _numbers(index, keys, len(first))
                found.append((first.astype(np.int32), count.astype(np.int32), number))
            parts.append((a, b, part, found))
        values: list = [None] * len(index)
        payload = {b: p for k, b, p in zip(answers["kind"].to_pylist(),
                                           answers["bucket"].to_pylist(),
                                           answers["payload"].to_pylist()) if k == 2}
        at: dict = {b: 0 for b in payload}
        width = np.dtype(scheme.answer).itemsize
        for p in sorted(index):            # as they were sent
            b = p[0] % buckets
            end = at[b] + scheme.windows(p[1]) * width
            values[index[p]] = payload[b][at[b]:end]
            at[b] = end
        index.clear()
        out = []
        for a, b, part, found in parts:
            edge = np.zeros(int(part.text_first[-1]) + 1, np.int32)
            while found:
                first, count, number = found.pop()
                if not len(first):
                    continue
                value = np.frombuffer(b"".join([values[k] for k in number.tolist()]), scheme.answer)
                window = np.repeat(first - (np.cumsum(count) - count), count)
                window += np.arange(len(window))
                if scheme.by_doc:
                    doc = np.repeat(part.texts_of(first), count) + a
                    window = window[(value < ids[doc]) & given[doc]]
                else:
                    window = window[value > 1]
                lo = int(first[0])
                times = np.bincount(window - lo)
                edge[lo:lo + len(times)] += times
                edge[lo + scheme.window:lo + scheme.window + len(times)] -= times
            gone = np.cumsum(edge, out=edge)[:-1] > 0
            for d in range(b - a):
                lo, hi = int(part.text_first[d]), int(part.text_first[d + 1])
                out.append(finish(part, lo, hi, gone[lo:hi]))
        spans = [s for _, s, _ in out]
        kind = pa.binary()
        return pa.table({
            "doc_id": table["doc_id"].cast(pa.int64()),
            "n_units": pa.array([n for n, _, _ in out], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            "kept": pa.array([k for _, _, k in out], kind)})
    return run


def gone_spans(gone: np.ndarray) -> list:
    """Maximal runs of removed units as [start, end)."""
    whole = np.zeros(len(gone) + 2, np.int8)
    whole[1:-1] = gone
    return np.flatnonzero(np.diff(whole)).reshape(-1, 2).tolist()


def remove_repeats(docs: DataFrame, scheme: Scheme, finish) -> DataFrame:
    """Columns doc_id, n_units, spans (removed runs, in units), kept (bytes);
    one row for each row of ``docs`` (columns doc_id and text are used)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = int(size // CHUNK) + 1
    buckets = int(size // BUCKET) + 1
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int"))
    by_chunk = dealt.groupBy("chunk")
    sent = by_chunk.applyInArrow(_anchors(scheme, buckets), _MESSAGE)
    shared = sent.groupBy("bucket").applyInArrow(_shared, _MESSAGE)
    pieces = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(
        lambda key, a, b: _send(scheme, buckets)(key, a, b), _MESSAGE)
    answers = pieces.groupBy("bucket").applyInArrow(_resolve(scheme), _MESSAGE)
    return by_chunk.cogroup(shared.unionByName(answers).groupBy("chunk")).applyInArrow(
        lambda key, a, b: _apply(scheme, buckets, finish)(key, a, b),
        "doc_id long, n_units long, spans array<array<long>>, kept binary")
