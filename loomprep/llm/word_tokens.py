"""Token ids of whole texts, looked up by distinct word parts.

The vocabulary's tokenizer splits at white space, lowers the case, and then takes
runs of letters, single digits and runs of other characters as parts that are
merged on their own.  So a text's ids are those of its parts, and each distinct
part is encoded once and remembered.  Parts are cut here only in words of ASCII
and Latin-1 letters, digits and punctuation without an apostrophe; any other word
(other scripts, combining marks, apostrophes, special tokens) is one part.

Parts are told apart by their bytes (``hashing.distinct_ranges``), never by a
hash.  New parts are encoded many in one text and cut at the tokens that close a
part (``</w>``); where the vocabulary has no such tokens, or their number does not
match, they are encoded one by one.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa

from .hashing import Words, chunks, distinct_ranges

VOCABULARY = "word_bpe_49k.json"
CACHE_PARTS = 200_000    # distinct parts in each of the two generations a worker remembers
JOINED = 512             # new parts encoded as one text

_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[32] = _SPACE
_CLASS[[ord("'"), ord("|")]] = _OTHER    # contractions; special tokens are written <|...|>
_LATIN = np.zeros(256, bool)             # second bytes of the letters U+00C0 to U+00FF
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False             # the signs for times and divided by
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def cut_parts(words: Words):
    """``(bytes with lower case where parts were cut, start, end, cut or whole)``."""
    data = words.data
    kind = _CLASS[data]
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    second &= _LATIN[data]
    kind[second] = _LETTER
    kind[:-1][second[1:]] = _LETTER
    whole = np.add.reduceat(kind == _OTHER, words.start) > 0
    inside = np.repeat(whole, np.diff(np.append(words.start, len(data))))
    low = _LOWER[data]
    low[second & (data <= 0x9E)] += 0x20
    begin = (kind != _SPACE) & ~inside
    begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begin[words.start[whole]] = True
    edge = np.flatnonzero(begin | (kind == _SPACE))
    opens = np.flatnonzero(begin[edge])
    return np.where(inside, data, low), edge[opens], edge[opens + 1], ~inside[edge[opens]]


class WordTokenizer:
    """Token ids of texts, by distinct parts of words."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.end = int(end_id).to_bytes(4, "little")
        self.known: dict = {}
        self.older: dict = {}

    def _each(self, parts: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(
            [p.decode() for p in parts], add_special_tokens=False)]

    def _together(self, parts: list[bytes]) -> list[bytes]:
        groups = [parts[k:k + JOINED] for k in range(0, len(parts), JOINED)]
        out: list[bytes] = []
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(
                [b" ".join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.closing[ids]) + 1)).tolist()
            if len(ends) != len(group) or ends[-1] != 4 * len(ids):
                out += self._each(group)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0] + ends, ends)]
        return out

    def _look_up(self, parts: list[bytes], cut: list[bool]) -> list[bytes]:
        """Ids (little-endian bytes) of distinct parts."""
        if len(self.known) > CACHE_PARTS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = [known.get(p) for p in parts]
        missing: tuple[list, list] = ([], [])
        for k, ids in enumerate(found):
            if ids is None:
                ids = older.get(parts[k])
                if ids is None:
                    missing[cut[k]].append(k)
                else:
                    found[k] = known[parts[k]] = ids
        for places, encode in zip(missing, (self._each, self._together)):
            if places:
                new = [parts[k] for k in places]
                for k, p, ids in zip(places, new, encode(new)):
                    found[k] = known[p] = ids
        return found

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; where each text begins, and the total)."""
        words = Words(texts)
        if len(words):
            data, start, end, cut = cut_parts(words)
            number, rows = distinct_ranges(data, start, end)
            raw = data.tobytes()
            table = self._look_up([raw[a:b] for a, b in zip(start[rows].tolist(), end[rows].tolist())],
                                  cut[rows].tolist())
            first = np.searchsorted(start, np.append(words.start, len(data))[words.first])
        else:
            number, table, first = np.zeros(0, np.int64), [], np.zeros(len(texts) + 1, np.int64)
        table.append(self.end)
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        flat = np.frombuffer(b"".join(table), "<u4")
        place = np.cumsum(sizes) - sizes
        # parts in order, and the end id after each text
        unit = np.full(len(number) + len(texts), len(table) - 1)
        unit[np.arange(len(number)) + np.repeat(np.arange(len(texts)), np.diff(first))] = number
        n = sizes[unit]
        upto = np.cumsum(n)
        ids = flat[np.repeat(place[unit] - upto + n, n) + np.arange(int(upto[-1]) if len(n) else 0)]
        return ids, np.concatenate(([0], upto[first[1:] + np.arange(len(texts))]))


_WORKER: dict = {}


def worker_tokenizer(path: str, end_id: int) -> WordTokenizer:
    if (path, end_id) not in _WORKER:
        _WORKER[path, end_id] = WordTokenizer(path, end_id)
    return _WORKER[path, end_id]


def token_pieces(path: str, length: int, end_id: int, with_ids: bool):
    """For ``mapInArrow`` over doc_id, text: each text's ids and the end id, cut at
    multiples of ``length``: doc_id, start, length, ids_crc32, doc_tokens[, ids]."""
    def run(batches):
        tokenizer = worker_tokenizer(path, end_id)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for a, b in chunks(texts):
                ids, begin = tokenizer.encode(texts[a:b])
                n = np.diff(begin)
                count = -(-n // length)
                owner = np.repeat(np.arange(b - a), count)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * length
                size = np.minimum(n[owner] - start, length)
                lo = begin[owner] + start
                cut = [ids[x:x + s].astype("<u4") for x, s in zip(lo.tolist(), size.tolist())]
                columns = [batch.column("doc_id")[a:b].take(pa.array(owner)), pa.array(start),
                           pa.array(size), pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                           pa.array(n[owner])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(cut, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run
