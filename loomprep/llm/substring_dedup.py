"""Substring dedup: suffix automata of reference shards.

Words that lie in a window of ``window`` consecutive words which also starts
in a document with a smaller id are removed.  The reference is the corpus
itself: its shared passages (see ``passages``) are dealt into shards by their
anchors; for each shard one suffix automaton is built over the words of the
shard's reference pieces, every state knowing the smallest document among its
occurrences.  The pieces of the documents dealt to that shard are streamed
through it for matching statistics; where the match is at least ``window``
words long, the state for the last ``window`` words gives the first document.

An automaton is sent to no other task: it meets exactly the passages that can
match in it, and the sum of all automata grows with the corpus, so a
broadcast of all of them would have no bound.

Defined cases: a null text has no words; an empty text has none either; a null
doc_id is neither smaller nor larger than any other, so such a row keeps all
its words and removes none elsewhere; rows with one doc_id do not remove each
other's words; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .passages import Scheme, gone_spans, remove_repeats

WINDOW = 13
GRAM = 7


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word ids.

    ``first[s]`` is the smallest document among the occurrences of state s."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first: list[int] = [np.iinfo(np.int64).max]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(np.iinfo(np.int64).max)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """State for the words of ``p`` followed by ``c``, taken out of ``q``."""
        nxt, link = self.next, self.link
        clone = self._state(self.length[p] + 1, dict(nxt[q]), link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def add(self, words: list, doc: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        none, last = first[0], 0
        for c in words:
            q = nxt[last].get(c)
            size = length[last] + 1
            if q is not None:
                last = q if length[q] == size else self._split(last, c, q)
            else:
                p, last = last, len(link)
                nxt.append({})
                link.append(0)
                length.append(size)
                first.append(none)
                while p >= 0 and q is None:
                    nxt[p][c] = last
                    p = link[p]
                    q = nxt[p].get(c) if p >= 0 else None
                if p >= 0:
                    link[last] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            if doc < first[last]:
                first[last] = doc

    def close(self) -> None:
        """Hand the smallest documents down the suffix links."""
        first, link = self.first, self.link
        for s in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if first[s] < first[link[s]]:
                first[link[s]] = first[s]

    def stream(self, words: list, window: int) -> list:
        """For each window: smallest document that holds it (none: the largest int)."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        state, matched, out = 0, 0, []
        none = np.iinfo(np.int64).max
        for n, c in enumerate(words, 1):
            q = nxt[state].get(c)
            while q is None and state:
                state = link[state]
                matched = length[state]
                q = nxt[state].get(c)
            if q is not None:
                state, matched = q, matched + 1
            if n >= window:
                while matched > window and length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                out.append(first[state] if matched >= window else none)
        return out


def resolve(texts: list, docs: np.ndarray, window: int = WINDOW) -> list:
    ids: dict = {}
    pieces = [[ids.setdefault(w, len(ids)) for w in t.split(b" ")] for t in texts]
    automaton = SuffixAutomaton()
    for words, doc in zip(pieces, docs.tolist()):
        automaton.add(words, doc)
    automaton.close()
    return [np.array(automaton.stream(words, window), np.int64) for words in pieces]


def _finish(part, lo: int, hi: int, gone: np.ndarray):
    if not gone.any():
        kept = part.buffer[part.start[lo]:part.end[hi - 1]] if hi > lo else b""
        return hi - lo, [], kept
    a, b = part.start[lo:hi][~gone].tolist(), part.end[lo:hi][~gone].tolist()
    return hi - lo, gone_spans(gone), b" ".join([part.buffer[x:y] for x, y in zip(a, b)])


def scheme(window: int = WINDOW, gram: int = GRAM) -> Scheme:
    return Scheme(window, min(gram, window), True, True,
                  lambda texts, docs: resolve(texts, docs, window))


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, removed (array of [start, end) in words), kept (the
    remaining words joined by one space); one row for each input row."""
    out = remove_repeats(docs, scheme(window, gram), _finish)
    return out.select("doc_id", F.col("n_units").alias("n_words"),
                      F.col("spans").alias("removed"),
                      F.col("kept").cast("string").alias("kept"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return out.select("doc_id", "n_words", removed.alias("n_removed"),
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
