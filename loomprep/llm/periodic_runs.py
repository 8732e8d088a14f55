"""Periodic runs of words: seed and extend along diagonals.

A run is a stretch of consecutive words with smallest period q and a length of at
least ``max(SHORTEST, TIMES * q)`` that no neighbouring word extends.  Words that
lie q apart are equal all along it, so on the diagonal of lag q it matches over at
least ``max(SHORTEST - q, (TIMES - 1) * q)`` words: the guaranteed overlap.

* Lags are taken in classes from Q to (3 Q + 1) / 2 (only 1 and 2 in the first).
  k-grams of the class's smallest guaranteed overlap (3 Q; 5 in the first class)
  are indexed, and each occurrence is paired with the next one of the same
  document.  Inside a run of period q that next one lies exactly q further: were
  it nearer, the k-gram would have two periods whose sum is at most its length + 1,
  hence their common divisor as a period, and with it the run.  So pairs
  at the class's lags find every run, and a run grown from one has its lag as its
  smallest period.
* Pairs that share a lag and touch are one seed.  A seed is extended both ways
  until words differ; the furthest position covered on each lag suppresses seeds
  within a stretch that is known already.
* k-grams are told apart exactly, by names of pairs of names (1, 2, 4, ... words).
  Beforehand, hashes of 5-grams leave out all words that lie in no repeated 5-gram
  of their document, which no run can hold; a collision there only keeps more.

Every text is handled within its row's task: there is no shuffle, and what a task
holds follows its longest text, not the table.

Defined cases: a null or empty text has no words, no runs and an empty collapsed
text; repeated rows and a null doc_id are answered each; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .hashing import Words, chunks, distinct_ranges, grams, mix

SHORTEST, TIMES = 6, 4
_FIRST = SHORTEST - 1        # words of the shortest guaranteed overlap
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"


def lag_classes(longest: int):
    """``(smallest lag, largest lag, k)`` of the classes that fit ``longest`` words."""
    low = 1
    while TIMES * low <= longest:
        high = 2 if low == 1 else (3 * low + 1) // 2
        yield low, high, _FIRST if low == 1 else (TIMES - 1) * low
        low = high + 1


def repeated_stretches(number: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges (start, end) covered by 5-grams that their document repeats."""
    n = len(number) - _FIRST + 1
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.flatnonzero(doc[:n] == doc[_FIRST - 1:])
    code = grams(mix(number.astype(np.uint64) + np.uint64(1)), _FIRST)[inside]
    group = pd.factorize(code ^ mix(doc[inside].astype(np.uint64) + np.uint64(1)))[0]
    again = np.zeros(n + 2, bool)            # with one position before and one behind
    again[inside + 1] = np.bincount(group, minlength=1)[group] > 1
    start = np.flatnonzero(again[1:] & ~again[:-1])      # a gap lies between two documents
    end = np.flatnonzero(again[:-1] & ~again[1:])
    keep = end - start >= SHORTEST - _FIRST + 1
    return start[keep], end[keep] + _FIRST - 1


class Grams:
    """Exact names of the windows of a sequence, by pairs of names of half the size."""

    def __init__(self, sequence: np.ndarray):
        self.names = [pd.factorize(sequence)[0]]

    def keys(self, k: int) -> np.ndarray:
        level = k.bit_length() - 1
        while len(self.names) <= level:
            last, half = self.names[-1], 1 << (len(self.names) - 1)
            self.names.append(pd.factorize((last[:len(last) - half] << 32) | last[half:])[0])
        name = self.names[level]
        rest = k - (1 << level)
        return (name[:len(name) - rest] << 32) | name[rest:]


def next_occurrences(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions with an equal key further on, and the distance to the next one."""
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    return order[same], order[same + 1] - order[same]


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements of two views are equal."""
    size, at = min(len(a), len(b)), 0
    step = 32
    while at < size:
        differ = a[at:min(at + step, size)] != b[at:min(at + step, size)]
        if differ.any():
            return at + int(differ.argmax())
        at += step
        step *= 2
    return size


def _class_runs(sequence: np.ndarray, windows: Grams, low: int, high: int, k: int):
    """(start, length, period) of the runs of one class of lags."""
    at, lag = next_occurrences(windows.keys(k))
    keep = (lag >= low) & (lag <= high)
    at, lag = at[keep], lag[keep]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    head = np.ones(len(at), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (at[1:] - at[:-1] > k)
    covered: dict[int, int] = {}             # furthest position known on each lag
    for i, q in zip(at[head].tolist(), lag[head].tolist()):
        if i < covered.get(q, 0):
            continue
        begin = i - _matching(sequence[:i][::-1], sequence[:i + q][::-1])
        end = i + k + _matching(sequence[i + k:], sequence[i + k + q:])
        covered[q] = end
        if end - begin + q >= max(SHORTEST, TIMES * q):
            yield begin, end - begin + q, q


def find_runs(number: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, where ``number`` names each word
    and ``doc`` its document; starts count over all words given."""
    start, end = repeated_stretches(number, doc)
    found: list[tuple[int, int, int]] = []
    sequence = windows = origin = None
    for low, high, k in lag_classes(int((end - start).max()) if len(start) else 0):
        fits = end - start >= max(SHORTEST, TIMES * low)
        start, end = start[fits], end[fits]
        size = end - start
        total = int(size.sum()) + len(size) + 1
        if sequence is None or 2 * total < len(sequence):   # leave out what has become too short
            # stretches one after another, a number of its own before each and at the end
            sequence = np.empty(total, np.int64)
            place = np.cumsum(size + 1) - size
            sequence[np.append(place - 1, total - 1)] = -1 - np.arange(len(size) + 1)
            inner = np.repeat(place - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            sequence[inner] = number[np.repeat(start - (np.cumsum(size) - size), size)
                                     + np.arange(int(size.sum()))]
            origin, shift = place, start - place
            windows = Grams(sequence)
        for at, length, q in _class_runs(sequence, windows, low, high, k):
            found.append((at + int(shift[np.searchsorted(origin, at, "right") - 1]), length, q))
    runs = np.array(found, np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _answer(texts: list[bytes]):
    """(words of each text, runs and the text they belong to, collapsed texts)."""
    words = Words(texts)
    count = np.diff(words.first)
    if not len(words):
        return count, np.zeros((0, 3), np.int64), np.zeros(0, np.int64), [b""] * len(texts)
    number, _ = distinct_ranges(words.data, words.start, words.end)
    runs = find_runs(number, words.doc)
    owner = words.doc[runs[:, 0]]
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(drop[:-1]) == 0
    bounds = np.append(words.start, len(words.data))
    kept = np.repeat(keep, np.diff(bounds))
    raw = words.data[kept].tobytes()
    upto = np.concatenate(([0], np.cumsum(kept)))[bounds[words.first]].tolist()
    collapsed = [raw[a:max(a, b - 1)] for a, b in zip(upto, upto[1:])]
    runs[:, 0] -= words.first[owner]
    return count, runs, owner, collapsed


def _rows(batches):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        for a, b in chunks(texts):
            count, runs, owner, collapsed = _answer(texts[a:b])
            items = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], fields=list(kind))
            cuts = np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[a:b], pa.array(count), pa.ListArray.from_arrays(pa.array(cuts), items),
                 pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "text"])


def collapse_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period; starts are word numbers from 0) and
    text: the words left, joined by one space, when every run keeps its first period only."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_rows, SCHEMA)


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """The contract's input: in one document of ten, by the checksum of doc_id,
    the words from some place on repeat a short piece of themselves."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", words.alias("w"), h.alias("h"), F.expr("0L + size(w)").alias("n"))
    rows = rows.selectExpr("doc_id", "text", "w", "h", "n", "(h div 10) % greatest(n, 1) as a", "h div 10 as g")
    rows = rows.selectExpr("doc_id", "text", "w", "h", "n", "a", "1 + (n - a) div (3 + g % 8) as p")
    tail = ("slice(flatten(array_repeat(slice(w, int(a + 1), int(p)), int((n - a) div p + 1))), 1, int(n - a))")
    return rows.selectExpr("doc_id", "case when h % 10 = 0 and n > 0 then "
                           f"array_join(concat(slice(w, 1, int(a)), {tail}), ' ') else text end as text")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; ties: smallest start, then period."""
    def order(x, y):
        one, two = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(one > two, -1).when(one < two, 1)
                .when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))
    return F.get(F.array_sort(runs, order), F.lit(0))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(with_repeated_tails(table(spark, sf_dir, "documents")))
    found = found.withColumn("best", strongest(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
