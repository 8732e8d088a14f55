"""Packing: cutting stock by column generation over a length histogram.

Documents become token ids (a public tokenizer, then an end id) and are cut
into pieces of ``length`` tokens and a remainder.  Pieces are counted by
length class (``STEP`` tokens wide, rounded up).  A linear program over
patterns - numbers of pieces of each class that fit one sequence - covers the
histogram with as few sequences as possible: its columns are made on demand by
knapsack dynamic programming over the classes' dual prices.  Counts of
patterns are rounded down, what is left is packed largest first, and the
pieces, ranked within their class, are assigned to the patterns' places.

The histogram has ``length / STEP`` classes whatever the corpus, so the linear
program on the driver has a fixed size.  Ranks come from counts by (class,
hash bucket), so a class that holds a third of all pieces is ranked in many
tasks.  Sequences hold at most ``length`` tokens, and offsets are summed
within a sequence.  Nothing but counts and patterns passes the driver.

Token ids come from ``word_tokens`` (each distinct word is encoded once and
looked up; equal to the tokenizer on the whole text).

Defined cases: null and empty texts have the end id only; a text with
white space only likewise; repeated rows are packed each; a null doc_id is
carried along; other columns are ignored; an empty table gives no sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import table
from .word_tokens import default_tokenizer, token_pieces

LENGTH, STEP, END_ID = 4096, 16, 2
BUCKET_PIECES = 50_000   # pieces of a class ranked in one bucket, about

def knapsack(price: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value and numbers of items (any number of each) within the capacity."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(size, kind="stable")
    sizes, prices = size[order], price[order]
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for w in range(1, capacity + 1):
        best[w], choice[w] = best[w - 1], -1
        k = fits[w]
        if k:
            value = prices[:k] + best[w - sizes[:k]]
            top = int(value.argmax())
            if value[top] > best[w] + 1e-12:
                best[w], choice[w] = value[top], top
    numbers = np.zeros(len(size), np.int64)
    w = capacity
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            numbers[order[choice[w]]] += 1
            w -= sizes[choice[w]]
    return float(best[capacity]), numbers


def first_patterns(demand: np.ndarray, size: np.ndarray, capacity: int) -> np.ndarray:
    """A starting basis: from the largest class down, a pattern that uses up what
    is left of the class and fills its room with smaller classes of which enough
    is left.  Its columns are triangular, so the matrix has an inverse, and the
    numbers of uses are not negative."""
    m = len(size)
    basis, left = np.zeros((m, m)), demand.astype(float)
    for c in np.argsort(-size, kind="stable"):
        basis[c, c] = capacity // size[c]
        if left[c] <= 0:
            continue
        uses = left[c] / basis[c, c]
        room = capacity - int(basis[c, c]) * size[c]
        left[c] = 0
        for j in np.argsort(-size, kind="stable"):
            if size[j] < size[c] and size[j] <= room:
                n = min(room // size[j], int(left[j] // uses))
                basis[j, c] = n
                left[j] -= n * uses
                room -= n * size[j]
    return basis


def cutting_stock(demand: np.ndarray, size: np.ndarray, capacity: int, gap: float = 0.002,
                  rounds: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used so that the demand is met
    exactly: the rounded-down linear program, then largest first.  Columns are
    added until the program is within ``gap`` of its bound."""
    m = len(size)
    if not m:
        return np.zeros((0, 0), np.int64), np.zeros(0, np.int64)
    basis = first_patterns(demand, size, capacity)           # columns are patterns
    inverse = np.linalg.inv(basis)
    used = np.maximum(inverse @ demand, 0.0)
    for step in range(rounds):
        value, pattern = knapsack(inverse.sum(0), size, capacity)
        if value <= 1 + gap:                                 # the best price bounds the optimum
            break
        direction = inverse @ pattern
        can = direction > 1e-9
        ratio = np.where(can, used / np.where(can, direction, 1.0), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        if step % 100 == 99:                                 # limits rounding errors
            inverse = np.linalg.inv(basis)
            used = np.maximum(inverse @ demand, 0.0)
            continue
        used = used - ratio[out] * direction
        used[out] = ratio[out]
        inverse[out] /= direction[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(direction[others], inverse[out])
    times = np.floor(np.maximum(used, 0.0) + 1e-6).astype(np.int64)
    patterns = np.rint(basis.T).astype(np.int64)
    left = demand - times @ patterns
    while (left < 0).any():                                  # a rounding error covered too much
        k = int(np.flatnonzero((times > 0) & (patterns[:, left < 0] > 0).any(1))[0])
        times[k] -= 1
        left = left + patterns[k]
    extra = []
    while left.any():                                        # largest first
        room, pattern = capacity, np.zeros(m, np.int64)
        for c in np.argsort(-size, kind="stable"):
            n = min(left[c], room // size[c])
            pattern[c] = n
            room -= n * size[c]
        left = left - pattern
        extra.append(pattern)
    keep = times > 0
    patterns, times = patterns[keep], times[keep]
    if extra:
        patterns = np.vstack((patterns, extra))
        times = np.concatenate((times, np.ones(len(extra), np.int64)))
    return patterns, times


class Places:
    """Sequence and place of the ``rank``-th piece of a class."""

    def __init__(self, classes: np.ndarray, patterns: np.ndarray, times: np.ndarray):
        base = np.concatenate(([0], np.cumsum(times)[:-1]))
        self.sequences = int(times.sum())
        self.by_class = {}
        for c, row in zip(classes.tolist(), patterns.T):
            use = np.flatnonzero(row)
            upto = np.cumsum(row[use] * times[use])
            self.by_class[c] = (upto, row[use], base[use])

    def sequence(self, size_class: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rank), np.int64)
        for c in np.unique(size_class).tolist():
            idx = np.flatnonzero(size_class == c)
            upto, each, base = self.by_class[c]
            k = np.searchsorted(upto, rank[idx], "right")
            before = np.concatenate(([0], upto))[k]
            out[idx] = base[k] + (rank[idx] - before) // each[k]
        return out


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, step: int = STEP,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if
    asked for, ids (array) of every piece."""
    path = tokenizer or default_tokenizer()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = materialize(texts.mapInArrow(
        token_pieces(path, length, end_id, with_ids), schema + (", ids array<int>" if with_ids else "")),
        "pieces")
    size_class = F.ceil(F.col("length") / step).cast("int")
    counted = cut.groupBy(size_class.alias("size_class")).count().orderBy("size_class").collect()
    classes = np.array([r.size_class for r in counted], np.int64)       # at most length / step
    demand = np.array([r["count"] for r in counted], np.int64)
    places = Places(classes, *cutting_stock(demand, classes, length // step))
    shared = docs.sparkSession.sparkContext.broadcast(places)

    hashed = F.xxhash64("doc_id", "start", "doc_tokens", "ids_crc32")
    buckets = int(demand.max() // BUCKET_PIECES) + 1 if len(demand) else 1
    ranked = cut.withColumn("size_class", size_class).withColumn(
        "bucket", F.pmod(hashed, F.lit(buckets)).cast("int"))
    counts = ranked.groupBy("size_class", "bucket").agg(F.count("*").alias("held"))
    before = Window.partitionBy("size_class").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.select("size_class", "bucket", F.coalesce(
        F.sum("held").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("size_class", "bucket").orderBy(hashed, "doc_id", "start")
    ranked = ranked.withColumn("own_rank", F.row_number().over(own) - 1).join(
        counts, ["size_class", "bucket"])

    @F.arrow_udf("long")
    def place(c: pa.Array, rank: pa.Array) -> pa.Array:
        return pa.array(shared.value.sequence(np.asarray(c), np.asarray(rank)), pa.int64())

    placed = ranked.withColumn("sequence_id", place(
        F.col("size_class"), (F.col("before") + F.col("own_rank")).cast("long")))
    inside = Window.partitionBy("sequence_id").orderBy(
        F.desc("length"), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset")
    return placed.select(*cut.columns[:5], "sequence_id", offset, *cut.columns[5:])


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
