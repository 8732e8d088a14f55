"""Hard-negative mining by slots between the positives' upper limits.

An anchor's positives are its best-scoring other vectors of the same label.  Each
of them opens a window of scores, from a lower to an upper percentage of its own
score, in which the best-scoring vectors of other labels are its hard negatives.
The windows overlap, but their upper limits split the scores into disjoint slots:
a score belongs to the slot of the smallest limit that it does not exceed.  Every
task keeps the top few of each anchor and slot for the rows it sees, the partial
tops are merged, and an anchor's merged slots in descending order hold, from any
slot on, the candidates of that slot's window in order: its answer is the first
few of that suffix that reach the lower limit.

Scores are exact integer inner products of ``floor(scale * x)``: of doubles where
no sum can pass 2**53, of Python integers elsewhere (held within the range of a
long).

Anchors (a share of all rows) are dealt into blocks and rows into groups, and
each block meets each group in one task, so both passes spread over
blocks x groups tasks of bounded size, whatever the labels.  What leaves a task is
a few rows for each anchor.  Limits are joined to their anchors; nothing but
counts reaches the driver.

Defined cases: rows with a null vec_id, label or vector, a null, non-finite or
(times the scale) infinite component, an empty vector or another dimension than most rows (of equal
numbers the larger) take no part; equal rows count once; other rows that share a
vec_id are candidates of their own, but never positives of an anchor with that
vec_id; ties go to the smaller vec_id; an anchor without positives, and a positive
with an empty window, return nothing; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import table

POSITIVES = NEGATIVES = 5
LOWER, UPPER = 80, 100        # per cent of the positive's score
SCALE = 256
GROUP_ROWS = 16_384           # rows, and anchors, that meet in one task (about)
CELLS = 1 << 21               # scores computed at a time
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, vector (integers as doubles), each row once."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda v: v.cast("double") * scale).alias("vector"))
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where("vec_id is not null and label is not null and size(vector) > 0").where(~bad)
    floor = F.transform("vector", lambda v: F.rint(v) - F.when(F.rint(v) > v, 1.0).otherwise(0.0) + 0.0)
    return rows.select("vec_id", "label", floor.alias("vector")).dropDuplicates()


def _matrix(column: pa.ChunkedArray, exact: bool) -> np.ndarray:
    flat = np.asarray(column.combine_chunks().flatten(), np.float64).reshape(len(column), -1)
    if exact:
        return flat
    return np.array([[int(v) for v in r] for r in flat.tolist()], object).reshape(flat.shape)


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = anchors @ rows.T
    if out.dtype == object:
        out = np.minimum(np.maximum(out, _LEAST), _MOST)
    return out.astype(np.int64)


def _best(group: np.ndarray, score: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Indices of the ``most`` entries with the highest score of each group; ties
    by ``order``."""
    ranked = np.lexsort((order, ~score, group))             # ~: descending, also for the least long
    of = group[ranked]
    first = np.ones(len(of), bool)
    first[1:] = of[1:] != of[:-1]
    place = np.arange(len(of)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(of) else of
    return ranked[place < most]


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return np.asarray(rows.column(name).combine_chunks())


def _joined(parts: list, names: list[str]) -> pa.Table:
    """One table of the tuples of arrays found."""
    if not parts:
        parts = [tuple(np.zeros(0, np.int64) for _ in names)]
    return pa.table({n: pa.array(np.concatenate([p[k] for p in parts]), pa.int64())
                     for k, n in enumerate(names)})


def _positives(exact: bool, most: int):
    """Partial tops of same-label rows for each anchor."""
    names = ["anchor_id", "anchor_key", "vec_id", "score"]

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if len(rows) and len(anchors):
            x, a = _matrix(rows.column("vector"), exact), _matrix(anchors.column("anchor_vector"), exact)
            ids, labels = _column(rows, "vec_id"), _column(rows, "label")
            own, key, own_label = (_column(anchors, c) for c in ("anchor_id", "anchor_key", "anchor_label"))
            for label in np.unique(own_label).tolist():
                same, mine = np.flatnonzero(labels == label), np.flatnonzero(own_label == label)
                step = max(1, CELLS // max(1, len(same)))
                for at in range(0, len(mine), step):
                    part = mine[at:at + step]
                    score = _scores(a[part], x[same])
                    other = own[part][:, None] != ids[same]
                    if len(same) > most + 1:                # what can be among the first few
                        least = np.partition(np.where(other, score, _LEAST), len(same) - most,
                                             axis=1)[:, len(same) - most]
                        other &= score >= least[:, None]
                    r, c = np.nonzero(other)
                    take = _best(r, score[r, c], ids[same][c], most)
                    r, c = r[take], c[take]
                    found.append((own[part][r], key[part][r], ids[same][c], score[r, c]))
        return _joined(found, names)
    return run


def _negatives(exact: bool, most: int):
    """Partial tops of other-label rows for each anchor and slot."""
    names = ["anchor_id", "anchor_key", "slot", "vec_id", "score"]

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if len(rows) and len(anchors):
            x, a = _matrix(rows.column("vector"), exact), _matrix(anchors.column("anchor_vector"), exact)
            ids, labels = _column(rows, "vec_id"), _column(rows, "label")
            own, key, own_label = (_column(anchors, c) for c in ("anchor_id", "anchor_key", "anchor_label"))
            uppers, lowers = (anchors.column(c).to_pylist() for c in ("uppers", "lowers"))
            top = np.array([u[0] for u in uppers], np.int64)
            floor = np.array([min(v) for v in lowers], np.int64)
            limits = np.full((len(own), max(map(len, uppers))), _LEAST, np.int64)
            for k, u in enumerate(uppers):
                limits[k, :len(u)] = u
            held = np.array([len(u) for u in uppers])
            step = max(1, CELLS // len(ids))
            for at in range(0, len(own), step):
                part = slice(at, at + step)
                score = _scores(a[part], x)
                r, c = np.nonzero((score <= top[part, None]) & (score >= floor[part, None])
                                  & (labels != own_label[part, None]))
                value = score[r, c]
                reached = (limits[part][r] >= value[:, None]).sum(1)
                slot = np.minimum(reached, held[part][r]) - 1
                take = _best(r * limits.shape[1] + slot, value, ids[c], most)
                r, c = r[take], c[take]
                found.append((own[part][r], key[part][r], slot[take], ids[c], value[take]))
        return _joined(found, names)
    return run


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, task, schema: str) -> DataFrame:
    """Every block of anchors with every group of rows, one task each."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("g", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(groups)).cast("int")
                           ).withColumn("b", every(blocks))
    right = anchors.withColumn("b", F.pmod(F.xxhash64("anchor_id", "anchor_key"), F.lit(blocks)).cast("int")
                               ).withColumn("g", every(groups))
    return left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInArrow(task, schema)


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES,
                        negatives: int = NEGATIVES, lower: int = LOWER, upper: int = UPPER,
                        scale: int = SCALE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score;
    ``is_anchor``: a condition on vec_id and label; ``lower``, ``upper``: per cent."""
    rows = materialize(usable_rows(vectors, scale), "whole-vectors")
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(
        F.count("*").alias("n"), F.sum(is_anchor.cast("long")).alias("anchors"),
        F.max(F.array_max(F.transform("vector", lambda v: F.abs(v)))).alias("most"))
    main = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    dimension, n, of_them, most = (main.d, main.n, main.anchors or 0, main.most or 0.0) if main else (0, 0, 0, 0.0)
    exact = dimension * most * most < 2.0 ** 53
    groups, blocks = -(-n // group_rows) or 1, -(-of_them // group_rows) or 1
    rows = rows.where(F.size("vector") == dimension)
    anchors = rows.where(is_anchor).select(
        F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "vector").alias("anchor_key"),
        F.col("label").alias("anchor_label"), F.col("vector").alias("anchor_vector"))
    of_anchor = ["anchor_id", "anchor_key"]

    partial = _meet(rows, anchors, blocks, groups, _positives(exact, positives),
                    "anchor_id long, anchor_key long, vec_id long, score long")
    by_score = [F.desc("score"), "vec_id"]
    place = F.row_number().over(Window.partitionBy(*of_anchor).orderBy(*by_score))
    best = partial.withColumn("place", place).where(F.col("place") <= positives)
    # ceil(lower * s / 100) and floor(upper * s / 100), without passing the range of a long
    share = "{0} * cast(score div 100 as decimal(24, 0)) + {1}({0} * (score % 100) / 100)"
    low, high = F.expr(share.format(lower, "ceil")), F.expr(share.format(upper, "floor"))
    bounded = lambda c: F.least(F.greatest(c, F.lit(_LEAST)), F.lit(_MOST)).cast("long")
    chosen = best.select(*of_anchor, F.struct(
        F.col("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        bounded(low).alias("lower"), bounded(high).alias("upper")).alias("p"))
    chosen = materialize(chosen.groupBy(*of_anchor).agg(F.array_sort(F.collect_list("p")).alias("chosen")),
                         "positives")

    limits = chosen.select(*of_anchor, F.col("chosen.upper").alias("uppers"),
                           F.col("chosen.lower").alias("lowers"))
    partial = _meet(rows, anchors.join(limits, of_anchor), blocks, groups, _negatives(exact, negatives),
                    "anchor_id long, anchor_key long, slot long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy(*of_anchor, "slot").orderBy(*by_score))
    slots = partial.withColumn("place", place).where(F.col("place") <= negatives)
    # slots from the highest to the lowest, each in order: any suffix is in order as well
    merged = slots.groupBy(*of_anchor).agg(F.array_sort(F.collect_list(
        F.struct("slot", "place", "vec_id", "score"))).alias("merged"))
    windows = chosen.join(merged, of_anchor).select("anchor_id", "merged", F.explode("chosen").alias("p"))
    answer = F.slice(F.filter("merged", lambda m: (m["slot"] >= F.col("p.place") - 1)
                              & (m["score"] >= F.col("p.lower"))), 1, negatives)
    return windows.select("anchor_id", "p", F.posexplode(answer).alias("at", "m")).select(
        "anchor_id", "p.positive_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("m.vec_id").alias("negative_id"), "p.positive_score", F.col("m.score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end"))
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         list_inner_product(a.vector, r.vector)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER
         AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
