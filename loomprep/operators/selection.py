"""Candidate selection per group (T6, T7, W7, W8, SC11).

Scores are rows ``(group_id, item_id, score)``.  Top-k is a ranked window
with a ``<= k`` filter, which Catalyst plans as ``WindowGroupLimit``: each
map task keeps at most k rows per group before the shuffle, so a group with a
third of all rows still sends only k rows per task.  Everything after top-k
runs on at most k rows per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import SEED, TEMPERATURE, TOP_K, TOP_P
from ..functions.hashing import seeded_key, unit_interval


def topk_per_group(scores: DataFrame, k: int = TOP_K, group: str = "group_id", item: str = "item_id",
                   score: str = "score", out: str = "rank") -> DataFrame:
    """The k highest scores of each group (ties by item id), 1-based rank."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(item))
    return scores.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def softmax(df: DataFrame, group: str = "group_id", score: str = "score",
            temperature: float = TEMPERATURE, out: str = "prob") -> DataFrame:
    """``exp((s - max)/T) / sum`` over the group (max-shifted)."""
    wg = Window.partitionBy(group)
    z = (F.col(score).cast("double") - F.max(F.col(score).cast("double")).over(wg)) / F.lit(float(temperature))
    d = df.withColumn("_e", F.exp(z))
    return d.withColumn(out, F.col("_e") / F.sum("_e").over(wg)).drop("_e")


def nucleus(df: DataFrame, p: float = TOP_P, group: str = "group_id", item: str = "item_id",
            prob: str = "prob") -> DataFrame:
    """Keep an item iff the probability mass strictly before it (in
    descending probability order) is below ``p``; renormalise the kept."""
    w = Window.partitionBy(group).orderBy(F.col(prob).desc(), F.col(item))
    before = F.coalesce(F.sum(prob).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    kept = df.withColumn("_before", before).where(F.col("_before") < p).drop("_before")
    return kept.withColumn(prob, F.col(prob) / F.sum(prob).over(Window.partitionBy(group)))


def select_candidates(scores: DataFrame, k: int = TOP_K, temperature: float = TEMPERATURE,
                      p: float = TOP_P, group: str = "group_id", item: str = "item_id",
                      score: str = "score") -> DataFrame:
    """top-k -> temperature softmax -> nucleus, the candidate list with
    probabilities."""
    top = topk_per_group(scores, k, group, item, score)
    return nucleus(softmax(top, group, score, temperature), p, group, item)


def weighted_draw(candidates: DataFrame, seed=SEED, group: str = "group_id", item: str = "item_id",
                  prob: str = "prob") -> DataFrame:
    """One draw per group by inverse CDF: ``u = md5(seed:group)`` in [0,1);
    the first candidate (descending probability) whose running sum exceeds
    ``u`` (the last one if rounding leaves the sum below ``u``)."""
    w = Window.partitionBy(group).orderBy(F.col(prob).desc(), F.col(item))
    d = candidates.withColumn("_u", unit_interval(seeded_key(seed, group))) \
        .withColumn("_cum", F.sum(prob).over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_rn", F.row_number().over(w)) \
        .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(group)))
    hit = d.where((F.col("_cum") > F.col("_u")) | (F.col("_rn") == F.col("_n")))
    first = Window.partitionBy(group).orderBy("_rn")
    return hit.withColumn("_f", F.row_number().over(first)).where(F.col("_f") == 1) \
        .drop("_u", "_cum", "_rn", "_n", "_f")


def exploded_scores(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``(group_id, item_id, score)`` rows of a vector table."""
    return vectors.select(F.col(id_col).alias("group_id"), F.posexplode(vec).alias("item_id", "score"))
