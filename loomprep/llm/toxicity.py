"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

Features of a text are the distinct words, pairs of adjacent words and pairs
with one word left out, lower-cased and without punctuation, hashed into
``2**DIM_BITS`` coordinates.  Training rows are dealt into shards of
``SHARD_ROWS``; each shard is learned by follow-the-regularised-leader with
per-coordinate rates and an L1 term that leaves most weights at zero, and the
shards' weights are averaged.  What is left is a short list of coordinates
that is broadcast; its size is at most ``2**DIM_BITS`` by construction.

Only the fit is bounded: at most ``MAX_ROWS`` labelled rows, those with the
smallest hash of doc_id, are used (a documented parameter), so the list of
training ids can be broadcast.  Every document is scored on its whole text.

Defined cases: null and empty texts score as a text without features (the
bias); a doc_id labelled more than once counts as toxic if any label says so;
null labels are left out; repeated rows score alike; without labels all scores
are 0.5; columns of ``docs`` besides doc_id and text are carried along unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .hashing import Words, chunks, mix

DIM_BITS = 20
MAX_ROWS = 20_000
SHARD_ROWS = 5_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.5, 1.0, 6.0, 0.0
THRESHOLD = 0.7
BIAS = 0                         # coordinate of the constant feature

# letters and digits of ASCII in lower case, bytes beyond ASCII as they are
_FOLD = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 32
              for c in range(256))


def features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(text number, coordinate) of every occurrence of a feature."""
    words = Words([t.translate(_FOLD) for t in texts])
    h, doc = words.hashes(), words.doc
    owners, hashes = [doc], [h]
    for gap, tag in ((1, 3), (2, 5)):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            owners.append(doc[:-gap][same])
            hashes.append(mix(h[:-gap][same] * np.uint64(tag) + h[gap:][same]))
    coordinate = (np.concatenate(hashes) >> np.uint64(64 - DIM_BITS)).astype(np.int64)
    return np.concatenate(owners), np.maximum(coordinate, BIAS + 1)


def distinct_features(texts: list) -> list[np.ndarray]:
    out = []
    for a, b in chunks(texts):
        owner, coordinate = features(texts[a:b])
        pairs = np.unique((owner << DIM_BITS) | coordinate)
        owner, coordinate = pairs >> DIM_BITS, pairs & ((1 << DIM_BITS) - 1)
        cut = np.searchsorted(owner, np.arange(b - a + 1))
        out += [coordinate[x:y].astype(np.int32) for x, y in zip(cut[:-1], cut[1:])]
    return out


def ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over the rows in the given order."""
    z, n = np.zeros(1 << DIM_BITS), np.zeros(1 << DIM_BITS)

    def weights(i):
        return np.where(np.abs(z[i]) <= L1 * (i != BIAS), 0.0,
                        (np.sign(z[i]) * L1 * (i != BIAS) - z[i])
                        / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for row, y in zip(rows, labels.tolist()):
            i = np.concatenate(([BIAS], row))
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - y
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(1 << DIM_BITS))


def _train(table):
    texts = [t or b"" for t in table["text"].combine_chunks().cast(pa.binary()).to_pylist()]
    y = table["toxic"].to_numpy().astype(float)
    order = np.argsort(table["key"].to_numpy(), kind="stable")    # any shuffle order trains alike
    rows = distinct_features(texts)
    w = ftrl([rows[k] for k in order], y[order])
    used = np.flatnonzero(w)
    return pa.table({"coordinate": pa.array(used, pa.int64()), "weight": pa.array(w[used])})


def remainder(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict[int, float]:
    """Weights by coordinate, learned from the rows whose remainder is not 1."""
    key = F.xxhash64("doc_id")
    wanted = labels.where(F.col("toxic").isNotNull() & (remainder() != 1)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).orderBy(key, "doc_id").limit(max_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select(
        "text", "toxic", F.xxhash64("doc_id", "text").alias("key"))
    shards = max(1, -(-min(max_rows, wanted.count()) // SHARD_ROWS))
    fitted = sample.withColumn("shard", F.pmod("key", F.lit(shards))).groupBy(
        "shard").applyInArrow(_train, "coordinate long, weight double")
    mean = fitted.groupBy("coordinate").agg((F.sum("weight") / shards).alias("weight"))
    return {r.coordinate: r.weight for r in mean.collect()}        # at most 2**DIM_BITS


def score(docs: DataFrame, weights: dict[int, float], name: str = "score") -> DataFrame:
    """``docs`` with the score of each text as another column."""
    coordinates = np.fromiter(sorted(weights), np.int64, len(weights))
    values = np.array([weights[c] for c in coordinates.tolist()])
    model = docs.sparkSession.sparkContext.broadcast((coordinates, values))

    @F.arrow_udf("double")
    def score_text(column: pa.Array) -> pa.Array:
        dense = np.zeros(1 << DIM_BITS, np.float32)
        where, value = model.value
        dense[where] = value
        bias = float(dense[BIAS])
        texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
        total = np.full(len(texts), bias)
        for a, b in chunks(texts):
            owner, coordinate = features(texts[a:b])
            hit = np.flatnonzero(dense[coordinate])
            pairs = np.unique((owner[hit] << DIM_BITS) | coordinate[hit])
            total[a:b] += np.bincount(pairs >> DIM_BITS, dense[pairs & ((1 << DIM_BITS) - 1)], b - a)
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))), pa.float64())

    return docs.withColumn(name, score_text(F.col("text")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), weights).select(
        "doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
