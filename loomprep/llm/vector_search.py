"""Approximate nearest neighbours: inverted lists with an adaptive dimension scan.

Largest inner products are smallest distances once every vector gets one more
component that brings all of them to one norm (queries get 0 there).  The
vectors are rotated by a random orthogonal matrix, so that the first ``d`` of
``D`` components estimate the whole distance, and dealt into lists by their
nearest centre.  A query scans the vectors of its nearest lists in blocks of
columns; after each block a hypothesis test gives up on candidates whose
partial distance is too large for the query's 20th distance at that many
dimensions (false alarms are ruled by ``EPSILON``).  The first bound for each
query is its k-th distance among the fitting sample's vectors in the lists it
probes, which are candidates.  Survivors are scored on the original vectors.
A query that still finds fewer than it should is scanned again over all lists
without a bound.

Only the fit (centres, first bounds, number of probed lists) uses a bounded
sample of ``SAMPLE`` vectors, those with the smallest hash; every vector is
indexed and every query answered.  The number of probed lists is the smallest
that reaches ``RECALL`` on queries drawn from the sample.  Lists are cut into
blocks of vectors and blocks of queries, so a task holds a bounded part of a
hot list.

Defined cases: vectors that are null, empty, zero, or hold a null or
non-finite component take no part, nor do rows without vec_id or of another
dimension than most; repeated rows of a vec_id count as one vector if equal, and
as candidates of their own otherwise; a query never finds its own vec_id; ties
go to the smaller vec_id; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import table

TOP, EVERY = 20, 20
SAMPLE, RECALL = 16_384, 0.98
EPSILON = 2.1            # of the hypothesis test
COLUMNS = 16             # dimensions added at a time
LIST_ROWS, QUERY_ROWS = 4096, 1024
SEED = 20240607


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that take part, each once."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.transform("embedding", lambda v: v.cast("double")).alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(
        ~bad & F.exists("embedding", lambda v: v != 0))
    return rows.dropDuplicates(["vec_id", "embedding"])


class Index:
    """The fitted part: rotation, common norm, centres, number of probed lists."""

    def __init__(self, sample: np.ndarray, largest: float, top: int, total: int):
        rng = np.random.default_rng(SEED)
        d = sample.shape[1]
        self.largest = largest                               # largest squared norm
        self.rotation = np.linalg.qr(rng.normal(size=(d + 1, d + 1)))[0]
        self.top = top
        self.sample = self.rotate(sample, False)
        lists = max(1, min(1024, int(math.sqrt(total) / 4), len(sample) // 8))
        self.centres = self._centres(lists, rng)
        self.sample_list = distances(self.sample, self.centres).argmin(1)
        self.probes = self._probes(sample, rng)

    def rotate(self, x: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(
            np.maximum(self.largest - (x * x).sum(1), 0.0))
        return np.column_stack((x, rest)) @ self.rotation

    def _centres(self, lists: int, rng) -> np.ndarray:
        x = self.sample
        centres = x[rng.choice(len(x), lists, replace=False)]
        for _ in range(8):
            own = distances(x, centres).argmin(1)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, x)
            n = np.bincount(own, minlength=lists)[:, None]
            centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
        return centres

    def _probes(self, sample: np.ndarray, rng) -> int:
        """Lists to probe so that sample queries find ``RECALL`` of their nearest."""
        picked = rng.choice(len(sample), min(256, len(sample)), replace=False)
        q = self.rotate(sample[picked], True)
        far = distances(q, self.sample)
        far[np.arange(len(picked)), picked] = np.inf
        k = min(self.top, len(sample) - 1)
        if k < 1:
            return len(self.centres)
        near = np.argpartition(far, k - 1, axis=1)[:, :k]
        own = self.sample_list
        place = np.argsort(np.argsort(distances(q, self.centres), axis=1), axis=1)
        needed = np.sort(np.take_along_axis(place, own[near], 1).ravel())
        return int(needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)))]) + 1

    def bounds(self, queries: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """k-th distance of each (rotated) query to the sample in its probed lists."""
        k = self.top + 1                                    # the query may be in the sample
        if len(self.sample) < k:
            return np.full(len(queries), np.inf)
        out = np.empty(len(queries))
        for a in range(0, len(queries), 256):
            far = distances(queries[a:a + 256], self.sample)
            probed = np.zeros((len(far), len(self.centres)), bool)
            np.put_along_axis(probed, lists[a:a + 256], True, axis=1)
            far[~probed[:, self.sample_list]] = np.inf
            out[a:a + 256] = np.partition(far, k - 1, axis=1)[:, k - 1]
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0.0)


def adaptive_scan(queries: np.ndarray, bounds: np.ndarray, candidates: np.ndarray,
                  epsilon: float = EPSILON, columns: int = COLUMNS):
    """(query, candidate) pairs that no hypothesis test gives up."""
    n = queries.shape[1]
    # the first block for all pairs at once, the others for the survivors
    far = distances(queries[:, :columns], candidates[:, :columns])
    seen = min(columns, n)
    limit = bounds * (seen / n) * (1 + epsilon / math.sqrt(seen)) ** 2 if seen < n else bounds
    q, c = np.nonzero(far <= limit[:, None] * (1 + 1e-9) + 1e-9)
    far = far[q, c]
    while seen < n:
        block = slice(seen, min(seen + columns, n))
        far = far + ((queries[q, block] - candidates[c, block]) ** 2).sum(1)
        seen = block.stop
        limit = bounds * (seen / n) * (1 + epsilon / math.sqrt(seen)) ** 2 if seen < n else bounds
        keep = far <= limit[q] * (1 + 1e-9) + 1e-9
        q, c, far = q[keep], c[keep], far[keep]
    return q, c


def _matrix(column) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray)
                      else column.flatten(), np.float64).reshape(len(column), -1)


def _assign(model, as_queries: bool, everything: bool = False):
    """List numbers of candidates (one) or queries (the probed ones), and first
    bounds; ``everything``: all lists and no bound."""
    def run(batches):
        index = model.value
        for batch in batches:
            if not batch.num_rows:
                continue
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = index.rotate(_matrix(part.column("embedding")), as_queries)
                far = distances(x, index.centres)
                if everything:
                    lists = np.tile(np.arange(far.shape[1]), (len(x), 1))
                    bound = np.full(len(x), np.inf)
                elif as_queries:
                    lists = np.argpartition(far, index.probes - 1, axis=1)[:, :index.probes] \
                        if index.probes < far.shape[1] else np.tile(np.arange(far.shape[1]), (len(x), 1))
                    bound = index.bounds(x, lists)
                else:
                    lists, bound = far.argmin(1)[:, None], np.zeros(len(x))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("embedding"),
                     pa.array(list(lists.astype(np.int32)), pa.list_(pa.int32())), pa.array(bound)],
                    names=["vec_id", "embedding", "lists", "bound"])
    return run


def _scan(model, top: int):
    def run(key, queries, candidates):
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.float64())})
        if not len(queries) or not len(candidates):
            return empty
        index = model.value
        q, x = _matrix(queries["embedding"]), _matrix(candidates["embedding"])
        q_id, x_id = queries["vec_id"].to_numpy(), candidates["vec_id"].to_numpy()
        a, b = adaptive_scan(index.rotate(q, True), queries["bound"].to_numpy(),
                             index.rotate(x, False))
        other = q_id[a] != x_id[b]
        a, b = a[other], b[other]
        score = np.concatenate([np.einsum("ij,ij->i", q[a[s:s + 50_000]], x[b[s:s + 50_000]])
                                for s in range(0, len(a), 50_000)] or [np.zeros(0)])
        order = np.lexsort((x_id[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        keep = rank < top
        return pa.table({"query_id": q_id[a[keep]], "vec_id": x_id[b[keep]], "score": score[keep]})
    return run


def search(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    usable = usable_vectors(vectors)
    sizes = usable.groupBy(F.size("embedding").alias("d")).count().orderBy(
        F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    same = materialize(usable.where(F.size("embedding") == sizes["d"]), "vectors")
    squared = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)
    largest = same.agg(F.max(squared)).first()[0]
    sample = same.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(SAMPLE)
    fitted = Index(np.array([r.embedding for r in sample.select("embedding").collect()]),
                   largest, top, sizes["count"])
    model = spark.sparkContext.broadcast(fitted)

    assigned = "vec_id long, embedding array<double>, lists array<int>, bound double"
    listed = materialize(same.mapInArrow(_assign(model, False), assigned).select(
        "vec_id", "embedding", F.col("lists")[0].alias("list")), "listed")
    queries = same.where(F.pmod("vec_id", F.lit(every)) == 0)
    found = materialize(_found(model, listed, queries.mapInArrow(_assign(model, True), assigned), top),
                        "found")
    least = min(top, max(0, same.select("vec_id").distinct().count() - 1))
    done = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= least)
    short = materialize(queries.join(done, F.col("vec_id") == F.col("query_id"), "left_anti"), "short")
    if least and not short.isEmpty():
        again = short.mapInArrow(_assign(model, True, True), assigned)
        found = found.unionByName(_found(model, listed, again, top))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).where(
        F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _found(model, listed: DataFrame, assigned: DataFrame, top: int) -> DataFrame:
    """query_id, vec_id, score: the best of every block of every probed list."""
    asked = materialize(assigned.select("vec_id", "embedding", "bound", F.explode("lists").alias("list")),
                        "asked")
    # a row for each list: at most a thousand
    blocks = listed.groupBy("list").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("x")).join(
        asked.groupBy("list").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("q")), "list")
    mine = F.pmod(F.xxhash64("vec_id"), F.col("x")).cast("int")
    candidates = listed.join(F.broadcast(blocks), "list").select(
        "list", "vec_id", "embedding", mine.alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("part"))
    mine = F.pmod(F.xxhash64("vec_id"), F.col("q")).cast("int")
    queries = asked.join(F.broadcast(blocks), "list").select(
        "list", "vec_id", "embedding", "bound",
        F.explode(F.sequence(F.lit(0), F.col("x") - 1)).alias("block"), mine.alias("part"))
    keys = ["list", "block", "part"]
    scan = _scan(model, top)
    return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        lambda key, a, b: scan(key, a, b), "query_id long, vec_id long, score double")


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
