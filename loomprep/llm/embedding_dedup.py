"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

Vectors with equal labels are linked if their cosine reaches ``threshold``.
Equal vectors of a label are merged into one class first.  Each of several
tables rotates a vector by three rounds of random signs and a fast Hadamard
transform; its hash is the nearest signed axis, ``k`` of them concatenated.
A vector is put into the buckets of all combinations of its two nearest axes
(multiprobe).  ``k`` follows from the largest number of classes of a label, so
that buckets stay small, and the number of tables from the chance, simulated
for the vectors' dimension, that two vectors at the threshold share a bucket:
all tables together miss such a pair with a probability of at most ``miss``.

Pairs in a bucket are verified on the vectors in double precision; a pair that
shares several buckets is counted in the smallest one only.  A bucket of more
than ``BLOCK`` vectors is cut into blocks and each pair of blocks is a group of
its own; only counts of links and the local components leave a group, never
pairs, and a task holds the pairs of a few rows at a time.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component link with nothing, nor do rows without label or vec_id; vectors of
different dimensions do not link; repeated rows are separate vectors, so they
link with each other; a vec_id is taken to name one vector (rows that give it
several are one vertex); other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import table
from .graph import components, local_roots
from .hashing import mix

THRESHOLD, MISS = 0.93, 0.002
BLOCK = 2048             # members of a bucket in one block
GROUP_ROWS = 20_000      # rows verified together, about
PENDING = 200_000        # linked pairs held before they are counted and merged
SEED = 20240601


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row (a power of two long)."""
    rows, n = x.shape
    h = 1
    while h < n:
        x = x.reshape(rows, n // (2 * h), 2, h)
        x = np.concatenate((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(rows, n)
        h *= 2
    return x


def axes(x: np.ndarray, table_no: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and second nearest signed axis of each row after a rotation."""
    width = 1 << max(1, math.ceil(math.log2(max(x.shape[1], 2))))
    y = np.zeros((len(x), width))
    y[:, :x.shape[1]] = x
    signs = np.random.default_rng((SEED, width, table_no, part)).choice((-1.0, 1.0), (3, width))
    for s in signs:
        y = hadamard(y * s)
    size = np.abs(y)
    best = size.argmax(1)
    rows = np.arange(len(y))
    size[rows, best] = -1
    second = size.argmax(1)
    return best * 2 + (y[rows, best] > 0), second * 2 + (y[rows, second] > 0)


def buckets(x: np.ndarray, label: np.ndarray, tables: int, k: int) -> np.ndarray:
    """Bucket numbers (rows x tables * 2**k) of vectors of one dimension."""
    base = mix(label.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(x.shape[1]))
    out = []
    for t in range(tables):
        options = [axes(x, t, p) for p in range(k)]
        for choice in itertools.product((0, 1), repeat=k):
            h = mix(base + np.uint64(t))
            for p, c in enumerate(choice):
                h = mix(h * np.uint64(31) + options[p][c].astype(np.uint64))
            out.append(h.view(np.int64))
    return np.stack(out, 1)


def tables_needed(dimension: int, k: int, threshold: float, miss: float) -> int:
    """Tables after which a pair at the threshold is missed with at most ``miss``."""
    rng = np.random.default_rng(SEED)
    a, b = rng.normal(size=(2, 4000, dimension))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.maximum(np.linalg.norm(b, axis=1), 1e-12)[:, None]
    b = threshold * a + math.sqrt(max(0.0, 1 - threshold ** 2)) * b
    (a1, a2), (b1, b2) = axes(a, 0, 0), axes(b, 0, 0)
    shared = ((a1 == b1) | (a1 == b2) | (a2 == b1) | (a2 == b2)).mean() ** k
    return max(1, math.ceil(math.log(miss) / math.log(max(1 - shared, 1e-9))))


def _vectors(column, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(v, kind).astype(np.float64) for v in column.to_pylist()]


def _by_dimension(vectors: list[np.ndarray]):
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for d in np.unique(sizes):
        idx = np.flatnonzero(sizes == d)
        yield idx, np.stack([vectors[i] for i in idx])


def _hash(tables: int, k: int, kind: str):
    def run(batches):
        for batch in batches:
            vectors = _vectors(batch.column("vector"), kind)
            label = np.asarray(batch.column("label"), np.int64)
            for idx, x in _by_dimension(vectors):
                at = buckets(x, label[idx], tables, k)
                for first in range(0, len(idx), 1000):
                    part = idx[first:first + 1000]
                    own = at[first:first + 1000]
                    # a row for each distinct bucket of a vector
                    own = np.sort(own, 1)
                    keep = np.ones(own.shape, bool)
                    keep[:, 1:] = own[:, 1:] != own[:, :-1]
                    row = np.repeat(part, keep.sum(1))
                    taken = batch.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[keep]), *taken.columns], names=["bucket", *taken.schema.names])
    return run


class _Links:
    """Counts of links and local components of a task's vectors."""

    def __init__(self, rows, tables: int, k: int):
        self.nodes, self.node = np.unique(rows["rep"].to_numpy(), return_inverse=True)
        self.size, self.label, self.bucket = (rows[c].to_numpy() for c in ("n", "label", "bucket"))
        self.tables, self.k = tables, k
        self.total = np.zeros(len(self.nodes), np.int64)
        self.root = np.arange(len(self.nodes))

    def add(self, idx: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Linked rows a and b of the vectors x, which are rows idx of the table."""
        touched, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        held = buckets(x[touched], self.label[idx[touched]], self.tables, self.k)
        at_a, at_b = at[:len(a)], at[len(a):]
        step = max(1, 8_000_000 // held.shape[1] ** 2)
        for lo in range(0, len(a), step):
            left, right = held[at_a[lo:lo + step]], held[at_b[lo:lo + step]]
            common = (left[:, :, None] == right[:, None, :]).any(2)
            least = np.where(common, left, np.iinfo(np.int64).max).min(1)
            # a pair is counted in the smallest bucket that it shares
            here = least == self.bucket[idx[a[lo:lo + step]]]
            ca, cb = idx[a[lo:lo + step][here]], idx[b[lo:lo + step][here]]
            np.add.at(self.total, self.node[ca], self.size[cb])
            np.add.at(self.total, self.node[cb], self.size[ca])
        ends = np.stack((self.root[self.node[idx[a]]], self.root[self.node[idx[b]]]))
        ends = ends[:, ends[0] != ends[1]]
        if ends.size:
            self.root = local_roots(len(self.nodes), *ends)[self.root]


def _verify(tables: int, k: int, threshold: float, kind: str):
    def run(key, rows):
        links = _Links(rows, tables, k)
        bucket, bi, bj, own = (rows[c].to_numpy() for c in ("bucket", "block_a", "block_b", "block"))
        for idx, x in _by_dimension(_vectors(rows["vector"], kind)):
            unit = x / np.linalg.norm(x, axis=1)[:, None]
            order = np.lexsort((bj[idx], bi[idx], bucket[idx]))
            keys = np.stack((bucket[idx], bi[idx], bj[idx]))[:, order]
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            pairs, held = [], 0
            for group in np.split(order, cuts):
                if len(group) < 2:
                    continue
                first = own[idx[group]] == bi[idx[group]]
                same = bi[idx[group[0]]] == bj[idx[group[0]]]
                left, right = (group, group) if same else (group[first], group[~first])
                for at in range(0, len(left), 128):
                    a, b = np.nonzero(unit[left[at:at + 128]] @ unit[right].T >= threshold)
                    if same:
                        a, b = a[a + at < b], b[a + at < b]
                    if len(a):
                        pairs.append(np.stack((left[a + at], right[b])))
                        held += len(a)
                    if held > PENDING:
                        links.add(idx, x, *np.concatenate(pairs, 1))
                        pairs, held = [], 0
            if pairs:
                links.add(idx, x, *np.concatenate(pairs, 1))
        root = links.nodes[links.root]
        keep = (links.total > 0) | (root != links.nodes)
        return pa.table({"rep": links.nodes[keep], "links": links.total[keep], "root": root[keep]})
    return run


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row for each input row."""
    double = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("label").cast("long").alias("label"), double.alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = ~F.exists("embedding", lambda v: v != 0)
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull()
              & F.col("embedding").isNotNull() & ~bad & ~zero)
    # 0.0 and -0.0 are one value; the text of the doubles is exact
    key = F.sha2(F.array_join(F.transform("embedding", lambda v: (v + 0.0).cast("string")), ","), 256)
    rows = rows.withColumn("key", F.when(F.coalesce(usable, F.lit(False)), key))
    good = rows.where(F.col("key").isNotNull())
    classes = good.groupBy("label", "key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    # floats travel as floats: they are exactly the doubles they become
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    as_bytes = classes.select("label", "rep", "n", _packed(F.col("embedding"), kind).alias("vector"))
    facts = good.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")
                                      ).agg(F.max("n"), F.max("d")).first()
    most, dimension = (x or 1 for x in facts)
    width = 2 << max(1, math.ceil(math.log2(max(dimension, 2))))
    k = max(1, math.ceil(math.log(most) / math.log(width)))
    tables = tables_needed(dimension, k, threshold, miss)

    schema = "bucket long, label long, rep long, n long, vector binary"
    put = as_bytes.mapInArrow(_hash(tables, k, kind), schema)
    crowd = materialize(put.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"),
                        "vector-buckets")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    # every member of a bucket arrives once for each of its blocks
    groups = int((crowd.agg(F.sum(F.col("members") * blocks)).first()[0] or 0) // GROUP_ROWS) + 1
    shared = put.join(crowd, "bucket")
    shared = shared.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    shared = shared.select("bucket", "label", "rep", "n", "vector", "block",
                           F.least("block", "other").alias("block_a"),
                           F.greatest("block", "other").alias("block_b"))
    shard = F.pmod(F.xxhash64("bucket", "block_a", "block_b"), F.lit(groups)).alias("shard")
    found = shared.withColumn("shard", shard).groupBy("shard").applyInArrow(
        _verify(tables, k, threshold, kind), "rep long, links long, root long")
    found = materialize(found, "vector-links")
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(found.where("rep <> root").select(F.col("rep").alias("a"),
                                                           F.col("root").alias("b")))
    joined = classes.select("label", "key", "rep", "n").join(degree, "rep", "left").join(
        labels, F.col("rep") == F.col("vertex"), "left").select(
        "label", "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("vec_id", "label", "key").join(joined, ["label", "key"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _packed(embedding, kind: str):
    """An array of doubles as the bytes of floats or doubles."""
    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        flat = np.asarray(column.flatten(), kind)
        width = flat.itemsize
        at = np.concatenate(([0], np.cumsum(np.asarray(pa.compute.list_value_length(column)))))
        data = flat.tobytes()
        return pa.array([data[width * a:width * b] for a, b in zip(at[:-1], at[1:])], pa.binary())
    return pack(embedding)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
