"""N-gram Jaccard join: MinHash banding with full verification.

Two documents are linked if the Jaccard similarity of their sets of ``n``-word
shingles reaches ``threshold``.  Bands and rows of the MinHash signature are
chosen so that a pair at the threshold is missed with a probability of at most
``miss`` while unlike pairs rarely meet.

Documents with equal shingle sets form one class first.  The band hashes of
the class representatives are shuffled; those that two or more share connect
candidates into groups (each bucket as a star, so a bucket of m members costs
m rows, not m * m).  The full shingle sets travel once to their group, where
every pair is verified on the sets themselves by products of set-membership
matrices.  A group with more than ``BLOCK`` shingles or ``DOCS`` members is cut
into blocks and each pair of blocks is verified on its own; links are counted
and merged row by row, so that memory follows the rows of a block and not their
pairs, and only numbers of links and local components leave a task.  As all pairs of a candidate group are
verified, not only those that share a band, fewer links are missed than the
signature alone would give.

Words are maximal runs without \\x20 and \\x09-\\x0D, unchanged.  A text with
fewer than ``n`` words has its whole word sequence as its only shingle; a text
without words (null, empty) is like no other text, and is a class of its own.

Defined cases: repeated rows are copies and link with each other; rows with a
null doc_id link with nothing and have no class; a doc_id is taken to name one
text (rows that give it several are one vertex); other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import table
from .graph import components, local_roots
from .hashing import Words, chunks, grams, mix

SHINGLE, THRESHOLD, MISS = 5, 0.8, 0.005
BLOCK = 1 << 20          # shingles of a group that are verified in one block
DOCS = 1 << 13           # members of a group that are verified in one block
PENDING = 1 << 18        # links that are held before they are merged
SEED = np.uint64(0x5DEECE66D)


def banding(threshold: float, miss: float, stray: float = 0.1) -> tuple[int, int]:
    """(bands, rows): the fewest rows in a band with which a pair of half the
    threshold is a candidate with at most ``stray``, and as many bands as keep a
    pair at the threshold missed with at most ``miss``."""
    for rows in range(1, 33):
        bands = math.ceil(math.log(miss) / math.log(1 - threshold ** rows))
        if 1 - (1 - (threshold / 2) ** rows) ** bands <= stray:
            break
    return bands, rows


def shingle_sets(texts: list, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; empty without words."""
    out = []
    for a, b in chunks(texts):
        w = Words(texts[a:b])
        h = w.digests()
        g = grams(h, n)
        for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            if hi - lo >= n:
                out.append(np.unique(g[lo:hi - n + 1]))
            else:
                # a short text is one shingle of its own length
                out.append(mix(grams(h[lo:hi], hi - lo) + np.uint64(hi - lo)) if hi > lo
                           else np.zeros(0, np.uint64))
    return out


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes (sets x bands) of non-empty sets."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    out = np.zeros((len(sets), bands), np.uint64)
    salt = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * SEED)
    for b in range(bands):
        h = np.full(len(sets), b, np.uint64)
        for r in range(rows):
            # xor and multiply: a permutation of the 64-bit values for each row
            seed = salt[b * rows + r]
            v = (flat ^ seed) * (seed | np.uint64(1))
            h = mix(h * np.uint64(31) + np.minimum.reduceat(v ^ (v >> np.uint64(29)), at))
        out[:, b] = h
    return out.view(np.int64)


def _set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _texts(batch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _describe(n: int, bands: int, rows: int):
    """doc_id, key of the shingle set (null: no words), its size, its band hashes."""
    def run(batches):
        for batch in batches:
            texts = _texts(batch)
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], n)
                full = [k for k, s in enumerate(sets) if len(s)]
                bands_of: list = [None] * len(sets)
                if full:
                    hashed = band_hashes([sets[k] for k in full], bands, rows)
                    for k, h in zip(full, hashed):
                        bands_of[k] = h
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b],
                     pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(bands_of, pa.list_(pa.int64()))],
                    names=["doc_id", "key", "m", "bands"])
    return run


def _member_sets(n: int):
    """The shingle sets of group members; a row whose text is not its class's is left out."""
    def run(batches):
        for batch in batches:
            texts, keys = _texts(batch), batch.column("key").to_pylist()
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], n)
                own = [k for k, s in enumerate(sets) if _set_key(s) == keys[a + k]]
                part = batch.slice(a, b - a).take(pa.array(own, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("rep", "n", "group", "blocks")),
                     pa.array([sets[k].tobytes() for k in own], pa.binary())],
                    names=["rep", "n", "group", "blocks", "shingles"])
    return run


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], threshold: float):
    """For each row a of left that has any: a, the rows b of right that reach the threshold."""
    size_l = np.fromiter(map(len, left), np.int64, len(left))
    size_r = np.fromiter(map(len, right), np.int64, len(right))
    flat_r = np.concatenate(right)
    words, where = np.unique(flat_r, return_inverse=True)
    owner_r = np.repeat(np.arange(len(right)), size_r)
    order = np.argsort(where, kind="stable")
    begin = np.searchsorted(where[order], np.arange(len(words) + 1))
    holders = owner_r[order]
    for a, s in enumerate(left):
        at = np.searchsorted(words, s)
        at = at[at < len(words)]
        hit = at[words[at] == s[:len(at)]] if len(at) else at
        if not len(hit):
            continue
        lo, n = begin[hit], begin[hit + 1] - begin[hit]
        idx = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        both = np.bincount(holders[idx], minlength=len(right))
        b = np.flatnonzero(both >= threshold * (size_l[a] + size_r - both) - 1e-9)
        if len(b):
            yield a, b


def _merged(root: np.ndarray, ends: list) -> np.ndarray:
    """Roots of all nodes after the links between roots in ``ends``."""
    if not ends:
        return root
    return local_roots(len(root), *np.concatenate(ends, 1))[root]


def _verify(threshold: float):
    def run(key, rows):
        rep, size = rows["rep"].to_numpy(), rows["n"].to_numpy()
        keys = np.stack([rows[c].to_numpy() for c in ("group", "block_a", "block_b")]).astype(np.int64)
        own = rows["block"].to_numpy()
        # repeated rows of a representative arrive once each: one is enough
        _, once = np.unique(np.concatenate((keys, rep[None])), axis=1, return_index=True)
        rep, size, keys, own = rep[once], size[once], keys[:, once], own[once]
        rows = rows.take(pa.array(once))
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"].to_pylist()]
        links = np.zeros(len(rep), np.int64)
        nodes, node = np.unique(rep, return_inverse=True)
        root, ends, held = np.arange(len(nodes)), [], 0
        order = np.lexsort(keys)
        cuts = np.flatnonzero((keys[:, order][:, 1:] != keys[:, order][:, :-1]).any(0)) + 1
        for group in np.split(order, cuts):
            first = own[group] == keys[1, group[0]]
            same = keys[1, group[0]] == keys[2, group[0]]
            left, right = (group, group) if same else (group[first], group[~first])
            if not len(left) or not len(right):
                continue
            for a, b in _overlaps([sets[i] for i in left], [sets[i] for i in right], threshold):
                a, b = left[a], right[b[b > a] if same else b]
                links[a] += size[b].sum()
                links[b] += size[a]
                # only links that join two components are held
                apart = np.unique(root[node[b]])
                apart = apart[apart != root[node[a]]]
                ends.append(np.stack((np.full(len(apart), root[node[a]]), apart)))
                held += len(apart) + 1
                if held > PENDING:
                    root, ends, held = _merged(root, ends), [], 0
        total = np.bincount(node, links, len(nodes)).astype(np.int64)
        root = nodes[_merged(root, ends)]
        keep = (total > 0) | (root != nodes)
        return pa.table({"rep": nodes[keep], "links": total[keep], "root": root[keep]})
    return run


def jaccard_join(docs: DataFrame, n: int = SHINGLE, threshold: float = THRESHOLD,
                 miss: float = MISS) -> DataFrame:
    """doc_id, class_id, n_links, copy_of; one row for each input row.

    class_id: smallest doc_id reachable over links; n_links: other rows linked
    directly; copy_of: smallest doc_id with an equal shingle set."""
    bands, band_rows = banding(threshold, miss)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = texts.where(F.col("doc_id").isNotNull())
    keyed = materialize(known.mapInArrow(
        _describe(n, bands, band_rows), "doc_id long, key binary, m long, bands array<long>"),
        "jaccard-keys")
    classes = materialize(keyed.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("m").alias("m"),
        F.first("bands").alias("bands")), "jaccard-classes")

    banded = classes.select("rep", F.explode("bands").alias("band"))
    stars = banded.groupBy("band").agg(F.min("rep").alias("centre"), F.max("rep").alias("other")
                                       ).where("centre <> other").select("band", "centre")
    spokes = banded.join(stars, "band").where("rep <> centre").select(
        F.col("rep").alias("a"), F.col("centre").alias("b"))
    groups = components(spokes).withColumnRenamed("component", "group")

    # a group's blocks are known before the sets are made; these are shuffled once
    member = materialize(groups.join(classes, F.col("vertex") == F.col("rep")).select(
        "key", "rep", "n", "m", "group"), "jaccard-members")
    volume = member.groupBy("group").agg(F.sum("m").alias("volume"), F.count("*").alias("members"))
    share = F.greatest(F.col("volume") / BLOCK, F.col("members") / DOCS)
    shards = int(volume.agg(F.sum(share * F.ceil(share))).first()[0] or 0) + 1
    wanted = member.join(volume, "group").select(
        F.col("rep").alias("doc_id"), "key", "rep", "n", "group",
        F.ceil(share).cast("int").alias("blocks"))
    # the members grow with the corpus: a shuffled join at every size
    sets = known.join(wanted.hint("merge"), "doc_id").mapInArrow(
        _member_sets(n), "rep long, n long, group long, blocks int, shingles binary")
    dealt = sets.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rep", "n", "shingles", "group", "block", F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"))
    shard = F.pmod(F.xxhash64("group", "block_a", "block_b"), F.lit(shards)).alias("shard")
    found = materialize(dealt.withColumn("shard", shard).groupBy("shard").applyInArrow(
        _verify(threshold), "rep long, links long, root long"), "jaccard-links")

    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(found.where("rep <> root").select(F.col("rep").alias("a"),
                                                           F.col("root").alias("b")))
    described = classes.join(degree, "rep", "left").join(
        labels, F.col("rep") == F.col("vertex"), "left").select(
        "key", F.coalesce("component", "rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
        F.col("rep").alias("copy_of"))
    out = keyed.select("doc_id", "key").join(described, "key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copy_of", "doc_id").alias("copy_of"))
    nameless = texts.where(F.col("doc_id").isNull()).select(
        "doc_id", F.lit(None).cast("long").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("copy_of"))
    return out.unionByName(nameless)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
