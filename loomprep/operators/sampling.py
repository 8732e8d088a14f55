"""Seeded sampling, shuffling and source mixing.

All randomness is a hash of (seed, row id): the same rows are chosen on every
run, on any partitioning, and after any task retry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import MAX_TEXT_CHARS, MIN_TEXT_CHARS, SEED, TEXT_SOURCE_PREFIX
from ..functions.hashing import seeded_key
from ..functions.text import normalize_text
from ..session import materialize
from ..sources.tables import spread
from .ranking import bucketed_rank, hash_bucket


def bottomk_sample(df: DataFrame, n: int, id_cols: Sequence[str] | str, seed=SEED,
                   key_col: str = "sample_key", method: str = "take_ordered",
                   digits: int = 4, ties: Sequence[str] = ()) -> DataFrame:
    """Uniform sample of ``n`` rows without replacement (all rows if fewer):
    the ``n`` smallest ``md5(seed:id)``; bottom-k samples of parts merge
    exactly, so the result does not depend on partitioning.  Rows that share
    an id go by the columns ``ties``.

    ``take_ordered``: ``TakeOrderedAndProject`` -- every task keeps its own
    bottom-n and partitions x n rows meet in one final merge.
    ``threshold``: rows are counted per ordered key bucket (leading hex
    digits; a partial aggregation of at most ``16**digits`` groups), the
    bucket where the running count reaches ``n`` is found on that small
    table, and only rows up to it go through the ordered take: the final
    merge sees about ``n + N/16**digits`` rows whatever the partition count,
    with no shuffle of the input.
    ``ranked``: a bucketed rank everywhere and ``rank < n``.
    Use ``threshold`` for inputs with very many partitions (large tables),
    and ``ranked`` when ``n`` itself is large: the ordered-take methods keep
    up to ``n`` rows per task."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    keyed = df.withColumn(key_col, seeded_key(seed, *ids))
    if method == "ranked":
        r = bucketed_rank(keyed, [key_col, *ids, *ties], hash_bucket(key_col, digits), out="_bk_rank")
        return r.where(F.col("_bk_rank") < int(n)).drop("_bk_rank")
    if method == "threshold":
        b = hash_bucket(key_col, digits)
        counts = keyed.groupBy(b.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        cum = counts.withColumn("_c", F.sum("_n").over(
            Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
        # first bucket whose running count reaches n (all buckets if fewer rows)
        last = cum.agg(F.coalesce(F.min(F.when(F.col("_c") >= int(n), F.col("_b"))),
                                  F.max("_b")).alias("_last")).scalar()
        keyed = keyed.where(b <= last)
    return keyed.orderBy(key_col, *ids, *ties).limit(int(n))


def seeded_shuffle(df: DataFrame, id_cols: Sequence[str] | str, seed=SEED,
                   out: str = "shuffle_rank", digits: int = 4,
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """Seeded permutation: 0-based rank ``out`` by ``(md5(seed:id), id)``,
    computed with bucketed ranks (no single-partition window)."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    keyed = df.withColumn("_shuffle_key", seeded_key(seed, *ids))
    return bucketed_rank(keyed, ["_shuffle_key", *ids], hash_bucket("_shuffle_key", digits),
                         partition_by=partition_by, out=out,
                         broadcast_offsets=not partition_by or None).drop("_shuffle_key")


def block_shuffle_order(idx: Column | str, key: Column | str, block: int) -> list[Column]:
    """Order of a bounded shuffle buffer: blocks of ``block`` rows in arrival
    order, hashed order inside a block (an order-approximate buffer shuffle)."""
    i = F.col(idx) if isinstance(idx, str) else idx
    k = F.col(key) if isinstance(key, str) else key
    return [F.floor(i / F.lit(int(block))), k]


def _pattern(pattern: Sequence[str] | str) -> list[str]:
    items = pattern.split(",") if isinstance(pattern, str) else list(pattern)
    return [p.strip().lower() for p in items if p and p.strip()]


def round_robin_mix(docs: DataFrame, pattern: Sequence[str] | str, n: int, *,
                    id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text",
                    seeds: Mapping[str, int] | None = None, seed: int = SEED,
                    languages: Sequence[str] | None = None,
                    min_chars: int = MIN_TEXT_CHARS, max_chars: int = MAX_TEXT_CHARS,
                    source_prefix: str = TEXT_SOURCE_PREFIX, digits: int = 4,
                    with_text: bool = True, spread_rows: bool = False) -> DataFrame:
    """Weighted round-robin over per-language streams.

    Each language stream is the rows of that language in seeded-shuffle order.
    The pattern is cycled; every turn pulls the next row of its language; a
    row shorter than ``min_chars`` after normalisation uses up its turn; the
    first exhausted language ends the mix; at most ``n`` rows are kept.
    ``spread_rows``: ``docs`` is a scan; spread it before the regex pass when
    it has fewer splits than the cluster has cores.

    Closed form: row of 0-based rank ``r`` in language ``l`` (weight ``w_l``,
    pattern slots ``s_l``) has key ``(r div w_l)*L + s_l[r mod w_l]``; the
    mix is the rows with ``key < E`` (``E`` = smallest key of a first missing
    row) that pass the length test, by key, first ``n``.
    """
    pat = _pattern(pattern)
    if not pat:
        raise ValueError("pattern must name at least one language")
    L = len(pat)
    streamed = sorted(set(languages) & set(pat)) if languages is not None else sorted(set(pat))
    if not streamed:
        raise ValueError("no language of the pattern has a stream")
    slots = {lang: [i for i, p in enumerate(pat) if p == lang] for lang in streamed}
    seeds = dict(seeds or {})
    lang = F.col(lang_col)

    seed_expr = F.lit(str(seed))
    for l in streamed:
        if l in seeds:
            seed_expr = F.when(lang == l, F.lit(str(seeds[l]))).otherwise(seed_expr)

    # Narrow projection: only the key, the language, the normalised length and the
    # text's digest travel through the shuffles; the text is joined back for the
    # kept rows.  Rows that share an id are told apart by the digest.
    src = docs.where(lang.isin(streamed))
    if spread_rows:                     # docs is a scan with too few splits (see spread())
        src = spread(src, id_col)
    digest = F.coalesce(F.md5(F.col(text_col)), F.lit(""))
    narrow = (src
              .select(F.col(id_col).alias("_id"), lang.alias("_lang"), digest.alias("_digest"),
                      F.md5(F.concat_ws(":", seed_expr, F.col(id_col).cast("string"))).alias("_key"),
                      F.length(normalize_text(text_col, max_chars)).alias("_len")))
    # written once: the ranks, the per-language counts and the stop key all
    # scan it, and the text is normalised only in this one pass
    narrow = materialize(narrow, "rr-keys").withColumn("_b", hash_bucket("_key", digits))

    def key_of(rank: Column, l: str) -> Column:
        w = len(slots[l])
        return ((F.floor(rank / w) * L).cast("bigint")
                + F.element_at(F.array(*[F.lit(s) for s in slots[l]]), (F.pmod(rank, F.lit(w)) + 1).cast("int")))

    # one count by language and bucket (bounded) gives the buckets' offsets, the
    # stop key, and the cut: a language gives at most n rows, so buckets behind its
    # n-th passing row are not ranked
    held = narrow.groupBy("_lang", "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_len") >= int(min_chars)).alias("_p"))
    before = Window.partitionBy("_lang").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(F.col("_lang").alias("_l"), F.col("_b").alias("_bucket"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                          F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_passed")
                          ).where(F.col("_passed") < int(n))
    in_bucket = Window.partitionBy("_lang", "_b").orderBy("_key", "_id", "_digest")
    ranked = narrow.join(offsets, (F.col("_lang") == F.col("_l")) & (F.col("_b") == F.col("_bucket"))) \
        .withColumn("_rank", F.col("_off") + F.row_number().over(in_bucket) - 1)
    mix_key = None
    for l in streamed:
        e = key_of(F.col("_rank"), l)
        mix_key = F.when(F.col("_lang") == l, e) if mix_key is None else mix_key.when(F.col("_lang") == l, e)

    counts = held.agg(*[F.coalesce(F.sum(F.when(F.col("_lang") == l, F.col("_n"))), F.lit(0)).cast("bigint")
                        .alias(f"_c_{i}") for i, l in enumerate(streamed)])
    end_key = counts.select(F.least(*[key_of(F.col(f"_c_{i}"), l) for i, l in enumerate(streamed)])
                            if len(streamed) > 1 else key_of(F.col("_c_0"), streamed[0])).scalar()

    kept = (ranked.withColumn("mix_key", mix_key)
            .where((F.col("mix_key") < end_key) & (F.col("_len") >= int(min_chars)))
            .select("_id", "_lang", "_digest", "_rank", "mix_key")
            .orderBy("mix_key").limit(int(n)))
    kept = kept.withColumn("seq", F.row_number().over(Window.orderBy("mix_key")) - 1)
    out = kept.select(F.col("seq").cast("bigint").alias("seq"), F.col("_id").alias(id_col),
                      F.col("_lang").alias(lang_col),
                      F.concat(F.lit(source_prefix), F.col("_lang")).alias("source"),
                      F.col("mix_key"), F.col("_rank").alias("lang_rank"), "_digest")
    if not with_text:
        return out.drop("_digest")
    # kept has at most n rows (the quota); Spark checks whether it is broadcast.
    # Rows with the same id and text are one text, whichever of them is kept
    wanted = out.select(F.col(id_col).alias("_id"), F.col("_digest").alias("_d")).distinct()
    raw = docs.select(F.col(id_col).alias("_rid"), F.col(text_col).alias("_raw"), digest.alias("_rd"))
    texts = raw.join(wanted, F.col("_rid").eqNullSafe(F.col("_id")) & (F.col("_rd") == F.col("_d"))) \
        .groupBy("_rid", "_rd").agg(F.first("_raw").alias("_raw"))
    out = out.join(texts, F.col(id_col).eqNullSafe(F.col("_rid")) & (F.col("_digest") == F.col("_rd")))
    return out.select("seq", id_col, lang_col, "source", "mix_key", "lang_rank",
                      normalize_text("_raw", max_chars).alias("text"))


def ratio_interleave(images: DataFrame, texts: DataFrame, n: int, *,
                     image_order: str = "seq", text_order: str = "seq") -> DataFrame:
    """Interleave ``k = max(1, round_half_even(I/T))`` images per text, then
    stop at ``n`` rows.  No images -> first n texts; no texts -> first n
    images.

    ``k`` uses the full input counts (two aggregates); only the first ``n``
    rows of either input can reach the first ``n`` of the mix, so each side
    is first cut to its ``n`` first rows by a bounded ``TakeOrderedAndProject``
    and the ranks below run over at most ``2n`` rows, whatever the inputs'
    size."""
    n_img = images.agg(F.count(F.lit(1))).scalar()
    n_txt = texts.agg(F.count(F.lit(1))).scalar()
    img = images.orderBy(image_order).limit(int(n))
    txt = texts.orderBy(text_order).limit(int(n))
    img = img.withColumn("_i", F.row_number().over(Window.orderBy(image_order)) - 1)
    txt = txt.withColumn("_j", F.row_number().over(Window.orderBy(text_order)) - 1)
    k = F.greatest(F.lit(1), F.bround(n_img / F.greatest(F.lit(1), n_txt)).cast("bigint"))
    img = (img.withColumn("_round", F.floor(F.col("_i") / k)).withColumn("_slot", F.pmod(F.col("_i"), k))
           .drop("_i"))
    txt = txt.withColumn("_round", F.col("_j")).withColumn("_slot", k).drop("_j")
    both = img.unionByName(txt, allowMissingColumns=True).orderBy("_round", "_slot").limit(int(n))
    return (both.withColumn("mix_seq", F.row_number().over(Window.orderBy("_round", "_slot")) - 1)
            .drop("_round", "_slot"))


def quota_targets(n: int, text_quota: int, image_quota: int, got_text: Column) -> tuple[int, Column]:
    """Text target ``min(max(text,0), n)`` and the image target that makes up
    for missing texts: ``min(n - got, image + text - got)``."""
    text_target = min(max(int(text_quota), 0), int(n))
    image_req = min(max(int(image_quota), 0), int(n))
    image_target = F.greatest(F.lit(0), F.least(F.lit(int(n)) - got_text,
                                                F.lit(image_req + text_target) - got_text))
    return text_target, image_target
