"""Token-sequence relations (SC7, SC13, P15-P17, P19, P20, W4, W5, W9, A5,
J1-J5).

Sequences are rows ``(sample_id, pos, token_id[, mask])``.  Per-sample
windows only ever see one sample's tokens, which come from one input row
(and capacity admission bounds them by the model context), so no window group
grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import (CHUNK_LEN, CONTEXT_LEN, IMAGE_PAD_ID, MERGE_SIZE, PATCH_SIZE,
                                   PREFILL_LEN, TEMPORAL_PATCH, VIDEO_PAD_ID, VISION_END_ID,
                                   VISION_START_ID)
from ..functions.hashing import hashed_id


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- SC7 / SC13: grid arithmetic -------------------------------------------

def grid_thw(frames, height, width, patch: int = PATCH_SIZE, temporal: int = TEMPORAL_PATCH) -> Column:
    """``(ceil(frames/tp), H div ps, W div ps)`` as ``struct<t,h,w>``."""
    return F.struct(F.ceil(_c(frames) / F.lit(temporal)).cast("int").alias("t"),
                    F.floor(_c(height) / F.lit(patch)).cast("int").alias("h"),
                    F.floor(_c(width) / F.lit(patch)).cast("int").alias("w"))


def visual_tokens(t, h, w, merge: int = MERGE_SIZE) -> Column:
    """Tokens a grid occupies after spatial merge: ``t*(h div m)*(w div m)``."""
    return (_c(t) * F.floor(_c(h) / merge) * F.floor(_c(w) / merge)).cast("int")


def chunk_count(length, chunk: int = CHUNK_LEN) -> Column:
    """Number of fixed-length chunks: ``ceil(length / chunk)``."""
    return F.ceil(_c(length) / F.lit(chunk)).cast("int")


# ---- P20: placeholder expansion --------------------------------------------

def time_marker_id(group, fps, temporal: int = TEMPORAL_PATCH, vocab: int = 500) -> Column:
    """Id of the time marker before a video temporal group: the mean frame
    time of the group, ``(tp*g + (tp-1)/2)/fps``, written in whole ms."""
    ms = F.round((_c(group) * temporal + (temporal - 1) / 2.0) / _c(fps) * 1000).cast("bigint")
    return hashed_id(F.concat(F.lit("<"), ms.cast("string"), F.lit("ms>")), vocab)


def media_tokens(modality, t, h, w, fps=None, merge: int = MERGE_SIZE,
                 temporal: int = TEMPORAL_PATCH, vocab: int = 500) -> Column:
    """An image becomes ``start + pads + end``; a video one such run per
    temporal group, each preceded by its time marker."""
    per = F.floor(_c(h) / merge) * F.floor(_c(w) / merge)
    run = lambda pad, n: F.concat(F.array(F.lit(VISION_START_ID)),
                                  F.array_repeat(F.lit(pad), n.cast("int")),
                                  F.array(F.lit(VISION_END_ID)))
    fps_c = F.lit(2.0) if fps is None else _c(fps)
    video = F.flatten(F.transform(F.sequence(F.lit(0), _c(t) - 1),
                                  lambda g: F.concat(F.array(time_marker_id(g, fps_c, temporal, vocab)),
                                                     run(VIDEO_PAD_ID, per))))
    return F.when(_c(modality) == "video", video).otherwise(run(IMAGE_PAD_ID, per * _c(t)))


def split_video_grids(grids: DataFrame) -> DataFrame:
    """Video grid rows ``(t, h, w)`` become ``t`` rows ``(1, h, w)``; video
    ordinals are renumbered across the split rows of the sample."""
    img = grids.where(F.col("modality") != "video")
    vid = grids.where(F.col("modality") == "video")
    w = Window.partitionBy("sample_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    vid = vid.withColumn("_before", F.coalesce(F.sum("t").over(w), F.lit(0)))
    vid = vid.select("sample_id", "modality", F.posexplode(F.sequence(F.lit(0), F.col("t") - 1)).alias("_j", "_x"),
                     "_before", "h", "w")
    vid = vid.select("sample_id", "modality", (F.col("_before") + F.col("_j")).cast("int").alias("ordinal"),
                     F.lit(1).alias("t"), "h", "w")
    return img.select("sample_id", "modality", "ordinal", "t", "h", "w").unionByName(vid)


# ---- W4 / A5: 3-axis positions ---------------------------------------------

def sequence_positions(tokens: DataFrame, grids: DataFrame, merge: int = MERGE_SIZE,
                       image_id: int = IMAGE_PAD_ID, video_id: int = VIDEO_PAD_ID,
                       start_id: int = VISION_START_ID) -> DataFrame:
    """3-axis position ids ``pos_t, pos_h, pos_w`` and the per-sample
    ``delta`` over mixed text/vision sequences.

    Over unmasked tokens (index ``i``): a vision block starts at the pad
    token right after a start token; its merged grid ``(t, h/m, w/m)``
    (looked up by modality and ordinal) gives ``n`` tokens and advance
    ``a = max(t, h, w)``.  Text: all axes ``i - shrink`` where shrink sums
    ``n - a`` of the blocks before; vision token ``j`` of a block at ``s``:
    ``base + (j div hw, (j div w) mod h, j mod w)`` with ``base = s -
    shrink(s)``.  Masked tokens get 1.  ``delta = max + 1 - len``.
    ``status`` flags ``missing_grid`` and ``grid_mismatch`` samples.
    """
    g = split_video_grids(grids)
    per_sample = (g.groupBy("sample_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("modality") == "image", F.struct(
            "ordinal", "t", (F.floor(F.col("h") / merge)).cast("int").alias("h"),
            (F.floor(F.col("w") / merge)).cast("int").alias("w"))))).alias("_img"),
        F.array_sort(F.collect_list(F.when(F.col("modality") == "video", F.struct(
            "ordinal", "t", (F.floor(F.col("h") / merge)).cast("int").alias("h"),
            (F.floor(F.col("w") / merge)).cast("int").alias("w"))))).alias("_vid")))
    has_mask = "mask" in tokens.columns
    t = tokens if has_mask else tokens.withColumn("mask", F.lit(1))
    t = t.join(per_sample, "sample_id", "left")

    w = Window.partitionBy("sample_id").orderBy("pos")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = F.col("mask") == 1
    # columns are added in a few batches (withColumns): each batch is one
    # analysis of the plan instead of one per column
    t = t.withColumns({"_i": F.sum(F.when(m, 1).otherwise(0)).over(run) - 1,
                       "_prev": F.last(F.when(m, F.col("token_id")), ignorenulls=True).over(
                           w.rowsBetween(Window.unboundedPreceding, -1))})
    is_img = m & (F.col("_prev") == start_id) & (F.col("token_id") == image_id)
    is_vid = m & (F.col("_prev") == start_id) & (F.col("token_id") == video_id)
    t = t.withColumns({"_img_ord": F.sum(F.when(is_img, 1).otherwise(0)).over(run) - 1,
                       "_vid_ord": F.sum(F.when(is_vid, 1).otherwise(0)).over(run) - 1,
                       "_is_img": is_img, "_blk": is_img | is_vid})
    g = F.when(F.col("_is_img"), F.get(F.col("_img"), F.col("_img_ord"))) \
        .when(F.col("_blk"), F.get(F.col("_vid"), F.col("_vid_ord")))
    t = t.withColumn("_g", g)
    n_b = F.col("_g.t") * F.col("_g.h") * F.col("_g.w")
    a_b = F.greatest(F.col("_g.t"), F.col("_g.h"), F.col("_g.w"))
    t = t.withColumn("_info", F.when(F.col("_blk"), F.struct(
        F.col("_i").alias("s"), n_b.alias("n"), a_b.alias("a"), F.col("_g.h").alias("h"),
        F.col("_g.w").alias("w"), F.col("_g").isNull().alias("missing"),
        F.when(F.col("_is_img"), F.lit(image_id)).otherwise(F.lit(video_id)).alias("pad"))))
    t = t.withColumns({"_shrink": F.sum(F.coalesce(F.col("_info.n") - F.col("_info.a"), F.lit(0))).over(run),
                       "_last": F.last("_info", ignorenulls=True).over(run)})
    i = F.col("_i")
    s, n, a = F.col("_last.s"), F.col("_last.n"), F.col("_last.a")
    hh, ww = F.col("_last.h"), F.col("_last.w")
    in_blk = m & s.isNotNull() & (i < s + n)
    j = i - s
    base = s - (F.col("_shrink") - (n - a))
    txt = i - F.col("_shrink")
    one = F.lit(1)
    t = t.withColumns({
        "pos_t": F.when(~m, one).when(in_blk, base + F.floor(j / (hh * ww))).otherwise(txt),
        "pos_h": F.when(~m, one).when(in_blk, base + F.pmod(F.floor(j / ww), hh)).otherwise(txt),
        "pos_w": F.when(~m, one).when(in_blk, base + F.pmod(j, ww)).otherwise(txt),
        "_in_blk": in_blk})
    pad_tok = F.col("token_id").isin(image_id, video_id)
    bad = (F.col("_in_blk") & (F.col("token_id") != F.col("_last.pad"))) | (m & pad_tok & ~F.col("_in_blk"))
    ws = Window.partitionBy("sample_id")
    t = t.withColumns({"_mx": F.max(F.when(m, F.greatest("pos_t", "pos_h", "pos_w"))).over(ws),
                       "_len": F.count(F.lit(1)).over(ws),
                       "_missing": F.max(F.coalesce(F.col("_info.missing"), F.lit(False))).over(ws),
                       "_bad": F.max(F.coalesce(bad, F.lit(False))).over(ws)})
    status = F.when(F.col("_missing"), F.lit("missing_grid")).when(F.col("_bad"), F.lit("grid_mismatch"))
    cols = ["sample_id", "pos", "token_id"] + (["mask"] if has_mask else [])
    return t.select(*cols, F.col("pos_t").cast("bigint").alias("pos_t"),
                    F.col("pos_h").cast("bigint").alias("pos_h"), F.col("pos_w").cast("bigint").alias("pos_w"),
                    (F.coalesce(F.col("_mx"), F.lit(0)) + 1 - F.col("_len")).cast("bigint").alias("delta"),
                    status.alias("status"))


def next_positions(positions: DataFrame) -> DataFrame:
    """A5: per sample, the next position id (max over axes + 1) and delta."""
    m = F.col("mask") == 1 if "mask" in positions.columns else F.lit(True)
    return positions.groupBy("sample_id").agg(
        (F.max(F.when(m, F.greatest("pos_t", "pos_h", "pos_w"))) + 1).alias("next_pos"),
        F.first("delta").alias("delta"))


# ---- W5: positions without vision ------------------------------------------

def mask_positions(tokens: DataFrame, row: Sequence[str] = ()) -> DataFrame:
    """``cumsum(mask) - 1`` with masked tokens at 1 and ``delta = max + 1 -
    len``; without a mask column, ``0..n-1`` and delta 0.  ``row`` names the
    columns that tell rows of one sample_id apart (repeated or null ids):
    positions and len are each row's own, the maximum is the sample_id's.
    Tokens that come partitioned by sample_id are not shuffled and are sorted
    once: what follows the first window needs a prefix of its order."""
    w = Window.partitionBy("sample_id", *row).orderBy("pos")
    ws = Window.partitionBy("sample_id")
    if "mask" not in tokens.columns:
        return tokens.withColumn("position", F.col("pos").cast("bigint")).withColumn("delta", F.lit(0).cast("bigint"))
    p = F.sum(F.col("mask").cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1
    n = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    d = tokens.withColumns({"position": F.when(F.col("mask") == 0, F.lit(1).cast("bigint")).otherwise(p), "_len": n})
    return d.withColumn("delta", (F.max("position").over(ws) + 1 - F.col("_len")).cast("bigint")).drop("_len")


# ---- P15 / W9: visual mask and chunks ----------------------------------------

def visual_mask(ids, chunk: int = CHUNK_LEN, image_id: int = IMAGE_PAD_ID,
                video_id: int = VIDEO_PAD_ID) -> Column:
    """Boolean array over ``ceil(len/chunk)*chunk`` slots: true at image or
    video pad ids, false in the padding."""
    x = _c(ids)
    pad = chunk_count(F.size(x), chunk) * chunk - F.size(x)
    return F.concat(F.transform(x, lambda v: v.isin(image_id, video_id)),
                    F.array_repeat(F.lit(False), pad.cast("int")))


def sequence_chunks(tokens: DataFrame, chunk: int = CHUNK_LEN) -> DataFrame:
    """Fixed-length chunks: chunk ``c`` holds positions ``[c*chunk,
    (c+1)*chunk)`` and attends to keys ``[0, (c+1)*chunk)``; a query at
    ``pos`` sees keys ``0..pos`` (``kv_visible = pos + 1``); padding slots of
    the last chunk see none.  A chunk is bounded by ``chunk`` tokens, so the
    per-chunk id list is bounded too.  The n x n mask is never built."""
    t = tokens.withColumn("chunk", F.floor(F.col("pos") / chunk).cast("int"))
    return t.groupBy("sample_id", "chunk").agg(
        F.count(F.lit(1)).cast("int").alias("n_tokens"),
        F.min("pos").alias("first_pos"),
        F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("_pt")) \
        .select("sample_id", "chunk", "n_tokens", "first_pos",
                ((F.col("chunk") + 1) * chunk).cast("int").alias("kv_len"),
                F.transform("_pt", lambda x: x["token_id"]).alias("token_ids"),
                F.transform("_pt", lambda x: (x["pos"] + 1).cast("int")).alias("kv_visible"))


def array_chunks(sequences: DataFrame, ids: str = "input_ids", chunk: int = CHUNK_LEN) -> DataFrame:
    """:func:`sequence_chunks` for sequences that arrive as arrays, one row each:
    every chunk is a slice of its own row, so nothing is shuffled."""
    each = sequences.where(F.size(ids) > 0).select("sample_id", ids, F.explode(
        F.sequence(F.lit(0), chunk_count(F.size(ids), chunk) - 1)).alias("chunk"))
    first = F.col("chunk") * chunk
    cut = F.slice(ids, first + 1, F.lit(chunk))
    return each.select("sample_id", "chunk", F.size(cut).cast("int").alias("n_tokens"),
                       first.cast("int").alias("first_pos"),
                       ((F.col("chunk") + 1) * chunk).cast("int").alias("kv_len"),
                       cut.alias("token_ids"),
                       F.transform(cut, lambda _, i: (i + first + 1).cast("int")).alias("kv_visible"))


# ---- P16: capacity ----------------------------------------------------------

def capacity_reason(n_tokens, prefill_len: int = PREFILL_LEN, context_len: int = CONTEXT_LEN) -> Column:
    """``over_context`` / ``over_prefill`` for sequences that do not fit, else null."""
    n = _c(n_tokens)
    return F.when(n > context_len, F.lit("over_context")).when(n > prefill_len, F.lit("over_prefill"))


# ---- P19: batch padding -----------------------------------------------------

def pad_batches(samples: DataFrame, batch_size: int, order: str = "sample_id", ids: str = "input_ids",
                pad_id: int = 0, side: str = "left", tasks: int | None = None) -> DataFrame:
    """Batch = rank div size (bucketed rank, no single partition), padded to
    the longest sequence of its batch, with an attention mask and the row's
    ``slot`` in its batch.  Every row is ranked as it is: rows that share a key
    follow each other (by their ids), rows with a null key come last.  ``tasks``:
    how many the batches are dealt to, where Spark's own number is not to hold."""
    from .ranking import SIDE, bucketed_rank, range_bucket
    bucket = F.coalesce(range_bucket(samples, order), F.lit(SIDE * SIDE))
    r = bucketed_rank(samples, [F.col(order).asc_nulls_last(), ids], bucket, out="_rk")
    r = r.withColumns({"batch_id": F.floor(F.col("_rk") / batch_size).cast("bigint"),
                       "slot": (F.col("_rk") % batch_size).cast("int")}).drop("_rk")
    # a batch is bounded by its size, so the arrays move once more and the rank is made once
    r = r.repartition(tasks, "batch_id") if tasks else r
    r = r.withColumn("padded_len", F.max(F.size(ids)).over(Window.partitionBy("batch_id")))
    n_pad = (F.col("padded_len") - F.size(ids)).cast("int")
    pad = F.array_repeat(F.lit(pad_id), n_pad)
    zeros = F.array_repeat(F.lit(0).cast("tinyint"), n_pad)
    ones = F.array_repeat(F.lit(1).cast("tinyint"), F.size(ids))
    if side == "left":
        out_ids, mask = F.concat(pad, F.col(ids)), F.concat(zeros, ones)
    else:
        out_ids, mask = F.concat(F.col(ids), pad), F.concat(ones, zeros)
    keep = [c for c in r.columns if c not in (ids, "attention_mask")]
    return r.select(*keep, out_ids.alias(ids), mask.alias("attention_mask"))


# ---- J1-J5: gathers and joins ----------------------------------------------

def hot_keys(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Keys holding at least ``fraction`` of all rows (partial aggregation;
    at most ``1/fraction`` keys, so the result has a proven size bound)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.where(F.col("_n") >= total * float(fraction)).select(key)


TRACKED = 4096           # ids that the frequency sketch tracks


def frequent_ways(tokens: DataFrame, key: str, ways: int) -> DataFrame:
    """(_hot, _ways): how many ways the rows of each frequent key are to be split so that
    no part holds more than one ``ways``-th of all rows.

    One pass of a frequent-items sketch (its error is at most some rows in ``TRACKED``);
    a key that needs splitting holds a ``ways``-th of the rows, so there are at most
    ``ways`` of them and the result may be broadcast."""
    top = tokens.agg(F.expr(f"approx_top_k(`{key}`, {int(ways)}, {max(TRACKED, 4 * int(ways))})").alias("k"),
                     F.count(F.lit(1)).alias("n"))
    each = top.select("n", F.explode("k").alias("k")).where("k.item is not null")
    return each.select(F.col("k.item").alias("_hot"),
                       F.ceil(F.col("k.count") * int(ways) / F.col("n")).cast("int").alias("_ways")).where("_ways > 1")


def _split_frequent(tokens: DataFrame, v: DataFrame, ways: int) -> DataFrame:
    """The gather's join with each frequent id split (and its vector copied) as often as
    its share of the rows asks for."""
    hot = frequent_ways(tokens, "token_id", ways)                       # at most ``ways`` rows
    t = tokens.join(F.broadcast(hot), tokens["token_id"] == F.col("_hot"), "left")
    part = F.pmod(F.xxhash64("sample_id", "pos"), F.col("_ways")).cast("int")
    t = t.withColumn("_part", F.coalesce(part, F.lit(0))).drop("_hot", "_ways")
    h = F.broadcast(hot.select(F.col("_hot").alias("_h"), F.col("_ways").alias("_w")))
    v = v.join(h, v["_vid"] == F.col("_h"), "left").select(
        "_vid", "embedding", F.explode(F.sequence(F.lit(0), F.coalesce("_w", F.lit(1)) - 1)).alias("_vpart"))
    return t.join(v, (t["token_id"] == v["_vid"]) & (t["_part"] == v["_vpart"]), "left").drop("_part", "_vpart")


def embedding_gather(tokens: DataFrame, vectors: DataFrame, id_col: str = "vec_id",
                     vec_col: str = "embedding", salt: int | str = 1,
                     hot_fraction: float | None = None) -> DataFrame:
    """``take(vectors, token_ids)``: equi-join on ``token_id = vec_id`` (a
    left join; unknown ids get ``status = 'unknown_id'`` instead of failing).
    Spark picks the join: broadcast only when the vector table is under the
    broadcast threshold by its size statistics, a shuffle join otherwise; AQE
    splits skewed partitions.

    ``salt > 1`` spreads ids over ``salt`` partitions by replicating vectors:
    every id when ``hot_fraction`` is None, otherwise only the ids holding at
    least ``hot_fraction`` of the token rows (found by a partial aggregation;
    at most ``1/hot_fraction`` ids, broadcast), so only hot vectors are
    replicated.  ``salt="auto"`` finds the frequent ids by a sketch and splits each by
    its share of the rows, four ways for every shuffle partition it would fill; the
    tokens are scanned once more for the sketch."""
    v = vectors.select(F.col(id_col).alias("_vid"), F.col(vec_col).alias("embedding"))
    if salt == "auto":
        partitions = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        j = _split_frequent(tokens, v, 4 * partitions)
    elif salt > 1:
        ways = F.sequence(F.lit(0), F.lit(salt - 1))
        t = tokens
        if hot_fraction is None:
            t = t.withColumn("_salt", F.pmod(F.hash("sample_id", "pos"), F.lit(salt)))
            v = v.withColumn("_salt", F.explode(ways))
        else:
            hk = hot_keys(tokens, "token_id", hot_fraction)     # <= 1/hot_fraction rows
            hot = F.broadcast(hk.select(F.col("token_id").alias("_hot"), F.lit(True).alias("_is_hot")))
            t = t.join(hot, t["token_id"] == hot["_hot"], "left").drop("_hot")
            t = t.withColumn("_salt", F.when(F.col("_is_hot"), F.pmod(F.hash("sample_id", "pos"), F.lit(salt)))
                             .otherwise(F.lit(0))).drop("_is_hot")
            hv = F.broadcast(hk.select(F.col("token_id").alias("_h")))
            v = v.join(hv, v["_vid"] == hv["_h"], "left") \
                .withColumn("_salt", F.explode(F.when(F.col("_h").isNotNull(), ways).otherwise(F.array(F.lit(0))))) \
                .drop("_h")
        j = t.join(v, (t["token_id"] == v["_vid"]) & (t["_salt"] == v["_salt"]), "left") \
            .drop(t["_salt"]).drop(v["_salt"])
    else:
        j = tokens.join(v, tokens["token_id"] == v["_vid"], "left")
    return j.withColumn("status", F.when(F.col("_vid").isNull(), F.lit("unknown_id"))).drop("_vid")


def visual_ranks(tokens: DataFrame, out: str = "vis_idx", image_id: int = IMAGE_PAD_ID,
                 video_id: int = VIDEO_PAD_ID) -> DataFrame:
    """0-based rank of each visual position inside its sample (null for text
    positions); computed on narrow token rows, per sample (bounded)."""
    flag = F.col("token_id").isin(image_id, video_id)
    w = Window.partitionBy("sample_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return tokens.withColumn(out, F.when(flag, F.sum(flag.cast("int")).over(w) - 1))


def input_vectors(tokens: DataFrame, vectors: DataFrame, vision: DataFrame,
                  sides: Sequence[DataFrame] = (), id_col: str = "vec_id", vec: str = "embedding",
                  vis_rank: str = "vis_idx", salt: int = 1,
                  hot_fraction: float | None = None) -> DataFrame:
    """J1 + J3 + J4 in one plan: the model input vector of every token row.

    Visual positions take the vision vector of their rank plus the side
    vectors (added in layer order); text positions gather from the vector
    table.  Token rows are shuffled while narrow, the side layers are summed
    on the (small) vision key before meeting the rows, and visual rows never
    enter the gather join, so the pad id cannot become a hot join key.  A
    visual row without a vision vector falls back to its token vector."""
    r = tokens if vis_rank in tokens.columns else visual_ranks(tokens, vis_rank)
    vt = vision.select("sample_id", vis_rank, F.col(vec).alias("_v"))
    for i, sd in enumerate(sides):
        sv = sd.select("sample_id", vis_rank, F.col(vec).alias(f"_s{i}"))
        vt = vt.join(sv, ["sample_id", vis_rank], "left") \
            .withColumn("_v", F.when(F.col(f"_s{i}").isNotNull(), F.zip_with("_v", f"_s{i}", lambda a, b: a + b))
                        .otherwise(F.col("_v"))).drop(f"_s{i}")
    seen = r.join(vt, ["sample_id", vis_rank], "left")
    # rows that have their vector ask for ids that no vector has, spread by place
    has = F.col("_v").isNotNull()
    asked = F.when(has, -1 - F.pmod(F.hash("sample_id", "pos"), F.lit(1 << 20))).otherwise(F.col("token_id"))
    g = embedding_gather(seen.withColumn("_token", F.col("token_id")).withColumn("token_id", asked),
                         vectors, id_col, vec, salt, hot_fraction)
    return g.withColumns({vec: F.coalesce("_v", "embedding"), "from_vision": has,
                          "status": F.when(~has, F.col("status")),
                          "token_id": F.col("_token")}).drop("_v", "_token")


def masked_replace(rows: DataFrame, vision: DataFrame, vis_rank: str = "vis_idx",
                   vec: str = "embedding", is_visual: Column | None = None) -> DataFrame:
    """Visual rows (by the visual mask) take the vision vectors in order:
    the k-th visual position of a sample gets vision row ``k``."""
    flag = is_visual if is_visual is not None else F.col("token_id").isin(IMAGE_PAD_ID, VIDEO_PAD_ID)
    w = Window.partitionBy("sample_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    r = rows.withColumn("_vis", flag) \
        .withColumn("_k", F.when(F.col("_vis"), F.sum(F.col("_vis").cast("int")).over(w) - 1))
    v = vision.select("sample_id", F.col(vis_rank).alias("_k"), F.col(vec).alias("_vvec"))
    j = r.join(v, ["sample_id", "_k"], "left")
    return j.withColumn(vec, F.when(F.col("_vis"), F.coalesce("_vvec", vec)).otherwise(F.col(vec))) \
        .withColumn("from_vision", F.col("_vvec").isNotNull()).drop("_vis", "_k", "_vvec")


def masked_add(rows: DataFrame, sides: Sequence[DataFrame], vis_rank: str = "vis_idx",
               vec: str = "embedding") -> DataFrame:
    """Add side vectors (several layers) at the visual positions, in order."""
    flag = F.col("token_id").isin(IMAGE_PAD_ID, VIDEO_PAD_ID)
    w = Window.partitionBy("sample_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    r = rows.withColumn("_k", F.when(flag, F.sum(flag.cast("int")).over(w) - 1))
    for i, s in enumerate(sides):
        sv = s.select("sample_id", F.col(vis_rank).alias("_k"), F.col(vec).alias(f"_s{i}"))
        r = r.join(sv, ["sample_id", "_k"], "left") \
            .withColumn(vec, F.when(F.col(f"_s{i}").isNotNull(),
                                    F.zip_with(vec, f"_s{i}", lambda a, b: a + b)).otherwise(F.col(vec))) \
            .drop(f"_s{i}")
    return r.drop("_k")


def decode_join(tokens: DataFrame, vocab: DataFrame, skip_ids: Sequence[int] = (),
                unknown: str = "<unk>") -> DataFrame:
    """Ids -> text: join to a ``(token_id, word)`` vocabulary, skip special
    ids, words joined by spaces in position order (per sample, bounded by the
    context length)."""
    t = tokens.where(~F.col("token_id").isin(*skip_ids)) if skip_ids else tokens
    j = t.join(vocab.select("token_id", "word"), "token_id", "left")
    return j.groupBy("sample_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("word", F.lit(unknown)).alias("w")))),
                                 lambda x: x["w"]), " ").alias("text"))


def trim_output(inp, out, end_id: int, max_new: int, skip_ids: Sequence[int] = ()) -> Column:
    """Generated part of an output: drop the prompt prefix, stop before the
    first end token, at most ``max_new`` tokens, special ids removed."""
    gen = F.slice(_c(out), F.size(_c(inp)) + 1, F.greatest(F.size(_c(out)) - F.size(_c(inp)), F.lit(0)))
    stop = F.array_position(gen, end_id)
    gen = F.when(stop > 0, F.slice(gen, 1, (stop - 1).cast("int"))).otherwise(gen)
    gen = F.slice(gen, 1, max_new)
    if skip_ids:
        gen = F.filter(gen, lambda x: ~x.isin(*skip_ids))
    return gen


def prefill_inputs(tokens: DataFrame, grids: DataFrame, vectors: DataFrame, vision: DataFrame,
                   sides: Sequence[DataFrame] = (), chunk: int = CHUNK_LEN,
                   prefill_len: int = PREFILL_LEN, context_len: int = CONTEXT_LEN
                   ) -> tuple[DataFrame, DataFrame]:
    """The data side of a chunked prefill, per token of every admitted
    sample: 3-axis positions and delta, the model input vector, the chunk
    and the number of visible keys.  Samples over the prefill or context
    capacity come back as rejects ``(sample_id, n_tokens, skip_reason)``
    (sizes by a partial aggregation) and are never windowed or gathered."""
    sizes = tokens.groupBy("sample_id").agg(F.count(F.lit(1)).cast("int").alias("n_tokens")) \
        .withColumn("skip_reason", capacity_reason("n_tokens", prefill_len, context_len))
    ok = tokens.join(sizes.where(F.col("skip_reason").isNull()).select("sample_id"), "sample_id", "left_semi")
    pos = sequence_positions(ok, grids)
    vec = input_vectors(ok, vectors, vision, sides).select("sample_id", "pos", "embedding", "from_vision",
                                                            F.col("status").alias("vec_status"))
    out = pos.join(vec, ["sample_id", "pos"], "inner") \
        .withColumns({"chunk": F.floor(F.col("pos") / chunk).cast("int"),
                      "kv_visible": (F.col("pos") + 1).cast("int"),
                      "visual": F.col("token_id").isin(IMAGE_PAD_ID, VIDEO_PAD_ID)})
    return out, sizes.where(F.col("skip_reason").isNotNull())


def decode_generated(df: DataFrame, inp: str, out: str, vocab: DataFrame, end_id: int, max_new: int,
                     skip_ids: Sequence[int] = (), key: str = "sample_id") -> DataFrame:
    """Generated text of each row: the output ids after the prompt, up to the
    first end id and at most ``max_new``, special ids removed, decoded
    through the ``(token_id, word)`` vocabulary.  Rows that generated
    nothing get an empty string."""
    gen = df.select(key, trim_output(F.col(inp), F.col(out), end_id, max_new, skip_ids).alias("_gen"))
    rows = gen.select(F.col(key).alias("sample_id"), F.posexplode("_gen").alias("pos", "token_id"))
    text = decode_join(rows, vocab)
    return gen.select(key).join(text.withColumnRenamed("sample_id", key), key, "left") \
        .select(key, F.coalesce("text", F.lit("")).alias("text"))
