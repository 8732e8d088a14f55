"""Image and frame geometry, pixel layout and value ranges (SC5, SC6,
SC8-SC10, W6, A4, T8).

Pixels are rows or flat arrays; layout is index arithmetic on columns (no
per-image Python).  Spark's ``image`` source gives ``data`` row-major in BGR
order: index ``(y*W + x)*nChannels + c``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (IMAGE_MAX_PIXELS, IMAGE_MIN_PIXELS, MERGE_SIZE, PATCH_SIZE,
                                   PIXEL_MEAN, PIXEL_STD, TEMPORAL_PATCH)
from .ranking import bucketed_rank, range_bucket


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pixel_cap_dims(width, height, max_pixels: int = IMAGE_MAX_PIXELS) -> Column:
    """Unchanged if ``max_pixels <= 0`` or the area fits; else every side
    ``max(1, round_half_even(side * sqrt(cap / area)))`` (may end slightly
    above the cap)."""
    w, h = _c(width).cast("bigint"), _c(height).cast("bigint")
    if max_pixels <= 0:
        return F.struct(w.cast("int").alias("width"), h.cast("int").alias("height"))
    ratio = F.sqrt(F.lit(float(max_pixels)) / (w * h).cast("double"))
    fit = (w * h) <= max_pixels
    nw = F.when(fit, w).otherwise(F.greatest(F.lit(1), F.bround(w * ratio).cast("int")))
    nh = F.when(fit, h).otherwise(F.greatest(F.lit(1), F.bround(h * ratio).cast("int")))
    return F.struct(nw.cast("int").alias("width"), nh.cast("int").alias("height"))


def resize_dims(height, width, factor: int = PATCH_SIZE * MERGE_SIZE,
                min_pixels: int = IMAGE_MIN_PIXELS, max_pixels: int = IMAGE_MAX_PIXELS) -> Column:
    """Sides rounded (half-even) to multiples of ``factor``; scaled down when
    the area exceeds ``max_pixels`` (floor) or up when below ``min_pixels``
    (ceil), keeping the aspect ratio."""
    h, w = _c(height).cast("double"), _c(width).cast("double")
    hb = F.bround(h / factor) * factor
    wb = F.bround(w / factor) * factor
    beta_dn = F.sqrt(h * w / max_pixels)
    beta_up = F.sqrt(F.lit(float(min_pixels)) / (h * w))
    too_big = hb * wb > max_pixels
    too_small = hb * wb < min_pixels
    nh = F.when(too_big, F.greatest(F.lit(float(factor)), F.floor(h / beta_dn / factor) * factor)) \
        .when(too_small, F.ceil(h * beta_up / factor) * factor).otherwise(hb)
    nw = F.when(too_big, F.greatest(F.lit(float(factor)), F.floor(w / beta_dn / factor) * factor)) \
        .when(too_small, F.ceil(w * beta_up / factor) * factor).otherwise(wb)
    return F.struct(nh.cast("int").alias("height"), nw.cast("int").alias("width"))


def normalize_pixels(px, mean: float = PIXEL_MEAN, std: float = PIXEL_STD) -> Column:
    """``(x - mean) / std`` over a pixel array."""
    return F.transform(_c(px), lambda x: (x.cast("double") - mean) / std)


def rgb_channel(c, n_channels) -> Column:
    """Channel index in RGB order from Spark's BGR(A) order (grey: 0)."""
    c, n = _c(c), _c(n_channels)
    return F.when(n >= 3, F.when(c < 3, 2 - c).otherwise(c)).otherwise(c)


def pixel_rows(df: DataFrame, key: str, data: str, height, width, n_channels,
               rgb: bool = True, frame: str | None = None, carry: tuple = ()) -> DataFrame:
    """Flat pixel arrays -> rows ``(key[, frame], y, x, c, v)``.  With
    ``rgb`` (conversion to RGB): BGR(A) is reordered to RGB, alpha dropped,
    and a grey value replicated to the three channels.  ``carry``: columns
    kept on every row (e.g. the width, for :func:`patchify`)."""
    cols = [key] + ([frame] if frame else []) + list(carry)
    d = df.select(*cols, F.posexplode(data).alias("_idx", "v"), _c(height).alias("_h"),
                  _c(width).alias("_w"), _c(n_channels).alias("_nc"))
    c = F.pmod(F.col("_idx"), F.col("_nc"))
    pix = F.floor(F.col("_idx") / F.col("_nc"))
    out = d.select(*cols, F.floor(pix / F.col("_w")).cast("int").alias("y"),
                   F.pmod(pix, F.col("_w")).cast("int").alias("x"),
                   (rgb_channel(c, F.col("_nc")) if rgb else c).cast("int").alias("c"), "v", "_nc")
    if rgb:
        out = out.where(~((F.col("_nc") == 4) & (F.col("c") == 3)))
        grey = F.col("_nc") == 1
        out = out.withColumn("c", F.explode(F.when(grey, F.array(F.lit(0), F.lit(1), F.lit(2)))
                                            .otherwise(F.array(F.col("c")))))
    return out.drop("_nc")


def patchify(pixels: DataFrame, key: str, width: int | str | Column, patch: int = PATCH_SIZE, merge: int = MERGE_SIZE,
             temporal: int = TEMPORAL_PATCH, frame: str = "frame", n_frames: Column | None = None) -> DataFrame:
    """Patch layout of ``(t, hblock, wblock, mh, mw, tp, py, px, c)``:
    pixel ``(frame, y, x, c)`` goes to temporal group ``t = frame div tp``,
    token ``((y div (ps*m))*WB + x div (ps*m))*m^2 + ((y div ps) mod m)*m +
    (x div ps) mod m`` and element ``(k*ps + y mod ps)*ps + x mod ps`` with
    ``k = frame mod tp``, channel last.  Frames are padded to a multiple of
    ``tp`` by repeating the last frame (``n_frames`` per item; 1 when no
    frame column).  ``width``: a number, or a column if the images differ in
    size.  Output rows ``(key, t, token, elem, c, v)``."""
    wide = F.lit(width) if isinstance(width, int) else _c(width)
    WB = F.floor(wide / (patch * merge))
    p = pixels if frame in pixels.columns else pixels.withColumn(frame, F.lit(0))
    nf = F.lit(1) if n_frames is None else n_frames
    p = p.withColumn("_nf", nf)
    # copies of the last frame fill the last temporal group
    pad = F.pmod(-F.col("_nf"), F.lit(temporal))
    copies = F.when(F.col(frame) == F.col("_nf") - 1, F.sequence(F.lit(0), pad)).otherwise(F.array(F.lit(0)))
    p = p.withColumn("_j", F.explode(copies)).withColumn("_f", F.col(frame) + F.col("_j"))
    y, x = F.col("y"), F.col("x")
    token = ((F.floor(y / (patch * merge)) * WB + F.floor(x / (patch * merge))) * (merge * merge)
             + F.pmod(F.floor(y / patch), F.lit(merge)) * merge + F.pmod(F.floor(x / patch), F.lit(merge)))
    k = F.pmod(F.col("_f"), F.lit(temporal))
    elem = (k * patch + F.pmod(y, F.lit(patch))) * patch + F.pmod(x, F.lit(patch))
    return p.select(key, F.floor(F.col("_f") / temporal).cast("int").alias("t"), token.cast("int").alias("token"),
                    elem.cast("int").alias("elem"), "c", "v")


def patch_vectors(patches: DataFrame, key: str) -> DataFrame:
    """Rows -> one flat vector per ``(key, t, token)`` ordered by
    ``(elem, c)``; bounded by ``tp*ps*ps*channels`` values per patch."""
    return patches.groupBy(key, "t", "token").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("elem", "c", "v"))), lambda s: s["v"]).alias("values"))


def _order_bucket(frames: DataFrame, order: str) -> Column:
    kind = frames.schema[order].dataType.typeName()
    if kind not in ("timestamp", "timestamp_ntz", "date"):
        return range_bucket(frames, order)
    whole = F.unix_micros(F.col(order).cast("timestamp"))
    return range_bucket(frames.select(whole.alias("_at")), "_at", key=whole)


def temporal_groups(frames: DataFrame, video: str, order: list[str], temporal: int = TEMPORAL_PATCH,
                    bucket: Column | None = None) -> DataFrame:
    """Ordered frames of each video -> ``frame_idx``, temporal group
    ``frame_idx div tp`` and slot; the last group is filled by repeating the
    last frame (``(-frames) mod tp`` copies, flagged ``is_pad``).  The frame
    rank uses buckets (by default quantile ranges of the first order column, a
    number or a time), so a very long video, or one with most of its frames in a
    short time, is ranked by many tasks."""
    b = bucket if bucket is not None else _order_bucket(frames, order[0])
    r = bucketed_rank(frames, order, b, partition_by=[video], out="frame_idx")
    counts = frames.groupBy(F.col(video).alias("_video")).agg(F.count(F.lit(1)).alias("_n"))
    r = r.join(counts, F.col(video).eqNullSafe(F.col("_video"))).drop("_video")
    pad = F.pmod(-F.col("_n"), F.lit(temporal))
    copies = F.when(F.col("frame_idx") == F.col("_n") - 1, F.sequence(F.lit(0), pad)).otherwise(F.array(F.lit(0)))
    r = r.withColumn("_j", F.explode(copies))
    r = r.withColumn("is_pad", F.col("_j") > 0).withColumn("slot_idx", F.col("frame_idx") + F.col("_j"))
    return r.withColumn("group_t", F.floor(F.col("slot_idx") / temporal).cast("bigint")) \
        .withColumn("slot", F.pmod(F.col("slot_idx"), F.lit(temporal)).cast("int")).drop("_n", "_j", "slot_idx")


def minmax_ranges(values: DataFrame, channel: str = "c", value: str = "v", bits: int = 8) -> DataFrame:
    """Per-channel min/max of calibration inputs and the linear scale
    ``(max - min) / (2^bits - 1)``."""
    return values.groupBy(channel).agg(F.min(value).alias("min_v"), F.max(value).alias("max_v")) \
        .withColumn("scale", (F.col("max_v") - F.col("min_v")) / float(2 ** bits - 1))


def frame_index_by_path(images: DataFrame, video: Column, path: str = "origin",
                        prefix_len: int | None = None) -> DataFrame:
    """Frames listed in path order (lexicographic: ``10`` sorts before
    ``2``) -> ``frame_idx`` per video, with bucketed ranks; a fixed-length
    path prefix is the bucket, which keeps the order and splits a video with
    very many frames.  The default length leaves the last six characters of the
    longest path out: a folder of ``frame_000123.png`` is cut every hundred."""
    d = images.withColumn("video_id", video)
    if prefix_len is None:
        length = images.agg(F.greatest(F.lit(0), F.max(F.length(path)) - 6)).scalar()
    else:
        length = F.lit(prefix_len)
    return bucketed_rank(d, [path], F.col(path).substr(F.lit(1), length), partition_by=["video_id"],
                         out="frame_idx", broadcast_offsets=None)
