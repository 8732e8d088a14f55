"""Registered queries: image geometry, pixel layout, frame grouping,
value ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import IMAGE_MAX_PIXELS, IMAGE_MIN_PIXELS, PIXEL_MEAN, PIXEL_STD
from ..operators import vision as Z
from ..sources.pixels import SIDE, page_image_sizes, vector_pixels
from ..sources.tables import table
from .registry import register

CAP = IMAGE_MAX_PIXELS
SIZES = """
sz AS (SELECT page_id, CAST(100 + length(html) % 1200 AS INTEGER) AS width,
              CAST(100 + (37 * page_id) % 900 AS INTEGER) AS height FROM pages)"""
PIX = """
px AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS idx,
              CAST(least(255, greatest(0, floor((CAST(unnest(embedding) AS DOUBLE) * 2 + 1) * 127.5))) AS INTEGER) AS v
       FROM embeddings)"""


@register("pixel_cap_dims", f"""
WITH {SIZES.strip()}
SELECT page_id,
  CASE WHEN width * height <= {CAP} THEN width
       ELSE greatest(1, CAST(round_even(width * sqrt({CAP}.0 / (width * height)), 0) AS INTEGER)) END AS width,
  CASE WHEN width * height <= {CAP} THEN height
       ELSE greatest(1, CAST(round_even(height * sqrt({CAP}.0 / (width * height)), 0) AS INTEGER)) END AS height
FROM sz""")
def pixel_cap_dims(spark, sf):
    s = page_image_sizes(table(spark, sf, "pages"))
    d = Z.pixel_cap_dims("width", "height", CAP)
    return s.select("page_id", d["width"].alias("width"), d["height"].alias("height"))


F32 = 32


@register("resize_dims", f"""
WITH {SIZES.strip()},
b AS (SELECT page_id, CAST(height AS DOUBLE) AS h, CAST(width AS DOUBLE) AS w,
             round_even(height / {F32}, 0) * {F32} AS hb, round_even(width / {F32}, 0) * {F32} AS wb FROM sz)
SELECT page_id,
  CAST(CASE WHEN hb * wb > {CAP} THEN greatest({F32}, floor(h / sqrt(h * w / {CAP}) / {F32}) * {F32})
            WHEN hb * wb < {IMAGE_MIN_PIXELS} THEN ceil(h * sqrt({IMAGE_MIN_PIXELS} / (h * w)) / {F32}) * {F32}
            ELSE hb END AS INTEGER) AS height,
  CAST(CASE WHEN hb * wb > {CAP} THEN greatest({F32}, floor(w / sqrt(h * w / {CAP}) / {F32}) * {F32})
            WHEN hb * wb < {IMAGE_MIN_PIXELS} THEN ceil(w * sqrt({IMAGE_MIN_PIXELS} / (h * w)) / {F32}) * {F32}
            ELSE wb END AS INTEGER) AS width
FROM b""")
def resize_dims(spark, sf):
    s = page_image_sizes(table(spark, sf, "pages"))
    d = Z.resize_dims("height", "width")
    return s.select("page_id", d["height"].alias("height"), d["width"].alias("width"))


@register("normalize_pixels", f"""
WITH {PIX.strip()}
SELECT vec_id, round(sum((v - {PIXEL_MEAN}) / {PIXEL_STD}), 6) AS norm_sum,
       round(min((v - {PIXEL_MEAN}) / {PIXEL_STD}), 6) AS norm_min FROM px GROUP BY vec_id""")
def normalize_pixels(spark, sf):
    p = vector_pixels(table(spark, sf, "embeddings"))
    n = p.select("vec_id", Z.normalize_pixels("pixels").alias("n"))
    total = F.aggregate("n", F.lit(0.0), lambda a, x: a + x)
    return n.select("vec_id", F.round(total, 6).alias("norm_sum"), F.round(F.array_min("n"), 6).alias("norm_min"))


@register("patchify", f"""
WITH {PIX.strip()},
yx AS (SELECT vec_id, idx // {SIDE} AS y, idx % {SIDE} AS x, v FROM px),
kk AS (SELECT yx.*, k FROM yx, (SELECT unnest([0, 1]) AS k))
SELECT vec_id, 0 AS t,
       CAST(((y // 4) * 2 + x // 4) * 4 + ((y // 2) % 2) * 2 + (x // 2) % 2 AS INTEGER) AS token,
       CAST((k * 2 + y % 2) * 2 + x % 2 AS INTEGER) AS elem, 0 AS c, v
FROM kk""")
def patchify(spark, sf):
    p = vector_pixels(table(spark, sf, "embeddings"))
    rows = Z.pixel_rows(p, "vec_id", "pixels", F.lit(SIDE), F.lit(SIDE), F.lit(1), rgb=False)
    return Z.patchify(rows, "vec_id", SIDE, patch=2, merge=2, temporal=2)


@register("temporal_groups", """
WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events),
p AS (SELECT user_id, event_id, frame_idx, false AS is_pad, frame_idx AS slot_idx FROM r
      UNION ALL
      SELECT user_id, event_id, frame_idx, true, frame_idx + 1 FROM r WHERE frame_idx = n - 1 AND n % 2 = 1)
SELECT user_id, event_id, CAST(frame_idx AS BIGINT) AS frame_idx, is_pad, CAST(slot_idx // 2 AS BIGINT) AS group_t,
       CAST(slot_idx % 2 AS INTEGER) AS slot FROM p""")
def temporal_groups(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    g = Z.temporal_groups(e, "user_id", ["ts", "event_id"], temporal=2)
    return g.select("user_id", "event_id", "frame_idx", "is_pad", "group_t", "slot")


@register("minmax_ranges", f"""
WITH {PIX.strip()}
SELECT CAST(idx % 4 AS INTEGER) AS c, min((v - {PIXEL_MEAN}) / {PIXEL_STD}) AS min_v,
       max((v - {PIXEL_MEAN}) / {PIXEL_STD}) AS max_v,
       round((max((v - {PIXEL_MEAN}) / {PIXEL_STD}) - min((v - {PIXEL_MEAN}) / {PIXEL_STD})) / 255, 9) AS scale
FROM px GROUP BY idx % 4""")
def minmax_ranges(spark, sf):
    p = vector_pixels(table(spark, sf, "embeddings"))
    n = p.select("vec_id", F.posexplode(Z.normalize_pixels("pixels")).alias("idx", "v"))
    r = Z.minmax_ranges(n.select(F.pmod("idx", F.lit(4)).cast("int").alias("c"), "v"), bits=8)
    return r.select("c", "min_v", "max_v", F.round("scale", 9).alias("scale"))
