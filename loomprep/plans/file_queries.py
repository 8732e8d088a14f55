"""Registered queries over raw files: damaged inputs, dumps of vectors, patch files,
images found by path, dense patches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import patches as D
from ..session import scratch_dir
from ..sources import captioned as C
from ..sources import file_sink as S
from ..sources.pixels import SIDE, vector_pixels
from ..sources.rejects import read_with_rejects
from ..sources.tables import table
from .registry import register
from .stream_queries import VALUES
from .vector_queries import BF16


def _scratch(spark, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@register("read_failures", """
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, CAST(NULL AS VARCHAR) AS reject
FROM documents WHERE doc_id % 10 <> 3
UNION ALL SELECT DISTINCT NULL, NULL, 'unreadable' FROM documents WHERE doc_id % 10 = 3""")
def read_failures(spark, sf):
    """The documents as files, a part of which (doc_id % 10 = 3) is not Parquet at all:
    the rows of the good ones, and each reason for which files were rejected."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path, broken = _scratch(spark, "good"), F.col("doc_id") % 10 == 3
    docs.where(~broken).write.parquet(path + "/parquet")
    docs.where(broken).select(F.coalesce("text", F.lit("")).alias("value")).write.text(path + "/other")
    rows, rejects = read_with_rejects(spark, f"{path}/parquet/*.parquet,{path}/other/*.txt", ["doc_id", "text"])
    reasons = rejects.select(F.regexp_extract("error", "^[a-z ]+", 0).alias("reject")).distinct()
    return rows.select("doc_id", F.length("text").alias("n_chars"), F.lit(None).cast("string").alias("reject")
                       ).unionByName(reasons, allowMissingColumns=True)


@register("vector_dump", f"""
WITH o AS (SELECT embedding, row_number() OVER (ORDER BY vec_id) - 1 AS vec_id FROM embeddings),
{BF16.strip().replace('CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings',
                      'generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM o')
     .replace('SELECT vec_id, x, ', 'SELECT vec_id, i, x, ')}
SELECT vec_id AS position, CAST(i AS INTEGER) AS i, x AS f32, y AS bf16 FROM bf""")
def vector_dump(spark, sf):
    """All vectors in order as float32 and bfloat16 records, read back component by component."""
    e, path = table(spark, sf, "embeddings"), _scratch(spark, "vectors")
    read = {}
    for kind in S.WIDTHS:
        S.dump_vectors(e, f"{path}/{kind}", kind=kind)
        read[kind] = S.read_vectors(spark, f"{path}/{kind}").select(
            "position", F.posexplode("vector").alias("i", kind))
    both = read["f32"].join(read["bf16"], ["position", "i"])
    return both.select("position", "i", F.col("f32").cast("double"), F.col("bf16").cast("double"))


def _images(spark, sf):
    """The vectors as images of two sizes, 8 x 8 and 16 wide, 4 high, as bytes."""
    wide = F.when(F.col("vec_id") % 2 == 0, F.lit(SIDE)).otherwise(F.lit(2 * SIDE))
    p = vector_pixels(table(spark, sf, "embeddings")).withColumn("width", wide)
    return p.select("vec_id", D.pixel_bytes("pixels").alias("px"), "width",
                    (F.lit(SIDE * SIDE) / F.col("width")).cast("int").alias("height"))


HEX = "string_agg(printf('%02x', v), '' ORDER BY token, elem)"
LAYOUT = f"""
{VALUES.strip()},
sz AS (SELECT *, CASE WHEN vec_id % 2 = 0 THEN 8 ELSE 16 END AS w FROM px),
yx AS (SELECT vec_id, w, idx // w AS y, idx % w AS x, v FROM sz),
kk AS (SELECT yx.*, k FROM yx, (SELECT unnest([0, 1]) AS k)),
pt AS (SELECT vec_id, w, ((y // 4) * (w // 4) + x // 4) * 4 + ((y // 2) % 2) * 2 + (x // 2) % 2 AS token,
              (k * 2 + y % 2) * 2 + x % 2 AS elem, v FROM kk)"""


@register("dense_patches", f"""
WITH {LAYOUT.strip()}
SELECT vec_id, 0 AS t, CAST(64 // w // 2 AS INTEGER) AS grid_h, CAST(w // 2 AS INTEGER) AS grid_w, 1 AS channels,
       md5(unhex({HEX})) AS patches_md5, CAST(NULL AS VARCHAR) AS error FROM pt GROUP BY vec_id, w""")
def dense_patches(spark, sf):
    """One row for each image, its patches as bytes."""
    p = D.dense_patches(_images(spark, sf), ["vec_id"], "px", "height", "width", F.lit(1), patch=2, merge=2,
                        temporal=2, rgb=False)
    return p.select("vec_id", "t", "grid_h", "grid_w", "channels", F.md5("patches").alias("patches_md5"), "error")


@register("frame_patches", f"""
WITH {VALUES.strip()},
n AS (SELECT max(vec_id) AS last FROM embeddings),
fr AS (SELECT vec_id // 3 AS video, vec_id % 3 AS f, idx // 8 AS y, idx % 8 AS x, v FROM px),
pad AS (SELECT * FROM fr UNION ALL SELECT video, f + 1, y, x, v FROM fr, n
        WHERE f = least(2, last - video * 3) AND f % 2 = 0),
pt AS (SELECT video, f // 2 AS t, ((y // 4) * 2 + x // 4) * 4 + ((y // 2) % 2) * 2 + (x // 2) % 2 AS token,
              (f % 2 * 2 + y % 2) * 2 + x % 2 AS elem, v FROM pad)
SELECT video, CAST(t AS INTEGER) AS t, CAST(count(*) AS INTEGER) AS n_values, md5(unhex({HEX})) AS patches_md5
FROM pt GROUP BY video, t""")
def frame_patches(spark, sf):
    """Every three vectors are the frames of a video: temporal groups of two, the last
    one filled with its last frame."""
    p = vector_pixels(table(spark, sf, "embeddings")).select(
        F.expr("vec_id div 3").alias("video"), (F.col("vec_id") % 3).alias("at"), D.pixel_bytes("pixels").alias("px"))
    out = D.dense_patches(p, ["video"], "px", F.lit(SIDE), F.lit(SIDE), F.lit(1), patch=2, merge=2, temporal=2,
                          rgb=False, frame="at")
    return out.select("video", "t", F.length("patches").alias("n_values"), F.md5("patches").alias("patches_md5"))


@register("patch_files", f"""
WITH {LAYOUT.strip()}
SELECT 'item-' || vec_id || '.bin' AS name, CAST(count(*) AS BIGINT) AS n_bytes, md5(unhex({HEX})) AS content_md5
FROM pt GROUP BY vec_id""")
def patch_files(spark, sf):
    """One file for each image with its first temporal group, read back."""
    p = D.dense_patches(_images(spark, sf), ["vec_id"], "px", "height", "width", F.lit(1), patch=2, merge=2,
                        temporal=2, rgb=False).where("t = 0")
    path = _scratch(spark, "patch-files")
    S.write_files(p.select(F.concat(F.lit("item-"), F.col("vec_id").cast("string"), F.lit(".bin")).alias("name"),
                           F.col("patches").alias("content")), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "item-*.bin").load(path)
    return files.select(F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.col("length").alias("n_bytes"),
                        F.md5("content").alias("content_md5"))


@register("payload_by_path", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'inline' WHEN page_id % 3 = 1 THEN 'file' END AS found,
       CASE WHEN page_id % 3 < 2 THEN md5(html) END AS payload_md5 FROM pages""")
def payload_by_path(spark, sf):
    """Images given inline (page_id % 3 = 0), by the path of a file (1) and by a path
    where nothing is (2): the payload that each row gets."""
    pages = table(spark, sf, "pages").select("page_id", F.encode("html", "UTF-8").alias("b"))
    path, kind = _scratch(spark, "payloads"), F.col("page_id") % 3
    name = F.concat(F.lit("p"), F.col("page_id").cast("string"))
    S.write_files(pages.where(kind == 1).select(name.alias("name"), F.col("b").alias("content")), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "p*").load(path).select(
        F.regexp_extract("path", "[^/]*$", 0).alias("path"), F.col("content").alias("data"))
    image = F.struct(F.when(kind == 0, F.col("b")).alias("bytes"), F.when(kind > 0, name).alias("path"))
    rows = C.with_payload(pages.select("page_id", image.alias("image")), files)
    return rows.select("page_id", F.when(C.has_payload(), "inline").when(F.col("payload").isNotNull(), "file"
                                                                         ).alias("found"),
                       F.md5("payload").alias("payload_md5"))
