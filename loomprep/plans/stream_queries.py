"""Registered queries: streams over the documents, the patch sink, progress
counts, decoded payloads and pixel channels.

A stream reads the documents' files as they are (``availableNow``: all that is
there, then stop) and its output is read back as a table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import MIN_TEXT_CHARS, SEED, TEXT_SOURCE_PREFIX
from ..operators import inference as I
from ..operators import prepare as P
from ..operators import vision as Z
from ..session import scratch_dir
from ..sources.files import write_patches
from ..sources.pixels import SIDE, vector_pixels
from ..sources.tables import table
from ..streaming import shuffle_buffer as SB
from ..streaming import text_stream as ST
from .registry import ORACLE, register
from .sql import cjk, md5key, norm

K, QUOTA = 50, 150
BUFFER, LANGUAGES = 64, ("en", "fr", "de", "es")
BATCH_BYTES = 64 << 20


def _stream(spark, sf):
    """The documents' files as a stream (a glob, as the table can be one file)."""
    schema = table(spark, sf, "documents").schema
    return ST.text_stream(spark, f"{sf.rstrip('/')}/documents.parque[t]", schema)


def _scratch(spark, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


CLEAN = f"""
cl AS (SELECT doc_id, lang, {norm('text')} AS t FROM documents),
ok AS (SELECT * FROM cl WHERE length(t) >= {MIN_TEXT_CHARS})"""


@register("stream_clean_texts", f"""
WITH {CLEAN.strip()}
SELECT doc_id, CAST(length(t) AS INTEGER) AS n_norm, md5(t) AS text_md5, {cjk('t')} AS has_cjk,
       '{TEXT_SOURCE_PREFIX}' || lang AS sample_source FROM ok""")
def stream_clean_texts(spark, sf):
    out = ST.clean_texts(_stream(spark, sf)).select(
        "doc_id", F.length("text_norm").alias("n_norm"), F.md5("text_norm").alias("text_md5"),
        "has_cjk", "sample_source")
    path = _scratch(spark, "clean-texts")
    q = (out.writeStream.option("checkpointLocation", path + "-progress")
         .trigger(availableNow=True).start(path, format="parquet"))
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


@register("stream_running_sample", f"""
SELECT doc_id, lang FROM documents ORDER BY {md5key(SEED, 'doc_id')}, doc_id LIMIT {K}""")
def stream_running_sample(spark, sf):
    q, read = ST.running_sample(spark, _stream(spark, sf).select("doc_id", "lang"), K, "doc_id", seed=SEED)
    q.awaitTermination()
    return read().select("doc_id", "lang")


@register("stream_until_quota", f"""
WITH {CLEAN.strip()},
r AS (SELECT doc_id, row_number() OVER (ORDER BY {md5key(SEED, 'doc_id')}, doc_id) - 1 AS arrival FROM ok)
SELECT doc_id, arrival FROM r WHERE arrival < {QUOTA}""")
def stream_until_quota(spark, sf):
    rows, _ = ST.collect_until_quota(spark, ST.clean_texts(_stream(spark, sf)).select("doc_id"), QUOTA,
                                     "doc_id", seed=SEED, trigger_available_now=True)
    return rows.select("doc_id", F.col("arrival").cast("bigint").alias("arrival"))


@register("stream_shuffle_buffer", f"""
WITH {CLEAN.strip()},
idx AS (SELECT doc_id, lang, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // {BUFFER} AS block
        FROM ok),
r AS (SELECT doc_id, lang, row_number() OVER (
        PARTITION BY lang ORDER BY block, {md5key(SEED, 'doc_id')}, doc_id) - 1 AS arrival_index FROM idx)
SELECT doc_id, lang, arrival_index FROM r WHERE arrival_index < {QUOTA}""")
def stream_shuffle_buffer(spark, sf):
    """Each language's first QUOTA clean texts in the order of its shuffle buffer; files
    are read some BATCH_BYTES at a time until every language has them."""
    schema = table(spark, sf, "documents").schema
    docs = ST.text_stream(spark, f"{sf.rstrip('/')}/documents.parque[t]", schema,
                          max_bytes_per_trigger=BATCH_BYTES)
    rows, _ = SB.shuffled_until_quota(
        spark, ST.clean_texts(docs).select("doc_id", "lang"), "lang", "doc_id", arrival=["doc_id"],
        buffer=BUFFER, quota=QUOTA, keys=LANGUAGES)
    return rows


@register("stream_counts", f"WITH {CLEAN.strip()} SELECT count(*) AS rows FROM ok")
def stream_counts(spark, sf):
    watched = ST.observed(ST.clean_texts(_stream(spark, sf)).select("doc_id"), "clean")
    path = _scratch(spark, "counted")
    q = (watched.writeStream.option("checkpointLocation", path + "-progress")
         .trigger(availableNow=True).start(path, format="parquet"))
    q.awaitTermination()
    seen = [p.observedMetrics.get("clean") for p in q.recentProgress]
    return spark.createDataFrame([(sum(m["rows"] for m in seen if m is not None),)], "rows bigint")


@register("progress_counts", f"""
WITH {CLEAN.strip()}
SELECT count(*) AS rows FROM cl""")
def progress_counts(spark, sf):
    df, seen = P.with_progress(table(spark, sf, "documents").select("doc_id"), "documents")
    df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"],)], "rows bigint")


@register("decode_payloads", """
SELECT page_id, CAST(length(html) AS INTEGER) AS n_chars,
       CAST(length(html) - length(replace(html, '<', '')) AS INTEGER) AS n_open FROM pages""")
def decode_payloads(spark, sf):
    def decode(payload: bytes) -> dict:
        text = payload.decode("utf-8")
        return {"n_chars": len(text), "n_open": text.count("<")}
    kind = T.StructType([T.StructField("n_chars", T.IntegerType()), T.StructField("n_open", T.IntegerType())])
    pages = table(spark, sf, "pages").select("page_id", F.encode("html", "UTF-8").alias("payload"))
    return pages.select("page_id", I.decode_bytes("payload", decode, kind).alias("d")).select("page_id", "d.*")


VALUES = """
px AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS idx,
              CAST(least(255, greatest(0, floor((CAST(unnest(embedding) AS DOUBLE) * 2 + 1) * 127.5))) AS INTEGER) AS v
       FROM embeddings)"""


@register("pixel_channels", f"""
WITH {VALUES.strip()}
SELECT vec_id, CAST(idx // 4 // 4 AS INTEGER) AS y, CAST(idx // 4 % 4 AS INTEGER) AS x,
       CAST(2 - idx % 4 AS INTEGER) AS c, v FROM px WHERE idx % 4 < 3""")
def pixel_channels(spark, sf):
    """The vectors as 4 x 4 images in BGRA order -> RGB rows."""
    p = vector_pixels(table(spark, sf, "embeddings"))
    return Z.pixel_rows(p, "vec_id", "pixels", F.lit(4), F.lit(4), F.lit(4), rgb=True)


@register("patchify_sizes", f"""
WITH {VALUES.strip()},
sz AS (SELECT *, CASE WHEN vec_id % 2 = 0 THEN 8 ELSE 16 END AS w FROM px),
yx AS (SELECT vec_id, w, idx // w AS y, idx % w AS x, v FROM sz),
kk AS (SELECT yx.*, k FROM yx, (SELECT unnest([0, 1]) AS k))
SELECT vec_id, 0 AS t,
       CAST(((y // 4) * (w // 4) + x // 4) * 4 + ((y // 2) % 2) * 2 + (x // 2) % 2 AS INTEGER) AS token,
       CAST((k * 2 + y % 2) * 2 + x % 2 AS INTEGER) AS elem, 0 AS c, v
FROM kk""")
def patchify_sizes(spark, sf):
    """Images of two sizes in one frame: 8 x 8 and 16 wide, 4 high."""
    wide = F.when(F.col("vec_id") % 2 == 0, F.lit(SIDE)).otherwise(F.lit(2 * SIDE))
    p = vector_pixels(table(spark, sf, "embeddings")).withColumn("width", wide)
    high = F.floor(F.lit(SIDE * SIDE) / F.col("width"))
    rows = Z.pixel_rows(p, "vec_id", "pixels", high, F.col("width"), F.lit(1), rgb=False, carry=("width",))
    return Z.patchify(rows, "vec_id", "width", patch=2, merge=2, temporal=2)


@register("patch_sink", ORACLE["patchify"])
def patch_sink(spark, sf):
    """The patch rows written by the sink and read back."""
    from .vision_queries import patchify
    path = _scratch(spark, "patches")
    write_patches(patchify(spark, sf), path)
    return spark.read.parquet(path)
