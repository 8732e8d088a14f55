"""Registered queries: text cleaning, shuffling and language mixing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import (MIN_TEXT_CHARS, NUM_CALIB, NUM_TEXT_CALIB, SEED, TEXT_SEEDS,
                                   TEXT_SOURCE_PREFIX)
from ..operators import sampling as S
from ..sources.tables import table
from .registry import register
from .sql import cjk, md5key, norm

MIX_PATTERN = "en,fr,en"


@register("normalize_text", f"""
SELECT doc_id, lang, {norm('text')} AS text_norm, CAST(length({norm('text')}) AS INTEGER) AS norm_chars
FROM documents""")
def normalize_text(spark, sf):
    d = table(spark, sf, "documents", spread_small=True)
    n = T.normalize_text("text")
    return d.select("doc_id", "lang", n.alias("text_norm"), F.length(n).alias("norm_chars"))


@register("contains_cjk", f"""
SELECT doc_id, {cjk('text')} AS has_cjk FROM documents""")
def contains_cjk(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.contains_cjk("text").alias("has_cjk"))


@register("min_length_filter", f"""
SELECT doc_id, lang, CAST(length({norm('text')}) AS INTEGER) AS norm_chars FROM documents
WHERE length({norm('text')}) >= {MIN_TEXT_CHARS}""")
def min_length_filter(spark, sf):
    d = table(spark, sf, "documents", spread_small=True)
    return (d.select("doc_id", "lang", F.length(T.normalize_text("text")).alias("norm_chars"))
            .where(F.col("norm_chars") >= MIN_TEXT_CHARS))


@register("seeded_shuffle", f"""
SELECT doc_id, row_number() OVER (ORDER BY {md5key(SEED, 'doc_id')}, doc_id) - 1 AS shuffle_rank
FROM documents""")
def seeded_shuffle(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return S.seeded_shuffle(d, "doc_id", seed=SEED, out="shuffle_rank")


@register("bottomk_sample", f"""
SELECT doc_id, {md5key(SEED, 'doc_id')} AS sample_key FROM documents
ORDER BY sample_key, doc_id LIMIT {NUM_TEXT_CALIB}""")
def bottomk_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    # straight over the scan: on a large table the threshold method keeps the
    # final merge at about n + N/65536 rows instead of (input splits x n)
    return S.bottomk_sample(d, NUM_TEXT_CALIB, "doc_id", seed=SEED, method="threshold")


def rr_ctes(n: int) -> str:
    """CTEs ending in ``kept`` (the round-robin mix keys, at most n rows)."""
    en_seed, other = TEXT_SEEDS["en"], SEED
    return f"""
d AS (
  SELECT doc_id, lang,
         md5(concat_ws(':', CASE WHEN lang = 'en' THEN '{en_seed}' ELSE '{other}' END,
                       CAST(doc_id AS VARCHAR))) AS k,
         length({norm('text')}) AS len, text AS raw
  FROM documents WHERE lang IN ('en', 'fr')),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k, doc_id, coalesce(md5(raw), '')) - 1 AS rk FROM d),
c AS (SELECT count(*) FILTER (WHERE lang = 'en') AS c_en,
             count(*) FILTER (WHERE lang = 'fr') AS c_fr FROM d),
e AS (SELECT least((c_en // 2) * 3 + CASE WHEN c_en % 2 = 0 THEN 0 ELSE 2 END,
                   c_fr * 3 + 1) AS end_key FROM c),
keyed AS (
  SELECT doc_id, lang, rk, len, raw,
         CASE WHEN lang = 'en' THEN (rk // 2) * 3 + CASE WHEN rk % 2 = 0 THEN 0 ELSE 2 END
              ELSE rk * 3 + 1 END AS mix_key
  FROM r),
kept AS (
  SELECT * FROM keyed, e WHERE mix_key < end_key AND len >= {MIN_TEXT_CHARS}
  ORDER BY mix_key LIMIT {n})"""


def _rr_sql(n: int) -> str:
    return f"""WITH {rr_ctes(n).strip()}
SELECT CAST(row_number() OVER (ORDER BY mix_key) - 1 AS BIGINT) AS seq, doc_id, lang,
       '{TEXT_SOURCE_PREFIX}' || lang AS source, mix_key, rk AS lang_rank, {norm('raw')} AS text
FROM kept"""


@register("round_robin_mix", _rr_sql(NUM_CALIB))
def round_robin_mix(spark, sf):
    d = table(spark, sf, "documents")
    return S.round_robin_mix(d, MIX_PATTERN, NUM_CALIB, seeds={"en": TEXT_SEEDS["en"]}, seed=SEED,
                             spread_rows=True)
