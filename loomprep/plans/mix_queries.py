"""Registered queries: ratio interleave, calibration mix, rendering,
admission, sorting and totals (the calibration-batch preparation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import (EN_IMAGE_PROMPTS, IMAGE_SOURCE, MAX_TOKENS, MIN_TOKENS, NUM_CALIB,
                                   NUM_IMAGE_CALIB, NUM_TEXT_CALIB, SEED, SYSTEM_PROMPT_EN,
                                   SYSTEM_PROMPT_ZH, TEXT_SEEDS, TEXT_SOURCE_PREFIX, ZH_IMAGE_PROMPTS)
from ..operators import calibration as C
from ..operators import messages as M
from ..operators import prepare as P
from ..operators.sampling import bottomk_sample, ratio_interleave
from ..session import materialize
from ..sources.tables import table
from .message_queries import CAPTIONED_CTE, _captioned, _item_bounds, _lst
from .registry import register
from .sequence_queries import ids_md5
from .sql import cjk, hashed_id, md5key, norm, q, words
from .text_queries import MIX_PATTERN, rr_ctes

MIXED = ZH_IMAGE_PROMPTS + EN_IMAGE_PROMPTS
V = P.DEFAULT_VOCAB
N_SYS_EN = len(SYSTEM_PROMPT_EN.split())
N_SYS_ZH = len(SYSTEM_PROMPT_ZH.split())
IMG_RUN = P.IMAGE_TOKENS + 2


# ---------------------------------------------------------------- interleave

@register("ratio_interleave", f"""
WITH {CAPTIONED_CTE.strip()},
iv AS (SELECT item_id, {md5key(SEED, 'item_id')} AS k FROM cp WHERE has_image),
ib AS (SELECT * FROM iv ORDER BY k, item_id LIMIT {NUM_IMAGE_CALIB}),
ish AS (SELECT item_id, row_number() OVER (ORDER BY k, item_id) - 1 AS i FROM ib),
tb AS (SELECT doc_id, {md5key(SEED, 'doc_id')} AS k FROM documents
       ORDER BY k, doc_id LIMIT {NUM_TEXT_CALIB}),
tx AS (SELECT doc_id AS item_id, row_number() OVER (ORDER BY k, doc_id) - 1 AS j FROM tb),
kk AS (SELECT greatest(1, CAST(round_even((SELECT count(*) FROM ish) /
                                greatest(1, (SELECT count(*) FROM tx)), 0) AS BIGINT)) AS kq),
u AS (SELECT i // kq AS rnd, i % kq AS slot, '{IMAGE_SOURCE}' AS source, item_id FROM ish, kk
      UNION ALL SELECT j AS rnd, kq AS slot, 'text' AS source, item_id FROM tx, kk),
top AS (SELECT * FROM u ORDER BY rnd, slot LIMIT {NUM_CALIB})
SELECT row_number() OVER (ORDER BY rnd, slot) - 1 AS mix_seq, source, item_id FROM top""")
def ratio_interleave_q(spark, sf):
    imgs = M.image_samples(_captioned(spark, sf)).select("item_id", "source")
    imgs = bottomk_sample(imgs, NUM_IMAGE_CALIB, "item_id", seed=SEED)
    docs = table(spark, sf, "documents")
    txt = bottomk_sample(docs.select(F.col("doc_id").alias("item_id"), F.lit("text").alias("source")),
                         NUM_TEXT_CALIB, "item_id", seed=SEED)
    # both sides hold at most their quota: written once, counted and read from there
    imgs, txt = materialize(imgs, "interleave-images"), materialize(txt, "interleave-texts")
    out = ratio_interleave(imgs, txt, NUM_CALIB, image_order="sample_key", text_order="sample_key")
    return out.select(F.col("mix_seq").cast("bigint").alias("mix_seq"), "source", "item_id")


# ---------------------------------------------------------- calibration mix

def mix_ctes() -> str:
    """CTEs ending in ``mix(mix_seq, source, item_id, text, lang)``."""
    return f"""{rr_ctes(NUM_TEXT_CALIB).strip()},
tx AS (SELECT row_number() OVER (ORDER BY mix_key) - 1 AS seq, kept.doc_id AS item_id,
              '{TEXT_SOURCE_PREFIX}' || kept.lang AS source, {norm('raw')} AS text FROM kept),
it AS (SELECT least({NUM_CALIB} - g, {NUM_IMAGE_CALIB + NUM_TEXT_CALIB} - g) AS image_target
       FROM (SELECT count(*) AS g FROM tx)),
{CAPTIONED_CTE.strip()},
v AS (SELECT *, row_number() OVER (ORDER BY item_id) - 1 AS rk FROM cp WHERE has_image),
iv AS (SELECT item_id, {_lst(MIXED)}[rk % {len(MIXED)} + 1] AS prompt, {md5key(SEED, 'item_id')} AS k FROM v),
ib AS (SELECT *, row_number() OVER (ORDER BY k, item_id) - 1 AS r FROM iv),
isel AS (SELECT ib.* FROM ib, it WHERE r < image_target),
ish AS (SELECT *, row_number() OVER (ORDER BY {md5key(SEED + 1, 'item_id')}, item_id) - 1 AS i FROM isel),
kk AS (SELECT greatest(1, CAST(round_even((SELECT count(*) FROM ish) /
                                greatest(1, (SELECT count(*) FROM tx)), 0) AS BIGINT)) AS kq),
u AS (SELECT i // kq AS rnd, i % kq AS slot, '{IMAGE_SOURCE}' AS source, item_id, prompt AS text FROM ish, kk
      UNION ALL SELECT seq AS rnd, kq AS slot, source, item_id, text FROM tx, kk),
top AS (SELECT * FROM u ORDER BY rnd, slot LIMIT {NUM_CALIB}),
mix AS (SELECT row_number() OVER (ORDER BY rnd, slot) - 1 AS mix_seq, source, item_id, text,
               CASE WHEN {cjk('text')} THEN 'zh' ELSE 'en' END AS lang FROM top)"""


def _mix(spark, sf):
    return C.calibration_mix(table(spark, sf, "documents"), _captioned(spark, sf), NUM_CALIB,
                             text_quota=NUM_TEXT_CALIB, image_quota=NUM_IMAGE_CALIB,
                             pattern=MIX_PATTERN, seeds={"en": TEXT_SEEDS["en"]}, seed=SEED,
                             spread_rows=True, image_bounds=_item_bounds(spark, sf))


@register("calibration_mix", f"""
WITH {mix_ctes()}
SELECT mix_seq, source, item_id, text, CAST(2 AS INTEGER) AS n_messages,
       CASE WHEN lang = 'zh' THEN {q(SYSTEM_PROMPT_ZH)} ELSE {q(SYSTEM_PROMPT_EN)} END AS system_text
FROM mix""")
def calibration_mix(spark, sf):
    m = _mix(spark, sf)
    return m.select(F.col("mix_seq").cast("bigint").alias("mix_seq"), "source", "item_id", "text",
                    F.size("messages").alias("n_messages"),
                    F.col("messages")[0]["content"][0]["text"].alias("system_text"))


@register("mix_counts", f"""
WITH {mix_ctes()}
SELECT source, count(*) AS n FROM mix GROUP BY source""")
def mix_counts(spark, sf):
    return P.mix_counts(_mix(spark, sf))


# ------------------------------------------------------------ render / admit

def _rendered_conversations(spark, sf):
    from .message_queries import _conv_messages
    m = _conv_messages(spark, sf)
    r = m.withColumn("enc", P.render_chat("messages", M.generation_flag("messages")))
    return r.select("conv_id", "enc.input_ids", "enc.error")


CONV_TOKENS = f"""
per_turn AS (
  SELECT conv_id, turn, role, list_concat([{P.MSG_START_ID}, {hashed_id('role', V)}],
           list_transform({words('text')}, lambda w: {hashed_id('w', V)}), [{P.MSG_END_ID}]) AS ids
  FROM conversations),
conv AS (
  SELECT conv_id, list_concat(flatten(list(ids ORDER BY turn)),
           CASE WHEN count(*) FILTER (WHERE role = 'assistant') = 0
                THEN [{P.MSG_START_ID}, {hashed_id("'assistant'", V)}] ELSE CAST([] AS INTEGER[]) END) AS ids
  FROM per_turn GROUP BY conv_id),
conv_tok AS (
  SELECT conv_id, CAST(len(ids) AS INTEGER) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5
  FROM conv)"""


@register("render_chat", f"""
WITH {CONV_TOKENS.strip()}
SELECT conv_id, n_tokens, ids_md5, CAST(NULL AS VARCHAR) AS error FROM conv_tok""")
def render_chat(spark, sf):
    r = _rendered_conversations(spark, sf)
    return r.select("conv_id", F.size("input_ids").alias("n_tokens"), ids_md5("input_ids"), "error")


@register("encode_defaults", f"""
WITH {CONV_TOKENS.strip()}
SELECT conv_id, n_tokens, ids_md5, CAST(n_tokens AS BIGINT) AS mask_sum FROM conv_tok""")
def encode_defaults(spark, sf):
    r = _rendered_conversations(spark, sf)
    e = P.encode_defaults(r, keep=["conv_id"])
    s = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))
    return e.select("conv_id", F.size("input_ids").alias("n_tokens"), ids_md5("input_ids"),
                    s.alias("mask_sum"))


def _doc_samples(spark, sf):
    """Documents as text samples with their rendered length; ids are not
    built here (admission needs the length only)."""
    d = table(spark, sf, "documents", spread_small=True)
    msgs = M.text_sample_messages(F.col("text"))
    r = d.select("doc_id", msgs.alias("messages"))
    n = P.render_length("messages", M.generation_flag("messages"))
    err = F.when(F.exists("messages", lambda m: F.exists(m["content"], lambda i: (i["type"] == "text")
                                                          & i["text"].isNull())), F.lit("render_failed"))
    return r.select("doc_id", n.alias("n_tokens"), err.alias("error"))


def _admit(df):
    d = df.withColumn("skip_reason", P.skip_reason("n_tokens", F.col("error")))
    return d.where(F.col("skip_reason").isNull()), d.where(F.col("skip_reason").isNotNull())


DOC_TOKENS = f"""
doc_tok AS (
  SELECT doc_id, CAST(3 + CASE WHEN {cjk('text')} THEN {N_SYS_ZH} ELSE {N_SYS_EN} END
                      + 3 + len({words('text')}) + 2 AS INTEGER) AS n_tokens
  FROM documents),
adm AS (
  SELECT doc_id, n_tokens,
         CASE WHEN n_tokens <= {MIN_TOKENS} THEN 'short' WHEN n_tokens > {MAX_TOKENS} THEN 'long' END
           AS skip_reason
  FROM doc_tok)"""


@register("length_admission", f"WITH {DOC_TOKENS.strip()} SELECT doc_id, n_tokens, skip_reason FROM adm")
def length_admission(spark, sf):
    d = _doc_samples(spark, sf)              # every row once, with its reason (null = admitted)
    return d.select("doc_id", "n_tokens", P.skip_reason("n_tokens", F.col("error")).alias("skip_reason"))


@register("skip_counts", f"""
WITH {DOC_TOKENS.strip()}
SELECT skip_reason, count(*) AS n FROM adm WHERE skip_reason IS NOT NULL GROUP BY skip_reason""")
def skip_counts(spark, sf):
    _, rej = _admit(_doc_samples(spark, sf))
    return P.skip_counts(rej)


@register("sort_by_length", f"""
WITH {DOC_TOKENS.strip()}
SELECT doc_id, n_tokens, row_number() OVER (ORDER BY n_tokens DESC, doc_id) - 1 AS sort_rank
FROM adm WHERE skip_reason IS NULL""")
def sort_by_length(spark, sf):
    ok, _ = _admit(_doc_samples(spark, sf))
    admitted = materialize(ok.select("doc_id", "n_tokens"), "admitted")   # rendered once
    return P.sort_by_length(admitted, "desc", seq="doc_id").select("doc_id", "n_tokens", "sort_rank")


# ------------------------------------------------------------- prepare

def _prepared(spark, sf):
    mix = _mix(spark, sf)
    r = mix.withColumn("enc", P.render_chat("messages", M.generation_flag("messages")))
    r = r.select("mix_seq", "source", "enc.input_ids", "enc.error")
    ok, _ = P.length_admission(r)
    e = P.encode_defaults(ok, keep=["mix_seq", "source", "n_tokens"])
    e = e.withColumn("has_image", F.col("source") == IMAGE_SOURCE)
    return P.sort_by_length(e, "desc", seq="mix_seq", max_rows=NUM_CALIB)   # the mix is capped at n


def _n_en(p: str) -> int:
    return len(p.split())


PREP_CTE = f"""
tok AS (
  SELECT mix_seq, source,
         CAST(3 + CASE WHEN lang = 'zh' THEN {N_SYS_ZH} ELSE {N_SYS_EN} END + 3 + len({words('text')}) + 2
              + CASE WHEN source = '{IMAGE_SOURCE}' THEN {IMG_RUN} ELSE 0 END AS INTEGER) AS n_tokens
  FROM mix),
prep AS (
  SELECT *, row_number() OVER (ORDER BY n_tokens DESC, mix_seq) - 1 AS sort_rank FROM tok
  WHERE n_tokens > {MIN_TOKENS} AND n_tokens <= {MAX_TOKENS})"""


@register("prepare_batches", f"""
WITH {mix_ctes()},
{PREP_CTE.strip()}
SELECT mix_seq, source, n_tokens, sort_rank FROM prep""")
def prepare_batches(spark, sf):
    p = _prepared(spark, sf)
    return p.select(F.col("mix_seq").cast("bigint").alias("mix_seq"), "source", "n_tokens", "sort_rank")


@register("token_totals", f"""
WITH {mix_ctes()},
{PREP_CTE.strip()}
SELECT CAST(sum(n_tokens) AS BIGINT) AS total_tokens, count(*) AS batches,
       count(*) FILTER (WHERE source = '{IMAGE_SOURCE}') AS image_batches FROM prep""")
def token_totals(spark, sf):
    return P.token_totals(_prepared(spark, sf))


@register("dry_run", f"""
WITH {mix_ctes()},
{PREP_CTE.strip()}
SELECT sort_rank, n_tokens AS input_ids_len, n_tokens AS attention_mask_len FROM prep WHERE sort_rank < 8""")
def dry_run(spark, sf):
    return P.dry_run(_prepared(spark, sf))
