"""Registered queries: message assembly, languages, captioned-image samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import (EN_IMAGE_PROMPTS, SEED, SYSTEM_PROMPT_EN,
                                   SYSTEM_PROMPT_ZH, ZH_IMAGE_PROMPTS)
from ..operators import messages as M
from ..sources.captioned import (ITEM_STRIDE, PAGE_STRIDE, captioned_images, item_key,
                                 scan_optional_columns)
from ..sources.tables import table
from .registry import register
from .sql import cjk, collapse, q, strip, words


def _flat(msgs_col: str = "messages"):
    m = F.col(msgs_col)
    return [F.size(m).alias("n_messages"),
            F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
            F.get(m, 0)["content"][0]["text"].alias("first_text")]


def _lst(items) -> str:
    return "[" + ", ".join(q(p) for p in items) + "]"


SYS_BY_LANG = f"CASE WHEN lang = 'zh' THEN {q(SYSTEM_PROMPT_ZH)} ELSE {q(SYSTEM_PROMPT_EN)} END"

# first user turn's language on long-form conversations
LANG_CTE = f"""
fu AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS utext,
              count(*) FILTER (WHERE role = 'user') AS n_user
       FROM conversations GROUP BY conv_id),
lg AS (SELECT conv_id, CASE WHEN n_user = 0 THEN 'en' WHEN {cjk("coalesce(utext, '')")} THEN 'zh' ELSE 'en' END AS lang
       FROM fu)"""

CAPTIONED_CTE = f"""
a AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
p AS (SELECT conv_id, turn + 1 AS turn, role AS prev_role, text AS prev_text FROM conversations),
ci AS (
  SELECT CAST(a.conv_id * {ITEM_STRIDE} + a.turn AS BIGINT) AS item_id,
         CASE WHEN p.prev_role = 'user' THEN p.prev_text END AS question,
         string_split(a.text, chr(10)) AS answer, pg.html AS html
  FROM a LEFT JOIN p ON p.conv_id = a.conv_id AND p.turn = a.turn
         LEFT JOIN pages pg ON pg.page_id = a.conv_id * {PAGE_STRIDE} + a.turn),
cc AS (
  SELECT *, list_filter(list_transform(answer, lambda x: coalesce({strip('x')}, '')), lambda x: x <> '') AS caps,
         coalesce(length(html) > 0, false) AS has_image
  FROM ci),
cp AS (
  SELECT *, CASE WHEN len(caps) > 0 THEN caps[CAST((CAST(('0x' || substring(md5(concat_ws(':', '{SEED}',
              CAST(item_id AS VARCHAR))), 1, 8)) AS BIGINT) % greatest(len(caps), 1)) + 1 AS INTEGER)]
            ELSE '' END AS caption
  FROM cc)"""


def _conv_messages(spark, sf):
    """Message lists of all conversations (the list is the operator's output)."""
    return M.conversation_messages(table(spark, sf, "conversations"))


def _item_bounds(spark, sf):
    """The item_id of every captioned row, straight from the scan (for rank buckets)."""
    turns = table(spark, sf, "conversations").where(F.col("role") == "assistant")
    return turns.select(item_key().alias("item_id"))


def _captioned(spark, sf):
    return captioned_images(table(spark, sf, "conversations"), table(spark, sf, "pages"))


@register("scan_optional_columns", "SELECT conv_id, turn, role, text FROM conversations")
def scan_optional(spark, sf):
    return scan_optional_columns(table(spark, sf, "conversations"),
                                 ("conv_id", "turn", "role", "text", "question", "answer", "image"))


@register("conversation_messages", f"""

SELECT conv_id, CAST(count(*) AS INTEGER) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       arg_min(text, turn) AS first_text, md5(string_agg(coalesce(text, ''), chr(31) ORDER BY turn)) AS texts_md5
FROM conversations GROUP BY conv_id""")
def conversation_messages(spark, sf):
    texts = F.transform("messages", lambda m: F.coalesce(m["content"][0]["text"], F.lit("")))
    return _conv_messages(spark, sf).select(
        "conv_id", *_flat(), F.md5(F.array_join(texts, "\x1f")).alias("texts_md5"))


@register("message_language", f"""
WITH {LANG_CTE.strip()}
SELECT conv_id, lang FROM lg""")
def message_language(spark, sf):
    return M.first_user_language(table(spark, sf, "conversations"))


@register("same_language", f"""
SELECT c.conv_id, c.turn, {cjk('p.text')} = {cjk('c.text')} AS same_lang
FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1""")
def same_language(spark, sf):
    c = table(spark, sf, "conversations")
    # only a flag of each text is shuffled
    flags = c.select("conv_id", "turn", T.contains_cjk("text").alias("cjk"))
    p = flags.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("cjk").alias("prev_cjk"))
    return (flags.join(p, ["conv_id", "turn"])
            .select("conv_id", "turn", (F.col("cjk") == F.col("prev_cjk")).alias("same_lang")))


@register("language_match_rate", f"""
WITH pairs AS (
  SELECT CASE WHEN {cjk('u.text')} THEN 'zh' ELSE 'en' END AS lang,
         {cjk('u.text')} = {cjk('a.text')} AS ok
  FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
  WHERE a.role = 'assistant' AND u.role = 'user')
SELECT lang, count(*) AS pairs, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS matched,
       round(CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS match_rate
FROM pairs GROUP BY lang""")
def language_match_rate(spark, sf):
    c = table(spark, sf, "conversations")
    flag = T.contains_cjk("text")
    a = c.where(F.col("role") == "assistant").select("conv_id", "turn", flag.alias("a_cjk"))
    u = c.where(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("turn"),
                                                flag.alias("u_cjk"))
    pairs = a.join(u, ["conv_id", "turn"]).select(
        F.when(F.col("u_cjk"), F.lit("zh")).otherwise(F.lit("en")).alias("lang"),
        (F.col("u_cjk") == F.col("a_cjk")).alias("ok"))
    return (pairs.groupBy("lang")
            .agg(F.count(F.lit(1)).alias("pairs"), F.sum(F.col("ok").cast("bigint")).alias("matched"))
            .withColumn("match_rate", F.round(F.col("matched") / F.col("pairs"), 6)))


@register("with_system_message", f"""
WITH {LANG_CTE.strip()},
fr AS (SELECT conv_id, arg_min(role, turn) AS first_role, arg_min(text, turn) AS first_text0,
              count(*) AS n FROM conversations GROUP BY conv_id)
SELECT fr.conv_id,
       CAST(CASE WHEN first_role = 'system' THEN n ELSE n + 1 END AS INTEGER) AS n_messages,
       CASE WHEN first_role = 'system' THEN first_text0 ELSE {SYS_BY_LANG} END AS first_text,
       first_role <> 'system' AS added
FROM fr JOIN lg ON lg.conv_id = fr.conv_id""")
def with_system_message(spark, sf):
    return M.system_message_heads(table(spark, sf, "conversations"))


@register("generation_flag", f"""

SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') = 0 AS add_generation_prompt
FROM conversations GROUP BY conv_id""")
def generation_flag(spark, sf):
    return M.generation_flags(table(spark, sf, "conversations"))


@register("caption_pick", f"WITH {CAPTIONED_CTE.strip()} SELECT item_id, CAST(len(caps) AS INTEGER) AS n_captions, caption FROM cp")
def caption_pick(spark, sf):
    c = _captioned(spark, sf)
    return c.select("item_id", F.size(M.clean_captions("answer")).alias("n_captions"),
                    M.pick_caption("answer", "item_id", seed=SEED).alias("caption"))


@register("valid_samples", f"""
WITH {CAPTIONED_CTE.strip()}
SELECT item_id, has_image, caption, has_image AND caption <> '' AS valid FROM cp""")
def valid_samples(spark, sf):
    c = _captioned(spark, sf)
    d = c.select("item_id", M.pick_caption("answer", "item_id", seed=SEED).alias("caption"), "has_image")
    return d.select("item_id", "has_image", "caption",
                    M.valid_image_sample("has_image", "caption", use_assistant=True).alias("valid"))


@register("valid_rank", f"""
WITH {CAPTIONED_CTE.strip()}
SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS valid_rank FROM cp
WHERE has_image AND caption <> ''""")
def valid_rank(spark, sf):
    s = M.image_samples(_captioned(spark, sf), bounds=_item_bounds(spark, sf), use_assistant=True)
    return s.select("item_id", "valid_rank")


@register("prompt_assign", f"""
WITH {CAPTIONED_CTE.strip()},
v AS (SELECT *, row_number() OVER (ORDER BY item_id) - 1 AS rk FROM cp WHERE has_image)
SELECT item_id, CASE WHEN coalesce({collapse('question')}, '') <> '' THEN {collapse('question')}
                     ELSE {_lst(ZH_IMAGE_PROMPTS)}[rk % {len(ZH_IMAGE_PROMPTS)} + 1] END AS prompt
FROM v""")
def prompt_assign(spark, sf):
    s = M.image_samples(_captioned(spark, sf), bounds=_item_bounds(spark, sf), mode="source", use_assistant=False)
    return s.select("item_id", "prompt")


MIXED = ZH_IMAGE_PROMPTS + EN_IMAGE_PROMPTS


@register("build_messages", f"""
WITH {CAPTIONED_CTE.strip()},
v AS (SELECT *, row_number() OVER (ORDER BY item_id) - 1 AS rk FROM cp WHERE has_image AND caption <> ''),
pr AS (SELECT *, {_lst(MIXED)}[rk % {len(MIXED)} + 1] AS prompt FROM v),
m AS (SELECT *, {cjk('prompt')} = {cjk('caption')} AS with_assistant,
             CASE WHEN {cjk('prompt')} THEN 'zh' ELSE 'en' END AS lang FROM pr)
SELECT item_id, CAST(CASE WHEN with_assistant THEN 3 ELSE 2 END AS INTEGER) AS n_messages,
       CASE WHEN with_assistant THEN 'system,user,assistant' ELSE 'system,user' END AS roles,
       {SYS_BY_LANG} AS first_text, prompt,
       CASE WHEN with_assistant THEN caption END AS assistant_text
FROM m""")
def build_messages(spark, sf):
    s = M.image_samples(_captioned(spark, sf), bounds=_item_bounds(spark, sf), mode="mixed", use_assistant=True,
                        require_lang_match=True)
    asst = F.get(F.filter("messages", lambda x: x["role"] == "assistant"), 0)
    return s.select("item_id", *_flat(), "prompt", asst["content"][0]["text"].alias("assistant_text"))
