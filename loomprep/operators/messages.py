"""Chat-message assembly and message-level predicates.

A message list is ``array<struct<role, content array<struct<type, text,
image_ref>>>>``.  Everything here is a higher-order-function expression on
that array (no Python), or a partial aggregation over the long form
``(conv_id, turn, role, text)`` that never assembles the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import (EN_IMAGE_PROMPTS, IMAGE_SOURCE, SEED, SYSTEM_PROMPT_EN,
                                   SYSTEM_PROMPT_ZH, ZH_IMAGE_PROMPTS)
from ..functions.hashing import seeded_key
from ..functions.text import collapse_whitespace, language_tag, same_language, strip_whitespace

ITEM = T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
                     T.StructField("image_ref", T.StringType())])
MESSAGE = T.StructType([T.StructField("role", T.StringType()),
                        T.StructField("content", T.ArrayType(ITEM))])
MESSAGES = T.ArrayType(MESSAGE)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_item(text) -> Column:
    """A content item of type ``text``."""
    return F.struct(F.lit("text").alias("type"), _c(text).cast("string").alias("text"),
                    F.lit(None).cast("string").alias("image_ref"))


def media_item(kind: str, ref) -> Column:
    """A content item of type ``image`` or ``video`` referring to media by id."""
    return F.struct(F.lit(kind).alias("type"), F.lit(None).cast("string").alias("text"),
                    _c(ref).cast("string").alias("image_ref"))


def message(role, *items: Column) -> Column:
    """A message struct ``{role, content}`` from content items."""
    r = F.lit(role) if isinstance(role, str) and role in ("user", "assistant", "system") else _c(role)
    return F.struct(r.alias("role"), F.array(*items).alias("content"))


def text_message(role, text) -> Column:
    """A message whose content is one text item (string content lifted)."""
    return message(role, text_item(text))


# ---- S8: loading message lists -------------------------------------------

def conversation_messages(conversations: DataFrame, key: str = "conv_id", order: str = "turn",
                          role: str = "role", text: str = "text") -> DataFrame:
    """Long-form turns -> one message list per conversation, in turn order.

    This collects every turn of a conversation into one row; on inputs whose
    conversations are not known to be bounded use
    :func:`assemble_conversations`, which admits by size first."""
    return (conversations.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("r"),
                                                      F.col(text).alias("t")))).alias("_turns"))
            .select(key, F.transform("_turns", lambda x: text_message(x["r"], x["t"])).alias("messages")))


def canonical_messages(df: DataFrame, col: str = "messages") -> Column:
    """The message-list column in canonical form, whatever its input shape
    (read from the schema): a plain string becomes one user message; a single
    message struct becomes a one-element list; a message whose ``content`` is
    a string gets one text item; item structs get any missing field as null."""
    from pyspark.sql import types as T
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, T.StringType):
        return lift_messages(c, "text")
    if isinstance(dt, T.StructType):
        c, dt = F.array(c), T.ArrayType(dt)
    msg_t = dt.elementType
    content_t = msg_t["content"].dataType

    def fix(m):
        if isinstance(content_t, T.StringType):
            items = F.array(text_item(m["content"]))
        else:
            names = set(content_t.elementType.fieldNames())
            items = F.transform(m["content"], lambda i: F.struct(
                *[(i[f] if f in names else F.lit(None)).cast("string").alias(f)
                  for f in ("type", "text", "image_ref")]))
        return F.struct(m["role"].cast("string").alias("role"), items.alias("content"))
    return F.transform(c, fix)


def conversation_sizes(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rendered size of each conversation computed on the long form with a
    partial aggregation (skew-safe): per turn ``3 + words`` (the stand-in
    renderer's count) plus the generation prompt when no assistant turn."""
    from ..functions.text import whitespace_tokens
    return (conversations.groupBy(key)
            .agg(F.sum(3 + F.size(whitespace_tokens("text"))).alias("_n"),
                 F.count_if(F.col("role") == "assistant").alias("_a"))
            .select(key, (F.col("_n") + F.when(F.col("_a") == 0, 2).otherwise(0)).cast("int").alias("n_tokens")))


def assemble_conversations(conversations: DataFrame, max_tokens: int, key: str = "conv_id",
                           order: str = "turn") -> tuple[DataFrame, DataFrame]:
    """Message lists only for conversations that fit ``max_tokens``; the
    others come back as ``long`` rejects without ever being collected into
    one row.  This bounds every collected group by the admission limit."""
    sizes = conversation_sizes(conversations, key)
    ok = sizes.where(F.col("n_tokens") <= int(max_tokens)).select(key)
    rejected = sizes.where(F.col("n_tokens") > int(max_tokens)).withColumn("skip_reason", F.lit("long"))
    msgs = conversation_messages(conversations.join(ok, key, "left_semi"), key, order)
    return msgs, rejected


def lift_messages(col, kind: str) -> Column:
    """Canonical message list from the accepted input shapes: ``messages``
    (already a list), ``message`` (one message struct) or ``text`` (plain
    string -> one user message)."""
    c = _c(col)
    if kind == "messages":
        return c
    if kind == "message":
        return F.array(c)
    return F.array(text_message("user", F.coalesce(c.cast("string"), F.lit(""))))


# ---- P2, P3, P4 ----------------------------------------------------------

def _first_text(content: Column) -> Column:
    return F.get(F.filter(content, lambda i: i["type"] == "text"), 0)["text"]


def message_language(messages) -> Column:
    """'zh' or 'en' from the first user message that has a text item; 'en'
    when there is none."""
    users = F.filter(_c(messages), lambda m: (m["role"] == "user")
                     & F.exists(m["content"], lambda i: i["type"] == "text"))
    first = F.get(users, 0)
    return F.when(F.size(users) > 0,
                  language_tag(F.coalesce(_first_text(first["content"]), F.lit("")))).otherwise(F.lit("en"))


def system_message(lang, override: str | None = None) -> Column:
    """The system message: the override text if given, else the text for ``lang``."""
    if override:
        txt = F.lit(override)
    else:
        txt = F.when(_c(lang) == "zh", F.lit(SYSTEM_PROMPT_ZH)).otherwise(F.lit(SYSTEM_PROMPT_EN))
    return text_message("system", txt)


def with_system_message(messages, enabled: bool = True, override: str | None = None) -> Column:
    """Prefix a system message unless disabled or the first message already
    is one; its text follows the language of the messages."""
    m = _c(messages)
    if not enabled:
        return m
    first_role = F.get(m, 0)["role"]
    return F.when(F.coalesce(first_role == "system", F.lit(False)), m) \
        .otherwise(F.concat(F.array(system_message(message_language(m), override)), m))


def has_assistant(messages) -> Column:
    """True when any message of the list has the assistant role."""
    return F.exists(_c(messages), lambda m: m["role"] == "assistant")


def generation_flag(messages, add_generation_prompt: bool = True) -> Column:
    """Ask for a generation prompt only when enabled and no assistant turn."""
    if not add_generation_prompt:
        return F.lit(False)
    return ~has_assistant(messages)


# ---- P7-P10: image samples -------------------------------------------------

PROMPT_MODES = ("source", "original", "mixed", "en", "zh")


def prompt_list(mode: str) -> tuple[str, ...]:
    """The caption prompts of a prompt mode (``mixed``: Chinese then English)."""
    mode = mode.lower()
    if mode == "mixed":
        return ZH_IMAGE_PROMPTS + EN_IMAGE_PROMPTS
    if mode == "en":
        return EN_IMAGE_PROMPTS
    return ZH_IMAGE_PROMPTS


def caption_prompt(question, rank, mode: str = "mixed") -> Column:
    """The question itself in ``source``/``original`` mode when it is not
    empty after whitespace cleaning; otherwise the ``rank mod size``-th prompt
    of the mode's list."""
    prompts = prompt_list(mode)
    pick = F.element_at(F.array(*[F.lit(p) for p in prompts]),
                        (F.pmod(_c(rank), F.lit(len(prompts))) + 1).cast("int"))
    if mode.lower() in ("source", "original"):
        q = F.coalesce(collapse_whitespace(_c(question)), F.lit(""))
        return F.when(q != "", q).otherwise(pick)
    return pick


def clean_captions(answer) -> Column:
    """Stripped (Unicode whitespace), non-empty captions; a null answer or
    null items count as empty."""
    return F.filter(F.transform(F.coalesce(_c(answer), F.array().cast("array<string>")),
                                lambda x: F.coalesce(strip_whitespace(x), F.lit(""))),
                    lambda x: x != "")


def pick_caption(answer, *key_cols, seed=SEED) -> Column:
    """Uniform pick among the cleaned captions by a hash of (seed, key);
    ``''`` when there is none."""
    caps = clean_captions(answer)
    h = F.conv(F.substring(seeded_key(seed, *key_cols), 1, 8), 16, 10).cast("bigint")
    idx = (F.pmod(h, F.greatest(F.size(caps), F.lit(1))) + 1).cast("int")
    return F.when(F.size(caps) > 0, F.element_at(caps, idx)).otherwise(F.lit(""))


def image_messages(prompt, caption, image_ref, use_assistant: bool = False,
                   require_lang_match: bool = True, system: bool = True,
                   system_override: str | None = None) -> Column:
    """User turn ``[image, prompt]``; an assistant caption turn when enabled
    and (no match required, or prompt and caption are in the same language)."""
    user = message("user", media_item("image", image_ref), text_item(prompt))
    msgs = F.array(user)
    if use_assistant:
        ok = F.lit(True) if not require_lang_match else same_language(prompt, caption)
        msgs = F.when(ok, F.array(user, text_message("assistant", caption))).otherwise(msgs)
    return with_system_message(msgs, system, system_override)


def valid_image_sample(has_payload, caption, use_assistant: bool = False) -> Column:
    """A usable image, and a caption only when assistant turns are on."""
    ok = _c(has_payload)
    if use_assistant:
        ok = ok & (_c(caption) != "")
    return ok


def text_sample_messages(text, system: bool = True, system_override: str | None = None) -> Column:
    """``[system?, user(text)]``; the first message is a user one, so the
    system message is always added when enabled."""
    user = F.array(text_message("user", text))
    if not system:
        return user
    lang = language_tag(F.coalesce(_c(text).cast("string"), F.lit("")))
    return F.concat(F.array(system_message(lang, system_override)), user)


def image_source() -> Column:
    """The source label of image samples."""
    return F.lit(IMAGE_SOURCE)


# ---- long-form (no array) versions for unbounded groups ---------------------

def first_user_language(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """P2 on long-form turns: partial aggregation, skew-safe."""
    first = F.min(F.when(F.col("role") == "user", F.struct(F.col("turn"), F.col("text"))))
    return (conversations.groupBy(key).agg(first.alias("_f"))
            .select(key, F.when(F.col("_f").isNull(), F.lit("en"))
                    .otherwise(language_tag(F.coalesce(F.col("_f.text"), F.lit("")))).alias("lang")))


def generation_flags(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """P12 on long-form turns: partial aggregation, skew-safe."""
    return conversations.groupBy(key).agg(
        (F.count_if(F.col("role") == "assistant") == 0).alias("add_generation_prompt"))


def system_message_heads(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """P4 on long-form turns: the number of messages and the first text with the
    system message, and whether it was added.  Partial aggregation, so the
    turns of a long conversation are never gathered."""
    user = F.min(F.when(F.col("role") == "user", F.struct("turn", "text")))
    heads = conversations.groupBy(key).agg(
        F.count("*").alias("_n"), F.min(F.struct("turn", "role", "text")).alias("_head"),
        user.alias("_user"))
    lang = F.when(F.col("_user").isNull(), F.lit("en")).otherwise(
        language_tag(F.coalesce(F.col("_user.text"), F.lit(""))))
    added = F.coalesce(F.col("_head.role") != "system", F.lit(True))
    text = system_message(lang)["content"][0]["text"]
    return heads.select(key, (F.col("_n") + added.cast("int")).cast("int").alias("n_messages"),
                        F.when(added, text).otherwise(F.col("_head.text")).alias("first_text"),
                        added.alias("added"))



def ranked_valid_images(captioned: DataFrame, *, use_assistant: bool = False, seed=SEED,
                        bounds: DataFrame | None = None) -> DataFrame:
    """Narrow rows ``(item_id, question, caption, valid_rank)`` of the valid
    captioned images; the rank is among valid rows in input order (``bounds``: a
    cheaper frame of the same ``item_id``, for the rank's buckets)."""
    from ..sources.captioned import has_payload
    from .ranking import valid_rank
    d = captioned.withColumn("caption", pick_caption("answer", "item_id", seed=seed))
    if "has_image" not in d.columns:
        d = d.withColumn("has_image", has_payload("image"))
    d = d.select("item_id", "question", "caption", "has_image")
    return valid_rank(d, valid_image_sample("has_image", "caption", use_assistant), "item_id",
                      out="valid_rank", bounds=bounds).drop("has_image")


def valid_image_keys(captioned: DataFrame, *, use_assistant: bool = False, seed=SEED,
                     bounds: DataFrame | None = None) -> DataFrame:
    """Keys only, ``(item_id, item_digest, valid_rank)``: validity is evaluated on the
    scan side and no text travels through the rank shuffle.  Rows that share an
    item_id are ranked by the digest of their texts."""
    from ..sources.captioned import has_payload
    from .ranking import valid_rank
    has = F.col("has_image") if "has_image" in captioned.columns else has_payload("image")
    ok = valid_image_sample(has, pick_caption("answer", "item_id", seed=seed), use_assistant)
    d = captioned.select("item_id", caption_digest().alias("item_digest"), ok.alias("_ok"))
    return valid_rank(d, "_ok", "item_id", out="valid_rank", bounds=bounds,
                      ties=["item_digest"]).drop("_ok")


def caption_digest() -> Column:
    """md5 of a captioned row's question and answer (nulls count)."""
    return F.md5(F.to_json(F.struct("question", "answer")))


def with_image_messages(ranked: DataFrame, *, mode: str = "mixed", use_assistant: bool = False,
                        require_lang_match: bool = True, system: bool = True,
                        system_override: str | None = None) -> DataFrame:
    """Prompt, message list and source for ranked image rows (run it after
    sampling, so only kept rows build arrays)."""
    v = ranked.withColumn("prompt", caption_prompt("question", "valid_rank", mode))
    ref = F.concat(F.lit("item:"), F.col("item_id").cast("string"))
    return v.withColumns({"messages": image_messages("prompt", "caption", ref, use_assistant,
                                                     require_lang_match, system, system_override),
                          "source": image_source()})


def image_samples(captioned: DataFrame, *, mode: str = "mixed", use_assistant: bool = False,
                  require_lang_match: bool = True, seed=SEED, system: bool = True,
                  system_override: str | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """Captioned rows -> valid image samples with their rank among valid rows
    (input order = ``item_id``), prompt, caption and message list."""
    r = ranked_valid_images(captioned, use_assistant=use_assistant, seed=seed, bounds=bounds)
    return with_image_messages(r, mode=mode, use_assistant=use_assistant,
                               require_lang_match=require_lang_match, system=system,
                               system_override=system_override)
