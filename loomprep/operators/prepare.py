"""Turning a sample mix into model batches (F3 stand-in, P13, P14, T2, A1-A3,
F4, F6, S11).

Rendering + tokenising is the caller's model-specific step (an Arrow
``pandas_udf`` returning ``struct<input_ids array<int>, error string>``).
The built-in stand-in below is a role-tagged rendering with whitespace words
hashed into a vocabulary: pure SQL expressions, so it runs in codegen and has
a relational oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (IMAGE_PAD_ID, MAX_TOKENS, MIN_TOKENS, MODEL_INPUT_KEYS,
                                   VIDEO_PAD_ID, VISION_END_ID, VISION_START_ID)
from ..functions.hashing import hashed_id
from ..functions.text import whitespace_tokens
from .ranking import bucketed_rank

# ids of the stand-in renderer's message delimiters (outside the hashed range)
MSG_START_ID = 151644
MSG_END_ID = 151645
DEFAULT_VOCAB = 151643
IMAGE_TOKENS = 144           # a 384x384 image, patch 16, merge 2


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _word_ids(text: Column, vocab: int) -> Column:
    return F.transform(whitespace_tokens(text), lambda w: hashed_id(w, vocab))


def render_chat(messages, add_generation, vocab: int = DEFAULT_VOCAB,
                image_tokens: int = IMAGE_TOKENS) -> Column:
    """Stand-in chat template + tokenizer -> ``struct<input_ids, error>``.

    Each message renders as ``[start, role] + content + [end]``; a text item
    as its hashed words, an image item as ``[vision_start] + image_pad *
    image_tokens + [vision_end]`` (video alike with the video pad); a
    generation prompt appends ``[start, 'assistant']``.  A null text item or
    an empty message list is an ``error`` (the row is kept, ids null)."""
    m = _c(messages)

    def item_ids(i):
        media = lambda pad: F.concat(F.array(F.lit(VISION_START_ID)),
                                     F.array_repeat(F.lit(pad), image_tokens),
                                     F.array(F.lit(VISION_END_ID)))
        return (F.when(i["type"] == "text", _word_ids(i["text"], vocab))
                .when(i["type"] == "image", media(IMAGE_PAD_ID))
                .when(i["type"] == "video", media(VIDEO_PAD_ID))
                .otherwise(F.array().cast("array<int>")))

    def msg_ids(x):
        return F.concat(F.array(F.lit(MSG_START_ID), hashed_id(x["role"], vocab)),
                        F.flatten(F.transform(x["content"], item_ids)),
                        F.array(F.lit(MSG_END_ID)))

    gen = F.when(_c(add_generation), F.array(F.lit(MSG_START_ID), hashed_id(F.lit("assistant"), vocab))) \
        .otherwise(F.array().cast("array<int>"))
    ids = F.concat(F.flatten(F.transform(m, msg_ids)), gen)
    bad = F.coalesce(F.size(m) == 0, F.lit(True)) | F.exists(
        m, lambda x: F.exists(x["content"], lambda i: (i["type"] == "text") & i["text"].isNull()))
    err = F.when(bad, F.lit("render_failed"))
    return F.struct(F.when(~bad, ids).alias("input_ids"), err.alias("error"))


def render_length(messages, add_generation, image_tokens: int = IMAGE_TOKENS) -> Column:
    """Length of :func:`render_chat`'s ids without building or hashing them:
    per message 3 + content (words of text items; ``image_tokens + 2`` per
    media item), plus 2 for a generation prompt.  Admission needs only this,
    so rejected (long) samples are never tokenised."""
    def item_len(i):
        return (F.when(i["type"] == "text", F.size(whitespace_tokens(i["text"])))
                .when(i["type"].isin("image", "video"), F.lit(image_tokens + 2)).otherwise(F.lit(0)))
    per_msg = F.transform(_c(messages), lambda x: 3 + F.aggregate(F.transform(x["content"], item_len),
                                                                  F.lit(0), lambda a, b: a + b))
    total = F.aggregate(per_msg, F.lit(0), lambda a, b: a + b)
    return (total + F.when(_c(add_generation), F.lit(2)).otherwise(F.lit(0))).cast("int")


def skip_reason(n_tokens, error, min_tokens: int = MIN_TOKENS, max_tokens: int = MAX_TOKENS,
                prefill_len: int | None = None, context_len: int | None = None) -> Column:
    """Admission with a reason, checked in order: ``error``; ``short`` when
    ``len <= min_tokens``; ``long`` when ``len > max_tokens`` (0 = no cap);
    optional capacity checks ``over_prefill`` / ``over_context``.  Null =
    admitted."""
    n = _c(n_tokens)
    r = F.when(_c(error).isNotNull() | n.isNull(), F.lit("error")) \
        .when(n <= int(min_tokens), F.lit("short"))
    if max_tokens and max_tokens > 0:
        r = r.when(n > int(max_tokens), F.lit("long"))
    if prefill_len:
        r = r.when(n > int(prefill_len), F.lit("over_prefill"))
    if context_len:
        r = r.when(n > int(context_len), F.lit("over_context"))
    return r


def length_admission(df: DataFrame, ids_col: str = "input_ids", error_col: str = "error",
                     **limits) -> tuple[DataFrame, DataFrame]:
    """Split into (admitted, rejected-with-reason); both keep every column."""
    d = df.withColumn("n_tokens", F.size(ids_col)).withColumn(
        "n_tokens", F.when(F.col(ids_col).isNotNull(), F.col("n_tokens")))
    d = d.withColumn("skip_reason", skip_reason("n_tokens", F.col(error_col), **limits))
    return d.where(F.col("skip_reason").isNull()), d.where(F.col("skip_reason").isNotNull())


def encode_defaults(df: DataFrame, keep: Sequence[str] = (), keys: Sequence[str] = MODEL_INPUT_KEYS) -> DataFrame:
    """Keep only model-input keys that exist (plus ``keep`` columns) and give
    a missing or null attention mask the all-ones default."""
    cols = [c for c in keys if c in df.columns]
    if "input_ids" not in cols:
        raise ValueError("input_ids is required")
    ones = F.array_repeat(F.lit(1).cast("tinyint"), F.size("input_ids"))
    mask = F.coalesce(F.col("attention_mask").cast("array<tinyint>"), ones) \
        if "attention_mask" in cols else ones
    out = [F.col(c) for c in keep] + [F.col(c) for c in cols if c != "attention_mask"]
    return df.select(*out, mask.alias("attention_mask"))


def sort_by_length(df: DataFrame, order: str = "desc", length: str = "n_tokens", seq: str = "seq",
                   out: str = "sort_rank", seed: int = 42, seq_side: int = 16,
                   max_rows: int | None = None) -> DataFrame:
    """Stable order by length (``asc``/``desc``), seeded ``shuffle`` or as is.
    Adds a 0-based ``out``; computed with bucketed ranks on ``(length, seq
    range)`` buckets, so one popular length does not land in one task; the
    bucket table has at most distinct lengths x ``seq_side ** 2`` rows and
    is joined without a forced broadcast.

    ``max_rows``: the input has at most this many rows (a quota-capped mix);
    then one window ranks them directly, and a row beyond it is an error."""
    from pyspark.sql import Window
    from .ranking import range_bucket
    if max_rows is not None and order in ("asc", "desc"):
        key = F.col(length).asc() if order == "asc" else F.col(length).desc()
        rank = F.row_number().over(Window.orderBy(key, F.col(seq))).cast("bigint")
        too_many = F.raise_error(F.lit(f"more than {int(max_rows)} rows to sort")).cast("bigint")
        return df.withColumn(out, F.when(rank <= int(max_rows), rank - 1).otherwise(too_many))
    if order == "shuffle":
        from .sampling import seeded_shuffle
        return seeded_shuffle(df, seq, seed=seed, out=out)
    if order not in ("asc", "desc"):
        return bucketed_rank(df, [seq], range_bucket(df, seq), out=out)
    ln = F.col(length) if order == "asc" else -F.col(length)
    d = df.withColumn("_ord_len", ln)
    bucket = F.struct(F.col("_ord_len").alias("l"), range_bucket(d, seq, seq_side).alias("s"))
    # the offset table has one row per non-empty (length, seq range): no
    # fixed bound, so the join is left to Spark's size check (AQE)
    return bucketed_rank(d, ["_ord_len", seq], bucket, out=out,
                         broadcast_offsets=False).drop("_ord_len")


def token_totals(prepared: DataFrame, mask_col: str = "attention_mask",
                 image_flag: str = "has_image", require: bool = True) -> DataFrame:
    """Totals: non-padded tokens, batches, batches with images (one row).  An
    empty set is an error (``no usable batches``) unless ``require`` is off."""
    ones = F.aggregate(F.col(mask_col), F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))
    batches = F.count(F.lit(1))
    if require:
        batches = F.when(batches > 0, batches).otherwise(
            F.raise_error(F.lit("no usable batches")).cast("bigint"))
    return prepared.agg(F.coalesce(F.sum(ones), F.lit(0)).cast("bigint").alias("total_tokens"),
                        batches.alias("batches"),
                        F.count_if(F.col(image_flag)).alias("image_batches"))


def mix_counts(mix: DataFrame, source: str = "source") -> DataFrame:
    """Samples per source (partial aggregation)."""
    return mix.groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def skip_counts(rejected: DataFrame) -> DataFrame:
    """Rejected samples per reason (partial aggregation)."""
    return rejected.groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n"))


def with_progress(df: DataFrame, name: str = "progress", reason: str | None = None):
    """Running counts without per-row printing: ``DataFrame.observe`` with a
    total and, if given, counts per reject reason.  Returns (df, Observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if reason:
        for r in ("error", "short", "long"):
            aggs.append(F.count_if(F.col(reason) == r).alias(r))
    return df.observe(obs, *aggs), obs


def dry_run(prepared: DataFrame, rank: str = "sort_rank", n: int = 8) -> DataFrame:
    """Preview of the first ``n`` batches with their shapes."""
    cols = [c for c in MODEL_INPUT_KEYS if c in prepared.columns]
    shapes = [F.size(c).alias(f"{c}_len") for c in cols
              if prepared.schema[c].dataType.typeName() == "array"]
    return prepared.where(F.col(rank) < n).select(rank, *shapes)
