"""The calibration mix: language-balanced texts + sampled captioned images,
interleaved by ratio, with quotas and image backfill (T4, T5, U1, W3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import (MAX_TEXT_CHARS, MIN_TEXT_CHARS, NUM_CALIB, NUM_IMAGE_CALIB,
                                   NUM_TEXT_CALIB, SEED)
from ..functions.hashing import seeded_key
from ..session import materialize
from ..sources.captioned import with_found_images
from . import messages as M
from .sampling import bottomk_sample, quota_targets, ratio_interleave, round_robin_mix


def text_samples(docs: DataFrame, pattern: Sequence[str] | str, n: int, *,
                 seeds: Mapping[str, int] | None = None, seed: int = SEED,
                 min_chars: int = MIN_TEXT_CHARS, max_chars: int = MAX_TEXT_CHARS,
                 system: bool = True, system_override: str | None = None,
                 spread_rows: bool = False) -> DataFrame:
    """Text samples of the round-robin mix: ``(seq, item_id, source, text,
    messages)`` with ``source = <prefix><lang>`` and an optional system turn."""
    t = round_robin_mix(docs, pattern, n, seeds=seeds, seed=seed, min_chars=min_chars,
                        max_chars=max_chars, spread_rows=spread_rows)
    return t.select("seq", F.col("doc_id").alias("item_id"), "source", "text",
                    M.text_sample_messages("text", system, system_override).alias("messages"))


def sampled_images(captioned: DataFrame, target, bound: int, *, seed: int = SEED,
                   shuffle_seed: int | None = None, mode: str = "mixed",
                   use_assistant: bool = False, require_lang_match: bool = True,
                   system: bool = True, system_override: str | None = None,
                   bounds: DataFrame | None = None) -> DataFrame:
    """Uniform sample of ``target`` valid image samples (``target`` may be a
    scalar-subquery Column, ``bound`` is its static upper bound), then a
    seeded shuffle key.  Ranks and the bottom-k run on keys only; question and
    answer are joined back for the kept items (at most ``bound`` keys, whose
    size Spark checks); image payloads never move -- messages refer to images by
    ``item:<id>``.  Each row is taken once: rows that share an item_id, or have
    none, are told apart by the digest of their texts, equal rows by their rank."""
    keys = M.valid_image_keys(captioned, use_assistant=use_assistant, seed=seed, bounds=bounds)
    # keys only.  The keys come out of the rank's shuffle, so the ordered take
    # merges (shuffle partitions x bound) rows at most, whatever the input size
    top = bottomk_sample(keys, bound, "item_id", seed=seed, ties=["valid_rank"])
    top = top.withColumn("_r", F.row_number().over(Window.orderBy("sample_key", "item_id", "valid_rank")) - 1) \
        .where(F.col("_r") < target)
    top = top.groupBy(F.col("item_id").alias("_id"), F.col("item_digest").alias("_digest")) \
        .agg(F.sort_array(F.collect_list("valid_rank")).alias("_ranks"))     # <= bound in all
    # question and answer are joined back for the kept (<= bound) items only; equal
    # rows are merged by a partial aggregation, then given out once for each rank
    payload = captioned.select("item_id", "question", "answer", M.caption_digest().alias("item_digest"))
    same = F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("item_digest") == F.col("_digest"))
    kept = payload.join(top, same, "inner").groupBy("item_id", "item_digest").agg(
        F.max(F.struct("question", "answer")).alias("_row"), F.max("_ranks").alias("_ranks"))
    top = kept.select("item_id", "_row.question", "_row.answer", F.explode("_ranks").alias("valid_rank")) \
        .withColumn("sample_key", seeded_key(seed, "item_id")) \
        .withColumn("caption", M.pick_caption("answer", "item_id", seed=seed)).drop("answer")
    top = M.with_image_messages(top, mode=mode, use_assistant=use_assistant,
                                require_lang_match=require_lang_match, system=system,
                                system_override=system_override)
    sseed = seed + 1 if shuffle_seed is None else shuffle_seed
    # rows that share an item_id keep the order of their ranks
    key = F.concat_ws(":", seeded_key(sseed, "item_id"), F.lpad(F.col("valid_rank").cast("string"), 19, "0"))
    return top.select("item_id", "source", F.col("prompt").alias("text"), "messages", "sample_key",
                      key.alias("shuffle_key"))


def calibration_mix(docs: DataFrame, captioned: DataFrame, n: int = NUM_CALIB, *,
                    text_quota: int = NUM_TEXT_CALIB, image_quota: int = NUM_IMAGE_CALIB,
                    pattern: Sequence[str] | str = "zh,en", seeds: Mapping[str, int] | None = None,
                    seed: int = SEED, mode: str = "mixed", use_assistant: bool = False,
                    require_lang_match: bool = True, system: bool = True,
                    system_override: str | None = None,
                    min_chars: int = MIN_TEXT_CHARS, max_chars: int = MAX_TEXT_CHARS,
                    spread_rows: bool = False, image_files: DataFrame | None = None,
                    image_bounds: DataFrame | None = None) -> DataFrame:
    """``image_files``: paths at which images given by path only are found;
    ``image_bounds``: a cheaper frame whose ``item_id`` is distributed alike.
    Texts first (the image target depends on how many arrived); images
    make up for missing texts; then ``k`` images per text up to ``n``."""
    text_target, _ = quota_targets(n, text_quota, image_quota, F.lit(0))
    texts = text_samples(docs, pattern, text_target, seeds=seeds, seed=seed, min_chars=min_chars,
                         max_chars=max_chars, system=system, system_override=system_override,
                         spread_rows=spread_rows)
    texts = materialize(texts, "mix-texts")            # <= text_target rows
    got = texts.agg(F.count(F.lit(1))).scalar()
    _, image_target = quota_targets(n, text_quota, image_quota, got)
    if image_files is not None:
        captioned = with_found_images(captioned, image_files)
    images = sampled_images(captioned, image_target, n, seed=seed, mode=mode,
                            use_assistant=use_assistant, require_lang_match=require_lang_match,
                            system=system, system_override=system_override, bounds=image_bounds)
    images = materialize(images.select("item_id", "source", "text", "messages", "shuffle_key"),
                         "mix-images")                  # <= n rows
    mixed = ratio_interleave(images, texts.select("item_id", "source", "text", "messages", "seq"), n,
                             image_order="shuffle_key", text_order="seq")
    return mixed.select("mix_seq", "source", "item_id", "text", "messages")
