"""Registered queries: top-k, softmax/nucleus and weighted draw on the
exploded ``embeddings`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import SEED, TEMPERATURE, TOP_K, TOP_P
from ..operators import selection as X
from ..sources.tables import table
from .registry import register
from .sql import md5key, unit

SCORES = """
sc AS (SELECT vec_id AS group_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS item_id,
              unnest(embedding) AS score FROM embeddings)"""

TOPK = f"""{SCORES.strip()},
tk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, item_id) AS rank
                      FROM sc) WHERE rank <= {TOP_K}),
sm AS (SELECT *, exp((CAST(score AS DOUBLE) - max(CAST(score AS DOUBLE)) OVER (PARTITION BY group_id)) / {TEMPERATURE}) AS e
       FROM tk),
pr AS (SELECT group_id, item_id, e / sum(e) OVER (PARTITION BY group_id) AS prob FROM sm),
cu AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY group_id ORDER BY prob DESC, item_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pr),
nu AS (SELECT group_id, item_id, prob / sum(prob) OVER (PARTITION BY group_id) AS prob FROM cu
       WHERE before < {TOP_P})"""


def _scores(spark, sf):
    return X.exploded_scores(table(spark, sf, "embeddings"))


@register("topk_per_group", f"""
WITH {TOPK}
SELECT group_id, item_id, round(CAST(score AS DOUBLE), 6) AS score, CAST(rank AS INTEGER) AS rank FROM tk""")
def topk_per_group(spark, sf):
    t = X.topk_per_group(_scores(spark, sf), TOP_K)
    return t.select("group_id", "item_id", F.round(F.col("score").cast("double"), 6).alias("score"), "rank")


@register("nucleus_filter", f"""
WITH {TOPK}
SELECT group_id, item_id, round(prob, 6) AS prob FROM nu""")
def nucleus_filter(spark, sf):
    c = X.select_candidates(_scores(spark, sf), TOP_K, TEMPERATURE, TOP_P)
    return c.select("group_id", "item_id", F.round("prob", 6).alias("prob"))


@register("weighted_draw", f"""
WITH {TOPK},
dr AS (SELECT *, {unit(md5key(SEED, 'group_id'))} AS u,
              sum(prob) OVER (PARTITION BY group_id ORDER BY prob DESC, item_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
              row_number() OVER (PARTITION BY group_id ORDER BY prob DESC, item_id) AS rn,
              count(*) OVER (PARTITION BY group_id) AS n FROM nu),
hit AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY rn) AS f FROM dr WHERE cum > u OR rn = n)
SELECT group_id, item_id, round(prob, 6) AS prob FROM hit WHERE f = 1""")
def weighted_draw(spark, sf):
    c = X.select_candidates(_scores(spark, sf), TOP_K, TEMPERATURE, TOP_P)
    d = X.weighted_draw(c, seed=SEED)
    return d.select("group_id", "item_id", F.round("prob", 6).alias("prob"))
