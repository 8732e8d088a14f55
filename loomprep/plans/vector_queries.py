"""Registered queries: batched model scoring and vector export."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import inference as I
from ..operators import vectors as W
from ..sources.tables import table
from .registry import register

DIM = 64


def _w(i: str, j: str | int, layer: int) -> str:
    return f"((({i} + 3 * {j} + {5 * layer}) % 11) - 5) / 10.0"


EXP = """
ex AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS x
       FROM embeddings)"""


@register("batch_predict", f"""
WITH {EXP.strip()}
SELECT vec_id, round(sum(x * {_w('i', 0, 0)}), 6) AS score FROM ex GROUP BY vec_id""")
def batch_predict(spark, sf):
    e = table(spark, sf, "embeddings")
    s = I.batch_predict("embedding", I.linear_scorer(DIM), T.DoubleType(), 256, [DIM])
    return e.select("vec_id", F.round(s, 6).alias("score"))


def _layer_sum(layer: int) -> str:
    return " + ".join(_w("i", j, layer) for j in range(4))


@register("batch_predict_multi", f"""
WITH {EXP.strip()}
SELECT vec_id, round(sum(x * ({_layer_sum(0)})), 6) AS final_sum,
       round(sum(x * ({_layer_sum(1)})), 6) AS side1_sum,
       round(sum(x * ({_layer_sum(2)})), 6) AS side2_sum,
       round(sum(x * ({_layer_sum(3)})), 6) AS side3_sum
FROM ex GROUP BY vec_id""")
def batch_predict_multi(spark, sf):
    e = table(spark, sf, "embeddings")
    out = I.batch_predict("embedding", I.linear_encoder(DIM), I.encoder_return_type(), 256, [DIM])
    s = e.select("vec_id", out.alias("o"))
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 6)
    return s.select("vec_id", total("o.final").alias("final_sum"), total("o.side1").alias("side1_sum"),
                    total("o.side2").alias("side2_sum"), total("o.side3").alias("side3_sum"))


BF16 = """
bx AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
be AS (SELECT vec_id, x, floor(log2(abs(x))) AS e0 FROM bx),
be1 AS (SELECT *, CASE WHEN pow(2.0, e0) > abs(x) THEN e0 - 1 ELSE e0 END AS e1 FROM be),
be2 AS (SELECT *, CASE WHEN pow(2.0, e1 + 1) <= abs(x) THEN e1 + 1 ELSE e1 END AS e FROM be1),
bf AS (SELECT vec_id, x, CASE WHEN x = 0 THEN x ELSE round_even(x / pow(2.0, e - 7), 0) * pow(2.0, e - 7) END AS y
       FROM be2)"""


@register("vector_export", f"""
WITH {BF16.strip()}
SELECT vec_id, CAST(count(*) AS INTEGER) AS dim, round(sum(y), 6) AS bf16_sum,
       round(max(abs(y - x)), 9) AS max_err FROM bf GROUP BY vec_id""")
def vector_export(spark, sf):
    e = table(spark, sf, "embeddings")
    cands = W.EMBED_CANDIDATES + ("embedding",)
    x = W.vector_export(e, candidates=cands)
    err = F.array_max(F.zip_with("vector", "vector_bf16", lambda a, b: F.abs(b.cast("double") - a.cast("double"))))
    return x.select("vec_id", F.size("vector").alias("dim"),
                    F.round(F.aggregate("vector_bf16", F.lit(0.0), lambda a, v: a + v.cast("double")), 6).alias("bf16_sum"),
                    F.round(err, 9).alias("max_err"))
