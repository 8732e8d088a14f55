"""Vector tables: export by ordered candidate column names and bfloat16
narrowing (S10, SC12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Candidate names of the token-embedding tensor, in the order
# they are tried (first hit wins).
EMBED_CANDIDATES = (
    "model.embed_tokens.weight",
    "llm.model.embed_tokens.weight",
    "language_model.model.embed_tokens.weight",
    "embed_tokens.weight",
    "model.text_model.embed_tokens.weight",
    "model.language_model.embed_tokens.weight",
)


def pick_vector_column(df: DataFrame, candidates: Sequence[str] = EMBED_CANDIDATES) -> Column:
    """The first candidate column that exists; when several exist, per row
    the first non-null one in candidate order."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        raise KeyError(f"none of the candidate vector columns exist: {list(candidates)}")
    cols = [F.col(f"`{c}`") for c in present]
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def bf16_round(x) -> Column:
    """Round a float to the nearest bfloat16 value (ties to even), as a
    double: ``e = floor(log2|x|)`` (corrected to be exact), ``q = 2^(e-7)``,
    ``round_half_even(x / q) * q``.  Zero stays zero, non-finite unchanged."""
    v = (F.col(x) if isinstance(x, str) else x).cast("double")
    a = F.abs(v)
    e0 = F.floor(F.log2(a))
    e1 = F.when(F.pow(F.lit(2.0), e0) > a, e0 - 1).otherwise(e0)
    e = F.when(F.pow(F.lit(2.0), e1 + 1) <= a, e1 + 1).otherwise(e1)
    q = F.pow(F.lit(2.0), e - 7)
    finite = ~F.isnan(v) & (a < F.lit(float("inf")))
    return F.when((v == 0) | ~finite, v).otherwise(F.bround(v / q) * q)


def vector_export(df: DataFrame, id_col: str = "vec_id",
                  candidates: Sequence[str] = EMBED_CANDIDATES, bf16: bool = True) -> DataFrame:
    """``(id, vector float32[, vector_bf16])`` ready for a parquet sink."""
    v = pick_vector_column(df, candidates).cast("array<float>")
    out = df.select(F.col(id_col), v.alias("vector"))
    if bf16:
        out = out.withColumn("vector_bf16", F.transform("vector", lambda x: bf16_round(x).cast("float")))
    return out
