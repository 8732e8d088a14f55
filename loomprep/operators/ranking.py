"""Exact global / per-group ranks without a single-partition window.

A window ``row_number() OVER (ORDER BY k)`` with no partition moves every row
into one task.  Instead rows are split into ordered buckets (a prefix of the
md5 order key, or quantile ranges for numeric keys), the per-bucket counts are
prefix-summed on the small count table, and each bucket is ranked on its own
and shifted by its offset.  A hot group (one language holding a third of the
rows) is spread over ``16**digits`` buckets, and every step recomputes the
same ranks after a lost task because nothing depends on arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed_rank(df: DataFrame, order_cols: Sequence[str], bucket: Column,
                  partition_by: Sequence[str] = (), out: str = "rank",
                  broadcast_offsets: bool | None = None) -> DataFrame:
    """Add a 0-based rank ``out`` of each row by ``order_cols`` inside
    ``partition_by`` (global when empty).

    ``bucket`` must be monotone in ``order_cols`` (rows of a lower bucket sort
    before rows of a higher one).  The offset table has one row per
    (partition, bucket); it is broadcast when the partition is global or the
    caller declares it small, otherwise AQE picks the join by measured size.
    """
    part = list(partition_by)
    d = df.withColumn("_bkt", bucket)
    counts = d.groupBy(*part, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    wo = (Window.partitionBy(*part) if part else Window).orderBy("_bkt") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, "_bkt",
                            F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_off"))
    if broadcast_offsets is None:
        broadcast_offsets = not part
    keys = [*part, "_bkt"]
    offsets = offsets.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(keys)], "_off")
    if broadcast_offsets:       # callers pass True only for bounded bucket tables
        offsets = F.broadcast(offsets)
    same = [F.col(c).eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(keys)]     # null keys count
    joined = d.join(offsets, same, "inner").drop(*[f"_o{i}" for i in range(len(keys))])
    wr = Window.partitionBy(*part, "_bkt").orderBy(*order_cols)
    return (joined.withColumn(out, F.col("_off") + F.row_number().over(wr) - 1)
            .drop("_bkt", "_off"))


def hash_bucket(hash_col: str, digits: int = 3) -> Column:
    """Ordered bucket from the leading hex digits of an md5 string."""
    return F.substring(F.col(hash_col), 1, digits)


SIDE = 40               # range_bucket uses SIDE * SIDE quantile ranges


def range_bucket(df: DataFrame, id_col: str, side: int = SIDE, key: Column | None = None) -> Column:
    """Ordered bucket for a numeric key: ``side * side`` ranges between the
    key's approximate quantiles over ``df``, so outlying or clustered keys fill
    the buckets evenly.  Any ``df`` that is distributed like the ranked rows
    works (best the scan before joins and filters).  The quantiles are one
    aggregate over the keys, run when the query is built, and become one array
    literal that each row searches by halving; their number, and with it the
    offset table, stays fixed however large the input grows.  A null key has the
    bucket null.  ``key``: what to search for, if not the column ``id_col``."""
    n = side * side
    fractions = ",".join(f"{k / n!r}D" for k in range(1, n))
    points = df.agg(F.expr(f"percentile_approx(`{id_col}`, array({fractions}), {5 * n})")).first()[0]
    k = F.col(id_col) if key is None else key
    if not points:
        return F.when(k.isNotNull(), F.lit(0))
    if isinstance(points[0], (int, float)):                 # one parsed expression instead of n literals
        known = F.expr("array(" + ",".join(f"{p}L" if isinstance(p, int) else f"double('{p}')"
                                           for p in points) + ")")
    else:
        known = F.array(*map(F.lit, points))
    steps = F.expr("array(" + ",".join(str(1 << e) for e in reversed(range(n.bit_length()))) + ")")

    def forward(at: Column, step: Column) -> Column:        # ``at`` points are known to be <= k
        return at + F.when(F.coalesce(F.get(known, at + step - 1) <= k, F.lit(False)), step).otherwise(0)
    return F.when(k.isNotNull(), F.aggregate(steps, F.lit(0), forward))


def valid_rank(df: DataFrame, valid: Column | str, order_col: str, out: str = "valid_rank",
               bounds: DataFrame | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Rank among valid rows in input order (``valid_seen`` before the row).
    Invalid rows are dropped; ``order_col`` is the numeric input order, rows equal
    in it go by ``ties``.
    ``bounds``: a cheaper frame whose ``order_col`` is distributed alike."""
    v = F.col(valid) if isinstance(valid, str) else valid
    bounds = df.select(order_col) if bounds is None else bounds
    return bucketed_rank(df.where(v), [order_col, *ties], range_bucket(bounds, order_col), out=out)
