"""Deterministic, engine-portable hashing.

Everything that must be reproducible across engines and across task retries is
derived from ``md5`` of a ``:``-joined key (same bytes in Spark and in other
SQL engines), never from a random generator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_key(seed, *cols) -> Column:
    """md5 hex of ``seed:col1:col2...`` -- the shuffle order key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_col(c).cast("string") for c in cols]))


def unit_interval(hex_col) -> Column:
    """Uniform double in [0, 1) from the leading 13 hex digits of an md5."""
    return (F.conv(F.substring(_col(hex_col), 1, 13), 16, 10).cast("double")
            / F.lit(float(16 ** 13)))


def hashed_id(value, modulus: int) -> Column:
    """Stable id in [0, modulus) from the leading 8 hex digits of md5(value)."""
    return F.pmod(F.conv(F.substring(F.md5(_col(value).cast("string")), 1, 8), 16, 10)
                  .cast("bigint"), F.lit(int(modulus))).cast("int")
