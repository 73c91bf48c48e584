"""Partition-independent random draws.

``rand(seed)`` depends on the partition layout, so every draw here is a
60-bit integer taken from ``md5(seed:i:j)``; the same expression is written
in the DuckDB oracles, which makes random operators testable exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash60(*parts) -> Column:
    """60-bit non-negative BIGINT from md5 of ':'-joined parts."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    hexs = F.substring(F.md5(F.concat_ws(":", *[c.cast("string") for c in cols])), 1, 15)
    return F.conv(hexs, 16, 10).cast("bigint")


def hash60_sql(*parts: str) -> str:
    """DuckDB spelling of :func:`hash60` (for oracle SQL)."""
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"('0x' || substr(md5(concat_ws(':', {inner})), 1, 15))::BIGINT"


def uniform01(*parts) -> Column:
    """Uniform double in [0, 1) from :func:`hash60`."""
    return hash60(*parts).cast("double") / F.lit(float(1 << 60))
