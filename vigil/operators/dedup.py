"""Deduplication by key (D2) without a per-key window.

`row_number() over (partition by key order by t) = 1` sends every copy of a
key to one task; a key copied a billion times is then one task.  An
aggregate `min_by(struct(row), ordering)` is reduced map-side: each input
task keeps one copy per key before the shuffle, so the hot key costs one row
per task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str,
          keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) by `order`; ties broken by the
    whole row so the choice is deterministic.  Rows with a null key are one
    group per distinct null pattern, as in GROUP BY."""
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*[F.col(c) for c in orders], payload)
    pick = F.min_by if keep == "first" else F.max_by
    return (df.groupBy(*keys).agg(pick(payload, ordering).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
            .select(*df.columns))
