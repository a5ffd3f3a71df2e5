"""Keep the newest row per key (T-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PACK = "__latest"


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the greatest by ``order_by`` (all descending,
    NULLs last), ties broken by the remaining columns in schema order.

    Expressed as ``groupBy(keys).agg(max(struct(order..., rest...)))`` rather
    than ``row_number() = 1``: the aggregate runs a map-side partial step, so
    a hot key (many overlapping loads of one symbol/day) is collapsed on every
    mapper before the shuffle instead of landing whole in one task.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(f"`{c}`") for c in order_by + rest])
    out = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max(packed).alias(_PACK))
    return out.select(*[F.col(f"`{c}`") if c in keys else F.col(_PACK).getField(c).alias(c) for c in df.columns])
