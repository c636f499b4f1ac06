"""Deduplication operators.

First/last-per-key is an *aggregate* (``min``/``max`` of a struct whose leading
fields are the order), not a window: Spark combines map-side, so an object
holding a third of all alerts is reduced inside every map task before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], agg, payload: list[str] | None) -> DataFrame:
    payload = [c for c in (payload if payload is not None else df.columns) if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in payload])
    picked = df.groupBy(*keys).agg(agg(packed).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r._o{i}").alias(c) for i, c in enumerate(order)],
                         *[F.col(f"_r.{c}") for c in payload])


def first_per_key(df: DataFrame, keys: list[str], order: list[str], payload: list[str] | None = None) -> DataFrame:
    """Row with the smallest ``order`` tuple per key (keep='first')."""
    return _pick(df, keys, order, F.min, payload)


def last_per_key(df: DataFrame, keys: list[str], order: list[str], payload: list[str] | None = None) -> DataFrame:
    """Row with the largest ``order`` tuple per key (a later file overwrites)."""
    return _pick(df, keys, order, F.max, payload)
