"""Standard scaler: fit = one aggregate, apply = a 1-row broadcast.

Population standard deviation, NaN ignored while fitting, zero deviation
replaced by 1 (MLlib's ``StandardScaler`` uses the sample deviation and keeps
0, so it is not used).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``mean_<c>``, ``std_<c>`` for every column (single pass)."""
    aggs = []
    for c in columns:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs.append(F.avg(x).alias(f"mean_{c}"))
        aggs.append(F.stddev_pop(x).alias(f"_sd_{c}"))
    stats = df.agg(*aggs)
    return stats.select(
        *[e for c in columns for e in (
            F.col(f"mean_{c}"),
            F.when(F.col(f"_sd_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_sd_{c}")).alias(f"std_{c}"))])


def apply_scaler(df: DataFrame, stats: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """``(x - mean) / std`` with the fitted statistics (1 row: safe to broadcast)."""
    j = df.crossJoin(F.broadcast(stats))
    out = [F.col(c) for c in df.columns if c not in columns or suffix]
    out += [((F.col(c).cast("double") - F.col(f"mean_{c}")) / F.col(f"std_{c}")).alias(f"{c}{suffix}")
            for c in columns]
    return j.select(*out)
