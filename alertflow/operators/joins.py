"""Joins: catalogue cross-match and the anti join against seen ids.

No side is broadcast by hand here: both the dataset and the catalogue grow
with the survey, so the strategy is left to Catalyst/AQE, which broadcasts a
side only after measuring it at runtime (``autoBroadcastJoinThreshold``) and
otherwise sort-merge joins, splitting skewed partitions (skew join on).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow.functions.labels import map_label


def catalog_labels(catalog: DataFrame, id_col: str = "oid", class_col: str = "predicted_class",
                   out_id: str = "object_id", out_label: str = "label") -> DataFrame:
    """Catalogue -> (object_id, label) with the raw class mapped to 5 classes."""
    return catalog.select(F.col(id_col).alias(out_id), map_label(class_col).alias(out_label))


def crossmatch(dataset: DataFrame, labels: DataFrame, on: str = "object_id",
               null_safe: bool = False) -> DataFrame:
    """Inner equi-join of the dataset with the label table on the id.

    Duplicate catalogue ids multiply rows (the source behaviour). With
    ``null_safe`` a null id matches a null id, as pandas does.
    """
    if not null_safe:
        return dataset.join(labels, on, "inner")
    r = labels.withColumnRenamed(on, "_k")
    return dataset.join(r, dataset[on].eqNullSafe(r["_k"]), "inner").drop("_k")


def anti_seen(df: DataFrame, seen: DataFrame, on: str = "object_id") -> DataFrame:
    """Rows whose id is not in ``seen`` (batch form of the processed-id filter)."""
    return df.join(seen.select(on), on, "left_anti")
