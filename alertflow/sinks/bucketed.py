"""Id tables bucketed and sorted by their key, for joins that move only the other side.

The ids seen so far and the label catalogue grow for years while a batch is small.
Kept as tables bucketed by the id, they are read in place by a join on the id: the
batch alone is shuffled, into the table's buckets. Appending keeps the buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None, mode: str = "overwrite") -> str:
    """Write ``df`` as a table of ``buckets`` sorted buckets, one file each for this write."""
    w = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return table


def append_ids(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Add the ids of a batch to the table of seen ids; ids it already holds are left out."""
    new = df.select(key).where(F.col(key).isNotNull()).distinct()
    known = df.sparkSession.table(table)
    save_bucketed(unseen(new, known, key), table, [key], buckets, path, mode="append")


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose id the bucketed table ``seen`` does not hold. A null id is never seen."""
    return df.join(seen.select(F.col(key).alias("_seen")).hint("merge"), F.col(key) == F.col("_seen"), "left_anti")


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
