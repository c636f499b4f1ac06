"""Small helpers the operators share: table access, written cuts of the lineage, bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor costs no recomputation above this point,
    and the reader knows the real size, so joins on it are planned from it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(col: str | Column = "text") -> Column:
    """UTF-8 bytes of a text column, empty for null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit("")).cast("binary")


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table whose size is proven to stay under ``limit``; error beyond it."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows


def one_row_each(docs: DataFrame, repeats: DataFrame, on: Column) -> DataFrame:
    """``docs`` with one row for each key of ``repeats`` (keys that several rows have, distinct).

    ``on`` matches a row with its key. Of rows of one key the one with the least hash
    of all its columns stays. Without repeats, the usual case, ``docs`` is untouched.
    """
    if repeats.isEmpty():
        return docs
    names = docs.columns
    many = docs.join(repeats.hint("merge"), on).withColumn("_row_hash", F.xxhash64(*[F.col(c).cast("string") for c in names]))
    first = many.withColumn("_row_rank", F.row_number().over(
        Window.partitionBy(*repeats.columns).orderBy("_row_hash"))).where("_row_rank = 1")
    return docs.join(repeats.hint("merge"), on, "left_anti").unionByName(first.select(*names))
