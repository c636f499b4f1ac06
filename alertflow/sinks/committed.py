"""Batch sink with a commit: a reader sees all of a batch or nothing of it.

The tasks of a batch write their files into a hidden folder of that attempt. When
all have ended, the driver moves the folder to ``batch_id=<n>`` and then publishes
a manifest entry by renaming a complete file into place; the entry is the commit.
A batch with an entry is never written again, so a replay changes nothing; an
attempt that died before its entry leaves only what no reader looks at, and the
replay replaces it. The entry holds the batch's facts (row counts, rates), so they
are committed with it.

Readers take the folders that have an entry (:func:`read_committed`). Where a
rename is one step, a plain reader of the root sees whole batches too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFEST = "_manifest"
ATTEMPTS = "_attempts"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"{target}: could not be moved into place")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written aside, then renamed."""
    aside = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    fs, p = _fs(spark, aside)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _move(spark, aside, path)


def entry_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{MANIFEST}/{batch_id}.json"


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    return exists(spark, entry_path(root, batch_id))


def commit_batch(df: DataFrame, root: str, batch_id: int, fmt: str = "parquet", options: dict | None = None,
                 facts: Callable[[], dict] | None = None) -> bool:
    """Write ``df`` as batch ``batch_id`` under ``root``; False if the batch was committed before.

    ``facts`` is asked after the tasks have written and before the commit.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    if is_committed(spark, root, batch_id):
        return False
    attempt = f"{root}/{ATTEMPTS}/{batch_id}-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**(options or {})).save(attempt)
    folder = f"batch_id={batch_id}"
    fs, old = _fs(spark, f"{root}/{folder}")
    if fs.exists(old):  # moved by an attempt that died before its entry
        fs.delete(old, True)
    _move(spark, attempt, f"{root}/{folder}")
    put_text(spark, entry_path(root, batch_id), json.dumps({"batch_id": batch_id, "folder": folder, **(facts() if facts else {})}))
    return True


def manifest(spark: SparkSession, root: str, schema: str = "batch_id long, folder string") -> DataFrame:
    """Committed batches, one row each, with the facts named in ``schema``."""
    if not exists(spark, f"{root.rstrip('/')}/{MANIFEST}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{root.rstrip('/')}/{MANIFEST}")


def read_committed(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet", options: dict | None = None,
                   with_batch: bool = False) -> DataFrame:
    """Rows of the committed batches; the driver lists one path a batch, as a file sink's log does."""
    root = root.rstrip("/")
    folders = sorted(r["folder"] for r in manifest(spark, root).select("folder").collect())
    if not folders:
        out = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())]))
    else:
        out = spark.read.format(fmt).options(**(options or {})).option("basePath", root).schema(schema).load([f"{root}/{f}" for f in folders])
    return out if with_batch else out.drop("batch_id")
