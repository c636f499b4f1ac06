"""Batch sources: alert files, dataset folders, label catalogue, class partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow import schemas as S
from alertflow.session import scratch_path
from alertflow.sinks.committed import MANIFEST, exists, read_committed
from alertflow.sources import containers as CT


def avro_available(spark: SparkSession) -> bool:
    """True when the external Avro data source is on the classpath."""
    try:
        ds = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource
        ds.lookupDataSource("avro", spark._jsparkSession.sessionState().conf())
        return True
    except Exception:  # noqa: BLE001 - py4j raises a generic error
        return False


def scan_alerts(spark: SparkSession, path: str | list[str], fmt: str = "avro",
                schema: T.StructType = S.ALERT_SCHEMA, glob: str | None = None,
                ignore_corrupt: bool = False) -> DataFrame:
    """One row per alert from a directory of alert files.

    ``fmt``: ``avro`` (Spark's Avro source), ``avro-mapred`` (the Hadoop Avro
    input format bundled with Spark -- no extra jar; records arrive as JSON
    text, bytes as Latin-1 text), or any file format with a Parquet/JSON twin.
    A damaged file fails the scan. ``ignore_corrupt`` skips it instead; take
    :func:`rejected_files` then, which names every file that gave no row. Without the
    Avro data source a skipping scan reads containers block by block
    (``sources.containers``) and keeps the records before the damage.
    ``glob`` selects files by name on every path (Avro: ``*.avro`` by default).
    ``fmt="avro"`` without the Avro data source on the classpath falls back to
    ``avro-mapred``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "avro" and not avro_available(spark):
        fmt = "avro-mapred"
    if fmt == "avro-mapred" and ignore_corrupt:
        return CT.scan_containers(CT.container_files(spark, paths, glob or "*.avro"), schema)[0]
    if fmt == "avro-mapred":
        return _scan_avro_mapred(spark, paths, schema, glob or "*.avro")
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", str(ignore_corrupt).lower())
    if glob is None and fmt == "avro":
        glob = "*.avro"
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(fmt).load(paths)


def rejected_files(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                   schema: T.StructType = S.ALERT_SCHEMA, glob: str | None = None) -> DataFrame:
    """``path, length, n_rows`` of the files that a skipping scan took no row from; of Avro
    containers, those with damage and how many records lie before it.

    The listing reads file names and sizes only (the content column is pruned);
    the rows per file are counted on the executors.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt in ("avro", "avro-mapred"):
        bad = CT.scan_containers(CT.container_files(spark, paths, glob or "*.avro"), schema)[1]
        sizes = spark.read.format("binaryFile").option("pathGlobFilter", glob or "*.avro").option(
            "recursiveFileLookup", "true").load(paths).select("path", "length")
        return bad.join(sizes, "path").select("path", "length", "n_rows")
    listed = spark.read.format("binaryFile")
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true")
    if glob:
        listed, rows = listed.option("pathGlobFilter", glob), rows.option("pathGlobFilter", glob)
    counts = rows.format(fmt).load(paths).groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("n_rows"))
    files = listed.load(paths).select("path", "length", F.col("_metadata.file_path").alias("file_path"))
    joined = files.join(counts, F.col("file_path") == F.col("_path"), "left")
    return joined.where(F.col("n_rows").isNull()).select("path", "length", F.lit(0).cast("long").alias("n_rows"))


def _scan_avro_mapred(spark: SparkSession, paths: list[str], schema: T.StructType, glob: str) -> DataFrame:
    """Avro container files read by executors through ``AvroAsTextInputFormat``.

    The records go as JSON lines, JVM to JVM, to the shared folder and are read
    from there: no Python worker touches an alert. The lines are the scan's
    materialised input, so later stages never read the containers again.
    """
    sc = spark.sparkContext
    # a folder is read by the file pattern, a file or a pattern as given
    paths = [p if p.endswith(".avro") or "*" in p else f"{p.rstrip('/')}/{glob}" for p in paths]
    named = sc._jvm.org.apache.spark.util.Utils.classForName
    fmt, key, value = (named(n, True, False) for n in ("org.apache.avro.mapred.AvroAsTextInputFormat",
                                                       "org.apache.hadoop.io.Text", "org.apache.hadoop.io.NullWritable"))
    out = scratch_path(spark, "avro_lines")
    for i, p in enumerate(paths):
        records = sc._jsc.hadoopFile(p, fmt, key, value)
        records.keys().saveAsTextFile(f"{out}/{i}", named("org.apache.hadoop.io.compress.GzipCodec", True, False))
    text = [f"{out}/{i}" for i in range(len(paths))]

    # bytes fields come as Latin-1 text: read them as strings and re-encode.
    def as_text(dt):
        if isinstance(dt, T.StructType):
            return T.StructType([T.StructField(f.name, as_text(f.dataType), True) for f in dt.fields])
        if isinstance(dt, T.BinaryType):
            return T.StringType()
        return dt
    df = spark.read.schema(as_text(schema)).json(text)
    out = []
    for f in schema.fields:
        if f.name in S.CUTOUT_CHANNELS:
            out.append(F.struct(F.encode(F.col(f"{f.name}.stampData"), "ISO-8859-1").alias("stampData")).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def load_folders(spark: SparkSession, folders: list[str], fmt: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """Read several dataset folders, tagging rows with the folder's position in
    ``folders`` (``folder_rank``) for keep-first deduplication.

    Each folder is its own scan with its rank as a literal, so no path is
    compared: names with spaces or nested folders keep their own rank.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    parts = [reader.load(f).withColumn("folder_rank", F.lit(i)) for i, f in enumerate(folders)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_catalog(spark: SparkSession, path: str, schema: T.StructType = S.CATALOG_SCHEMA) -> DataFrame:
    """Label catalogue CSV with header, declared schema (no inference pass)."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema).csv(path)


def read_class_partition(spark: SparkSession, root: str, label_col: str = "label",
                         classes: list[str] | None = None) -> DataFrame:
    """Per-class dataset written with ``partitionBy(label)``; asking for some
    classes prunes the other partitions at planning time."""
    df = spark.read.parquet(root)
    if classes:
        df = df.where(F.col(label_col).isin(classes))
    return df


def read_predictions(spark: SparkSession, root: str, with_batch: bool = False) -> DataFrame:
    """Prediction CSV folders (``batch_id=<n>/``) as the 34-column table; of a committed sink, its committed batches."""
    if exists(spark, f"{root.rstrip('/')}/{MANIFEST}"):
        df = read_committed(spark, root, S.PREDICTION_SCHEMA, "csv", {"header": "true"}, with_batch=True)
        return df.select(*S.PREDICTION_HEADER, *(["batch_id"] if with_batch else []))
    df = spark.read.option("header", True).schema(S.PREDICTION_SCHEMA).csv(root)
    return df.select(*S.PREDICTION_HEADER, *(["batch_id"] if with_batch else []))
