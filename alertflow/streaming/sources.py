"""Streaming sources: the two message topics (Kafka, or a Parquet file twin)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.functions.metadata import parse_json
from alertflow.session import scratch_path


def message_stream(spark: SparkSession, topic: str, servers: str | None = None, path: str | None = None,
                   max_per_trigger: int | None = None, starting: str = "latest",
                   fail_on_data_loss: bool = True, headers: bool = False,
                   options: dict[str, str] | None = None) -> DataFrame:
    """Raw ``(key, value, topic, timestamp[, headers])`` rows of one topic.

    Kafka (``servers``): ``subscribe``, ``startingOffsets``, ``failOnDataLoss``
    and ``maxOffsetsPerTrigger`` as given; ``options`` adds any reader option
    (retries, timeouts). By default nothing caps a trigger, and messages lost
    on the broker stop the query instead of passing unseen. File twin (``path``): Parquet files
    with the same columns, ``maxFilesPerTrigger`` as the rate limit; used
    offline and in tests (no Kafka jar here). ``headers`` also reads the
    message headers (where the alert id travels, see :func:`alert_id`).
    """
    cols = ["key", "value", "topic", "timestamp"] + (["headers"] if headers else [])
    if servers:
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("subscribe", topic).option("startingOffsets", starting)
             .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if headers:
            r = r.option("includeHeaders", "true")
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return r.load().select(*cols)
    if not path:
        raise ValueError("give servers= or path=")
    r = spark.readStream.schema(S.MESSAGE_SCHEMA_WITH_HEADERS if headers else S.MESSAGE_SCHEMA)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.parquet(path).where(F.col("topic") == topic)


def alert_id(headers: str = "headers", name: str = S.ALERT_ID_HEADER):
    """The alert id carried in a message header (null when absent)."""
    h = F.filter(F.col(headers), lambda x: x["key"] == F.lit(name))
    return F.get(h, 0)["value"].cast("string")


def metadata_stream(raw: DataFrame, schema=S.METADATA_SCHEMA) -> DataFrame:
    """Metadata topic -> object_id[, alert_id], 23 parsed fields, event time."""
    ids = [alert_id().alias("alert_id")] if "headers" in raw.columns else []
    parsed = raw.select(F.col("key").cast("string").alias("object_id"), *ids,
                        parse_json(F.col("value").cast("string"), schema).alias("metadata"),
                        F.col("timestamp").alias("meta_time"))
    return parsed.select("object_id", *(["alert_id"] if ids else []), "metadata.*", "meta_time")


def image_stream(raw: DataFrame) -> DataFrame:
    """Image topic -> object_id[, alert_id], raw bytes, event time."""
    ids = [alert_id().alias("alert_id")] if "headers" in raw.columns else []
    return raw.select(F.col("key").cast("string").alias("object_id"), *ids, F.col("value").alias("image_data"),
                      F.col("timestamp").alias("image_time"))


def write_time_ordered(df: DataFrame, path: str, slices: int = 4, order_col: str = "timestamp",
                       rows_per_file: int = 250_000) -> int:
    """Append ``df`` as ``slices`` consecutive time slices; returns the files of each slice.

    A file stream picks files by modification time; writing the slices one
    after the other makes slice order = event-time order, as a topic replays
    (used to build file twins of topics for offline runs and tests). The input
    is evaluated once, into the shared folder. Slices hold about the same rows
    (approximate quantiles), each spread over as many files as its rows ask for;
    a stream that takes that many files a trigger reads one slice a batch.
    """
    spark = df.sparkSession
    at = F.col(order_col).cast("double")
    cuts = [(i + 1) / slices for i in range(slices - 1)]
    once = scratch_path(spark, "time_slices")
    df.write.parquet(f"{once}/rows")
    rows = spark.read.schema(df.schema).parquet(f"{once}/rows")
    n, bounds = rows.agg(F.count(F.lit(1)), F.percentile_approx(at, F.array(*[F.lit(c) for c in cuts]), 1000)
                         if cuts else F.array().cast("array<double>")).first()
    if not n:
        return 1
    slot = F.lit(0)
    for b in bounds or []:
        slot = slot + (at > F.lit(b)).cast("int")
    rows.withColumn("_slot", slot).write.partitionBy("_slot").parquet(f"{once}/slots")
    slotted = spark.read.parquet(f"{once}/slots")
    files = max(1, -(-n // (slices * rows_per_file)))
    for i in range(slices):
        slotted.where(F.col("_slot") == i).select(*df.columns).repartition(files).write.mode("append").parquet(path)
    return files


def write_message_twin(messages: DataFrame, path: str, slices: int = 4, order_col: str = "timestamp", rows_per_file: int = 250_000) -> int:
    """File twin of a topic: message rows as time-ordered Parquet files; the files of a slice."""
    return write_time_ordered(messages, path, slices, order_col, rows_per_file)
