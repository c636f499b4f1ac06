"""The producer as one flow: alert files -> decoded cutouts and metadata -> both topics.

As a batch job over a folder, or as a stream of the folder: files that arrive are
published with the next trigger, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow import schemas as S
from alertflow.functions import images as I
from alertflow.functions import metadata as M
from alertflow.operators import cutouts as C
from alertflow.session import scratch_path
from alertflow.sinks import writers as W
from alertflow.sinks.committed import commit_batch, is_committed
from alertflow.sources import alerts as SRC
from alertflow.sources import containers as CT


def alert_messages(alerts: DataFrame, shape: tuple[int, int] = (S.CUTOUT_SIZE, S.CUTOUT_SIZE),
                   crop: int | None = S.CROP_SIZE, crop_start: int | None = S.CROP_START,
                   order: str = "candid", carry: list[str] = ()) -> DataFrame:
    """One row per publishable alert: object id, alert id, 23 fields, channel-last image.

    Alerts with an unreadable cutout are not published (see ``cutouts.reject_report``);
    columns named in ``carry`` go along.
    """
    keep = ["objectId", order, "candidate", *S.TOP_LEVEL_DOUBLE_FIELDS, *carry]
    good = C.valid_alerts(C.ingest_cutouts(alerts, keep, shape=shape, crop=crop, crop_start=crop_start))
    side = crop or shape[0]
    return good.select(M.object_id(), F.col(order).alias("alert_id"), *M.metadata_columns(),
                       I.chw_to_hwc(I.stack_channels(*[F.col(c) for c in S.CUTOUT_CHANNELS]), len(S.CUTOUT_CHANNELS), side, side)
                       .alias("image"), *carry)


def publish_alerts(spark: SparkSession, path: str | list[str], fmt: str = "avro", glob: str | None = None,
                   servers: str | None = None, metadata_path: str | None = None, image_path: str | None = None,
                   ignore_corrupt: bool = False, **cutout_args) -> None:
    """Scan a folder of alert files and publish every good alert on both topics.

    The decoded alerts are written once to the shared folder, so cutouts are
    decoded once for the two topics. The alert id travels as a message header.
    """
    alerts = SRC.scan_alerts(spark, path, fmt, glob=glob, ignore_corrupt=ignore_corrupt)
    once = scratch_path(spark, "producer")
    messages = alert_messages(alerts, **cutout_args).withColumn("time", F.current_timestamp())
    messages.write.parquet(once)
    rows = spark.read.schema(messages.schema).parquet(once)
    W.publish(W.metadata_messages(rows, time_col="time", alert_col="alert_id"), servers, metadata_path)
    W.publish(W.image_messages(rows, "object_id", "image", time_col="time", alert_col="alert_id"), servers, image_path)


BINARY_FILES = "path string, modificationTime timestamp, length long, content binary"


def alert_stream(spark: SparkSession, folder: str, fmt: str = "avro", glob: str | None = None, max_files: int | None = None,
                 archive: str | None = None, schema: T.StructType = S.ALERT_SCHEMA) -> DataFrame:
    """A folder of alert files as a stream: ``record`` or a reject per row, and the batch's ``time``.

    ``max_files`` limits a trigger; with ``archive`` finished files move there. Spark
    logs the files of every batch in the checkpoint, so each is read once. ``time`` is
    the trigger's, which the log keeps: a replayed batch gives the same messages.
    """
    reader = spark.readStream.format("binaryFile" if fmt == "avro" else fmt).schema(BINARY_FILES if fmt == "avro" else schema)
    if glob or fmt == "avro":
        reader = reader.option("pathGlobFilter", glob or "*.avro")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = reader.load(folder)
    if fmt == "avro":
        rows = CT.decode(files, schema)
    else:
        rows = files.select(F.struct(*schema.names).alias("record"), F.lit(None).cast("string").alias("reject_path"),
                            F.lit(None).cast("long").alias("reject_offset"), F.lit(None).cast("string").alias("reject_reason"),
                            F.lit(None).cast("long").alias("reject_kept"))
    return rows.withColumn("time", F.current_timestamp())


def publish_alert_stream(alerts: DataFrame, root: str, checkpoint: str, servers: str | None = None, trigger_seconds: int | None = 1,
                         available_now: bool = False, **cutout_args):
    """Start the producer over :func:`alert_stream`; returns the running query.

    Every batch goes to ``root/<metadata topic>``, ``root/<image topic>`` and
    ``root/rejects``, each committed once (``sinks.committed``): a batch that died
    between the topics publishes only the missing one when it is replayed. With
    ``servers`` the topics are Kafka's, where a replay can repeat messages; consumers
    tell them by the alert id in the header.
    """
    topics = {S.METADATA_TOPIC: f"{root}/{S.METADATA_TOPIC}", S.IMAGE_TOPIC: f"{root}/{S.IMAGE_TOPIC}"}

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, f"{root}/rejects", batch_id):
            return  # the last of the three
        once = scratch_path(spark, "producer_batch")
        batch.write.parquet(once)  # containers are decoded once
        rows = spark.read.schema(batch.schema).parquet(once)
        good = rows.where("reject_reason is null").select("record.*", "time")
        decoded = scratch_path(spark, "producer_messages")
        messages = alert_messages(good, carry=["time"], **cutout_args)
        messages.write.parquet(decoded)  # cutouts are decoded once
        messages = spark.read.schema(messages.schema).parquet(decoded)
        for topic, made in ((S.METADATA_TOPIC, W.metadata_messages(messages, time_col="time", alert_col="alert_id")),
                            (S.IMAGE_TOPIC, W.image_messages(messages, "object_id", "image", time_col="time", alert_col="alert_id"))):
            if servers:
                W.publish(made, servers)
            else:
                commit_batch(made, topics[topic], batch_id)
        bad = rows.where("reject_reason is not null").select(
            F.col("reject_path").alias("path"), F.col("reject_offset").alias("offset"), F.col("reject_reason").alias("reason"),
            F.col("reject_kept").alias("n_rows"))
        commit_batch(bad, f"{root}/rejects", batch_id)

    w = alerts.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
