"""Batch sinks: dataset tables, per-class partitions, message rows, prediction CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.functions.metadata import to_json_text


def write_dataset(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One row per object, Parquet (replaces one file per object)."""
    df.write.mode(mode).parquet(path)
    return path


def write_by_class(df: DataFrame, root: str, label_col: str = "label", mode: str = "overwrite",
                   files_per_class: int | None = None) -> str:
    """One partition directory per class (``label=AGN/``, ...).

    By default no shuffle: each task writes one file per class it holds
    (at most tasks x classes files). ``files_per_class`` clusters rows by
    (class, salt) first -- one extra shuffle -- for fewer, larger files; the
    salt spreads a hot class over that many tasks instead of one.
    """
    if files_per_class:
        salt = (F.abs(F.xxhash64(*[F.col(c) for c in df.columns if c != label_col])) % files_per_class)
        df = df.repartition(F.col(label_col), salt)
    df.write.mode(mode).partitionBy(label_col).parquet(root)
    return root


def _message_extras(time_col: str | None, alert_col: str | None) -> list:
    extra = [F.col(time_col).cast("timestamp").alias("timestamp")] if time_col else []
    if alert_col:
        extra.append(F.array(F.struct(F.lit(S.ALERT_ID_HEADER).alias("key"),
                                      F.encode(F.col(alert_col).cast("string"), "UTF-8").alias("value")))
                     .alias("headers"))
    return extra


def metadata_messages(df: DataFrame, id_col: str = "object_id", columns: list[str] = S.METADATA_COLUMNS,
                      topic: str = S.METADATA_TOPIC, time_col: str | None = None,
                      alert_col: str | None = None) -> DataFrame:
    """Rows ready for a message sink: key = UTF-8 id, value = JSON of the metadata;
    optionally ``timestamp`` (file twin) and the alert id as a message header."""
    return df.select(F.lit(topic).alias("topic"), F.encode(F.col(id_col), "UTF-8").alias("key"),
                     F.encode(to_json_text(*columns), "UTF-8").alias("value"), *_message_extras(time_col, alert_col))


def image_messages(df: DataFrame, id_col: str, image_col: str, topic: str = S.IMAGE_TOPIC,
                   time_col: str | None = None, alert_col: str | None = None, packed: bool = False) -> DataFrame:
    """Rows for a message sink: value = the image as little-endian float32 bytes
    (``packed``: ``image_col`` already holds the bytes)."""
    from alertflow.functions.images import pack_float32
    named = [c for c in (time_col, alert_col) if c]
    rows = df.select(id_col, image_col, *[c for c in named if c not in (id_col, image_col)])
    if not packed:
        rows = pack_float32(rows, image_col, image_col)
    return rows.select(F.lit(topic).alias("topic"), F.encode(F.col(id_col), "UTF-8").alias("key"),
                       F.col(image_col).alias("value"), *_message_extras(time_col, alert_col))


def publish(messages: DataFrame, servers: str | None = None, path: str | None = None) -> None:
    """Write message rows to Kafka (``servers``) or to a Parquet file twin (``path``)."""
    if servers:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    elif path:
        messages.write.mode("append").parquet(path)
    else:
        raise ValueError("give servers= or path=")


# Options of prediction files, for writing.
PREDICTION_CSV = {"header": "true", "nullValue": "", "emptyValue": ""}


def write_predictions_csv(df: DataFrame, root: str, batch_id: int) -> str:
    """Prediction rows as CSV with header under ``batch_id=<n>/``, overwritten,
    so a replayed micro-batch replaces its own output (idempotent append)."""
    path = f"{root.rstrip('/')}/batch_id={batch_id}"
    df.select(*S.PREDICTION_HEADER).write.mode("overwrite").options(**PREDICTION_CSV).csv(path)
    return path


def publish_stream(messages: DataFrame, checkpoint: str, servers: str | None = None, path: str | None = None,
                   trigger_seconds: int | None = None, available_now: bool = False):
    """Streaming twin of :func:`publish`: a message stream to Kafka or to a
    Parquet file twin, checkpointed (exactly-once for the file sink)."""
    w = messages.writeStream.option("checkpointLocation", checkpoint)
    if servers:
        w = w.format("kafka").option("kafka.bootstrap.servers", servers)
    elif path:
        w = w.format("parquet").option("path", path)
    else:
        raise ValueError("give servers= or path=")
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
