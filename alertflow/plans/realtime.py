"""The real-time classification job, wired end to end.

``save_training`` stores what the stream needs from training (model, class
list, scaler statistics, image shape); ``run_classifier`` reads both topics,
pairs metadata and images once per object, scores every micro-batch and
appends prediction rows -- the whole job a user starts.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from alertflow import schemas as S
from alertflow.operators import fused as FU
from alertflow.operators import model as ML
from alertflow.session import DEFAULT_CONF, STATE_STORE, session_conf
from alertflow.streaming import classify as CL
from alertflow.streaming import sources as SS


def save_training(spark: SparkSession, path: str, model, stats: DataFrame, classes: list[str] = S.CLASS_LABELS,
                  image_shape: tuple[int, int, int] = (S.CROP_SIZE, S.CROP_SIZE, 3), kind: str = "mlp",
                  normalise: str = "cube") -> str:
    """Model + classes + 1-row scaler statistics + shape + normalisation, under ``path``.

    ``normalise`` is what the training images went through (``build_dataset``:
    ``cube``); the stream applies the same. ``kind="fused"`` takes ``(shape,
    parameters)`` of the image network.
    """
    if kind == "fused":
        FU.save(spark, f"{path}/model", *model)
        spark.createDataFrame([(json.dumps(classes),)], "classes string").write.mode("overwrite").json(f"{path}/classes")
    else:
        ML.save(model, path, classes)
    stats.write.mode("overwrite").parquet(f"{path}/stats")
    spark.createDataFrame([(json.dumps({"shape": list(image_shape), "kind": kind, "normalise": normalise}),)], "meta string") \
        .write.mode("overwrite").json(f"{path}/meta")
    return path


def load_training(spark: SparkSession, path: str):
    meta = json.loads(spark.read.json(f"{path}/meta").first()[0])
    if meta["kind"] == "fused":
        model, classes = FU.predictor(*FU.load(spark, f"{path}/model")), json.loads(spark.read.json(f"{path}/classes").first()[0])
    else:
        model, classes = ML.load(path, meta["kind"])
    stats = spark.read.parquet(f"{path}/stats")
    if stats.count() != 1:
        raise ValueError(f"{path}/stats: one row of scaler statistics expected")
    return model, classes, stats, tuple(meta["shape"]), meta["normalise"]


def run_classifier(spark: SparkSession, training_path: str, out_root: str, checkpoint: str,
                   servers: str | None = None, metadata_path: str | None = None, image_path: str | None = None,
                   keys: tuple[str, ...] = ("object_id",), max_per_trigger: int | None = None,
                   trigger_seconds: int | None = 15, available_now: bool = False,
                   watermark: str | None = CL.DEFAULT_WATERMARK, bound: str | None = CL.DEFAULT_BOUND,
                   state_partitions: int | None = None, starting: str = "latest",
                   fail_on_data_loss: bool = True, options: dict[str, str] | None = None, repeatable: bool = False):
    """Start the classifier; returns the running query.

    Kafka (``servers``) or file twins (``metadata_path`` / ``image_path``);
    ``keys`` with ``alert_id`` reads the alert id from message headers.
    ``starting``, ``fail_on_data_loss`` and ``options`` go to both topic readers;
    ``repeatable`` chooses each object's pair by event time, whatever the batch cut.
    """
    model, classes, stats, shape, normalise = load_training(spark, training_path)
    headers = "alert_id" in keys
    meta = SS.metadata_stream(SS.message_stream(spark, S.METADATA_TOPIC, servers, metadata_path, max_per_trigger,
                                                starting, fail_on_data_loss, headers, options))
    img = SS.image_stream(SS.message_stream(spark, S.IMAGE_TOPIC, servers, image_path, max_per_trigger,
                                            starting, fail_on_data_loss, headers, options))
    pairs = CL.first_pairs(meta, img, keys, watermark, bound, repeatable=repeatable)
    run = CL.batch_writer(model, classes, stats, out_root, S.METADATA_COLUMNS, shape, dedup_in_batch=False,
                          normalise=normalise)
    store = spark.conf.get(STATE_STORE, None)
    with session_conf(spark, STATE_STORE, DEFAULT_CONF[STATE_STORE] if repeatable or not store else store):  # timers need RocksDB
        return CL.start(pairs, run, checkpoint, trigger_seconds, available_now, state_partitions=state_partitions)
