"""The streaming classifier: joined metadata+image stream -> prediction CSV.

Everything the source did in a driver-side row loop runs here as column
expressions on executors: unpack the image bytes, per-channel min-max, null/NaN
-> -999 on the metadata, scale with the *training* statistics (a 1-row
broadcast), score with the MLlib model, route the status and shape the
34-column row. Cross-batch dedup is Spark state (see ``stateful``), so it
survives restarts; each micro-batch is committed whole under its own ``batch_id``
folder, once.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.functions import images as I
from alertflow.functions.metadata import processing_stamp, sentinel_fill
from alertflow.functions.predictions import prediction_row, route_status
from alertflow.operators import model as ML
from alertflow.operators.scaler import apply_scaler
from alertflow.session import default_state_partitions, shuffle_partitions
from alertflow.sinks.committed import commit_batch, is_committed, manifest
from alertflow.sinks.writers import PREDICTION_CSV
from alertflow.streaming.firstseen import first_seen
from alertflow.streaming.stateful import dedup_stream, join_streams


# State is bounded by default: a pair arrives within the bound, a repeat within the watermark.
DEFAULT_WATERMARK = "1 day"
DEFAULT_BOUND = "1 hour"


def prepare(df: DataFrame, stats: DataFrame, meta_cols: list[str] = S.METADATA_COLUMNS,
            shape: tuple[int, int, int] = (S.CROP_SIZE, S.CROP_SIZE, 3),
            normalise: str = "channel") -> DataFrame:
    """Clean image + metadata and assemble ``features`` for every row.

    ``normalise`` is what the model was trained on: ``channel`` (min-max per
    channel) or ``cube`` (whole-cube min-max). Pixels are cleaned first.

    Rows whose image is missing or has the wrong size get zeros as features
    (so one pass scores the whole batch) and ``image_processed = false``;
    their scores are discarded by the status routing.
    """
    h, w, c = shape
    n = h * w * c
    x = I.unpack_float32(df, "image_data", "_raw", n).withColumn("_img", I.pixel_clean("_raw")).drop("_raw")
    if normalise == "cube":
        x = I.minmax_cube(x, "_img", "_norm")
    elif normalise == "channel":
        x = I.minmax_channel(x, "_img", "_norm", c, layout="hwc", size=n)
    else:
        raise ValueError(f"normalise {normalise!r}")
    meta_present = F.lit(False)
    for m in meta_cols:
        meta_present = meta_present | F.col(m).isNotNull()
    # validity from the byte length (JVM), not from the Python result: a later
    # filter on it is then pushed down without running the decoder twice
    ok_bytes = F.coalesce(F.length("image_data") == F.lit(4 * n), F.lit(False))
    x = x.withColumn("image_processed", ok_bytes).withColumn("metadata_processed", meta_present)
    x = x.withColumn("_norm", F.coalesce("_norm", F.array_repeat(F.lit(0.0), n)))
    # keep the raw metadata for the output row; scale a cleaned copy
    scaled_names = [f"_s_{m}" for m in meta_cols]
    x = x.select("*", *[F.col(m).alias(s) for m, s in zip(meta_cols, scaled_names)])
    x = sentinel_fill(x, scaled_names)
    st = stats.select(*[F.col(f"{k}_{m}").alias(f"{k}__s_{m}") for m in meta_cols for k in ("mean", "std")])
    x = apply_scaler(x, st, scaled_names, suffix="")
    return ML.assemble(x, "_norm", scaled_names).drop("_img", "_norm", *scaled_names)


def classify(df: DataFrame, model, classes: list[str], stats: DataFrame, meta_cols: list[str] = S.METADATA_COLUMNS,
             shape: tuple[int, int, int] = (S.CROP_SIZE, S.CROP_SIZE, 3), stamp=None,
             normalise: str = "channel") -> DataFrame:
    """Prediction rows (34 columns) for a batch of joined records.

    ``model`` is a fitted MLlib model, or any batch predictor
    ``predict(X) -> probabilities`` run through ``mapInPandas``.
    """
    prepared = prepare(df, stats, meta_cols, shape, normalise)
    if hasattr(model, "transform"):
        scored = ML.score(model, prepared)
    else:
        from pyspark.ml.functions import vector_to_array
        arr = prepared.withColumn("features_arr", vector_to_array("features")).drop("features")
        scored = ML.score_with_function(arr, model, len(classes)).drop("features_arr")
    routed = route_status(scored, "probs", F.col("image_processed"), F.col("metadata_processed"), classes)
    return prediction_row(routed, stamp=stamp if stamp is not None else processing_stamp())


def first_of_batch(batch: DataFrame) -> DataFrame:
    """One row per object: the first by event time and alert id where present, then by content.

    The same row on every replay. The rank is cut to one row a task before the
    shuffle, so a hot object reaches its task as one row per input task.
    """
    order = [c for c in ("meta_time", "image_time", "alert_id") if c in batch.columns]
    w = Window.partitionBy("object_id").orderBy(*order, F.xxhash64(*batch.columns))
    return batch.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


SUMMARY_SCHEMA = "input_rows long, new_objects long, rows_written long, scored long, success_rate double"


def read_summaries(spark, out_root: str) -> DataFrame:
    """Per-batch summaries committed by :func:`batch_writer`, with running totals
    (one row per micro-batch: a small table, ordered by batch)."""
    df = manifest(spark, out_root, SUMMARY_SCHEMA + ", batch_id long")
    w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({"total_objects": F.sum("new_objects").over(w), "total_input": F.sum("input_rows").over(w)}).orderBy("batch_id")


def batch_writer(model, classes: list[str], stats: DataFrame, out_root: str,
                 meta_cols: list[str] = S.METADATA_COLUMNS,
                 shape: tuple[int, int, int] = (S.CROP_SIZE, S.CROP_SIZE, 3), dedup_in_batch: bool = True,
                 normalise: str = "channel"):
    """``foreachBatch`` callback: skip empty batches, dedup inside the batch
    (not needed after :func:`first_pairs`, which already emits one pair per
    object), classify, commit ``batch_id=<n>/`` with its summary (``sinks.committed``:
    a reader never sees part of a batch, a replay of a committed batch changes
    nothing). The micro-batch is persisted for the emptiness check and the
    write, so the stateful plan runs once. Errors propagate: the batch fails
    and is retried, nothing is lost."""
    from pyspark import StorageLevel
    from pyspark.sql import Observation

    def run(batch: DataFrame, batch_id: int) -> None:
        if is_committed(batch.sparkSession, out_root, batch_id):
            return
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            _write(batch, batch_id)
        finally:
            batch.unpersist()

    def _write(batch: DataFrame, batch_id: int) -> None:
        # what comes in, what is one row an object, what is written: gathered by the one job that writes
        came = Observation(f"input_{batch_id}")
        batch = batch.observe(came, F.count(F.lit(1)).alias("input_rows"))
        one = first_of_batch(batch) if dedup_in_batch else batch
        preds = classify(one, model, classes, stats, meta_cols, shape, normalise=normalise)
        obs = Observation(f"batch_{batch_id}")
        ok = (~F.col("clase_predicha").isin(S.INCOMPLETE_STATUS, S.ERROR_STATUS)).cast("long")
        preds = preds.observe(obs, F.count(F.lit(1)).alias("rows_written"), F.sum(ok).alias("scored"))

        def summary() -> dict:
            n, scored = int(obs.get.get("rows_written") or 0), int(obs.get.get("scored") or 0)
            return {"input_rows": int(came.get.get("input_rows") or 0), "new_objects": n, "rows_written": n,
                    "scored": scored, "success_rate": 100.0 * scored / max(n, 1)}

        commit_batch(preds.select(*S.PREDICTION_HEADER), out_root, batch_id, "csv", PREDICTION_CSV, summary)
        run.summaries.append({"batch_id": batch_id, **summary()})  # the last few, for logs; bounded for 24/7 runs
    run.summaries = deque(maxlen=100)
    return run


def first_pairs(meta: DataFrame, images: DataFrame, keys: list[str] = ("object_id",),
                watermark: str | None = DEFAULT_WATERMARK, bound: str | None = DEFAULT_BOUND,
                meta_time: str = "meta_time", image_time: str = "image_time", repeatable: bool = False) -> DataFrame:
    """One (metadata, image) pair per object: the first one seen.

    ``keys=("object_id",)`` (messages keyed by object only): each side is
    deduplicated *before* the join (first-seen wins, state in the store), so
    the join holds at most one row per object per side and emits at most one
    pair per object -- an object with a million alerts costs one state entry,
    never a million-squared pairs. Equivalent to the source's join +
    per-batch dedup + processed-id filter (one pair per object).

    ``keys=("object_id", "alert_id")`` (alert id in a message header): the
    metadata and the image *of the same alert* are joined first (one row per
    alert, no cross pairs), then the first pair per object is kept. Give a
    ``watermark`` and ``bound`` here: join state is per alert.

    With ``watermark`` and ``bound`` (the defaults) state is evicted once the
    watermark passes; an object seen again after eviction is classified again,
    and a partner arriving more than ``bound`` away from the other side is not
    paired. ``watermark=None, bound=None`` is the exact form: the dedup ids and
    the joined rows, image bytes included, stay as long as the query lives (like
    the source's in-memory id set), about 5.5 KB an object at the full image size.

    ``repeatable`` (messages keyed by object) pairs the earliest metadata with the
    earliest image by event time (``firstseen``): the same pairs however the stream
    is cut into batches. A row waits until the watermark has passed it, and the
    state stays as in the exact form.
    """
    keys = list(keys)
    obj = ["object_id"]
    if repeatable:
        if keys != obj:
            raise ValueError("repeatable pairs are keyed by the object alone")
        late = watermark or DEFAULT_WATERMARK
        return join_streams(first_seen(images, "object_id", image_time, late), first_seen(meta, "object_id", meta_time, late), obj).drop(meta_time)
    if watermark:
        meta = meta.withWatermark(meta_time, watermark)
        images = images.withWatermark(image_time, watermark)

    def dedup(df: DataFrame, k: list[str]) -> DataFrame:
        return df.dropDuplicatesWithinWatermark(k) if watermark else df.dropDuplicates(k)

    if keys == obj:
        m, i = dedup(meta, obj), dedup(images, obj)
        if bound and watermark:
            return join_streams(i, m, obj, image_time, meta_time, None, bound).drop(meta_time)
        return join_streams(i, m.drop(meta_time), obj)
    pairs = join_streams(images, meta, keys, image_time, meta_time, None, bound).drop(meta_time)
    return dedup(pairs, obj)


def start(joined: DataFrame, run, checkpoint: str, trigger_seconds: int | None = 15,
          available_now: bool = False, name: str | None = None, state_partitions: int | None = None):
    """Start the micro-batch query (append mode, checkpointed).

    ``state_partitions`` (default: one per core) is fixed into the checkpoint
    at the first start; later restarts keep it.
    """
    spark = joined.sparkSession
    n = state_partitions or default_state_partitions(spark)
    w = joined.writeStream.foreachBatch(run).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    with shuffle_partitions(spark, n):
        return w.start()


def run_until_stopped(query, timeout_s: float | None = None) -> dict:
    """Block until the query ends (or ``timeout_s``), stop it, return its last progress."""
    try:
        query.awaitTermination(timeout_s)
    finally:
        last = query.lastProgress
        query.stop()
    return last or {}


def progress_totals(query) -> dict:
    """Totals over the query's retained progress reports: micro-batches,
    input rows, and input rows per second of processing."""
    prog = query.recentProgress or []
    rows = sum(int(p.get("numInputRows", 0)) for p in prog)
    ms = sum(int((p.get("durationMs") or {}).get("triggerExecution", 0)) for p in prog)
    return {"batches": len(prog), "input_rows": rows, "rows_per_sec": rows / (ms / 1000) if ms else None}
