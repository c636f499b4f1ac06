"""Registry entries for streaming, model, cutout and CSV keys.

Streaming keys run a real Structured Streaming query over file twins of the
topics (``availableNow``: every file, several micro-batches, checkpointed),
into a Parquet sink under the shared folder, and return a batch read of it.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.functions import images as I
from alertflow.functions import metadata as M
from alertflow.functions.labels import map_label
from alertflow.functions.metadata import parse_json
from alertflow.functions.predictions import prediction_row, route_status
from alertflow.operators import cutouts as C
from alertflow.operators import fused as FU
from alertflow.operators import joins as J
from alertflow.operators import model as ML
from alertflow.operators import pipeline as PL
from alertflow.operators import ranking as R
from alertflow.operators import training as TR
from alertflow.operators.scaler import fit_scaler
from alertflow.plans import prepare as P
from alertflow.plans import producer as PR
from alertflow.plans import standins as SI
from alertflow.plans.stamps import stamp_bytes
from alertflow.registry import _events_by_folder, _explode, _t, query
from alertflow.session import DEFAULT_CONF, STATE_STORE, default_state_partitions, scratch_path, session_conf, shuffle_partitions
from alertflow.sources import alerts as SRC
from alertflow.sources import containers as CT
from alertflow.sources.alerts import read_predictions
from alertflow.sinks import bucketed as BK
from alertflow.sinks import writers as W
from alertflow.sinks.committed import read_committed
from alertflow.streaming import classify as CL
from alertflow.streaming import sources as SS
from alertflow.streaming.firstseen import first_seen
from alertflow.streaming.progress import ProgressLog, lifetime_totals, state_keys
from alertflow.streaming.stateful import dedup_stream, join_streams


def _run_to_parquet(stream: DataFrame, name: str, spark: SparkSession) -> DataFrame:
    base = scratch_path(spark, name)
    w = (stream.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").outputMode("append")
         .trigger(availableNow=True))
    with shuffle_partitions(spark, default_state_partitions(spark)):
        q = w.start()
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")


def _file_twin(df: DataFrame, spark: SparkSession, name: str, slices: int = 4, order: str = "ts") -> tuple[str, int]:
    """Folder of a file twin, and how many files one time slice has."""
    path = scratch_path(spark, name)
    return path, SS.write_time_ordered(df, path, slices, order)


def _cores(spark) -> int:
    return default_state_partitions(spark)


# Rows that carry an image, in one task: about 50 MB.
IMAGE_ROWS = 50_000


def _image_tasks(spark, n: int) -> int:
    """Tasks for ``n`` rows that carry images: one a core, and more as the rows grow."""
    return max(_cores(spark), -(-n // IMAGE_ROWS))


def _events_ts(spark, d) -> DataFrame:
    # streaming watermarks need TIMESTAMP (with zone); the tables hold TIMESTAMP_NTZ
    return _t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_source")
def q_stream_source(spark, d):
    v = _events_ts(spark, d)
    msgs = v.select(F.encode(SI.object_key(), "UTF-8").alias("key"), F.encode("props", "UTF-8").alias("value"),
                    F.lit(S.METADATA_TOPIC).alias("topic"), F.col("ts").alias("timestamp"))
    path, files = _file_twin(msgs, spark, "topic_twin", order="timestamp")
    raw = SS.message_stream(spark, S.METADATA_TOPIC, path=path, max_per_trigger=files)
    parsed = raw.select(F.col("key").cast("string").alias("object_id"),
                        parse_json(F.col("value").cast("string"), "k INT").getField("k").alias("k"))
    return _run_to_parquet(parsed, "stream_source", spark)


@query("stream_join")
def q_stream_join(spark, d):
    v = _events_ts(spark, d).select(F.col("event_id").alias("alert_id"), SI.object_key().alias("object_id"),
                                    "value", "props", "ts")
    # one time-ordered file set read as two streams: both sides advance
    # together, so no record arrives behind the watermark
    path, files = _file_twin(v, spark, "join_twin")
    schema = spark.read.parquet(path).schema

    def side():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    ls = side().select("alert_id", "object_id", "value", F.col("ts").alias("meta_time"))
    rs = side().select("alert_id", "object_id", "props", F.col("ts").alias("image_time"))
    j = join_streams(ls, rs, ["object_id", "alert_id"], "meta_time", "image_time", watermark="1 hour", bound="1 hour")
    out = _run_to_parquet(j.select("alert_id", "object_id", "value", "props"), "stream_join", spark)
    return out


@query("stream_dedup")
def q_stream_dedup(spark, d):
    v = _events_ts(spark, d).select(SI.object_key().alias("object_id"), "event_id", "ts")
    path, files = _file_twin(v, spark, "dedup_twin")
    s = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)
    out = _run_to_parquet(dedup_stream(s, ["object_id"]).select("object_id"), "stream_dedup", spark)
    return out


def shuffled_twin(rows: DataFrame, key: str, time_col: str, name: str, files: int) -> tuple[str, float]:
    """File twin whose files hold events of any time, closed by a heartbeat behind them; and the events' span in seconds."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    dealt = rows.withColumn("_file", F.pmod(F.xxhash64(*rows.columns), F.lit(files)))
    ends = rows.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).first()
    span = (ends["hi"] - ends["lo"]).total_seconds() if ends["lo"] else 0.0
    dealt.repartition(files, "_file").drop("_file").write.parquet(path)
    beat = rows.agg(F.max(time_col).alias("hi")).select(*[
        (F.col("hi") + F.make_dt_interval(secs=F.lit(2 * span + 86400.0))).cast(f.dataType).alias(f.name) if f.name == time_col
        else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    beat.write.mode("append").parquet(path)
    return path, span


@query("stream_first_seen")
def q_stream_first_seen(spark, d):
    """The earliest event of each object, whole, from files in no order of time."""
    v = _events_ts(spark, d).select(SI.object_key().alias("object_id"), "event_id", "ts", "event_type", "value")
    path, span = shuffled_twin(v, "object_id", "ts", "first_seen_twin", 8)
    s = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 4).parquet(path)
    out = first_seen(s, "object_id", "ts", f"{int(span) + 1} seconds", ["event_id"])
    with session_conf(spark, STATE_STORE, DEFAULT_CONF[STATE_STORE]):  # timers need the RocksDB store
        return _run_to_parquet(out.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "stream_first_seen", spark)


# ---------------------------------------------------------------- classifier stand-in

_STREAM_SHAPE = (SI.CUBE_H, SI.CUBE_W, SI.CUBE_C)
_EVENT_CLASS = {"click": "AGN", "view": "QSO", "purchase": "VS", "signup": "YSO", "error": "Other"}


def _alert_rows(spark, d) -> DataFrame:
    """Per alert: metadata (23 columns), an HWC image derived from ``value``,
    a 5-class label from ``event_type``; every 17th object's images have a bad size."""
    v = _events_ts(spark, d)
    v = v.repartition(_image_tasks(spark, v.count()), "event_id")  # one-file table: spread the packing
    img = F.transform(F.sequence(F.lit(0), F.lit(SI.CUBE_VALUES - 1)),
                      lambda i: ((F.col("value") * (i + 1)) % F.lit(7.0)).cast("float"))
    lab = F.lit("Other")
    for t, c in _EVENT_CLASS.items():
        lab = F.when(F.col("event_type") == t, F.lit(c)).otherwise(lab)
    bad = (F.col("user_id") % 17 == 0).alias("bad")
    alerts = SI.alerts_from_events(v, extra=[img.alias("hwc"), lab.alias("label"), bad, SI.object_key().alias("key_id")])
    rows = M.project_alerts(alerts.withColumnRenamed("candid", "alert_id"), keep=["alert_id", "ts", "hwc", "label", "bad", "key_id"])
    # every alert keeps its object here, so each object's flags are known
    rows = rows.withColumn("object_id", F.col("key_id")).drop("key_id")
    packed = I.pack_float32(rows, "hwc", "image_data").drop("hwc")
    out = packed.withColumn("image_data", F.when(F.col("bad"), F.substring("image_data", 1, 100)).otherwise(F.col("image_data"))).drop("bad")
    # read by the scaler fit, the training and both topic twins: materialise
    # once in the shared folder (also cuts the lineage)
    return out.checkpoint(eager=True)


def _train_stream_model(spark, rows: DataFrame):
    stats = fit_scaler(M.sentinel_fill(rows, S.METADATA_COLUMNS), S.METADATA_COLUMNS).checkpoint(eager=True)
    prepared = CL.prepare(rows, stats, S.METADATA_COLUMNS, _STREAM_SHAPE)
    model = ML.train(prepared.where("image_processed"), "label", S.CLASS_LABELS, kind="lr", max_iter=20)
    return model, stats


@query("stream_classify")
def q_stream_classify(spark, d):
    rows = _alert_rows(spark, d)
    model, stats = _train_stream_model(spark, rows)
    meta_msgs = W.metadata_messages(rows, "object_id", S.METADATA_COLUMNS, time_col="ts")
    img_msgs = rows.select(F.encode("object_id", "UTF-8").alias("key"), F.col("image_data").alias("value"),
                           F.lit(S.IMAGE_TOPIC).alias("topic"), F.col("ts").alias("timestamp"))
    path = scratch_path(spark, "classify_topics")  # one folder per topic, as topics are separate logs
    n_meta = SS.write_message_twin(meta_msgs, f"{path}/{S.METADATA_TOPIC}", slices=2)
    n_img = SS.write_message_twin(img_msgs, f"{path}/{S.IMAGE_TOPIC}", slices=2, rows_per_file=IMAGE_ROWS)
    meta_s = SS.metadata_stream(SS.message_stream(spark, S.METADATA_TOPIC, path=f"{path}/{S.METADATA_TOPIC}",
                                                  max_per_trigger=n_meta))
    img_s = SS.image_stream(SS.message_stream(spark, S.IMAGE_TOPIC, path=f"{path}/{S.IMAGE_TOPIC}",
                                              max_per_trigger=n_img))
    # one prediction per object over the whole replay: the exact form
    joined = CL.first_pairs(meta_s, img_s, watermark=None, bound=None)
    out_root = scratch_path(spark, "predictions")
    run = CL.batch_writer(model, S.CLASS_LABELS, stats, out_root, S.METADATA_COLUMNS, _STREAM_SHAPE,
                          dedup_in_batch=False)
    # a batch holds half of the messages: as many state partitions as its images ask for
    q = CL.start(joined, run, f"{out_root}_checkpoint", available_now=True, state_partitions=_image_tasks(spark, -(-rows.count() // 2)))
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    got = read_predictions(spark, out_root)
    total = sum((F.col(f"prob_{c}") for c in S.CLASS_LABELS), F.lit(0.0))
    incomplete = F.col("clase_predicha") == S.INCOMPLETE_STATUS
    return got.select("object_id", "image_processed", "metadata_processed",
                      F.when(incomplete, S.INCOMPLETE_STATUS).otherwise("scored").alias("status"),
                      F.when(incomplete, total == 0).otherwise(F.abs(total - 1) < 1e-6).alias("probabilities_sum"))


@query("prediction_csv")
def q_prediction_csv(spark, d):
    e = _t(spark, d, "embeddings")
    df = e.select(F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("object_id"),
                  I.score_normalize(SI.scores()).alias("p"),
                  F.col("embedding")[5].cast("double").alias("ra"), F.col("embedding")[6].cast("double").alias("dec"))
    routed = route_status(df, "p", F.lit(True), F.lit(True))
    rows = prediction_row(routed, stamp=F.lit(None).cast("string"))
    rows = rows.select(*[F.round(c, 6).alias(c) if c.startswith("prob_") or c == "confianza" else c
                         for c in rows.columns])
    root = scratch_path(spark, "prediction_csv")
    W.write_predictions_csv(rows, root, 0)
    return read_predictions(spark, root)


# ---------------------------------------------------------------- cutouts

def _stamp(image, kind, factor: float = 1.0, shift: float = 0.0):
    return stamp_bytes(image, kind, F.lit(factor).cast("float"), F.lit(shift).cast("float"))


def _stamp_alerts(spark, d) -> DataFrame:
    e = _t(spark, d, "embeddings")
    vid = F.col("vec_id")
    sci_kind = F.when(vid % 17 == 0, "broken").when(vid % 23 == 0, "nan").otherwise("ok")
    diff_kind = F.when(vid % 19 == 0, "short").otherwise("ok")
    ok = F.lit("ok")
    return e.select(vid.alias("candid"),
                    F.struct(_stamp("embedding", sci_kind).alias("stampData")).alias("cutoutScience"),
                    F.struct(_stamp("embedding", ok, factor=-1.0).alias("stampData")).alias("cutoutTemplate"),
                    F.struct(_stamp("embedding", diff_kind, factor=2.0).alias("stampData")).alias("cutoutDifference"))


@query("cutout_ingest")
def q_cutout_ingest(spark, d):
    # the stand-in stamps are written once; the operator reads stored alerts
    stored = scratch_path(spark, "stamp_alerts")
    _stamp_alerts(spark, d).write.parquet(stored)
    alerts = spark.read.parquet(stored)
    decoded = C.ingest_cutouts(alerts, ["candid"], shape=(SI.IMG_H, SI.IMG_W), crop=4, crop_start=None)
    good = C.valid_alerts(decoded)
    cube = good.select(F.col("candid").alias("vec_id"),
                       I.stack_channels(*[F.col(c) for c in S.CUTOUT_CHANNELS]).alias("cube"))
    return _explode(cube, "vec_id", "cube")


# ---------------------------------------------------------------- containers

CONTAINER_ROWS, CONTAINER_BLOCK = 250, 100
_LONG, _REAL, _TEXT = ["null", "long"], ["null", "double"], ["null", "string"]
# three versions of one record: narrow numbers, a field more, a field less and another one more
CONTAINER_VERSIONS = [
    {"type": "record", "name": "Event", "fields": [{"name": "event_id", "type": "int"}, {"name": "value", "type": "float"},
                                                   {"name": "kind", "type": "string"}]},
    {"type": "record", "name": "Event", "fields": [{"name": "event_id", "type": "long"}, {"name": "value", "type": "double"},
                                                   {"name": "kind", "type": "string"}, {"name": "user_id", "type": _LONG}]},
    {"type": "record", "name": "Event", "fields": [{"name": "props", "type": _TEXT}, {"name": "event_id", "type": "long"},
                                                   {"name": "value", "type": _REAL}]}]


def _container_files(spark, d) -> DataFrame:
    """``events`` as containers of 250 records in three schema versions; some damaged by fixed rules on the file's number."""
    def pack(key, pdf):
        number = int(key[0])
        pdf = pdf.sort_values("event_id")
        schema = CONTAINER_VERSIONS[number % 3]
        raw = CT.container(schema, pdf.rename(columns={"event_type": "kind"}).to_dict("records"), block=CONTAINER_BLOCK)
        if number % 7 == 3:  # the payload of the second block, or of the only one
            _, codec, sync, at = CT.header(raw)
            starts = [a for a, _, _ in CT.blocks(raw, codec, sync, at)]
            hit = starts[min(1, len(starts) - 1)] + 8
            raw = raw[:hit] + b"\xff" * 8 + raw[hit + 8:]
        elif number % 7 == 5:
            raw = raw[:-10]
        elif number % 7 == 6:
            raw = b"junk" + raw
        return pd.DataFrame({"path": [f"part-{number:06d}.avro"], "content": [raw]})

    v = _t(spark, d, "events").withColumn("_file", F.floor(F.col("event_id") / CONTAINER_ROWS).cast("long"))
    path = scratch_path(spark, "container_files")
    v.drop("ts").groupBy("_file").applyInPandas(pack, "path string, content binary").write.parquet(path)
    return spark.read.schema("path string, content binary").parquet(path)


@query("container_records")
def q_container_records(spark, d):
    """Every record before the damage, under one schema resolved over the versions."""
    return CT.scan_containers(_container_files(spark, d))[0]


@query("container_rejects")
def q_container_rejects(spark, d):
    bad = CT.scan_containers(_container_files(spark, d))[1]
    return bad.select("path", "reason", (F.col("offset") > 0).alias("behind_start"), "n_rows")


# ---------------------------------------------------------------- train and score

@query("train_score")
def q_train_score(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("label"), "embedding")
    classes = [str(i) for i in range(SI.N_LABELS)]
    split = R.stratified_split(e, "vec_id", "label").checkpoint(eager=True)  # read twice below
    train = ML.augment_rotations(split.where(F.col("split") == "train"), "embedding", SI.IMG_H, SI.IMG_W)
    train = ML.assemble(train, "embedding", [])
    model = ML.train(train, "label", classes, kind="mlp", n_features=SI.IMG_H * SI.IMG_W, max_iter=30, hidden=(32,))
    test = ML.assemble(split.where(F.col("split") == "test"), "embedding", [])
    scored = ML.score(model, test)
    total = F.aggregate("probs", F.lit(0.0), lambda s, x: s + x)
    return scored.select("vec_id", "label", (F.abs(total - 1) < 1e-6).alias("probabilities_sum"),
                         I.argmax_label("probs", classes).isin(classes).alias("known_class"))


@query("fused_gradient")
def q_fused_gradient(spark, d):
    """One data-parallel gradient of the fused network where it is known in closed form:
    the metadata layer passes its inputs on, the layers around it are zero."""
    classes, meta = 5, 4
    shape = FU.Shape(side=SI.IMG_H, channels=1, meta=meta, classes=classes, pad=1, filters=2, image_units=3, meta_units=meta)
    told = F.transform(F.slice("embedding", 1, meta), lambda x: x.cast("double") + 1)
    rows = _t(spark, d, "embeddings").select(F.col("embedding").alias("image"), told.alias("meta"), (F.col("vec_id") % classes).cast("int").alias("label_idx"))
    flat = np.zeros(shape.start().size)
    shape.split(flat)["meta"][:] = np.eye(meta)
    total, loss, n = FU.summed_gradient(rows, shape, flat)
    out = shape.split(total)["out"][shape.image_units:]
    made = [(c, u, float(out[u, c]), loss / n, n) for c in range(classes) for u in range(meta)]
    return spark.createDataFrame(made, "class int, unit int, gradient double, loss double, n_rows long").withColumns(
        {"gradient": F.round("gradient", 6), "loss": F.round("loss", 6)})


@query("saved_pipeline")
def q_saved_pipeline(spark, d):
    """Scaler, normaliser and assembler fitted, saved, loaded, and applied: every feature of every row."""
    e = _t(spark, d, "embeddings").select("vec_id", "embedding", F.col("label").cast("double").alias("a"),
                                          SI.null_when(F.col("vec_id") % 7 == 0, F.col("vec_id").cast("double")).alias("b"))
    path = scratch_path(spark, "pipeline")
    PL.feature_pipeline("embedding", ["a", "b"]).fit(e).write().overwrite().save(path)
    made = PL.load_pipeline(path).transform(e)
    out = _explode(made.select("vec_id", vector_to_array("features").alias("features")), "vec_id", "features")
    return out.withColumn("value", F.round("value", 4))


# ---------------------------------------------------------------- id tables

BUCKETS = 8


def _id_table(spark, df: DataFrame, key: str) -> DataFrame:
    """``df`` as a table bucketed by ``key``, in two writes as it would grow."""
    name, path = f"ids_{uuid.uuid4().hex}", scratch_path(spark, "bucketed")
    half = F.pmod(F.xxhash64(key), F.lit(2))
    BK.save_bucketed(df.where(half == 0), name, [key], BUCKETS, path)
    BK.save_bucketed(df.where(half == 1), name, [key], BUCKETS, path, mode="append")
    return BK.read_bucketed(spark, name)


@query("unseen_bucketed")
def q_unseen_bucketed(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang")
    return BK.unseen(docs, _id_table(spark, _t(spark, d, "labels").select("doc_id"), "doc_id"), "doc_id")


@query("crossmatch_bucketed")
def q_crossmatch_bucketed(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("object_id"), "lang", "n_chars")
    catalog = _id_table(spark, SI.catalog_from_labels(_t(spark, d, "labels")), "oid")
    return J.crossmatch(_id_table(spark, docs, "object_id"), J.catalog_labels(catalog))


# ---------------------------------------------------------------- training watched by a validation split

WATCH_SETTINGS = {"patience": 3, "cut_patience": 2, "factor": 0.5, "step": 0.1, "min_step": 0.02, "min_delta": 0.25, "cut_delta": 1.0}


@query("watch_losses")
def q_watch_losses(spark, d):
    """Each user's events as one training: losses by time, some of them missing."""
    v = _t(spark, d, "events")
    epoch = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    losses = v.select("user_id", epoch.alias("epoch"), SI.null_when(F.col("event_id") % 11 == 0, F.col("value")).alias("loss"))
    return TR.watch_losses(losses, "user_id", "epoch", "loss", **WATCH_SETTINGS)


# ---------------------------------------------------------------- whole preparation flow

def _prep_balance(catalog: DataFrame) -> dict[str, int]:
    """A quarter of the catalogue's VS objects: the sample grows with the data."""
    n = catalog.where(map_label("predicted_class") == "VS").count()
    return {"VS": max(1, n // 4)}


def _prep_alerts(spark, d) -> DataFrame:
    """Alert records from ``events`` with three gzip-FITS 8x8 cutouts each,
    derived from ``value``; every 29th science stamp is broken gzip and every
    31st difference stamp has the wrong shape."""
    # the stand-in table is one small file (one scan split): spread the Python
    # stamp encoding over the cores (real alert folders arrive as many files)
    v = _t(spark, d, "events")
    v = v.repartition(_image_tasks(spark, v.count()), "event_id")
    made = F.transform(F.sequence(F.lit(0), F.lit(SI.IMG_H * SI.IMG_W - 1)),
                      lambda i: ((F.col("value") * (i + 1)) % F.lit(7.0)).cast("float"))
    v, eid = v.withColumn("_img", made), F.col("event_id")  # a column: made and sent once for the three
    sci = _stamp("_img", F.when(eid % 29 == 0, "broken").otherwise("ok"))
    ref = _stamp("_img", F.lit("ok"), factor=0.5)
    diff = _stamp("_img", F.when(eid % 31 == 0, "short").otherwise("ok"), shift=1.0)
    return SI.alerts_from_events(v, stamps=[sci, ref, diff])


def _prep_catalog(spark, d) -> DataFrame:
    """Label catalogue: one row per object seen in ``events``, raw class by ``user_id % 17``."""
    users = _t(spark, d, "events").select("user_id").distinct()
    classes = F.array(*[F.lit(c) for c in SI.RAW_CLASSES])
    return users.select(SI.object_key().alias("oid"),
                        F.get(classes, (F.col("user_id") % 17).cast("int")).alias("predicted_class"))


def _prep_dataset(spark, d) -> DataFrame:
    catalog = _prep_catalog(spark, d)
    stored = scratch_path(spark, "prep_alerts")
    _prep_alerts(spark, d).withColumn("folder_rank", (F.col("candid") % 3).cast("int")).write.parquet(stored)
    alerts = spark.read.parquet(stored)
    records = P.alert_records(alerts, shape=(SI.IMG_H, SI.IMG_W), crop=4, crop_start=None, catalog=catalog)
    return P.build_dataset(records, catalog, balance=_prep_balance(catalog))


@query("record_choice")
def q_record_choice(spark, d):
    """The last alert of each object in each of three folders, then the first folder's."""
    v = SRC.load_folders(spark, _events_by_folder(spark, d)).select(
        SI.object_key().alias("object_id"), "folder_rank", F.col("event_id").alias("alert_order"), "value")
    return P.one_record_per_object(v)


def _published(meta: DataFrame, img: DataFrame) -> DataFrame:
    """Both topics' messages, joined by alert: all fields, one row a pixel."""
    meta, img = SS.metadata_stream(meta).drop("meta_time"), SS.image_stream(img)
    pixels = I.unpack_float32(img.select(F.col("alert_id").alias("image_alert"), F.col("object_id").alias("image_object"), "image_data"),
                              "image_data", "img", 3 * 4 * 4).drop("image_data")
    # JSON and images are far smaller in their files than as rows: never broadcast by the files' size
    both = meta.join(pixels.hint("merge"), (F.col("alert_id") == F.col("image_alert")) & (F.col("object_id") == F.col("image_object")))
    out = both.select(F.col("alert_id").cast("long").alias("alert_id"), "object_id", *S.METADATA_COLUMNS,
                      F.posexplode_outer("img").alias("pos", "pixel"))
    return out.withColumns({"pos": F.col("pos").cast("int"), "pixel": F.round(F.col("pixel").cast("double"), 4)})


@query("producer_flow")
def q_producer_flow(spark, d):
    """Alert files -> cutouts and metadata -> both topic twins -> read back, all fields and values."""
    folder = scratch_path(spark, "alert_files")
    _prep_alerts(spark, d).drop("ts").write.parquet(folder)
    topics = scratch_path(spark, "producer_topics")
    PR.publish_alerts(spark, folder, fmt="parquet", metadata_path=f"{topics}/m", image_path=f"{topics}/i",
                      shape=(SI.IMG_H, SI.IMG_W), crop=4, crop_start=None)
    read = spark.read.schema(S.MESSAGE_SCHEMA_WITH_HEADERS)
    return _published(read.parquet(f"{topics}/m"), read.parquet(f"{topics}/i"))


@query("producer_stream")
def q_producer_stream(spark, d):
    """The same folder published as a stream, two triggers, each batch committed on both topics."""
    folder, root = scratch_path(spark, "alert_files"), scratch_path(spark, "producer_stream")
    alerts = _prep_alerts(spark, d).drop("ts")
    files = _image_tasks(spark, _t(spark, d, "events").count())  # one a task
    alerts.write.parquet(folder)
    stream = PR.alert_stream(spark, folder, fmt="parquet", max_files=-(-files // 2))
    q = PR.publish_alert_stream(stream, root, f"{root}/checkpoint", available_now=True, shape=(SI.IMG_H, SI.IMG_W), crop=4, crop_start=None)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return _published(*[read_committed(spark, f"{root}/{t}", S.MESSAGE_SCHEMA_WITH_HEADERS) for t in (S.METADATA_TOPIC, S.IMAGE_TOPIC)])


@query("stream_totals")
def q_stream_totals(spark, d):
    """Input rows and distinct ids over the whole life of a query: two runs, several batches each."""
    v = _events_ts(spark, d).select(SI.object_key().alias("object_id"), "event_id", "ts")
    path, log, base = scratch_path(spark, "totals_twin"), scratch_path(spark, "totals_log"), scratch_path(spark, "totals")
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for half in range(2):
            v.where(F.col("event_id") % 2 == half).repartition(3, "event_id").write.mode("append").parquet(path)
            s = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 1).parquet(path)
            with shuffle_partitions(spark, default_state_partitions(spark)):
                q = (dedup_stream(s, ["object_id"]).writeStream.format("parquet").option("path", f"{base}/out")
                     .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
            q.awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)  # reports come on the listener's thread
    finally:
        spark.streams.removeListener(listener)
    ids = state_keys(spark, f"{base}/checkpoint").agg(F.count_distinct("object_id").alias("objects"))
    return lifetime_totals(spark, log).select("runs", "input_rows").crossJoin(F.broadcast(ids))  # one row each


@query("prepare_dataset")
def q_prepare_dataset(spark, d):
    """Cutout ingest -> metadata -> first alert per object -> cross-match ->
    balance -> normalise -> written per class -> read back, every pixel compared."""
    ds = _prep_dataset(spark, d)
    root = P.save_dataset(ds, scratch_path(spark, "prepared"))
    back = spark.read.parquet(root).select("label", "object_id", F.round("ra", 6).alias("ra"), F.posexplode_outer("data").alias("pos", "value"))
    return back.select("label", "object_id", "ra", F.col("pos").cast("int").alias("pos"),
                       F.round(F.col("value").cast("double"), 4).alias("value"))


@query("train_evaluate")
def q_train_evaluate(spark, d):
    """The training flow on the prepared dataset: per-class split, train-split
    scaler, channel-last images with rotated views, MLP, test-split report."""
    ds = _prep_dataset(spark, d)
    res = P.train_and_evaluate(ds, (SI.CUBE_C, 4, 4), kind="mlp", max_iter=30, hidden=(32,))
    report = res["test_report"]
    rates = [F.col(c).between(0.0, 1.0) for c in ("precision", "recall", "f1")]
    return report.select("label", "support", (rates[0] & rates[1] & rates[2]).alias("rates_valid"))
