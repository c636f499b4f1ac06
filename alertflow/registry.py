"""Driver-facing registry: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Each builds its input from the given tables (see ``alertflow.plans.standins``)
and runs the library operator over the *whole* table. Arrays are returned
exploded as ``(id, pos, value)``; floating results are rounded where two
engines may sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.functions import images as I
from alertflow.functions import metadata as M
from alertflow.functions.labels import map_label
from alertflow.functions.predictions import prediction_row, route_status
from alertflow.operators import cutouts as C
from alertflow.operators import dedup as D
from alertflow.operators import joins as J
from alertflow.operators import metrics as X
from alertflow.operators import ranking as R
from alertflow.operators.scaler import apply_scaler, fit_scaler
from alertflow.plans import standins as SI
from alertflow.session import scratch_path
from alertflow.sinks import writers as W
from alertflow.sources import alerts as SRC

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # streaming / ML / cutout keys live in their modules and register on import
    from alertflow.plans import registry_extra  # noqa: F401
    return dict(_REGISTRY)


def _t(spark, d, name):
    return SI.table(spark, d, name)


def _explode(df: DataFrame, id_col: str, arr: str, value: str = "value", to_double: bool = True) -> DataFrame:
    # posexplode_outer + explicit filter: Spark infers no size() filter for an
    # outer generator, so the array expression is not inlined and re-evaluated
    # below the Generate (which would recompute per-row image statistics).
    e = df.select(id_col, F.posexplode_outer(arr).alias("pos", value)).where(F.col("pos").isNotNull())
    if to_double:
        e = e.withColumn(value, F.col(value).cast("double"))
    return e.withColumn("pos", F.col("pos").cast("int"))


# ---------------------------------------------------------------- projections

def _metadata(alerts: DataFrame) -> DataFrame:
    return M.project_alerts(alerts.withColumnRenamed("candid", "alert_id"), keep=["alert_id"])


@query("metadata_defaults")
def q_metadata_defaults(spark, d):
    return _metadata(SI.alerts_from_events(_t(spark, d, "events")))


@query("scan_alerts")
def q_scan_alerts(spark, d):
    alerts = SI.alerts_from_events(_t(spark, d, "events")).drop("ts")
    path = scratch_path(spark, "alerts")
    # several files per folder, as alert folders have (split on write, no shuffle)
    alerts.write.mode("overwrite").option("maxRecordsPerFile", 2500).parquet(path)
    scanned = SRC.scan_alerts(spark, path, fmt="parquet", glob="*.parquet")
    return _metadata(scanned)


@query("flag_to_int")
def q_flag_to_int(spark, d):
    a = SI.alerts_from_events(_t(spark, d, "events"))
    return a.select(F.col("candid").alias("alert_id"), F.col("candidate.isdiffpos").alias("isdiffpos_raw"),
                    M.flag_to_int("candidate.isdiffpos").alias("isdiffpos"))


@query("approx_nondet")
def q_approx_nondet(spark, d):
    a = SI.alerts_from_events(_t(spark, d, "events"))
    return a.select(F.col("candid").alias("alert_id"),
                    F.col("candidate.ndethist").alias("ndethist"), F.col("candidate.ncovhist").alias("ncovhist"),
                    M.approx_nondet("candidate.ncovhist", "candidate.ndethist").alias("approx_nondet"))


@query("sentinel_fill")
def q_sentinel_fill(spark, d):
    v = _t(spark, d, "events")
    x = (F.when(F.col("event_id") % 7 == 0, F.lit(None))
         .when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    df = v.select("event_id", x.cast("double").alias("value"),
                  F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("user_id").cast("int")).alias("n"))
    return M.sentinel_fill(df, ["value", "n"])


@query("json_parse")
def q_json_parse(spark, d):
    v = _t(spark, d, "events")
    return v.select("event_id", M.parse_json("props", "k INT").getField("k").alias("k"))


@query("struct_expand")
def q_struct_expand(spark, d):
    v = _t(spark, d, "events")
    parsed = v.select("event_id", M.parse_json("props", "k INT, z STRING").alias("m"))
    return parsed.select("event_id", "m.*")


@query("message_cast")
def q_message_cast(spark, d):
    v = _t(spark, d, "events")
    msgs = v.select("event_id", F.encode(SI.object_key(), "UTF-8").alias("key"),
                    F.encode(F.col("props"), "UTF-8").alias("value"))
    return M.message_cast(msgs, keep=["event_id"])


@query("metadata_messages")
def q_metadata_messages(spark, d):
    meta = _metadata(SI.alerts_from_events(_t(spark, d, "events")))
    msgs = W.metadata_messages(meta)
    parsed = msgs.select("topic", F.col("key").cast("string").alias("object_id"),
                         M.parse_json(F.col("value").cast("string"), S.METADATA_SCHEMA).alias("m"))
    return parsed.select("topic", "object_id", *[f"m.{c}" for c in S.METADATA_COLUMNS])


@query("prediction_row")
def q_prediction_row(spark, d):
    e = _t(spark, d, "embeddings")
    df = e.select(F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("object_id"),
                  I.score_normalize(SI.scores()).alias("p"),
                  F.col("embedding")[5].cast("double").alias("ra"), F.col("embedding")[6].cast("double").alias("dec"),
                  F.lit(True).alias("image_ok"), F.lit(True).alias("meta_ok"))
    routed = route_status(df, "p", F.col("image_ok"), F.col("meta_ok"))
    out = prediction_row(routed, stamp=F.lit(None).cast("string"))
    return out.select(*[F.round(c, 6).alias(c) if c.startswith("prob_") or c == "confianza" else c
                        for c in out.columns])


@query("prob_columns")
def q_prob_columns(spark, d):
    e = _t(spark, d, "embeddings")
    df = e.select("vec_id", I.score_normalize(SI.scores()).alias("p"))
    df = df.select("vec_id", *I.prob_columns("p", S.CLASS_LABELS))
    return df.select("vec_id", *[F.round(c, 6).alias(c) for c in df.columns[1:]])


@query("batch_summary")
def q_batch_summary(spark, d):
    v = _t(spark, d, "events")
    g = X.batch_summary(v, F.to_date("ts").alias("day"), "user_id", F.col("value") >= 10)
    return g.withColumn("success_rate", F.round("success_rate", 6))


@query("feature_select")
def q_feature_select(spark, d):
    li = _t(spark, d, "lineitem")
    return M.select_features(li, SI.LINEITEM_FEATURES, keep=["l_orderkey"])


@query("feature_cast")
def q_feature_cast(spark, d):
    li = M.cast_features(_t(spark, d, "lineitem"), SI.LINEITEM_FEATURES, "float")
    return li.groupBy("l_returnflag").agg(*[F.round(F.sum(F.col(c).cast("double")), 2).alias(f"sum_{c}")
                                            for c in SI.LINEITEM_FEATURES])


# ---------------------------------------------------------------- labels / catalogue

def _catalog_via_csv(spark, d) -> DataFrame:
    cat = SI.catalog_from_labels(_t(spark, d, "labels"))
    path = scratch_path(spark, "catalog")
    cat.write.mode("overwrite").option("header", True).csv(path)
    return SRC.read_catalog(spark, path)


@query("label_catalog")
def q_label_catalog(spark, d):
    return _catalog_via_csv(spark, d)


@query("label_map")
def q_label_map(spark, d):
    cat = SI.catalog_from_labels(_t(spark, d, "labels"))
    return cat.groupBy(map_label("predicted_class").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("crossmatch")
def q_crossmatch(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("object_id"), "lang", "n_chars")
    labels = J.catalog_labels(SI.catalog_from_labels(_t(spark, d, "labels")))
    return J.crossmatch(docs, labels)


@query("value_counts")
def q_value_counts(spark, d):
    v = _t(spark, d, "events")
    v = v.withColumn("event_type", SI.null_when(F.col("event_id") % 10 == 0, F.col("event_type")))
    return X.value_counts(v, "event_type", out="n")


@query("label_index")
def q_label_index(spark, d):
    return X.label_index(_t(spark, d, "events"), "event_type")


@query("one_hot")
def q_one_hot(spark, d):
    v = _t(spark, d, "events")
    idx = X.label_index(v, "event_type").checkpoint(eager=True)
    n = idx.count()  # the encoder's width: one output column a label
    # the size of the written index decides the join's strategy
    oh = v.join(idx, "event_type").select("event_id", I.one_hot("label_index", n).alias("oh"))
    return oh.select("event_id", *[F.col("oh")[i].alias(f"oh_{i}") for i in range(n)])


# ---------------------------------------------------------------- filters

@query("class_filter")
def q_class_filter(spark, d):
    return _t(spark, d, "events").where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query("anti_seen")
def q_anti_seen(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang")
    seen = _t(spark, d, "labels").select("doc_id")
    return J.anti_seen(docs, seen, "doc_id")


def _channels(spark, d) -> DataFrame:
    e = _t(spark, d, "embeddings")
    vid = F.col("vec_id")
    return e.select("vec_id", "label",
                    SI.null_when(vid % 5 == 0, SI.channel(0)).alias("sci"),
                    SI.null_when(vid % 7 == 0, SI.channel(1)).alias("ref"),
                    SI.null_when(vid % 11 == 0, SI.channel(2)).alias("diff"))


@query("all_channels_valid")
def q_all_channels_valid(spark, d):
    return C.valid_alerts(_channels(spark, d), ["sci", "ref", "diff"]).select("vec_id", "label")


@query("reject_report")
def q_reject_report(spark, d):
    c = _channels(spark, d)
    named = c.select("vec_id", *[F.when(F.col(col).isNull(), F.lit("empty")).otherwise(F.lit("ok")).alias(f"{name}_status")
                                 for name, col in zip(S.CUTOUT_CHANNELS, ["sci", "ref", "diff"])])
    return C.reject_report(named).select("channel", F.col("n").alias("n_invalid"))


@query("shape_check")
def q_shape_check(spark, d):
    e = _t(spark, d, "embeddings")
    arr = F.when(F.col("vec_id") % 13 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    df = e.select("vec_id", arr.alias("img"))
    return df.select("vec_id", F.size("img").alias("n_values"),
                     (F.size("img") == SI.IMG_H * SI.IMG_W).alias("valid"))


@query("status_routing")
def q_status_routing(spark, d):
    e = _t(spark, d, "embeddings")
    vid = F.col("vec_id")
    p = F.when(vid % 29 == 0, F.array(*[F.lit(float("nan"))] * SI.N_SCORES)).otherwise(I.score_normalize(SI.scores()))
    df = e.select("vec_id", p.alias("p"))
    r = route_status(df, "p", ~(vid % 17 == 0), ~(vid % 19 == 0), failed=vid % 23 == 0)
    return r.select("vec_id", "clase_predicha", F.round("confianza", 6).alias("confianza"),
                    *[F.round(f"prob_{c}", 6).alias(f"prob_{c}") for c in S.CLASS_LABELS],
                    "image_processed", "metadata_processed")


# ---------------------------------------------------------------- scaler

@query("scaler_fit")
def q_scaler_fit(spark, d):
    st = fit_scaler(_t(spark, d, "lineitem"), SI.LINEITEM_FEATURES)
    return st.select(*[F.round(c, 4).alias(c) for c in st.columns])


@query("scaler_apply")
def q_scaler_apply(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", *SI.LINEITEM_FEATURES)
    st = fit_scaler(li, SI.LINEITEM_FEATURES)
    z = apply_scaler(li, st, SI.LINEITEM_FEATURES, suffix="_z")
    return z.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_z", 4).alias(f"{c}_z") for c in SI.LINEITEM_FEATURES])


# ---------------------------------------------------------------- metrics

def _predictions(spark, d) -> DataFrame:
    e = _t(spark, d, "embeddings")
    return e.select("vec_id", F.col("label").alias("true_label"), I.argmax(SI.class_sums()).alias("pred_label"))


@query("confusion_matrix")
def q_confusion_matrix(spark, d):
    return X.confusion_matrix(_predictions(spark, d), "true_label", "pred_label", list(range(SI.N_CLASSES)))


@query("classification_report")
def q_classification_report(spark, d):
    r = X.classification_report(_predictions(spark, d), "true_label", "pred_label", list(range(SI.N_CLASSES)))
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("top_confusions")
def q_top_confusions(spark, d):
    return X.top_confusions(_predictions(spark, d), "true_label", "pred_label", 5)


@query("distinct_objects")
def q_distinct_objects(spark, d):
    return X.distinct_objects(_t(spark, d, "events"), "user_id")


@query("dataset_shape")
def q_dataset_shape(spark, d):
    return X.dataset_shape(_t(spark, d, "events"))


# ---------------------------------------------------------------- dedup

@query("dedup_batch")
def q_dedup_batch(spark, d):
    v = _t(spark, d, "events").select("user_id", "ts", "event_id", "value")
    return D.first_per_key(v, ["user_id"], ["ts", "event_id"])


@query("dedup_first")
def q_dedup_first(spark, d):
    v = _t(spark, d, "events").select("user_id", "ts", "event_id", (F.col("event_id") % 3).cast("int").alias("folder_rank"))
    return D.first_per_key(v, ["user_id"], ["folder_rank", "ts", "event_id"]).select("user_id", "folder_rank", "event_id")


@query("dedup_last")
def q_dedup_last(spark, d):
    v = _t(spark, d, "events").select("user_id", "ts", "event_id", (F.col("event_id") % 3).cast("int").alias("folder_rank"))
    return D.last_per_key(v, ["folder_rank", "user_id"], ["ts", "event_id"]).select("folder_rank", "user_id", "event_id")


# ---------------------------------------------------------------- sort / sampling

@query("head_k")
def q_head_k(spark, d):
    return _t(spark, d, "events").orderBy("ts", "event_id").limit(5).select("event_id", "ts", "user_id")


def _shuffled(spark, d) -> DataFrame:
    v = _t(spark, d, "events").select("event_id", "event_type")
    return R.shuffle_positions(v, "event_id")


@query("shuffle_rows")
def q_shuffle_rows(spark, d):
    return _shuffled(spark, d).select("event_id", "position")


@query("example_lookup")
def q_example_lookup(spark, d):
    v = _t(spark, d, "events").select("event_id", "event_type")
    return R.row_at(v, "event_id", 9).select("event_id", "event_type", "position")


@query("minibatch")
def q_minibatch(spark, d):
    s = _shuffled(spark, d)
    return s.groupBy(R.minibatch("position").alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))


@query("balance_sample")
def q_balance_sample(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", "label")
    smallest = e.groupBy("label").count().agg(F.min("count")).first()[0]
    return R.balance_sample(e, "vec_id", "label", max(1, smallest // 2))


def _split(spark, d) -> DataFrame:
    e = _t(spark, d, "embeddings").select("vec_id", "label")
    return R.stratified_split(e, "vec_id", "label")


@query("stratified_split")
def q_stratified_split(spark, d):
    return _split(spark, d)


@query("concat_splits")
def q_concat_splits(spark, d):
    s = _split(spark, d).checkpoint(eager=True)  # split once; the three parts read it
    parts = [s.where(F.col("split") == n) for n in ("train", "validation", "test")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- arrays

def _emb(spark, d) -> DataFrame:
    return _t(spark, d, "embeddings").select("vec_id", "embedding")


@query("center_crop")
def q_center_crop(spark, d):
    df = _emb(spark, d).select("vec_id", I.center_crop("embedding", SI.IMG_H, SI.IMG_W, 4).alias("img"))
    return _explode(df, "vec_id", "img")


def _with_bad_pixels(spark, d) -> DataFrame:
    e = _emb(spark, d)
    vid = F.col("vec_id")
    img = F.transform("embedding", lambda x, i: F.when(i == vid % 64, F.lit(float("nan")))
                      .when(i == (vid + 1) % 64, F.lit(float("inf")))
                      .when(i == (vid + 2) % 64, F.lit(float("-inf"))).otherwise(x).cast("float"))
    return e.select("vec_id", img.alias("img"))


@query("pixel_clean")
def q_pixel_clean(spark, d):
    df = _with_bad_pixels(spark, d).select("vec_id", I.pixel_clean("img").alias("img"))
    return _explode(df, "vec_id", "img")


@query("stack_channels")
def q_stack_channels(spark, d):
    e = _emb(spark, d)
    df = e.select("vec_id", I.stack_channels(SI.channel(0), SI.channel(1), SI.channel(2)).alias("img"))
    return _explode(df, "vec_id", "img")


@query("chw_to_hwc")
def q_chw_to_hwc(spark, d):
    df = _emb(spark, d).select("vec_id", I.chw_to_hwc(SI.cube(), SI.CUBE_C, SI.CUBE_H, SI.CUBE_W).alias("img"))
    return _explode(df, "vec_id", "img")


@query("image_roundtrip")
def q_image_roundtrip(spark, d):
    e = _emb(spark, d).select("vec_id", I.chw_to_hwc(SI.cube(), SI.CUBE_C, SI.CUBE_H, SI.CUBE_W).alias("hwc"))
    back = I.unpack_float32(I.pack_float32(e, "hwc", "bytes").drop("hwc"), "bytes", "hwc", SI.CUBE_VALUES)
    back = back.select("vec_id", I.hwc_to_chw("hwc", SI.CUBE_C, SI.CUBE_H, SI.CUBE_W).alias("img"))
    return _explode(back, "vec_id", "img")


@query("image_messages")
def q_image_messages(spark, d):
    e = _emb(spark, d).select(F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("object_id"),
                              I.chw_to_hwc(SI.cube(), SI.CUBE_C, SI.CUBE_H, SI.CUBE_W).alias("hwc"))
    m = W.image_messages(e, "object_id", "hwc")
    back = I.unpack_float32(m.select("topic", F.col("key").cast("string").alias("object_id"), "value"), "value", "img", SI.CUBE_VALUES)
    return (back.select("topic", "object_id", F.posexplode_outer("img").alias("pos", "value")).where(F.col("pos").isNotNull())
            .select("topic", "object_id", F.col("pos").cast("int").alias("pos"), F.col("value").cast("double").alias("value")))


def _flat_channel_cube(spark, d) -> DataFrame:
    """HWC cube; every 10th image has a flat reference channel (all 0.5)."""
    e = _emb(spark, d)
    flat = F.array_repeat(F.lit(0.5).cast("float"), SI.CUBE_H * SI.CUBE_W)
    ref = F.when(F.col("vec_id") % 10 == 0, flat).otherwise(SI.channel(1))
    chw = I.stack_channels(SI.channel(0), ref, SI.channel(2))
    return e.select("vec_id", I.chw_to_hwc(chw, SI.CUBE_C, SI.CUBE_H, SI.CUBE_W).alias("img"))


@query("minmax_channel")
def q_minmax_channel(spark, d):
    df = I.minmax_channel(_flat_channel_cube(spark, d), "img", "norm", SI.CUBE_C, layout="hwc",
                          size=SI.CUBE_VALUES)
    out = _explode(df.select("vec_id", "norm"), "vec_id", "norm")
    return out.withColumn("value", F.round("value", 6))


@query("minmax_cube")
def q_minmax_cube(spark, d):
    df = I.minmax_cube(_emb(spark, d).select("vec_id", SI.cube().alias("img")), "img", "norm")
    out = _explode(df.select("vec_id", "norm"), "vec_id", "norm")
    return out.withColumn("value", F.round("value", 4))


@query("rescale")
def q_rescale(spark, d):
    df = _emb(spark, d).select("vec_id", I.rescale("embedding").alias("img"))
    return _explode(df, "vec_id", "img")


@query("zero_pad")
def q_zero_pad(spark, d):
    df = _emb(spark, d).select("vec_id", I.zero_pad("embedding", SI.IMG_H, SI.IMG_W, 3).alias("img"))
    return _explode(df, "vec_id", "img")


@query("rotations")
def q_rotations(spark, d):
    df = _emb(spark, d).select("vec_id", F.inline(I.rotations("embedding", SI.IMG_H, SI.IMG_W)))
    return df.select("vec_id", "k", F.posexplode_outer("image").alias("pos", "value")).where(F.col("pos").isNotNull()) \
             .select("vec_id", "k", F.col("pos").cast("int").alias("pos"), F.col("value").cast("double").alias("value"))


@query("image_range")
def q_image_range(spark, d):
    e = _emb(spark, d)
    return e.select("vec_id", I.image_min("embedding").cast("double").alias("min_value"),
                    I.image_max("embedding").cast("double").alias("max_value"))


@query("argmax_label")
def q_argmax_label(spark, d):
    e = _emb(spark, d).select("vec_id", SI.scores().alias("p"))
    return e.select("vec_id", I.argmax_label("p", S.CLASS_LABELS).alias("clase_predicha"),
                    I.confidence("p").alias("confianza"))


@query("score_normalize")
def q_score_normalize(spark, d):
    df = _emb(spark, d).select("vec_id", I.score_normalize(SI.scores()).alias("p"))
    return _explode(df, "vec_id", "p").withColumn("value", F.round("value", 6))


@query("feature_fuse")
def q_feature_fuse(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", "label", SI.cube().alias("img"))
    return _explode(e.select("vec_id", I.feature_fuse("img", ["label", "vec_id"]).alias("features")), "vec_id", "features")


# ---------------------------------------------------------------- sources / sinks (write + read back)

def _events_by_folder(spark, d) -> list[str]:
    v = _t(spark, d, "events")
    base = scratch_path(spark, "folders")
    paths = []
    for i in range(3):
        p = f"{base}/folder_{i}"
        v.where(F.col("event_id") % 3 == i).write.mode("overwrite").parquet(p)
        paths.append(p)
    return paths


@query("load_folders")
def q_load_folders(spark, d):
    df = SRC.load_folders(spark, _events_by_folder(spark, d))
    return df.groupBy("folder_rank").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("sum_value"))


def _by_class_root(spark, d) -> str:
    v = _t(spark, d, "events").select("event_id", "user_id", "value", "event_type")
    root = scratch_path(spark, "by_class")
    return W.write_by_class(v, root, "event_type")


@query("read_class_partition")
def q_read_class_partition(spark, d):
    df = SRC.read_class_partition(spark, _by_class_root(spark, d), "event_type", ["purchase"])
    return df.select("event_id", "user_id", "value", "event_type")


@query("write_by_class")
def q_write_by_class(spark, d):
    df = SRC.read_class_partition(spark, _by_class_root(spark, d), "event_type")
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("dataset_roundtrip")
def q_dataset_roundtrip(spark, d):
    e = _t(spark, d, "embeddings")
    path = W.write_dataset(e, scratch_path(spark, "dataset"))
    back = spark.read.parquet(path).select("vec_id", "label", F.posexplode("embedding").alias("pos", "value"))
    return back.withColumns({"pos": F.col("pos").cast("int"), "value": F.col("value").cast("double")})
