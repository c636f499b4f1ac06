"""Stream = batch, across several triggers and a restart from the checkpoint."""
import os
import uuid

import numpy as np
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.session import scratch_path
from alertflow.streaming import classify as CL
from alertflow.streaming import sources as SS
from alertflow.streaming.stateful import dedup_stream, join_streams
from tests.conftest import SF_SMALL


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _messages(df, topic):
    return df.select(F.encode(F.concat(F.lit("obj_"), F.col("user_id").cast("string")), "UTF-8").alias("key"),
                     F.encode("props", "UTF-8").alias("value"), F.lit(topic).alias("topic"),
                     F.col("ts").alias("timestamp"))


def _run(stream, out, ckpt):
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None


def test_dedup_survives_restart(spark):
    ev = _events(spark)
    half = ev.agg(F.expr("percentile_approx(unix_timestamp(ts), 0.5)")).first()[0]
    first, second = ev.where(F.unix_timestamp("ts") <= half), ev.where(F.unix_timestamp("ts") > half)
    topic = scratch_path(spark, "t_topic")
    out, ckpt = scratch_path(spark, "t_out"), scratch_path(spark, "t_ckpt")
    SS.write_message_twin(_messages(first, "Metadata"), topic, slices=3)

    def stream():
        raw = SS.message_stream(spark, "Metadata", path=topic, max_per_trigger=1)
        return dedup_stream(raw.select(F.col("key").cast("string").alias("object_id")), ["object_id"])
    _run(stream(), out, ckpt)
    n1 = spark.read.parquet(out).count()
    SS.write_message_twin(_messages(second, "Metadata"), topic, slices=3)
    _run(stream(), out, ckpt)  # restart from the checkpoint
    got = spark.read.parquet(out)
    assert got.count() == got.distinct().count()  # no object emitted twice across restarts
    assert got.count() == ev.select("user_id").distinct().count()
    assert n1 == first.select("user_id").distinct().count()


def test_join_with_watermark_equals_batch(spark):
    ev = _events(spark).select(F.col("event_id").alias("alert_id"),
                               F.concat(F.lit("obj_"), F.col("user_id").cast("string")).alias("object_id"),
                               "value", "props", "ts")
    path = scratch_path(spark, "t_join")
    SS.write_time_ordered(ev, path, slices=4, order_col="ts")
    schema = spark.read.parquet(path).schema

    def side():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    left = side().select("alert_id", "object_id", "value", F.col("ts").alias("lt"))
    right = side().select("alert_id", "object_id", "props", F.col("ts").alias("rt"))
    j = join_streams(left, right, ["object_id", "alert_id"], "lt", "rt", watermark="1 hour", bound="1 hour")
    out = scratch_path(spark, "t_join_out")
    _run(j.select("alert_id", "object_id", "value", "props"), out, scratch_path(spark, "t_join_ckpt"))
    assert sorted(spark.read.parquet(out).collect()) == sorted(ev.select("alert_id", "object_id", "value", "props").collect())


def test_object_join_pairs_every_alert_of_an_object(spark):
    # the source join: key = object only -> n x m pairs per object (batch form)
    a = spark.createDataFrame([("o1", 1), ("o1", 2), ("o2", 3)], "object_id string, x int")
    b = spark.createDataFrame([("o1", 10), ("o1", 20)], "object_id string, y int")
    assert join_streams(a, b, ["object_id"]).count() == 4


def test_classifier_batch_is_idempotent_and_routes(spark, tmp_path):
    from alertflow.operators import model as ML
    from alertflow.operators.scaler import fit_scaler
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        img = rng.random(12).astype(np.float32)
        b = img.astype("<f4").tobytes() if i % 7 else b"\x00" * 10  # every 7th image has a bad size
        meta = {c: (i % 5 if c in S.INT_METADATA_COLUMNS else float(i % 5)) for c in S.METADATA_COLUMNS}
        rows.append((f"o{i}", b, S.CLASS_LABELS[i % 5], *[meta[c] for c in S.METADATA_COLUMNS]))
    schema = "object_id string, image_data binary, label string, " + ", ".join(
        f"{c} {'int' if c in S.INT_METADATA_COLUMNS else 'double'}" for c in S.METADATA_COLUMNS)
    df = spark.createDataFrame(rows, schema)
    stats = fit_scaler(df, S.METADATA_COLUMNS)
    shape = (2, 2, 3)
    prepared = CL.prepare(df, stats, S.METADATA_COLUMNS, shape)
    model = ML.train(prepared.where("image_processed"), "label", S.CLASS_LABELS, kind="lr", max_iter=5)
    out = str(tmp_path / f"pred_{uuid.uuid4().hex}")
    run = CL.batch_writer(model, S.CLASS_LABELS, stats, out, S.METADATA_COLUMNS, shape)
    run(df, 0)
    run(df, 0)  # replay of the same batch replaces its output
    from alertflow.sources.alerts import read_predictions
    got = read_predictions(spark, out)
    assert got.count() == 40
    assert os.path.isdir(os.path.join(out, "batch_id=0"))
    bad = got.where(F.col("clase_predicha") == S.INCOMPLETE_STATUS)
    assert bad.count() == len([i for i in range(40) if i % 7 == 0])
    assert bad.where((F.col("prob_AGN") != 0) | F.col("image_processed")).count() == 0
    ok = got.where(F.col("clase_predicha") != S.INCOMPLETE_STATUS)
    sums = ok.select((F.col("prob_AGN") + F.col("prob_QSO") + F.col("prob_VS") + F.col("prob_YSO")
                      + F.col("prob_Other")).alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-6 for r in sums)
    assert [f.name for f in got.schema.fields] == S.PREDICTION_HEADER
    assert run.summaries[-1]["new_objects"] == 40 and run.summaries[-1]["scored"] == 40 - 6


def test_dedup_watermark_bounds_state_exact_form_does_not(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    # the state for 'k' is evicted at the end of the first batch that runs with
    # the advanced watermark (the third); the fourth batch repeats 'k'
    batches = [[("k", base)], [("x", base + dt.timedelta(hours=10))], [("y", base + dt.timedelta(hours=10.5))],
               [("k", base + dt.timedelta(hours=11))]]
    src = scratch_path(spark, "wm_src")
    schema = "object_id string, ts timestamp"
    for rows in batches:  # one file per micro-batch, written in order
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def run(watermark):
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        out = scratch_path(spark, "wm_out")
        _run(dedup_stream(s, ["object_id"], "ts", watermark), out, scratch_path(spark, "wm_ckpt"))
        return sorted(r.object_id for r in spark.read.parquet(out).collect())
    assert run(None) == ["k", "x", "y"]  # exact: the id set is kept forever
    assert run("1 hour") == ["k", "k", "x", "y"]  # bounded: 'k' was evicted, its repeat passes


def test_classifier_with_python_predictor(spark, tmp_path):
    from alertflow.operators.scaler import fit_scaler
    rows = [(f"o{i}", np.full(12, i / 40, dtype="<f4").tobytes(), *[(i % 3) if c in S.INT_METADATA_COLUMNS
                                                                    else float(i) for c in S.METADATA_COLUMNS])
            for i in range(20)]
    schema = "object_id string, image_data binary, " + ", ".join(
        f"{c} {'int' if c in S.INT_METADATA_COLUMNS else 'double'}" for c in S.METADATA_COLUMNS)
    df = spark.createDataFrame(rows, schema)

    def predict(x):  # a stand-in for an exported network: uniform scores
        return np.full((x.shape[0], 5), 0.2)
    preds = CL.classify(df, predict, S.CLASS_LABELS, fit_scaler(df, S.METADATA_COLUMNS), S.METADATA_COLUMNS,
                        (2, 2, 3), stamp=F.lit("t"))
    got = preds.collect()
    assert len(got) == 20 and all(r.clase_predicha == "AGN" and abs(r.confianza - 0.2) < 1e-12 for r in got)


def test_classifier_stream_restart_scores_each_object_once(spark):
    from alertflow.operators import model as ML
    from alertflow.operators.scaler import fit_scaler
    from alertflow.sources.alerts import read_predictions
    ev = _events(spark)
    obj = F.concat(F.lit("obj_"), F.col("user_id").cast("string"))
    img = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: (F.col("value") * (i + 1) % 5).cast("float"))
    from alertflow.functions.images import pack_float32
    label = F.element_at(F.array(*[F.lit(c) for c in S.CLASS_LABELS]), (F.col("user_id") % 5 + 1).cast("int"))
    rows = ev.select(obj.alias("object_id"),
                     *[F.col("value").cast("int" if c in S.INT_METADATA_COLUMNS else "double").alias(c)
                       for c in S.METADATA_COLUMNS],
                     "ts", img.alias("image"), label.alias("label"))
    rows = pack_float32(rows, "image", "image_data").drop("image")
    stats = fit_scaler(rows, S.METADATA_COLUMNS)
    model = ML.train(CL.prepare(rows, stats, S.METADATA_COLUMNS, (2, 2, 3)), "label", S.CLASS_LABELS,
                     kind="lr", max_iter=3)
    half = rows.agg(F.expr("percentile_approx(unix_timestamp(ts), 0.5)")).first()[0]
    topics = scratch_path(spark, "cls_topics")

    def publish(part):
        m = part.select(F.encode("object_id", "UTF-8").alias("key"),
                        F.encode(F.to_json(F.struct(*S.METADATA_COLUMNS)), "UTF-8").alias("value"),
                        F.lit("Metadata").alias("topic"), F.col("ts").alias("timestamp"))
        i = part.select(F.encode("object_id", "UTF-8").alias("key"), F.col("image_data").alias("value"),
                        F.lit("Imagen").alias("topic"), F.col("ts").alias("timestamp"))
        SS.write_message_twin(m, f"{topics}/m", slices=2)
        SS.write_message_twin(i, f"{topics}/i", slices=2)

    out, ckpt = scratch_path(spark, "cls_out"), scratch_path(spark, "cls_ckpt")

    def run_once():
        ms = SS.metadata_stream(SS.message_stream(spark, "Metadata", path=f"{topics}/m", max_per_trigger=1))
        im = SS.image_stream(SS.message_stream(spark, "Imagen", path=f"{topics}/i", max_per_trigger=1))
        writer = CL.batch_writer(model, S.CLASS_LABELS, stats, out, S.METADATA_COLUMNS, (2, 2, 3),
                                 dedup_in_batch=False)
        exact = CL.first_pairs(ms, im, watermark=None, bound=None)
        q = CL.start(exact, writer, ckpt, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
        tot = CL.progress_totals(q)
        assert tot["batches"] >= 2 and tot["input_rows"] > 0

    publish(rows.where(F.unix_timestamp("ts") <= half))
    run_once()
    first = read_predictions(spark, out).count()
    assert CL.read_summaries(spark, out).agg(F.sum("new_objects")).first()[0] == first
    publish(rows.where(F.unix_timestamp("ts") > half))
    run_once()  # restart from the checkpoint with new files
    got = read_predictions(spark, out)
    n_obj = rows.select("object_id").distinct().count()
    assert got.count() == n_obj == got.select("object_id").distinct().count()
    assert CL.read_summaries(spark, out).orderBy(F.desc("batch_id")).first().total_objects == n_obj
    assert 0 < first <= n_obj


def test_alert_id_header_pairs_each_alert_with_its_own_image(spark):
    import datetime as dt
    from alertflow.sinks import writers as W
    t0 = dt.datetime(2024, 1, 1)
    # two alerts per object; the second alert's image arrives first in its file
    rows = [(f"o{o}", o * 10 + a, float(o * 10 + a), t0 + dt.timedelta(minutes=o * 5 + a)) for o in range(6)
            for a in range(2)]
    df = spark.createDataFrame(rows, "object_id string, candid long, ra double, ts timestamp")
    df = df.withColumn("img", F.array_repeat(F.col("ra").cast("float"), 12))
    topics = scratch_path(spark, "hdr_topics")
    W.metadata_messages(df, "object_id", ["ra"], time_col="ts", alert_col="candid") \
        .coalesce(1).write.parquet(f"{topics}/m")
    W.image_messages(df.orderBy(F.desc("candid")), "object_id", "img", time_col="ts", alert_col="candid") \
        .coalesce(1).write.parquet(f"{topics}/i")
    meta = SS.metadata_stream(SS.message_stream(spark, "Metadata", path=f"{topics}/m", headers=True),
                              schema="ra double")
    img = SS.image_stream(SS.message_stream(spark, "Imagen", path=f"{topics}/i", headers=True))
    pairs = CL.first_pairs(meta, img, keys=("object_id", "alert_id"), watermark="1 hour", bound="10 minutes")
    out = scratch_path(spark, "hdr_out")
    _run(pairs.select("object_id", "alert_id", "ra", "image_data"), out, scratch_path(spark, "hdr_ckpt"))
    got = spark.read.parquet(out).collect()
    assert len(got) == 6 and len({r.object_id for r in got}) == 6
    for r in got:  # the image belongs to the same alert as the metadata
        assert np.frombuffer(r.image_data, "<f4")[0] == np.float32(r.ra) and int(r.alert_id) == int(r.ra)


def test_publish_stream_to_file_twin(spark):
    from alertflow.sinks import writers as W
    src = scratch_path(spark, "pub_src")
    SS.write_message_twin(_messages(_events(spark), "Metadata"), src, slices=2)
    raw = SS.message_stream(spark, "Metadata", path=src, max_per_trigger=1)
    out = scratch_path(spark, "pub_out")
    q = W.publish_stream(raw, scratch_path(spark, "pub_ckpt"), path=out, available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == _events(spark).count()
    assert CL.progress_totals(q)["batches"] == 2


def test_first_of_batch_is_the_same_on_any_layout(spark):
    rows = [("a", 2, 1.0), ("a", 1, 9.0), ("a", 1, 3.0), ("b", 5, 2.0), (None, 1, 1.0), (None, 2, 0.0)]
    df = spark.createDataFrame(rows, "object_id string, meta_time int, v double")
    want = sorted(map(str, CL.first_of_batch(df).collect()))
    assert len(want) == 3
    for n in (1, 3, 7):
        assert sorted(map(str, CL.first_of_batch(df.repartition(n)).collect())) == want
