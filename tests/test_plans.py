"""End-to-end batch plans on hand-made alerts: prepare -> save -> train -> evaluate."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.plans import prepare as P
from alertflow.plans.stamps import encode_stamp
from alertflow.session import scratch_path
from alertflow.sources.alerts import read_class_partition

RAW = ["RRL", "QSO", "AGN", "YSO", "SNIa", "E"]


def _alerts(spark, n_obj=36, per_obj=2, size=9):
    rng = np.random.default_rng(7)
    rows = []
    for o in range(n_obj):
        for k in range(per_obj):
            stamps = [encode_stamp(rng.random((size, size)).astype(np.float32) + o % 3) for _ in range(3)]
            if o == 5 and k == 0:
                stamps[1] = b"broken"  # this alert is dropped, the object's other alert survives
            cand = {f: float(o + k) for f in S.CANDIDATE_DOUBLE_FIELDS}
            cand.update(isdiffpos="t" if o % 2 else "f", ndethist=o, ncovhist=o + 3)
            rows.append((f"OBJ{o:03d}", o * 10 + k, cand, 1.0, 2.0, 3.0, 4.0,
                         {"stampData": stamps[0]}, {"stampData": stamps[1]}, {"stampData": stamps[2]}))
    return spark.createDataFrame(rows, S.ALERT_SCHEMA)


def test_prepare_save_train_evaluate(spark):
    alerts = _alerts(spark)
    cat = spark.createDataFrame([(f"OBJ{o:03d}", RAW[o % len(RAW)]) for o in range(36)] + [("OBJ999", "QSO")],
                                "oid string, predicted_class string")
    records = P.alert_records(alerts, shape=(9, 9), crop=3, crop_start=None)
    ds = P.build_dataset(records, cat, balance={"VS": 5})
    counts = {r.label: r["count"] for r in ds.groupBy("label").count().collect()}
    assert counts["VS"] == 5 and sum(counts.values()) == 36 - (12 - 5)
    assert ds.select("object_id").distinct().count() == ds.count()
    rng = ds.select(F.explode("data").alias("x")).agg(F.min("x"), F.max("x")).first()
    assert rng[0] == 0.0 and rng[1] <= 1.0
    root = scratch_path(spark, "ds")
    P.save_dataset(ds, root)
    back = read_class_partition(spark, root, "label")
    assert back.count() == ds.count()
    res = P.train_and_evaluate(back, (3, 3, 3), kind="lr", max_iter=10)
    rep = {r.label: r for r in res["test_report"].collect()}
    assert set(S.CLASS_LABELS) | {"accuracy", "macro avg", "weighted avg"} == set(rep)
    assert 0.0 <= rep["accuracy"].precision <= 1.0
    n_test = res["test"].count()
    assert rep["accuracy"].support == n_test


def test_model_save_load_roundtrip(spark):
    from alertflow.operators import model as ML
    rows = [(i, [float(i % 3), float(i % 5)], S.CLASS_LABELS[i % 3]) for i in range(60)]
    df = ML.assemble(spark.createDataFrame(rows, "id int, x array<double>, label string"), "x", [])
    model = ML.train(df, "label", S.CLASS_LABELS, kind="lr", max_iter=5)
    path = scratch_path(spark, "model")
    ML.save(model, path, S.CLASS_LABELS)
    back, classes = ML.load(path, "lr")
    assert classes == S.CLASS_LABELS
    a = sorted((r.id, tuple(round(p, 9) for p in r.probs)) for r in ML.score(model, df).collect())
    b = sorted((r.id, tuple(round(p, 9) for p in r.probs)) for r in ML.score(back, df).collect())
    assert a == b


@pytest.mark.parametrize("kind", ["lr", "fused"])
def test_train_save_then_run_classifier(spark, kind):
    from alertflow.plans import realtime as RT
    from alertflow.sinks import writers as W
    from alertflow.sources.alerts import read_predictions
    alerts = _alerts(spark, n_obj=24, per_obj=1)
    cat = spark.createDataFrame([(f"OBJ{o:03d}", RAW[o % len(RAW)]) for o in range(24)],
                                "oid string, predicted_class string")
    records = P.alert_records(alerts, shape=(9, 9), crop=3, crop_start=None)
    ds = P.build_dataset(records, cat, balance={})
    settings = {"max_iter": 5} if kind == "lr" else {"epochs": 2, "layers": {"pad": 1, "filters": 2, "image_units": 4, "meta_units": 3}}
    res = P.train_and_evaluate(ds, (3, 3, 3), kind=kind, **settings)
    assert res["test_report"].where("label = 'accuracy'").first().support == res["test"].count() > 0
    path = RT.save_training(spark, scratch_path(spark, "training"), res["model"], res["stats"],
                            image_shape=(3, 3, 3), kind=kind)
    # publish the same objects as topic twins: channel-last bytes, JSON metadata
    from alertflow.functions import images as I
    # the raw cubes: the stream normalises them as the training did
    raw = records.join(ds.select("object_id"), "object_id", "left_semi")
    rows = raw.withColumn("hwc", I.chw_to_hwc("data", 3, 3, 3)).withColumn("ts", F.current_timestamp())
    topics = scratch_path(spark, "rt_topics")
    W.publish(W.metadata_messages(rows, time_col="ts"), path=f"{topics}/m")
    W.publish(W.image_messages(rows, "object_id", "hwc", time_col="ts"), path=f"{topics}/i")
    out = scratch_path(spark, "rt_out")
    q = RT.run_classifier(spark, path, out, scratch_path(spark, "rt_ckpt"), metadata_path=f"{topics}/m",
                          image_path=f"{topics}/i", available_now=True)
    q.awaitTermination()
    got = read_predictions(spark, out)
    assert got.count() == ds.count()
    assert got.where(F.col("clase_predicha").isin(S.CLASS_LABELS)).count() == ds.count()


def test_training_and_stream_make_equal_features(spark):
    from alertflow.functions import images as I
    from alertflow.operators import model as ML
    from alertflow.operators.scaler import apply_scaler, fit_scaler
    from alertflow.plans import realtime as RT
    from alertflow.streaming import classify as CL
    alerts = _alerts(spark, n_obj=12, per_obj=1)
    cat = spark.createDataFrame([(f"OBJ{o:03d}", RAW[o % len(RAW)]) for o in range(12)], "oid string, predicted_class string")
    records = P.alert_records(alerts, shape=(9, 9), crop=3, crop_start=None)
    ds = P.build_dataset(records, cat, balance={}).withColumn("data", I.chw_to_hwc("data", 3, 3, 3))
    stats = fit_scaler(ds, S.METADATA_COLUMNS)
    train = ML.assemble(apply_scaler(ds, stats, S.METADATA_COLUMNS), "data", S.METADATA_COLUMNS)
    model = ML.train(train, "label", S.CLASS_LABELS, kind="lr", max_iter=2)
    path = RT.save_training(spark, scratch_path(spark, "feat_training"), model, stats, image_shape=(3, 3, 3), kind="lr")
    _, _, loaded, shape, normalise = RT.load_training(spark, path)
    assert normalise == "cube"
    joined = I.pack_float32(records.withColumn("data", I.chw_to_hwc("data", 3, 3, 3)), "data", "image_data").drop("data")
    streamed = CL.prepare(joined, loaded, S.METADATA_COLUMNS, shape, normalise)
    a = {r.object_id: np.array(r.features.toArray()) for r in train.collect()}
    b = {r.object_id: np.array(r.features.toArray()) for r in streamed.collect()}
    assert set(a) <= set(b) and all(np.allclose(a[k], b[k], atol=1e-6) for k in a)
    other = CL.prepare(joined, loaded, S.METADATA_COLUMNS, shape, "channel").collect()
    assert any(not np.allclose(a[r.object_id], r.features.toArray(), atol=1e-3) for r in other if r.object_id in a)


def test_last_alert_of_the_folder_then_first_folder(spark):
    rows = [("o1", 0, 1, 1.0), ("o1", 0, 2, 2.0), ("o1", 1, 3, 3.0), ("o2", 1, 1, 4.0), ("o2", 1, 5, 5.0), ("o3", 2, 9, 6.0)]
    df = spark.createDataFrame(rows, "object_id string, folder_rank int, alert_order long, v double")
    got = {r.object_id: r.v for r in P.one_record_per_object(df).collect()}
    assert got == {"o1": 2.0, "o2": 5.0, "o3": 6.0}
    plain = {r.object_id: r.v for r in P.one_record_per_object(df.drop("folder_rank")).collect()}
    assert plain == {"o1": 3.0, "o2": 5.0, "o3": 6.0}


def test_dataset_decodes_once_and_aggregates_no_cube(spark):
    alerts = _alerts(spark, n_obj=24)
    cat = spark.createDataFrame([(f"OBJ{o:03d}", RAW[o % len(RAW)]) for o in range(20)], "oid string, predicted_class string")
    records = P.alert_records(alerts, shape=(9, 9), crop=3, crop_start=None, catalog=cat)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and plan.index("MapInPandas") < plan.index("LeftSemi")  # the join is below the decoder
    ds = P.build_dataset(records, cat, balance={"VS": 3})
    plan = ds._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "SortAggregate" not in plan
    assert ds.where("label = 'VS'").count() == 3 and ds.select("object_id").distinct().count() == ds.count()


def test_balanced_classes_default_and_error(spark):
    import pytest
    assert P.DEFAULT_BALANCE == {"Other": 12000, "VS": 12000}
    alerts = _alerts(spark, n_obj=12, per_obj=1)
    cat = spark.createDataFrame([(f"OBJ{o:03d}", RAW[o % len(RAW)]) for o in range(12)], "oid string, predicted_class string")
    records = P.alert_records(alerts, shape=(9, 9), crop=3, crop_start=None)
    with pytest.raises(ValueError, match="12000"):
        P.build_dataset(records, cat)


def test_shared_folder_must_be_named_off_a_local_master(spark, monkeypatch):
    import pytest
    from alertflow import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    assert int(session.cluster_conf(100 << 40)["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
