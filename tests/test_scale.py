"""Steps whose tasks, batches and broadcasts must stay bounded while the tables grow."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow import schemas as S
from alertflow.plans import prepare as P
from alertflow.plans import registry_extra as RX
from alertflow.plans.stamps import encode_stamp
from alertflow.session import scratch_path, session_conf
from alertflow.sinks import writers as W
from alertflow.sources import containers as CT


@pytest.fixture(scope="module")
def tables(spark):
    """A folder with 900 events of 40 users, one id missing a value."""
    d = scratch_path(spark, "scale_tables")
    n = F.col("id")
    spark.range(900).select(n.alias("event_id"), F.timestamp_seconds(n * 60 + 1_700_000_000).cast("timestamp_ntz").alias("ts"), (n % 40).alias("user_id"),
                            F.element_at(F.array(*[F.lit(t) for t in ("click", "view", "purchase", "signup", "error")]), (n % 5 + 1).cast("int")).alias("event_type"),
                            F.when(n != 7, n * 0.37).alias("value"), F.concat(F.lit('{"k": '), n % 50, F.lit("}")).alias("props")).coalesce(1) \
        .write.parquet(f"{d}/events.parquet")
    return d


def test_tasks_with_images_grow_with_the_rows(spark, tables, monkeypatch):
    assert RX._image_tasks(spark, 10) == spark.sparkContext.defaultParallelism
    assert RX._image_tasks(spark, 36_000_000) == 720
    monkeypatch.setattr(RX, "IMAGE_ROWS", 50)
    assert RX._alert_rows(spark, tables).rdd.getNumPartitions() == 18
    assert RX._prep_alerts(spark, tables).rdd.getNumPartitions() == 18


def test_published_topics_join_without_a_broadcast(spark):
    rows = spark.range(200).select(F.concat(F.lit("o"), F.col("id") % 9).alias("object_id"), F.col("id").alias("alert_id"), F.lit(0.5).alias("x"),
                                   F.array_repeat(F.col("id").cast("float"), 48).alias("image"), F.lit("2024-01-01").alias("time"))
    rows = rows.withColumns({c: F.lit(1.0) for c in S.METADATA_COLUMNS})
    topics = scratch_path(spark, "scale_topics")
    W.publish(W.metadata_messages(rows, time_col="time", alert_col="alert_id"), path=f"{topics}/m")
    W.publish(W.image_messages(rows, "object_id", "image", time_col="time", alert_col="alert_id"), path=f"{topics}/i")
    read = spark.read.schema(S.MESSAGE_SCHEMA_WITH_HEADERS)
    got = RX._published(read.parquet(f"{topics}/m"), read.parquet(f"{topics}/i"))
    assert got.count() == 200 * 48 and got.where("pixel != alert_id").isEmpty()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_alerts_of_one_frequent_id_are_split(spark):
    good = {"stampData": encode_stamp(np.ones((9, 9), np.float32))}
    cand = {f: 1.0 for f in S.CANDIDATE_DOUBLE_FIELDS} | {"isdiffpos": "t", "ndethist": 1, "ncovhist": 1}
    few = spark.createDataFrame([("a", 1, cand, 1.0, 2.0, 3.0, 4.0, good, good, good)], S.ALERT_SCHEMA)
    many = spark.range(2000).select(F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("o"), "id")).alias("_oid"), F.col("id").alias("_n"))
    alerts = many.crossJoin(few).withColumns({"objectId": F.col("_oid"), "candid": F.col("_n")}).drop("_oid", "_n").repartition(8)
    stored = scratch_path(spark, "scale_alerts")
    alerts.write.parquet(stored)
    alerts = spark.read.parquet(stored)
    # the ids of the catalogue come twice, an alert still once
    catalog = spark.range(2000).select(F.when(F.col("id") < 2, F.lit("hot")).otherwise(F.concat(F.lit("o"), "id")).alias("oid"), F.lit("QSO").alias("predicted_class"))
    with session_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), session_conf(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"), \
            session_conf(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10k"), \
            session_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k"), session_conf(spark, "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5"):
        got = P.alert_records(alerts, shape=(9, 9), crop=3, crop_start=None, catalog=catalog)
        ids = [r.alert_order for r in got.select("alert_order").collect()]
        made = got.select("alert_order")
        made.collect()
        plan = made._jdf.queryExecution().executedPlan().toString()
    assert sorted(ids) == [i for i in range(2000) if i]  # o0 alone is not in the catalogue
    assert "skew=true" in plan.lower()


def test_a_batch_of_decoded_records_is_bounded():
    writer = {"type": "record", "name": "R", "fields": [{"name": "n", "type": "long"}]}
    schema = CT.resolve([writer])
    out = T.StructType([T.StructField("record", schema, True), *CT._REJECT])
    files = [CT.container(writer, [{"n": i} for i in range(a, a + 5000)], block=100) for a in range(0, 40_000, 5000)]
    files[3] = files[3][:-10]
    given = pa.RecordBatch.from_arrays([pa.array([f"f{i}" for i in range(8)]), pa.array(files, pa.binary())], ["path", "content"])
    sizes, kept, bad = [], [], []
    for b in CT.decoded_batches(iter([given]), out, schema):
        sizes.append(b.num_rows)
        kept += [r["record"]["n"] for r in b.to_pylist() if r["record"]]
        bad += [r["reject_path"] for r in b.to_pylist() if r["reject_path"]]
    assert kept == [n for n in range(40_000) if not 19_900 <= n < 20_000] and bad == ["f3"]
    assert max(sizes) < CT.BATCH_RECORDS + 100 + 8
