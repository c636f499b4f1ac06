"""Bucketed id tables and the saved feature pipeline."""
import re
import uuid

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from alertflow.functions import images as I
from alertflow.operators import joins as J
from alertflow.operators import pipeline as PL
from alertflow.session import scratch_path
from alertflow.sinks import bucketed as BK


def table(spark, df, key, buckets=4):
    name, path = f"t_{uuid.uuid4().hex}", scratch_path(spark, "bk")
    BK.save_bucketed(df, name, [key], buckets, path)
    return name, path


def shuffles(df, scan_column):
    """Names of the exchanges above the scan that reads ``scan_column`` as a bucketed table."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [(len(x) - len(x.lstrip(" :+-*()0123456789")), x) for x in lines]
    at = next(i for i, (_, x) in enumerate(depth) if "FileScan" in x and "Bucketed: true" in x and scan_column in x)
    above, level = [], depth[at][0]
    for n, x in reversed(depth[:at]):
        if n < level:
            level = n
            above.append(x)
    # a join is where the other side comes in
    own = above[:next(i for i, x in enumerate(above) if "Join" in x)]
    return [x for x in own if re.search("Exchange", x)]


def test_the_id_table_is_joined_where_it_lies(spark):
    seen = spark.range(0, 2000, 2).select(F.concat(F.lit("o"), "id").alias("object_id"))
    name, path = table(spark, seen, "object_id")
    batch = spark.createDataFrame([(f"o{i}", i) for i in range(50)] + [(None, -1)], "object_id string, v int")
    got = BK.unseen(batch, BK.read_bucketed(spark, name), "object_id")
    plain = J.anti_seen(batch, seen, "object_id")
    assert sorted(r["v"] for r in got.collect()) == sorted(r["v"] for r in plain.collect())
    assert shuffles(got, "object_id") == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # the table grows by batches; the join still finds everything in place
    BK.append_ids(batch, name, "object_id", 4, path)
    again = BK.unseen(batch, BK.read_bucketed(spark, name), "object_id")
    assert [r["v"] for r in again.collect()] == [-1] and shuffles(again, "object_id") == []
    every = BK.read_bucketed(spark, name)
    assert every.count() == every.distinct().count() == 1000 + 25


def test_catalogue_and_dataset_in_the_same_buckets_move_nothing(spark):
    docs = spark.range(500).select(F.col("id").cast("string").alias("object_id"), (F.col("id") % 3).alias("v"))
    cat = spark.range(0, 900, 3).select(F.col("id").cast("string").alias("oid"), F.lit("AGN").alias("predicted_class"))
    a, _ = table(spark, docs, "object_id")
    b, _ = table(spark, cat, "oid")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = J.crossmatch(BK.read_bucketed(spark, a), J.catalog_labels(BK.read_bucketed(spark, b)))
        assert got.count() == 167
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---------------------------------------------------------------- pipeline

@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    got = []
    for i in range(60):
        img = rng.normal(size=12).astype(np.float32)
        img[i % 12] = [1.0, np.nan, np.inf][i % 3]
        got.append((i, [float(v) for v in img], None if i % 10 == 0 else float(i), float("nan") if i % 9 == 0 else i / 7.0, float(i % 3)))
    return spark.createDataFrame(got, "id long, image array<float>, a double, b double, label double").repartition(3)


@pytest.mark.parametrize("mode", ["cube", "channel"])
def test_a_loaded_pipeline_gives_the_same_features_to_batch_and_stream(spark, rows, mode):
    path, files = scratch_path(spark, "pl"), scratch_path(spark, "pl_rows")
    fitted = PL.feature_pipeline("image", ["a", "b"], mode, 3, 12, LogisticRegression(maxIter=3)).fit(rows)
    fitted.write().overwrite().save(path)
    loaded = PL.load_pipeline(path)
    rows.write.parquet(files)

    def features(df):
        return df.select("id", vector_to_array("features").alias("f"), vector_to_array("probability").alias("p"))

    want = {r["id"]: (r["f"], r["p"]) for r in features(fitted.transform(rows)).collect()}
    assert {r["id"]: (r["f"], r["p"]) for r in features(loaded.transform(rows)).collect()} == want
    stream = features(loaded.transform(spark.readStream.schema(rows.schema).parquet(files)))
    q = (stream.writeStream.format("parquet").option("path", f"{path}_out").option("checkpointLocation", f"{path}_c").trigger(availableNow=True).start())
    q.awaitTermination()
    assert {r["id"]: (r["f"], r["p"]) for r in spark.read.parquet(f"{path}_out").collect()} == want
    # against the operators themselves
    clean = rows.withColumn("image", I.pixel_clean("image"))
    norm = I.minmax_cube(clean, "image", "n") if mode == "cube" else I.minmax_channel(clean, "image", "n", 3, size=12)
    images = {r["id"]: r["n"] for r in norm.collect()}
    a = np.array([-999.0 if i % 10 == 0 else float(i) for i in range(60)])
    for i, (f, _) in want.items():
        assert np.allclose(f[:12], images[i]) and f[12] == pytest.approx((a[i] - a.mean()) / a.std())


def test_pipeline_errors(spark, rows):
    with pytest.raises(ValueError, match="mode"):
        PL.CubeNormaliser(inputCol="image", outputCol="n", mode="other").transform(rows)
    with pytest.raises(ValueError, match="no value"):
        PL.PopulationScaler(inputCols=["a"]).fit(rows.where("id < 0"))
    flat = PL.PopulationScaler(inputCols=["c"], suffix="_s").fit(rows.withColumn("c", F.lit(4.0)))
    assert {r["c_s"] for r in flat.transform(rows.withColumn("c", F.lit(4.0))).collect()} == {0.0}
