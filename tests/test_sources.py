"""Sources and sinks: Avro containers (bundled input format), folders, catalogue, partitions."""
import json
import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertflow.functions import metadata as M
from alertflow.operators import cutouts as C
from alertflow.operators import joins as J
from alertflow.plans.stamps import encode_stamp
from alertflow.session import scratch_path
from alertflow.sources import alerts as SRC
from alertflow.sinks import writers as W

_AVRO_SCHEMA = {
    "type": "record", "name": "alert", "fields": [
        {"name": "objectId", "type": ["null", "string"]},
        {"name": "candid", "type": ["null", "int"]},  # py4j passes Python ints as Integer
        {"name": "candidate", "type": ["null", {"type": "record", "name": "cand", "fields": [
            {"name": "ra", "type": ["null", "double"]},
            {"name": "isdiffpos", "type": ["null", "string"]},
            {"name": "ndethist", "type": ["null", "int"]}]}]},
        {"name": "gal_lat", "type": ["null", "double"]},
        {"name": "cutoutScience", "type": ["null", {"type": "record", "name": "cut", "fields": [
            {"name": "stampData", "type": ["null", "bytes"]}]}]},
    ]}


def _write_avro(spark, path, records):
    jvm = spark._jvm
    schema = jvm.org.apache.avro.Schema.Parser().parse(json.dumps(_AVRO_SCHEMA))
    cand_s = schema.getField("candidate").schema().getTypes().get(1)
    cut_s = schema.getField("cutoutScience").schema().getTypes().get(1)
    writer = jvm.org.apache.avro.file.DataFileWriter(jvm.org.apache.avro.generic.GenericDatumWriter(schema))
    writer.create(schema, jvm.java.io.File(path))
    for r in records:
        rec = jvm.org.apache.avro.generic.GenericData.Record(schema)
        rec.put("objectId", r.get("objectId"))
        rec.put("candid", r["candid"])
        if "candidate" in r:
            c = jvm.org.apache.avro.generic.GenericData.Record(cand_s)
            c.put("ra", r["candidate"].get("ra"))
            c.put("isdiffpos", r["candidate"].get("isdiffpos"))
            if r["candidate"].get("ndethist") is not None:
                c.put("ndethist", r["candidate"]["ndethist"])
            rec.put("candidate", c)
        if "stamp" in r:
            s = jvm.org.apache.avro.generic.GenericData.Record(cut_s)
            s.put("stampData", jvm.java.nio.ByteBuffer.wrap(bytearray(r["stamp"])))
            rec.put("cutoutScience", s)
        writer.append(rec)
    writer.close()


def test_avro_container_scan_with_bundled_input_format(spark):
    base = scratch_path(spark, "avro")
    folder = base.replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    stamp = encode_stamp(np.arange(63 * 63, dtype=np.float32).reshape(63, 63))
    _write_avro(spark, f"{folder}/a.avro", [
        {"objectId": "OBJ1", "candid": 1, "candidate": {"ra": 10.5, "isdiffpos": "t", "ndethist": 4}, "stamp": stamp},
        {"objectId": None, "candid": 2},
    ])
    _write_avro(spark, f"{folder}/b.avro", [{"objectId": "OBJ2", "candid": 3, "candidate": {"ra": 1.0}}])
    alerts = SRC.scan_alerts(spark, folder, fmt="avro")  # no Avro data source here: input-format path
    rows = {r.candid: r for r in alerts.collect()}
    assert set(rows) == {1, 2, 3}
    assert bytes(rows[1].cutoutScience.stampData) == stamp  # every byte value survives
    meta = {r.object_id: r for r in M.project_alerts(alerts).collect()}
    assert meta["OBJ1"].isdiffpos == 1 and meta["OBJ1"].ndethist == 4 and meta["OBJ1"].ra == 10.5
    assert meta["Unknown"].ra == -999.0 and meta["OBJ2"].ndethist == -1
    dec = C.ingest_cutouts(alerts, ["candid"], channels=["cutoutScience"])
    ok = {r.candid: r.cutoutScience_status for r in dec.collect()}
    assert ok == {1: "ok", 2: "empty", 3: "empty"}


def test_load_folders_rank_and_keep_first(spark):
    base = scratch_path(spark, "folders")
    paths = []
    for i, rows in enumerate([[("a", 1), ("b", 2)], [("a", 3), ("c", 4)]]):
        p = f"{base}/f{i}"
        spark.createDataFrame(rows, "object_id string, v int").write.parquet(p)
        paths.append(p)
    df = SRC.load_folders(spark, paths)
    from alertflow.operators.dedup import first_per_key
    got = {r.object_id: r.v for r in first_per_key(df, ["object_id"], ["folder_rank"]).collect()}
    assert got == {"a": 1, "b": 2, "c": 4}


def test_catalog_csv_duplicates_and_crossmatch(spark):
    path = scratch_path(spark, "cat")
    rows = [("o1", "RRL"), ("o1", "E"), ("o2", None), ("o3", "Nope"), ("o9", "QSO")]
    spark.createDataFrame(rows, "oid string, predicted_class string").write.option("header", True).csv(path)
    cat = J.catalog_labels(SRC.read_catalog(spark, path))
    data = spark.createDataFrame([("o1",), ("o2",), ("o3",), ("o4",)], "object_id string")
    got = sorted((r.object_id, r.label) for r in J.crossmatch(data, cat).collect())
    assert got == [("o1", "VS"), ("o1", "VS"), ("o2", "Other"), ("o3", "Other")]
    n = spark.createDataFrame([(None,)], "object_id string")
    nl = spark.createDataFrame([(None, "QSO")], "object_id string, label string")
    assert J.crossmatch(n, nl).count() == 0 and J.crossmatch(n, nl, null_safe=True).count() == 1


def test_partition_pruning_by_class(spark):
    root = scratch_path(spark, "byclass")
    df = spark.createDataFrame([(i, ["AGN", "QSO", "VS"][i % 3]) for i in range(30)], "id int, label string")
    W.write_by_class(df, root)
    one = SRC.read_class_partition(spark, root, "label", ["QSO"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "QSO" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert one.count() == 10


def test_metadata_messages_roundtrip(spark):
    df = spark.createDataFrame([("o1", 1.5, None)], "object_id string, ra double, ndethist int")
    msgs = W.metadata_messages(df, columns=["ra", "ndethist"])
    r = msgs.first()
    assert r.topic == "Metadata" and bytes(r.key) == b"o1"
    assert json.loads(bytes(r.value).decode()) == {"ra": 1.5, "ndethist": None}
    out = scratch_path(spark, f"twin_{uuid.uuid4().hex}")
    W.publish(msgs.withColumn("timestamp", F.current_timestamp()), path=out)
    assert spark.read.parquet(out).count() == 1


def test_truncated_file_between_good_ones_is_reported(spark):
    base = scratch_path(spark, "trunc").replace("file:", "")
    alerts = spark.createDataFrame([(f"o{i}", i) for i in range(6)], "objectId string, candid long")
    for i in range(3):
        alerts.where(F.col("candid") % 3 == i).coalesce(1).write.parquet(f"{base}/part{i}")
    os.makedirs(f"{base}/all", exist_ok=True)
    import glob
    import shutil
    for i in range(3):
        src = glob.glob(f"{base}/part{i}/*.parquet")[0]
        shutil.copy(src, f"{base}/all/f{i}.parquet")
    with open(f"{base}/all/f1.parquet", "r+b") as fh:  # the middle file is cut short
        fh.truncate(20)
    scan = dict(fmt="parquet", glob="*.parquet", schema=alerts.schema)
    with pytest.raises(Exception):  # noqa: B017 - a damaged file is never passed over unasked
        SRC.scan_alerts(spark, f"{base}/all", **scan).collect()
    got = SRC.scan_alerts(spark, f"{base}/all", ignore_corrupt=True, **scan).collect()
    assert sorted(r.candid for r in got) == [0, 2, 3, 5]
    rejected = SRC.rejected_files(spark, f"{base}/all", **scan).collect()
    assert [(r.path.rsplit("/", 1)[1], r.length, r.n_rows) for r in rejected] == [("f1.parquet", 20, 0)]


def test_load_folders_with_a_space_and_a_nested_path(spark):
    base = scratch_path(spark, "odd folders")
    paths = [f"{base}/p/ds", f"{base}/q/p/ds", f"{base}/with space"]
    for i, p in enumerate(paths):
        spark.createDataFrame([("a", i)], "object_id string, v int").write.parquet(p)
    got = sorted((r.folder_rank, r.v) for r in SRC.load_folders(spark, paths).collect())
    assert got == [(0, 0), (1, 1), (2, 2)]


def test_avro_scan_honours_the_file_pattern(spark):
    folder = scratch_path(spark, "avro_glob").replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    for name, k in (("a_1.avro", 1), ("b_2.avro", 2)):
        _write_avro(spark, f"{folder}/{name}", [{"objectId": name, "candid": k}])
    assert [r.candid for r in SRC.scan_alerts(spark, folder, fmt="avro-mapred", glob="b_*.avro").collect()] == [2]
    scan = SRC.scan_alerts(spark, folder, fmt="avro-mapred")
    assert sorted(r.candid for r in scan.collect()) == [1, 2]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan  # a file scan of JSON lines


def test_write_by_class_clustered_files(spark):
    import glob
    root = scratch_path(spark, "byclass2")
    df = spark.range(0, 600).select("id", F.element_at(F.array(F.lit("AGN"), F.lit("VS")),
                                                       (F.col("id") % 2 + 1).cast("int")).alias("label"))
    W.write_by_class(df.repartition(12), root, files_per_class=2)
    for lab in ("AGN", "VS"):
        files = glob.glob(f"{root.replace('file:', '')}/label={lab}/*.parquet")
        assert 1 <= len(files) <= 2
    assert SRC.read_class_partition(spark, root).count() == 600
