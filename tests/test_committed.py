"""Committed batches, the producer stream and lifetime totals."""
import json
import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow import schemas as S
from alertflow.plans import producer as PR
from alertflow.plans.stamps import encode_stamp
from alertflow.session import scratch_path
from alertflow.sinks import committed as CM
from alertflow.sources import containers as CT
from alertflow.streaming import sources as SS
from alertflow.streaming.progress import ProgressLog, lifetime_totals, read_progress, state_keys
from alertflow.streaming.stateful import dedup_stream

KIND = T.StructType([T.StructField("id", T.LongType())])


def ids(spark, root):
    return sorted(r["id"] for r in CM.read_committed(spark, root, KIND).collect())


def failing(df, tasks_that_work=1):
    """Rows whose write dies in a later task, after the first one's file is written."""
    def work(batches):
        from pyspark import TaskContext
        for b in batches:
            if TaskContext.get().partitionId() >= tasks_that_work:
                raise RuntimeError("planted")
            yield b
    return df.repartition(3).mapInArrow(work, df.schema)


def test_a_reader_sees_a_batch_whole_or_not_at_all(spark, monkeypatch):
    root = scratch_path(spark, "committed")
    assert ids(spark, root) == []
    assert CM.commit_batch(spark.range(5), root, 0, facts=lambda: {"rows": 5})
    with pytest.raises(Exception, match="planted"):
        CM.commit_batch(failing(spark.range(100)), root, 1)
    assert ids(spark, root) == [0, 1, 2, 3, 4] and not CM.is_committed(spark, root, 1)
    # died after the tasks, before the folder is in place; then between the folder and its entry
    move = CM._move
    for broken_at in (1, 2):
        calls = []

        def moved(*a):
            calls.append(a)
            if len(calls) == broken_at:
                raise OSError("planted")
            return move(*a)

        monkeypatch.setattr(CM, "_move", moved)
        with pytest.raises(OSError, match="planted"):
            CM.commit_batch(spark.range(10, 20), root, 1)
        assert ids(spark, root) == [0, 1, 2, 3, 4]
    monkeypatch.setattr(CM, "_move", move)
    assert CM.commit_batch(spark.range(10, 13), root, 1)
    assert ids(spark, root) == [0, 1, 2, 3, 4, 10, 11, 12]
    # a replay of a committed batch changes nothing, whatever it brings
    assert not CM.commit_batch(spark.range(1000), root, 0)
    assert ids(spark, root) == [0, 1, 2, 3, 4, 10, 11, 12]
    assert spark.read.schema(KIND).parquet(root).count() == 8  # a plain reader finds no attempt either
    facts = CM.manifest(spark, root, "batch_id long, rows long").orderBy("batch_id").collect()
    assert [(r["batch_id"], r["rows"]) for r in facts] == [(0, 5), (1, None)]


# ---------------------------------------------------------------- producer stream

SIDE = 4


def _avro(kind):
    if isinstance(kind, T.StructType):
        _avro.n = getattr(_avro, "n", 0) + 1
        return {"type": "record", "name": f"R{_avro.n}", "fields": [{"name": f.name, "type": ["null", _avro(f.dataType)]} for f in kind.fields]}
    return {"string": "string", "long": "long", "bigint": "long", "int": "int", "double": "double", "binary": "bytes"}[kind.simpleString()]


ALERT = _avro(S.ALERT_SCHEMA)


def alerts(numbers, bad=()):
    """One container of alerts; the science stamp of some is broken."""
    rows = []
    for n in numbers:
        stamp = {"stampData": encode_stamp(np.full((SIDE, SIDE), n, np.float32))}
        rows.append({"objectId": f"O{n}", "candid": n, "candidate": {"ra": float(n)},
                     **{c: stamp for c in S.CUTOUT_CHANNELS}, **({S.CUTOUT_CHANNELS[0]: {"stampData": b"junk"}} if n in bad else {})})
    return CT.container(ALERT, rows, block=2)


def put(folder, name, raw):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/_{name}", "wb") as f:
        f.write(raw)
    os.replace(f"{folder}/_{name}", f"{folder}/{name}")


def publish(spark, folder, root, **kw):
    stream = PR.alert_stream(spark, folder, max_files=1, **kw)
    q = PR.publish_alert_stream(stream, root, f"{root}/checkpoint", available_now=True, shape=(SIDE, SIDE), crop=None, crop_start=None)
    q.awaitTermination()
    return q


def published(spark, root):
    def read(topic):
        return CM.read_committed(spark, f"{root}/{topic}", S.MESSAGE_SCHEMA_WITH_HEADERS)
    meta = [(int(r["alert_id"]), r["object_id"], r["ra"]) for r in SS.metadata_stream(read(S.METADATA_TOPIC)).collect()]
    images = [(int(r["alert_id"]), len(r["image_data"])) for r in SS.image_stream(read(S.IMAGE_TOPIC)).collect()]
    return sorted(meta), sorted(images)


def want(numbers):
    return [(n, f"O{n}", float(n)) for n in numbers], [(n, 4 * 3 * SIDE * SIDE) for n in numbers]


def test_files_that_arrive_are_published_once(spark):
    folder, root = scratch_path(spark, "arrivals").replace("file:", ""), scratch_path(spark, "arrivals_out")
    put(folder, "a.avro", alerts(range(3)))
    put(folder, "b.avro", alerts(range(3, 8), bad={4})[:-20])  # the last block is cut
    publish(spark, folder, root, archive=None)
    assert published(spark, root) == want([0, 1, 2, 3, 5, 6])
    put(folder, "c.avro", alerts([9]))
    put(folder, "d.avro", b"junk")
    publish(spark, folder, root)
    publish(spark, folder, root)  # nothing new
    assert published(spark, root) == want([0, 1, 2, 3, 5, 6, 9])
    rejects = CM.read_committed(spark, f"{root}/rejects", T.StructType([T.StructField(n, t) for n, t in (
        ("path", T.StringType()), ("offset", T.LongType()), ("reason", T.StringType()), ("n_rows", T.LongType()))]))
    assert sorted((r["path"].rpartition("/")[2], r["n_rows"]) for r in rejects.collect()) == [("b.avro", 4), ("d.avro", 0)]


def test_a_killed_batch_repeats_nothing(spark, monkeypatch):
    folder, root = scratch_path(spark, "killed").replace("file:", ""), scratch_path(spark, "killed_out")
    put(folder, "a.avro", alerts(range(3)))
    put(folder, "b.avro", alerts(range(3, 5)))
    commit, calls = PR.commit_batch, []

    def dying(df, at, n):
        calls.append(at)
        if len(calls) == 5:  # the second batch's image topic, its metadata being out
            raise RuntimeError("planted")
        return commit(df, at, n)

    monkeypatch.setattr(PR, "commit_batch", dying)
    with pytest.raises(Exception, match="planted"):
        publish(spark, folder, root)
    meta, images = published(spark, root)
    assert (len(meta), len(images)) == (5, 3)
    monkeypatch.setattr(PR, "commit_batch", commit)
    publish(spark, folder, root)
    assert published(spark, root) == want(range(5))
    times = CM.read_committed(spark, f"{root}/{S.METADATA_TOPIC}", S.MESSAGE_SCHEMA_WITH_HEADERS).union(
        CM.read_committed(spark, f"{root}/{S.IMAGE_TOPIC}", S.MESSAGE_SCHEMA_WITH_HEADERS))
    assert times.select("timestamp").distinct().count() == 2  # the replay kept the batch's time


# ---------------------------------------------------------------- lifetime totals

def test_totals_cover_more_than_a_hundred_batches_and_a_restart(spark):
    folder, log, base = scratch_path(spark, "many"), scratch_path(spark, "many_log"), scratch_path(spark, "many_out")
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    local = folder.replace("file:", "")
    os.makedirs(local)
    try:
        for run in range(2):
            for i in range(55):
                with open(f"{local}/{run}-{i}.json", "w") as f:
                    f.writelines(json.dumps({"k": (7 * i + j) % 90 + run}) + "\n" for j in range(i % 4 + 1))
            s = spark.readStream.schema("k long").option("maxFilesPerTrigger", 1).json(folder)
            q = (dedup_stream(s, ["k"]).writeStream.format("noop").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start())
            q.awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    every = spark.read.schema("k long").json(folder)
    total = lifetime_totals(spark, log).collect()
    assert len(total) == 1
    assert (total[0]["batches"], total[0]["runs"], total[0]["input_rows"]) == (110, 2, every.count())
    assert total[0]["seconds"] > 0 and total[0]["first_at"] < total[0]["last_at"]
    kept = sorted(r["k"] for r in state_keys(spark, f"{base}/c").collect())
    assert kept == sorted(r["k"] for r in every.distinct().collect())
    # a batch that is reported twice counts once
    one = next(f for f in os.listdir(log.replace("file:", "") + "/" + total[0]["query_id"]) if f.startswith("3-"))
    at = f"{log.replace('file:', '')}/{total[0]['query_id']}"
    shutil.copy(f"{at}/{one}", f"{at}/3-another.json")
    assert read_progress(spark, log).count() == 110 and read_progress(spark, f"{log}-none").count() == 0
    assert read_progress(spark, log, total[0]["query_id"]).agg(F.sum("input_rows")).first()[0] == every.count()
