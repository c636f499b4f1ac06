"""The first-seen row of an object does not depend on how the stream is cut."""
import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from alertflow.session import scratch_path
from alertflow.streaming.firstseen import first_seen

SCHEMA = "object_id string, alert long, ts timestamp, note string"
START = dt.datetime(2024, 1, 1)


def events(n=120, seed=0):
    rng = random.Random(seed)
    rows = [(f"o{rng.randrange(15)}", i, START + dt.timedelta(seconds=rng.randrange(60)), rng.choice([None, "x", "y"])) for i in range(n)]
    return rows + [rows[3], (rows[3][0], 7, rows[3][2], "tie"), (None, 500, START, "no object")]


def wanted(rows):
    best = {}
    for r in rows:
        if r[0] is not None and (r[0] not in best or (r[2], r[1]) < (best[r[0]][2], best[r[0]][1])):
            best[r[0]] = r
    return best


def run(spark, path, out, files, stop_after=None, watermark="2 minutes", forget=None):
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(path)
    w = (first_seen(s, "object_id", "ts", watermark, ["alert"], forget).writeStream.format("parquet").option("path", f"{out}/rows")
         .option("checkpointLocation", f"{out}/state"))
    q = w.trigger(availableNow=True).start() if stop_after is None else w.start()
    if stop_after is not None:
        while (q.lastProgress or {}).get("batchId", -1) < stop_after and q.isActive:
            time.sleep(0.2)
        q.stop()
    q.awaitTermination()
    assert q.exception() is None


def put(spark, path, rows, files):
    random.Random(1).shuffle(rows)
    for i in range(files):
        spark.createDataFrame(rows[i::files], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def beat(spark, path, seconds=3600):
    spark.createDataFrame([(None, None, START + dt.timedelta(seconds=seconds), None)], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def told(spark, out):
    return [tuple(r) for r in spark.read.schema(SCHEMA).parquet(f"{out}/rows").collect()]


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_same_rows_for_any_batch_cut(spark, batches):
    rows = events()
    path, out = scratch_path(spark, "fs_in"), scratch_path(spark, "fs_out")
    put(spark, path, list(rows), 9)
    beat(spark, path)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        run(spark, path, out, -(-9 // batches))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = wanted(rows)
    got = told(spark, out)
    assert len(got) == len(want) and all((r[1], r[2]) == (want[r[0]][1], want[r[0]][2]) for r in got)


def test_a_restart_continues_and_repeats_nothing(spark):
    rows = events(seed=4)
    path, out = scratch_path(spark, "fs_in"), scratch_path(spark, "fs_out")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        put(spark, path, list(rows[:70]), 2)
        run(spark, path, out, 1)
        assert told(spark, out) == []  # nothing is final yet
        put(spark, path, list(rows[70:]), 2)
        beat(spark, path)
        run(spark, path, out, 1)
        want = wanted(rows)
        first = sorted((r[0], r[1]) for r in told(spark, out))
        assert first == sorted((k, v[1]) for k, v in want.items())
        # an object that comes again is not given out again
        later = [(r[0], 900 + i, START + dt.timedelta(seconds=3700), "again") for i, r in enumerate(rows[:30])] + [
            ("new", 999, START + dt.timedelta(seconds=3701), "new")]
        put(spark, path, later, 1)
        beat(spark, path, 7200)
        run(spark, path, out, 1)
        assert sorted((r[0], r[1]) for r in told(spark, out)) == sorted([*first, ("new", 999)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_forgotten_object_is_first_seen_again(spark):
    path, out = scratch_path(spark, "fs_in"), scratch_path(spark, "fs_out")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        # first event, a repeat while the mark stands, a heartbeat that clears it, the object anew
        for alert, seconds, heartbeat in [(1, 0, 10_000), (2, 10_500, 11_000), (None, 0, 50_000), (3, 90_000, 200_000)]:
            if alert:
                put(spark, path, [("a", alert, START + dt.timedelta(seconds=seconds), None)], 1)
            beat(spark, path, heartbeat)
            run(spark, path, out, 9, watermark="1 second", forget=dt.timedelta(minutes=30))
        assert sorted(r[1] for r in told(spark, out)) == [1, 3]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pairs_of_the_classifier_do_not_depend_on_the_batch_cut(spark):
    from alertflow.streaming.classify import first_pairs
    rng = random.Random(2)
    meta = [(f"o{rng.randrange(9)}", float(i), START + dt.timedelta(seconds=rng.randrange(60))) for i in range(60)]
    img = [(f"o{rng.randrange(9)}", bytearray([i]), START + dt.timedelta(seconds=rng.randrange(60))) for i in range(60)]
    beat_at = START + dt.timedelta(days=1)
    kinds = ("object_id string, ra double, meta_time timestamp", "object_id string, image_data binary, image_time timestamp")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    got = []
    try:
        for files in (1, 4):
            sides = []
            for rows, kind in zip((meta, img), kinds):
                path = scratch_path(spark, "pairs")
                mixed = random.Random(files).sample(rows, len(rows))
                for i in range(files):
                    spark.createDataFrame(mixed[i::files], kind).coalesce(1).write.mode("append").parquet(path)
                spark.createDataFrame([(None, None, beat_at)], kind).coalesce(1).write.mode("append").parquet(path)
                sides.append(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(path))
            out = scratch_path(spark, "pairs_out")
            q = (first_pairs(*sides, watermark="2 minutes", bound=None, repeatable=True).writeStream.format("parquet")
                 .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start())
            q.awaitTermination()
            got.append(sorted((r["object_id"], r["ra"], bytes(r["image_data"])) for r in spark.read.parquet(f"{out}/rows").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]
    first = {o: min(t for p, _, t in meta if p == o) for o in {p for p, _, _ in meta}}
    assert {o for o, _, _ in got[0]} == set(first) & {p for p, _, _ in img}
    assert all(dict((v, t) for _, v, t in meta)[ra] == first[o] for o, ra, _ in got[0])
    with pytest.raises(ValueError, match="object"):
        first_pairs(*sides, keys=("object_id", "alert_id"), repeatable=True)
