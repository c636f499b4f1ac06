"""Containers read block by block: values, versions, damage, folders."""
import bz2
import json
import lzma
import os
import random
import zlib

import pytest
from pyspark.sql import types as T

from alertflow.session import scratch_path
from alertflow.sources import alerts as SRC
from alertflow.sources import containers as CT

EVERY = {"type": "record", "name": "Every", "namespace": "x.y", "fields": [
    {"name": "i", "type": "int"}, {"name": "l", "type": {"type": "long", "logicalType": "timestamp-micros"}}, {"name": "f", "type": "float"},
    {"name": "d", "type": "double"}, {"name": "b", "type": "boolean"}, {"name": "s", "type": "string"}, {"name": "raw", "type": "bytes"},
    {"name": "o", "type": ["null", "string"]}, {"name": "a", "type": {"type": "array", "items": "int"}},
    {"name": "m", "type": {"type": "map", "values": "double"}}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["p", "q"]}},
    {"name": "x", "type": {"type": "fixed", "name": "X", "size": 3}},
    {"name": "r", "type": ["null", {"type": "record", "name": "Inner", "fields": [{"name": "z", "type": ["null", "double"]}]}]},
    {"name": "again", "type": ["null", "Inner"]}]}
ROW = {"i": -5, "l": 1 << 60, "f": 0.5, "d": -1e300, "b": True, "s": "été", "raw": b"\x00\xff", "o": None, "a": [1, -2, 300000], "m": {"k": 1.5},
       "e": "q", "x": b"abc", "r": {"z": None}, "again": {"z": 2.0}}


def put(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, raw in files.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(raw)
    return folder


def local(spark, name):
    return scratch_path(spark, name).replace("file:", "")


def numbers(n, start=0):
    schema = {"type": "record", "name": "N", "fields": [{"name": "n", "type": "long"}]}
    return schema, [{"n": i} for i in range(start, start + n)]


def starts(raw):
    _, codec, sync, at = CT.header(raw)
    return [a for a, _, _ in CT.blocks(raw, codec, sync, at)]


def test_every_type_and_codec(spark):
    files = {"null.avro": CT.container(EVERY, [ROW], "null"), "deflate.avro": CT.container(EVERY, [ROW] * 3, block=2)}
    plain = files["null.avro"]
    meta_end = plain.index(b"null") + 4
    for codec, press in (("bzip2", bz2.compress), ("xz", lzma.compress)):
        _, _, sync, at = CT.header(plain)
        _, _, payload = next(CT.blocks(plain, "null", sync, at))
        head = plain[:at].replace(b"\x08null", CT._write_long(len(codec)) + codec.encode()) if meta_end else plain
        packed = press(payload)
        files[f"{codec}.avro"] = head + CT._write_long(1) + CT._write_long(len(packed)) + packed + sync
    df = CT.container_files(spark, put(local(spark, "every"), files))
    good, bad = CT.scan_containers(df)
    assert bad.collect() == []
    rows = good.collect()
    assert len(rows) == 6 and all(r.asDict(True) == ROW for r in rows)


def test_versions_are_resolved_to_one_table(spark):
    v1 = {"type": "record", "name": "A", "fields": [{"name": "id", "type": "int"}, {"name": "v", "type": "float"},
                                                    {"name": "in", "type": {"type": "record", "name": "I", "fields": [{"name": "p", "type": "int"}]}}]}
    v2 = {"type": "record", "name": "A", "fields": [{"name": "id", "type": "long"}, {"name": "v", "type": "int"}, {"name": "new", "type": "string"},
                                                    {"name": "in", "type": {"type": "record", "name": "I", "fields": [{"name": "q", "type": "string"}]}}]}
    v3 = {"type": "record", "name": "A", "fields": [{"name": "id", "type": "long"}, {"name": "list", "type": {"type": "array", "items": "int"}}]}
    v4 = {"type": "record", "name": "A", "fields": [{"name": "list", "type": {"type": "array", "items": "double"}}]}
    folder = put(local(spark, "versions"), {
        "a.avro": CT.container(v1, [{"id": 1, "v": 0.25, "in": {"p": 7}}]),
        "b.avro": CT.container(v2, [{"id": 1 << 40, "v": (1 << 30) + 1, "new": "x", "in": {"q": "z"}}]),
        "c.avro": CT.container(v3, [{"id": 3, "list": [1, 2]}]), "d.avro": CT.container(v4, [{"list": [0.5]}])})
    files = CT.container_files(spark, folder)
    schema = CT.resolve(CT.writer_schemas(files))
    assert schema.simpleString() == "struct<id:bigint,v:double,in:struct<p:int,q:string>,new:string,list:array<double>>"
    got = {r["id"]: r.asDict(True) for r in CT.scan_containers(files)[0].collect()}
    assert got[1] == {"id": 1, "v": 0.25, "in": {"p": 7, "q": None}, "new": None, "list": None}
    assert got[1 << 40] == {"id": 1 << 40, "v": float((1 << 30) + 1), "in": {"p": None, "q": "z"}, "new": "x", "list": None}
    assert got[3]["list"] == [1.0, 2.0] and got[None]["list"] == [0.5]
    with pytest.raises(ValueError, match="A.v"):
        CT.resolve([v1, {"type": "record", "name": "A", "fields": [{"name": "v", "type": "string"}]}])


def test_damage_gives_a_reject_and_keeps_what_is_before_it(spark):
    schema, rows = numbers(250)
    raw = CT.container(schema, rows, block=100)
    a, b, c = starts(raw)
    bad_sync = raw[:c - 1] + bytes([raw[c - 1] ^ 1]) + raw[c:]
    short = zlib.compressobj(6, zlib.DEFLATED, -15)
    payload = short.compress(b"\x02") + short.flush()  # one record where the block says five
    head = raw[:a]
    lying = head + CT._write_long(5) + CT._write_long(len(payload)) + payload + raw[a - 16:a]
    more = head + CT._write_long(0) + CT._write_long(len(payload)) + payload + raw[a - 16:a]
    huge = raw[:b] + CT._write_long(10) + CT._write_long(1 << 40) + raw[b:]
    folder = put(local(spark, "damage"), {
        "good.avro": raw, "tail.avro": raw[:-1], "sync.avro": bad_sync, "payload.avro": raw[:b + 6] + b"\xff" * 6 + raw[b + 12:],
        "lying.avro": lying, "more.avro": more, "huge.avro": huge, "empty.avro": b"", "text.avro": b"hello there", "head.avro": raw[:30],
        "codec.avro": raw.replace(b"\x0edeflate", b"\x0esnappy!"), "ends.avro": raw[:c], "none.avro": raw[:a], "other.txt": b"x"})
    good, bad = CT.scan_containers(CT.container_files(spark, folder))
    told = {r["path"].rpartition("/")[2]: (r["offset"], r["reason"], r["n_rows"]) for r in bad.collect()}
    assert told.pop("head.avro")[1].startswith("unreadable header") and told.pop("codec.avro")[1] == "codec 'snappy!'"
    assert told == {"tail.avro": (c, "truncated block", 200), "sync.avro": (b, "sync marker differs", 100),
                    "payload.avro": (b, "payload does not decompress", 100), "lying.avro": (a, "record does not decode", 0),
                    "more.avro": (a, "bytes left behind the block's records", 0), "huge.avro": (b, "truncated block", 100),
                    "text.avro": (0, "no container magic", 0)}  # Spark lists no file of length zero
    assert all(r["path"].startswith("file:/") for r in bad.collect())
    assert sorted(r["n"] for r in good.collect()) == sorted([*range(250), *range(200), *range(200), *[x for x in range(100)] * 3])


def test_no_flip_of_a_byte_stops_the_scan(spark):
    """Any single damaged byte gives rows, a reject or both; never an error, and never a row that is not there."""
    schema, rows = numbers(60)
    raw = CT.container(schema, rows, "null", block=20)
    rng = random.Random(3)
    files = [(f"{i}", bytearray(raw[:at] + bytes([raw[at] ^ rng.randrange(1, 256)]) + raw[at + 1:])) for i, at in enumerate(range(0, len(raw), 2))]
    df = spark.createDataFrame(files + [("null", None)], "path string, content binary").repartition(2)
    decoded = CT.decode(df, T.StructType([T.StructField("n", T.LongType())])).collect()
    assert len(decoded) > 60 and any(r["reject_path"] == "null" for r in decoded)


def test_scan_alerts_skips_damage_and_names_it(spark):
    schema, rows = numbers(150)
    raw = CT.container(schema, rows, block=100)
    folder = put(local(spark, "skip"), {"a.avro": raw, "b.avro": raw[:-3]})
    os.makedirs(f"{folder}/deeper")
    put(f"{folder}/deeper", {"a.avro": raw[:len(raw) // 2]})
    kind = T.StructType([T.StructField("n", T.IntegerType())])
    assert SRC.scan_alerts(spark, folder, "avro", kind, ignore_corrupt=True).count() == 150 + 100
    told = {r["path"].rpartition("/skip/")[2].partition("/")[2]: (r["length"], r["n_rows"]) for r in SRC.rejected_files(spark, folder, "avro", kind).collect()}
    assert told == {"b.avro": (len(raw) - 3, 100), "deeper/a.avro": (len(raw) // 2, 0)}


def test_rejected_file_is_not_hidden_by_a_good_one_of_its_name_and_size(spark):
    base = local(spark, "twins")
    spark.range(5).coalesce(1).write.parquet(f"{base}/one")
    name = next(f for f in os.listdir(f"{base}/one") if f.startswith("part"))
    size = os.path.getsize(f"{base}/one/{name}")
    put(f"{base}/two", {name: b"\0" * size})
    bad = SRC.rejected_files(spark, [f"{base}/one", f"{base}/two"], "parquet", T.StructType([T.StructField("id", T.LongType())])).collect()
    assert [r["path"].rpartition("/twins/")[2].split("/")[1] for r in bad] == ["two"]
    assert bad[0]["length"] == size


def test_empty_folder_and_no_readable_container(spark):
    none = spark.createDataFrame([], "path string, content binary")
    good, bad = CT.scan_containers(none)
    assert good.collect() == [] == bad.collect()
    only = spark.createDataFrame([("x", bytearray(b"junk"))], "path string, content binary")
    good, bad = CT.scan_containers(only)
    assert good.collect() == [] and [r["path"] for r in bad.collect()] == ["x"]


def test_both_readers_agree(spark):
    """Containers written by the Java library read here, and ours by the Java library."""
    schema, rows = numbers(30)
    folder = put(local(spark, "ours"), {"a.avro": CT.container(schema, rows, block=7)})
    kind = T.StructType([T.StructField("n", T.LongType())])
    assert sorted(r["n"] for r in SRC.scan_alerts(spark, folder, "avro-mapred", kind).collect()) == list(range(30))
    jvm, theirs = spark._jvm, local(spark, "theirs")
    os.makedirs(theirs)
    parsed = jvm.org.apache.avro.Schema.Parser().parse(json.dumps(schema))
    writer = jvm.org.apache.avro.file.DataFileWriter(jvm.org.apache.avro.generic.GenericDatumWriter(parsed))
    writer.setCodec(jvm.org.apache.avro.file.CodecFactory.deflateCodec(3))
    writer.create(parsed, jvm.java.io.File(f"{theirs}/b.avro"))
    for r in rows:
        rec = jvm.org.apache.avro.generic.GenericData.Record(parsed)
        rec.put("n", r["n"])
        writer.append(rec)
    writer.close()
    good, bad = CT.scan_containers(CT.container_files(spark, theirs))
    assert sorted(r["n"] for r in good.collect()) == list(range(30)) and bad.collect() == []
