"""Avro containers read block by block: their own schemas, and a reject row for damage.

``AvroAsTextInputFormat`` and Spark's Avro source give up a whole file for one damaged
block, and read with a schema given from outside. Here executors walk the blocks
of each container (header, then count, size, payload and sync marker), decode the
records with the writer schema of that very file, and give them to one reader
schema resolved over the file set: fields of any version, numbers widened (int,
long, float, double), null where a version lacks a field. At the first damage of a
file the records before it are kept and a reject row names path, offset and
reason; the rest of the file follows no marker that can be trusted.

Input is a table of ``path`` and ``content`` as Spark's binary-file source gives it
(batch or stream), so containers can lie in any store Spark reads. A container is
read by one task; sets of many moderate files spread over the cluster. Files of
length zero hold nothing and are not listed by Spark, so they have no reject row.

Codecs: null, deflate, bzip2, xz, zstandard. Logical types are read as the types they annotate.
"""

from __future__ import annotations

import bz2
import json
import lzma
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from alertflow.session import scratch_path

# Fixed values of the container format.
MAGIC = b"Obj\x01"
SYNC = 16
# What is decoded before a batch of rows is given out: payload bytes, or records (as objects they take many times their bytes).
BATCH_BYTES, BATCH_RECORDS = 8 << 20, 8192

_REJECT = [T.StructField("reject_path", T.StringType(), True), T.StructField("reject_offset", T.LongType(), True),
           T.StructField("reject_reason", T.StringType(), True), T.StructField("reject_kept", T.LongType(), True)]


class Damage(Exception):
    """A place in a container that cannot be read."""

    def __init__(self, offset: int, reason: str):
        super().__init__(reason)
        self.offset, self.reason = offset, reason


# ---------------------------------------------------------------- reading values

def _long(b: bytes, at: int) -> tuple[int, int]:
    """Zigzag variable-length integer."""
    shift = value = 0
    while True:
        byte = b[at]  # IndexError past the end
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            if value >> 64:
                raise ValueError("integer too long")
            return (value >> 1) ^ -(value & 1), at
        shift += 7
        if shift > 63:
            raise ValueError("integer too long")


def _int(b: bytes, at: int) -> tuple[int, int]:
    value, at = _long(b, at)
    if not -(1 << 31) <= value < 1 << 31:
        raise ValueError("integer beyond 32 bits")
    return value, at


def _bytes(b: bytes, at: int) -> tuple[bytes, int]:
    n, at = _long(b, at)
    if n < 0 or at + n > len(b):
        raise ValueError("length beyond the block")
    return bytes(b[at:at + n]), at + n


def _items(read: Callable, b: bytes, at: int) -> Iterator:
    """Values of an array's or a map's blocks; the last thing yielded is the position."""
    out = []
    while True:
        n, at = _long(b, at)
        if n == 0:
            return out, at
        if n < 0:
            n = -n
            _, at = _long(b, at)
        if n > len(b):
            raise ValueError("more items than bytes")
        for _ in range(n):
            value, at = read(b, at)
            out.append(value)


def value_reader(schema, named: dict | None = None) -> Callable:
    """``read(bytes, position) -> (value, position)`` for an Avro schema."""
    named = {} if named is None else named
    if isinstance(schema, list):
        options = [value_reader(s, named) for s in schema]

        def union(b, at):
            i, at = _long(b, at)
            if not 0 <= i < len(options):
                raise ValueError("union branch out of range")
            return options[i](b, at)
        return union
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return value_reader(kind, named)
    if kind == "record":
        fields: list = []

        def record(b, at):
            out = {}
            for name, read in fields:
                out[name], at = read(b, at)
            return out, at
        _name(schema, record, named)
        fields += [(f["name"], value_reader(f["type"], named)) for f in schema["fields"]]
        return record
    if kind == "enum":
        symbols = schema["symbols"]

        def enum(b, at):
            i, at = _long(b, at)
            return symbols[i], at
        _name(schema, enum, named)
        return enum
    if kind == "fixed":
        size = schema["size"]

        def fixed(b, at):
            if at + size > len(b):
                raise ValueError("fixed value beyond the block")
            return bytes(b[at:at + size]), at + size
        _name(schema, fixed, named)
        return fixed
    if kind == "array":
        item = value_reader(schema["items"], named)
        return lambda b, at: _items(item, b, at)
    if kind == "map":
        value = value_reader(schema["values"], named)

        def pair(b, at):
            key, at = _bytes(b, at)
            v, at = value(b, at)
            return (key.decode(), v), at
        return lambda b, at: _items(pair, b, at)
    plain = _PLAIN.get(kind)
    if plain:
        return plain
    if kind in named:
        return lambda b, at: named[kind](b, at)
    raise ValueError(f"unknown type {kind!r}")


def _name(schema: dict, read: Callable, named: dict) -> None:
    named[schema["name"]] = read
    if schema.get("namespace"):
        named[f"{schema['namespace']}.{schema['name']}"] = read


def _unpacked(form: str, size: int) -> Callable:
    form = struct.Struct(form)
    return lambda b, at: (form.unpack_from(b, at)[0], at + size)


def _text(b, at):
    raw, at = _bytes(b, at)
    return raw.decode(), at


_PLAIN = {"null": lambda b, at: (None, at), "boolean": lambda b, at: (b[at] != 0, at + 1), "int": _int, "long": _long,
          "float": _unpacked("<f", 4), "double": _unpacked("<d", 8), "bytes": _bytes, "string": _text}


# ---------------------------------------------------------------- blocks

def _zstd(data: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


_CODECS = {"null": bytes, "deflate": lambda d: zlib.decompress(d, -15), "bzip2": bz2.decompress, "xz": lzma.decompress, "zstandard": _zstd}


def header(content: bytes) -> tuple[dict, str, bytes, int]:
    """``(writer schema, codec, sync marker, offset of the first block)``."""
    if content[:4] != MAGIC:
        raise Damage(0, "no container magic")
    try:
        pairs, at = _items(lambda b, at: _entry(b, at), content, 4)
        meta = dict(pairs)
        schema = json.loads(meta["avro.schema"])
        codec = meta.get("avro.codec", b"null").decode()
    except (IndexError, KeyError, ValueError) as e:
        raise Damage(4, f"unreadable header: {e}") from e
    try:
        value_reader(schema)
        kind = spark_type(schema)
    except Exception as e:  # noqa: BLE001 - whatever stands where a schema should
        raise Damage(4, f"unreadable schema: {e}") from e
    if not isinstance(kind, T.StructType):
        raise Damage(4, "the schema is no record")
    if at + SYNC > len(content):
        raise Damage(at, "header without sync marker")
    return schema, codec, content[at:at + SYNC], at + SYNC


def _entry(b, at):
    key, at = _bytes(b, at)
    value, at = _bytes(b, at)
    return (key.decode(), value), at


def blocks(content: bytes, codec: str, sync: bytes, at: int) -> Iterator[tuple[int, int, bytes]]:
    """``(offset, records, payload)`` of each block; :class:`Damage` at the first one that cannot be read."""
    unpack = _CODECS.get(codec)
    if unpack is None:
        raise Damage(at, f"codec {codec!r}")
    while at < len(content):
        start = at
        try:
            count, at = _long(content, at)
            size, at = _long(content, at)
        except (IndexError, ValueError) as e:
            raise Damage(start, "truncated block") from e
        if count < 0 or size < 0:
            raise Damage(start, "negative block size")
        if at + size + SYNC > len(content):
            raise Damage(start, "truncated block")
        if content[at + size:at + size + SYNC] != sync:
            raise Damage(start, "sync marker differs")
        try:
            payload = unpack(content[at:at + size])
        except Exception as e:  # noqa: BLE001 - any codec's error is damage of this block
            raise Damage(start, "payload does not decompress") from e
        yield start, count, payload
        at += size + SYNC


def records(content: bytes, read: Callable, codec: str, sync: bytes, at: int) -> Iterator[tuple[list[dict], int]]:
    """The records of each block, with its payload's size; a block that does not decode in full gives none of its records."""
    for start, count, payload in blocks(content, codec, sync, at):
        out, pos = [], 0
        try:
            for _ in range(count):
                value, pos = read(payload, pos)
                out.append(value)
        except Exception as e:  # noqa: BLE001 - whatever the bytes made the decoder do
            raise Damage(start, "record does not decode") from e
        if pos != len(payload):
            raise Damage(start, "bytes left behind the block's records")
        yield out, len(payload)


# ---------------------------------------------------------------- schemas

def spark_type(schema, named: dict | None = None) -> T.DataType:
    """Spark type of an Avro schema (a union of null and one type, or of numbers)."""
    named = {} if named is None else named
    if isinstance(schema, list):
        kinds = [spark_type(s, named) for s in schema if s != "null"]
        out = kinds[0] if kinds else T.NullType()
        for k in kinds[1:]:
            out = widened(out, k, "union")
        return out
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return spark_type(kind, named)
    if kind == "record":
        out = T.StructType([T.StructField(f["name"], spark_type(f["type"], named), True) for f in schema["fields"]])
        named[schema["name"]] = out
        return out
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"], named), True)
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"], named), True)
    if kind in ("enum", "fixed"):
        named[schema["name"]] = T.StringType() if kind == "enum" else T.BinaryType()
        return named[schema["name"]]
    plain = {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
             "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType()}
    if kind in plain:
        return plain[kind]
    if kind in named:
        return named[kind]
    raise ValueError(f"unknown type {kind!r}")


_WIDTH = [T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def widened(a: T.DataType, b: T.DataType, where: str) -> T.DataType:
    """The type that holds values of both; fields of either record."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WIDTH and b in _WIDTH:
        i, j = sorted((_WIDTH.index(a), _WIDTH.index(b)))
        return T.DoubleType() if j == 2 and i < 2 else _WIDTH[j]  # a float would round whole numbers
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        both = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            both[f.name] = widened(both[f.name], f.dataType, f"{where}.{f.name}") if f.name in both else f.dataType
        return T.StructType([T.StructField(n, t, True) for n, t in both.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType, where), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(T.StringType(), widened(a.valueType, b.valueType, where), True)
    raise ValueError(f"{where}: {a.simpleString()} and {b.simpleString()} cannot be one field")


def resolve(schemas: list[dict]) -> T.StructType:
    """One reader schema over writer schemas: every field of any of them, in order of first appearance."""
    out: T.DataType = T.StructType([])
    for s in schemas:
        out = widened(out, spark_type(s), s.get("name", "record"))
    return out


def container_files(spark: SparkSession, paths: str | list[str], glob: str = "*.avro") -> DataFrame:
    """``path, content`` of the containers in folders."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load([paths] if isinstance(paths, str) else list(paths)).select("path", "content"))


def writer_schemas(files: DataFrame, limit: int = 10_000) -> list[dict]:
    """The distinct writer schemas of the files, in the order of the first path that has them; read from headers on executors."""
    def heads(batches):
        for b in batches:
            paths, texts = [], []
            for path, content in zip(b.column("path"), b.column("content")):
                try:
                    schema = header(content.as_buffer().to_pybytes())[0] if content.is_valid else None
                except Damage:
                    schema = None
                if schema is not None:
                    paths.append(path.as_py())
                    texts.append(json.dumps(schema))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], ["path", "schema"])

    found = files.select("path", "content").mapInArrow(heads, "path string, schema string").groupBy("schema").agg(F.min("path").alias("path"))
    rows = found.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} writer schemas")
    return [json.loads(r["schema"]) for r in sorted(rows, key=lambda r: r["path"])]


# ---------------------------------------------------------------- decoding

def _fitted(kind: T.DataType) -> Callable | None:
    """Values of a writer's type as the reader's: missing fields null, whole numbers widened."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return lambda v: None if v is None else float(v)
    if isinstance(kind, T.StructType):
        fits = [(f.name, _fitted(f.dataType)) for f in kind.fields]
        return lambda v: None if v is None else {n: (fit(v.get(n)) if fit else v.get(n)) for n, fit in fits}
    if isinstance(kind, T.ArrayType):
        fit = _fitted(kind.elementType)
        return (lambda v: None if v is None else [fit(x) for x in v]) if fit else None
    if isinstance(kind, T.MapType):
        fit = _fitted(kind.valueType)
        return (lambda v: None if v is None else [(k, fit(x)) for k, x in v]) if fit else None
    return None


def decoded_batches(batches: Iterator[pa.RecordBatch], out: T.StructType, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows of ``out`` for batches of ``path, content``; given out after some bytes or records, whatever a file holds."""
    kind, fit = to_arrow_schema(out), _fitted(schema)
    nothing = dict.fromkeys(n for n in out.names)
    readers: dict[str, Callable] = {}
    for b in batches:
        held, size = [], 0
        for path, content in zip(b.column("path").to_pylist(), b.column("content")):
            raw = content.as_buffer().to_pybytes() if content.is_valid else b""
            kept = 0
            try:
                writer, codec, sync, at = header(raw)
                name = json.dumps(writer)
                if name not in readers:
                    readers[name] = value_reader(writer)
                for rows, n in records(raw, readers[name], codec, sync, at):
                    held += [nothing | {"record": fit(r)} for r in rows]
                    size, kept = size + n, kept + len(rows)
                    if size >= BATCH_BYTES or len(held) >= BATCH_RECORDS:
                        yield pa.RecordBatch.from_pylist(held, schema=kind)
                        held, size = [], 0
            except Damage as e:
                held.append(nothing | {"reject_path": path, "reject_offset": e.offset, "reject_reason": e.reason, "reject_kept": kept})
        yield pa.RecordBatch.from_pylist(held, schema=kind)


def decode(files: DataFrame, schema: T.StructType) -> DataFrame:
    """``record`` (a struct of ``schema``) per record, or a reject per damaged file, in one pass; batch or stream."""
    out = T.StructType([T.StructField("record", schema, True), *_REJECT])
    return files.select("path", "content").mapInArrow(lambda batches: decoded_batches(batches, out, schema), out)


def scan_containers(files: DataFrame, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of container files; without ``schema`` it is resolved over the files' own.

    Decoded once, into the shared folder; rejects are ``path, offset, reason, n_rows``
    with the number of records kept before the damage.
    """
    spark = files.sparkSession
    schema = resolve(writer_schemas(files)) if schema is None else schema
    if not schema.fields:  # no readable container: rejects alone
        schema = T.StructType([T.StructField("_none", T.StringType())])
    decoded = decode(files, schema)
    path = scratch_path(spark, "containers")
    decoded.write.parquet(path)
    rows = spark.read.schema(decoded.schema).parquet(path)
    good = rows.where("reject_reason is null").select("record.*")
    bad = rows.where("reject_reason is not null").select(
        F.col("reject_path").alias("path"), F.col("reject_offset").alias("offset"), F.col("reject_reason").alias("reason"),
        F.col("reject_kept").alias("n_rows"))
    return good, bad


# ---------------------------------------------------------------- writing (fixtures, and containers as message payloads)

def _write_long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _write(schema, value, named: dict) -> bytes:
    if isinstance(schema, list):
        at = schema.index("null") if value is None else next(i for i, s in enumerate(schema) if s != "null")
        return _write_long(at) + _write(schema[at], value, named)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(schema, dict) and "name" in schema:
        named[schema["name"]] = schema
    if isinstance(kind, (dict, list)):
        return _write(kind, value, named)
    if isinstance(kind, str) and kind in named and kind is schema:
        return _write(named[kind], value, named)
    if kind == "record":
        return b"".join(_write(f["type"], value.get(f["name"]), named) for f in schema["fields"])
    if kind == "array":
        return (_write_long(len(value)) + b"".join(_write(schema["items"], v, named) for v in value) if value else b"") + b"\0"
    if kind == "map":
        return (_write_long(len(value)) + b"".join(_write("string", k, named) + _write(schema["values"], v, named) for k, v in value.items()) if value else b"") + b"\0"
    if kind == "enum":
        return _write_long(schema["symbols"].index(value))
    if kind in ("int", "long"):
        return _write_long(value)
    if kind in ("float", "double"):
        return struct.pack("<f" if kind == "float" else "<d", value)
    if kind == "boolean":
        return bytes([bool(value)])
    if kind == "null":
        return b""
    if kind == "fixed":
        return value
    raw = value.encode() if kind == "string" else value
    return _write_long(len(raw)) + raw


def container(schema: dict, rows: list[dict], codec: str = "deflate", block: int = 100, sync: bytes = b"alertflow-marker") -> bytes:
    """A container of ``rows``; the same bytes for the same rows."""
    meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
    out = [MAGIC, _write_long(len(meta)), *[_write("string", k, {}) + _write("bytes", v, {}) for k, v in meta.items()], b"\0", sync]
    for a in range(0, len(rows), block):
        payload = b"".join(_write(schema, r, {}) for r in rows[a:a + block])
        if codec == "deflate":
            press = zlib.compressobj(6, zlib.DEFLATED, -15)
            payload = press.compress(payload) + press.flush()
        out += [_write_long(len(rows[a:a + block])), _write_long(len(payload)), payload, sync]
    return b"".join(out)
