"""Token-id files: whole texts encoded, Simple-8b coded and written in document order.

``write_token_files`` encodes where the texts lie and deals their ids, half the bytes
of the texts, to ranges of the document id (quantiles of the id column alone), so
file k holds documents below those of file k+1. An id, or the null id, that spans
several ranges is dealt over them by a hash of the text. It writes through Spark's Parquet committer: a lost executor's partial
files never become visible. A file row is one chunk of whole documents with the
count of ids before it in its file. ``read_token_files``
needs one prefix sum over the files (as many rows as write tasks) to place every
document in the whole stream.

Defined results: a null or empty text has only the end id; null ids come first;
rows of one id are ordered by a hash of the text; no rows give no files and no rows; other
columns are ignored; a text of any length is tokenised in bounded segments.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertflow.llm import simple8b
from alertflow.llm.common import n_shuffle
from alertflow.llm.tokens import cache_for, release

CHUNK_IDS = 1 << 18  # a chunk closes once it holds so many ids; it is coded and decoded in one go
MAX_FILES = 1_000_000  # bound of the per-file prefix table
_FILE_SCHEMA = "part int, chunk int, base long, n_ids long, doc_ids array<bigint>, n_tokens array<bigint>, payload binary"


def write_token_files(docs: DataFrame, path: str, vocab: str, end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, write chunks in ascending id order."""
    n = n_shuffle(docs.sparkSession)
    encoded = _encoded(docs, vocab, end_id, id_col, text_col, *_ranges(docs, id_col, n))
    ordered = encoded.repartitionById(n, "part").sortWithinPartitions("doc_id", "th", "ids")

    def chunks(batches):
        release()
        part = TaskContext.get().partitionId()
        state = {"chunk": 0, "base": 0}
        ids, counts, data, held = [], [], [], 0

        def close():
            stream = np.concatenate(data)
            row = (part, state["chunk"], state["base"], len(stream), list(ids), list(counts), simple8b.encode(stream))
            state["chunk"] += 1
            state["base"] += len(stream)
            ids.clear(), counts.clear(), data.clear()
            return _batch(row)

        for batch in batches:
            for doc, wide, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "wide", "ids"))):
                stream = np.frombuffer(raw, "<u4" if wide else "<u2")
                ids.append(doc)
                counts.append(len(stream))
                data.append(stream)
                held += len(stream)
                if held >= CHUNK_IDS:
                    held = 0
                    yield close()
        if ids:
            yield close()

    ordered.select("doc_id", "wide", "ids").mapInArrow(chunks, _FILE_SCHEMA).write.parquet(path)


def _ranges(docs: DataFrame, id_col: str, n: int) -> tuple[int, np.ndarray]:
    """How many of ``n`` ranges the null ids take, and the upper ends of the others but the last."""
    key = F.col(id_col).cast("long")
    total, known = docs.agg(F.count(F.lit(1)), F.count(key)).first()
    nulls = min(n - 1, n * (total - known) // max(1, total))
    shares = [(i + 1) / (n - nulls) for i in range(n - nulls - 1)]
    if not known or not shares:
        return nulls, np.zeros(0, np.int64)
    ends = docs.agg(F.percentile_approx(key, F.array(*[F.lit(x) for x in shares]), F.lit(max(10_000, 10 * n)))).first()[0]
    return nulls, np.array(ends, np.int64)


def ranges_of(ids: np.ndarray, null: np.ndarray, th: np.ndarray, nulls: int, ends: np.ndarray) -> np.ndarray:
    """Range of each row, in the order of (id, hash); nulls come first."""
    low, high = np.searchsorted(ends, ids, "left"), np.searchsorted(ends, ids, "right")
    low, high = np.where(null, 0, low + nulls), np.where(null, max(0, nulls - 1), high + nulls)
    place = (th.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)  # as the signed hash sorts
    return (low + (place * (high - low + 1).astype(np.uint64) >> np.uint64(32)).astype(np.int64)).astype(np.int32)


def _encoded(docs: DataFrame, vocab: str, end_id: int, id_col: str, text_col: str, nulls: int, ends: np.ndarray) -> DataFrame:
    """``part, doc_id, th, wide, ids``: each whole text's ids and the end id, two bytes an id where all fit."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def encode(batches):
        cache = cache_for(vocab)
        for batch in batches:
            wide, out = [], []
            for enc in cache.encode(batch.column("text").to_pylist()):
                stream = np.empty(len(enc) // 4 + 1, "<u4")
                stream[:-1], stream[-1] = np.frombuffer(enc, "<u4"), end_id
                wide.append(bool(stream.max() >> 16))
                out.append((stream if wide[-1] else stream.astype("<u2")).tobytes())
            ids, th = batch.column("doc_id"), batch.column("th").to_numpy()
            part = ranges_of(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), th, nulls, ends)
            yield pa.RecordBatch.from_arrays([pa.array(part), ids, batch.column("th"), pa.array(wide, pa.bool_()), pa.array(out, pa.binary())],
                                             ["part", "doc_id", "th", "wide", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    return rows.mapInArrow(encode, "part int, doc_id long, th long, wide boolean, ids binary")


def _batch(row: tuple) -> pa.RecordBatch:
    part, chunk, base, n_ids, ids, counts, payload = row
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([base], pa.int64()),
         pa.array([n_ids], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
         pa.array([counts], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
        ["part", "chunk", "base", "n_ids", "doc_ids", "n_tokens", "payload"])


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Chunks with ``start``: ids of the whole stream before the chunk."""
    files = spark.read.schema(_FILE_SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("part", F.coalesce(F.sum("ids").over(w), F.lit(0)).cast("long").alias("file_start"))
    if totals.count() > MAX_FILES:
        raise ValueError(f"more than {MAX_FILES} token files")
    return files.join(F.broadcast(before), "part").withColumn("start", F.col("file_start") + F.col("base"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents read back: ``doc_id, start, n_tokens, ids`` (little-endian uint32 bytes)."""
    return _read(spark, path, False)


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Documents read back, with the crc32 of their ids in place of the ids."""
    return _read(spark, path, True)


def _read(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    def documents(batches):
        release()
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("start", "doc_ids", "n_tokens", "payload")]
            for start, docs, counts, payload in zip(*cols):
                raw = memoryview(simple8b.decode(payload).astype("<u4").tobytes())
                ends = np.cumsum(counts)
                starts = ends - counts
                cut = [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                last = (pa.array([zlib.crc32(c) for c in cut], pa.int64()) if digest
                        else pa.array([bytes(c) for c in cut], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(starts + start, pa.int64()),
                     pa.array(counts, pa.int64()), last], names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"]
    schema = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary")
    return _placed(spark, path).select("start", "doc_ids", "n_tokens", "payload").mapInArrow(documents, schema)
