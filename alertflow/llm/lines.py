"""Line dedup by overlapping three-line windows, in DataFrame operations only.

A text is its lines (split at ``\\n``). Every run of three consecutive lines is a
window, named by 128 bits of hash over its lines. A window's first occurrence, by
document id and then by place, stays; the lines of every later occurrence go, so
windows that overlap remove the whole repeated passage. Within a document the
later places of a window are found by sorting its windows; across documents each
(document, window) pair counts once, and the smallest id is taken with map-side
combining, so a passage in a third of all documents reaches its task as one row
per input task. Only repeated windows are joined back; AQE splits the partition
of a hot one.

Defined results: null text counts as empty; texts of fewer than three lines have
no window and stay as they are; windows of three empty lines match nothing; rows
with a null id come after all others; rows of one id (or all of null id) count as
one document across documents, each row on its own within; no rows give no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import written

WINDOW = 3


def windows(lines: Column) -> Column:
    """Array of ``(a, b, pos, empty)``: two independent 64-bit hashes of each window and its first line's index.

    The hashed lines are zipped with themselves one and two lines on, so a text
    of n lines costs n steps (reading them by index in a lambda would rebuild
    the array at every step).
    """
    hashed = F.transform(lines, lambda x: F.struct(F.xxhash64(F.lit(1), x).alias("a"), F.xxhash64(F.lit(2), x).alias("b"),
                                                   (x == "").alias("empty")))
    n = F.size(lines) - (WINDOW - 1)
    zipped = F.arrays_zip(*[F.slice(hashed, k + 1, n).alias(f"l{k}") for k in range(WINDOW)])
    parts = [f"l{k}" for k in range(WINDOW)]
    return F.transform(zipped, lambda z, i: F.struct(
        F.xxhash64(*[z[k]["a"] for k in parts]).alias("a"), F.xxhash64(*[z[k]["b"] for k in parts]).alias("b"),
        i.alias("pos"), (z["l0"]["empty"] & z["l1"]["empty"] & z["l2"]["empty"]).alias("empty")))


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with its sorted windows ``ws``; ``again`` says the window came earlier in the row."""
    cut = rows.where(F.size("lines") >= WINDOW)
    ws = cut.withColumn("ws", F.array_sort(F.filter(windows(F.col("lines")), lambda w: ~w["empty"])))
    before = F.concat(F.array(F.lit(None).cast(ws.schema["ws"].dataType.elementType)), F.slice("ws", 1, F.greatest(F.size("ws") - 1, F.lit(0))))
    marked = F.zip_with("ws", before, lambda w, p: F.struct(
        w["a"].alias("a"), w["b"].alias("b"), w["pos"].alias("pos"),
        F.coalesce((w["a"] == p["a"]) & (w["b"] == p["b"]), F.lit(False)).alias("again")))
    return ws.withColumn("ws", F.filter(marked, lambda w: w["a"].isNotNull())).drop("lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_lines, n_removed`` of every row: the text without later occurrences."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lined = rows.withColumn("lines", F.split("text", "\n"))
    # one row per (row, window): its hashes, the places after the first go whatever other documents hold
    marked = written(_marked(lined.select("doc_id", F.xxhash64("text").alias("th"), "lines"))
                     .select("doc_id", "th", F.inline("ws")), "lines-windows")
    firsts = marked.where(~F.col("again"))
    repeated = written(firsts.groupBy("a", "b").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                       .where("n > 1").drop("n"), "lines-repeated")
    # both sides grow with the data, so they are merged at every size
    later = (firsts.join(repeated.hint("merge"), ["a", "b"]).where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
             .select("doc_id", "th", "pos"))
    gone = (later.unionByName(marked.where("again").select("doc_id", "th", "pos"))
            .groupBy(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"))
            .agg(F.collect_set("pos").alias("starts")))
    # the narrow table of a partition is hashed and the texts stream past it: no text is sorted or held
    joined = rows.join(written(gone, "lines-gone").hint("shuffle_hash"),
                       F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.xxhash64("text") == F.col("g_th")), "left")
    joined = joined.withColumn("lines", F.split("text", "\n"))
    covered = F.flatten(F.transform("starts", lambda p: F.sequence(p, p + WINDOW - 1)))
    # merged covered positions: what is left keeps its order
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), covered)
    clean = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return joined.select("doc_id", F.when(F.col("starts").isNull(), F.col("text")).otherwise(clean).alias("text"),
                         F.size("lines").cast("long").alias("n_lines"),
                         F.when(F.col("starts").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size(kept))
                         .cast("long").alias("n_removed"))
