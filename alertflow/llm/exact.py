"""Exact dedup: one row per document with the row that stays for its text.

Rows are grouped by a 128-bit content hash. Where a hash has several rows, the
texts inside the group are compared byte for byte; texts that differ under one
hash are kept apart. Grouping combines map-side, so a group that holds a third of
the table reaches its task as one row per input task. Only ids and hashes are
shuffled, and of repeated texts one copy per task for the comparison.

Defined results: null text counts as empty; rows with a null id have a group but
lose to any id (an all-null group keeps null, ``kept`` true); rows that repeat the
id that stays are one document: all are marked kept, and ``drop_exact_copies`` leaves
one of them; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import one_row_each, written


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                 hash_expr: Callable[[Column], Column] = content_hash) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row; ``keep`` is ``min`` or ``max``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pick = {"min": F.min, "max": F.max}[keep]
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    hashed = source.select("doc_id", hash_expr(F.col("text")).alias("h"),
                           F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    ids = written(hashed, "exact-hashed")
    repeated = written(ids.groupBy("h").agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                       .where("group_size > 1"), "exact-groups")

    # byte comparison inside the groups: the distinct texts of each repeated hash
    texts = (source.select(hash_expr(F.col("text")).alias("h"), "text")
             .join(repeated.select("h"), "h", "left_semi")
             .groupBy("h", "text").agg(F.count(F.lit(1)).alias("n")))
    clashing = written(texts.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h"),
                       "exact-clashes")
    if clashing.isEmpty():
        grouped = ids.join(repeated, "h", "left")
    else:
        grouped = _split_clashes(source, ids, repeated, clashing, pick, hash_expr)
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return grouped.select("doc_id", keep_id.alias("keep_id"),
                          F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                          F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256")


def _split_clashes(source, ids, repeated, clashing, pick, hash_expr) -> DataFrame:
    """Groups of colliding hashes are formed by the text itself."""
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    rows = source.select("doc_id", "text", hash_expr(F.col("text")).alias("h"), sha)
    apart = rows.join(clashing, "h", "left_semi").drop("h")
    groups = written(apart.groupBy("text").agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
                     "exact-apart")
    cols = ["doc_id", "text_sha256", "keep_id", "group_size"]
    plain = ids.join(clashing, "h", "left_anti").join(repeated, "h", "left").select(*cols)
    return plain.unionByName(apart.join(groups, "text").select(*cols))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each text, also of rows that repeat id and text."""
    groups = written(exact_groups(docs, id_col, text_col, keep), "exact-decided")
    gone = written(groups.where(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), F.col("text_sha256").alias("_gone_text"))
                   .distinct(), "exact-gone")
    again = written(groups.where("kept").groupBy(F.col("doc_id").alias("_twice_id"), F.col("text_sha256").alias("_twice_text"))
                    .agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "exact-twice")
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    # the rows to drop grow with the data, so the join is a merge at every size
    stay = docs.join(gone.hint("merge"), F.col(id_col).eqNullSafe(F.col("_gone_id")) & (sha == F.col("_gone_text")), "left_anti")
    return one_row_each(stay, again, F.col(id_col).eqNullSafe(F.col("_twice_id")) & (sha == F.col("_twice_text")))
