"""Vector code compression: product quantisation by member-resident Lloyd rounds.

A vector is scaled to integers and cut into equal consecutive parts; each part
position has a codebook. Parts are rows that live with their owner, a (position,
entry, salt) key: the table of members is dealt by that key once, after the first
assignment. In a round every owner sums its resident members; the sums per
(position, entry) give the new codebooks. The members are then assigned again
where they are. Those that keep their entry stay in their files; only the parts
that change entry go through the next shuffle, to their new owners. The salt
bounds an owner: an entry that holds a third of all parts is many owners.

Only codebooks (entries x dimensions integers) and their sums reach the driver.
All arithmetic is on integers and exact.

Defined results: rows whose vector is null or holds null or non-finite components
are dropped, and so are rows whose components are too large for exact 64-bit
sums (2**27 after scaling) and rows whose length is not the commonest one that can
be cut into the parts (ties: the shorter). Fewer rows than entries give a codebook
of that many entries. Null ids come last in the choice of the first entries, rows
of one id are ordered by their components; repeated rows each have a result. Null
labels are one label. No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import written
from alertflow.llm.vectors import all_finite, doubles, floors, lists, matrix, small_enough
from alertflow.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0
OWNER_ROWS = 4096  # most vectors whose part at one position falls to one owner
_MEMBER = "rid long, pos int, entry int, salt long, part array<int>"


def _kept(vectors: DataFrame, parts: int, scale: float, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``rid, vec_id, label, v``: the rows that take part, each with a key of its own."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), doubles(vec_col).alias("x"))
    rows = rows.where(all_finite(F.col("x")) & (F.size("x") > 0) & (F.size("x") % parts == 0))
    rows = rows.where(small_enough(F.col("x"), scale))
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    rows = rows.where(F.size("x") == F.lit(sizes["d"] if sizes else 0))
    # the key is fixed by the written table
    return written(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label",
                               floors(F.col("x"), scale).alias("v")), "codes-rows")


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the lower) and the squared distance, exactly."""
    index, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for a in range(0, len(parts), 8192):
        p = parts[a:a + 8192]
        most = max(int(np.abs(p).max(initial=0)), int(np.abs(book).max(initial=0)))
        if p.shape[1] * most * most < 1 << 50:  # every product and sum is a whole number that a double holds
            d = (p * p).sum(1)[:, None] - 2.0 * (p.astype(float) @ book.T.astype(float)) + (book * book).sum(1)[None, :]
        else:
            d = np.stack([((p - c) ** 2).sum(1) for c in book], axis=1)
        at = d.argmin(1)
        index[a:a + 8192], error[a:a + 8192] = at, ((p - book[at]) ** 2).sum(1)
    return index, error


def _salt(rid: np.ndarray, salts: int) -> np.ndarray:
    return ((rid & 0x1FFFFFFFF) + (rid >> 33)) % salts


def _dealt(books: np.ndarray, salts: int):
    """Whole vectors to assigned parts."""
    def deal(batches):
        for b in batches:
            v = matrix(b.column("v"))
            if not len(v):
                continue
            rid = b.column("rid").to_numpy()
            for pos, book in enumerate(books):
                p = v[:, pos * book.shape[1]:(pos + 1) * book.shape[1]]
                entry, _ = nearest(p, book)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid), pa.array(np.full(len(rid), pos, np.int32)), pa.array(entry.astype(np.int32)),
                     pa.array(_salt(rid, salts)), lists(p.astype(np.int32), pa.int32())],
                    ["rid", "pos", "entry", "salt", "part"])
    return deal


def _judged(books: np.ndarray):
    """Members with the entry that is nearest now, its squared distance, and whether it is another one."""
    def judge(batches):
        for b in batches:
            if not b.num_rows:
                continue
            pos, old = b.column("pos").to_numpy(), b.column("entry").to_numpy()
            p = matrix(b.column("part"))
            entry, error = np.empty(len(pos), np.int64), np.empty(len(pos), np.int64)
            for k in np.unique(pos):
                at = np.flatnonzero(pos == k)
                entry[at], error[at] = nearest(p[at], books[k])
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("pos"), pa.array(entry.astype(np.int32)), b.column("salt"), b.column("part"),
                 pa.array(error), pa.array(entry != old)], ["rid", "pos", "entry", "salt", "part", "error", "moved"])
    return judge


def _owned(members: DataFrame) -> DataFrame:
    return members.repartition("pos", "entry", "salt")


def _updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """New codebooks from the sums of the resident members; an entry without members stays."""
    width = books.shape[2]
    sums = members.groupBy("pos", "entry").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("part")[j].cast("decimal(28,0)")).alias(f"s{j}") for j in range(width)])
    new = books.copy()
    for r in sums.collect():  # positions x entries rows at most
        new[r["pos"], r["entry"]] = [int(r[f"s{j}"]) // r["n"] for j in range(width)]
    return new


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"):
    """``(codes, codebooks)``: ``vec_id, label, code, error`` of every kept row; the books as (part, entry, component)."""
    rows = _kept(vectors, parts, scale, id_col, vec_col, label_col)
    n = rows.count()
    if not n:
        codes = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return codes, np.zeros((parts, 0, 0), np.int64)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    salts = -(-n // OWNER_ROWS)
    members = written(_owned(rows.select("rid", "v").mapInArrow(_dealt(books, salts), _MEMBER)), "codes-members")
    for r in range(rounds):
        books = _updated(members, books)
        judged = members.mapInArrow(_judged(books), _MEMBER + ", error long, moved boolean")
        if r < rounds - 1:
            at = scratch_path(rows.sparkSession, "llm-codes-judged")
            judged.drop("error").write.partitionBy("moved").parquet(at)
            told = rows.sparkSession.read.schema(_MEMBER + ", moved boolean").parquet(at)
            # who stays is read from where it lies; who moves is dealt to the new owner
            moved = written(_owned(told.where("moved").drop("moved")), "codes-moved")
            members = told.where("not moved").drop("moved").unionByName(moved)
    if not rounds:
        judged = members.mapInArrow(_judged(books), _MEMBER + ", error long, moved boolean")
    coded = judged.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("pos", "entry"))).alias("c"),
                                      F.sum("error").alias("error"))
    digits = F.transform("c", lambda e: F.lpad(F.lower(F.hex(e["entry"])), 2, "0"))
    codes = rows.select("rid", "vec_id", "label").join(coded.select("rid", F.array_join(digits, "").alias("code"), "error"), "rid")
    return written(codes.drop("rid"), "codes-coded"), books


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Integer vectors that rows of part indexes stand for."""
    return np.concatenate([books[pos][codes[:, pos]] for pos in range(len(books))], axis=1)


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_digests(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """Codes with the error summed over equal labels and the digest of the codebooks."""
    totals = written(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels").withColumnRenamed("label", "l")
    return codes.join(totals, F.col("label").eqNullSafe(F.col("l")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
