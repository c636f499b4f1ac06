"""Exact, repeatable ranking at scale: shuffle order, balanced samples, splits.

Order of rows is the seeded hash ``md5('<seed>:' || id)`` (ties by id), so a
re-run, a retried task or a lost executor gives the same order -- nothing
depends on ``rand()`` or on partition layout.

A plain ``row_number() over (partition by class order by hash)`` sends a whole
class to one task; with a class holding a third of all rows that task is the
job. Instead (two-level rank):

1. bucket = first ``digits`` hex digits of the hash (16**digits buckets, chosen
   from the row count so that a bucket holds a few thousand rows);
2. count rows per (class, bucket) -- map-side partial aggregation;
3. prefix-sum those counts per class -> the offset of every bucket;
4. join the offsets back (broadcast only after its row count is checked);
5. ``row_number`` inside (class, bucket) + offset = the exact global rank.

Only id, class and hash are ranked; the positions join the rows back by id.

Because buckets are prefixes of the hash, bucket order equals hash order, so
the result is identical to the plain window (tested).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.session import shared_dir

# Broadcast the (class, bucket) offset table only below this many rows
# (about 50 bytes a row); above it the join shuffles on (class, bucket), the
# same partitioning the in-bucket window needs, so no extra exchange.
MAX_BROADCAST_ROWS = 500_000
# Rows a bucket holds on average: the bucket count grows with the data, so the
# in-bucket sort stays this small at any size.
BUCKET_ROWS = 4096


def digits_for(rows: int) -> int:
    """Hex digits that give buckets of about ``BUCKET_ROWS`` rows."""
    digits = 1
    while 16 ** digits * BUCKET_ROWS < rows:
        digits += 1
    return digits


def seeded_hash(id_col: str | Column, seed: int = S.SEED) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
                   broadcast_right: bool = False) -> DataFrame:
    """Equi-join on ``on`` where null keys match each other (a null class is a class)."""
    r = right.select(*[F.col(c).alias(f"_k_{c}") if c in on else F.col(c) for c in right.columns])
    if broadcast_right:
        r = F.broadcast(r)
    cond = [left[c].eqNullSafe(r[f"_k_{c}"]) for c in on]
    return left.join(r, cond, how).drop(*[f"_k_{c}" for c in on])


def _join_small(big: DataFrame, small: DataFrame, on: list[str], checked_rows: int) -> DataFrame:
    """Join a small table whose row count was checked: broadcast below the bound."""
    return null_safe_join(big, small, on, "inner", checked_rows <= MAX_BROADCAST_ROWS)


def bucket_offsets(df: DataFrame, by: list[str]) -> tuple[DataFrame, int]:
    """Per (by..., bucket): row count ``_n`` and rows before the bucket ``_off``;
    and the table's row count (the size check for broadcasting)."""
    shared_dir(df.sparkSession)
    # Reliable checkpoints (shared folder): a lost executor cannot lose them,
    # and the join below re-reads the table instead of recounting.
    counts = df.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy("_b") if by else Window.orderBy("_b")
    if by:
        offsets = counts.withColumn("_off", F.sum("_n").over(w) - F.col("_n"))
    else:
        # no class: sum by the first digit, then inside each first digit, so that
        # the bucket table itself never sits in one task
        first = counts.withColumn("_f", F.substring("_b", 1, 1))
        heads = first.groupBy("_f").agg(F.sum("_n").alias("_h")).withColumn(
            "_base", F.sum("_h").over(Window.orderBy("_f")) - F.col("_h")).select("_f", "_base")  # 16 rows
        inner = Window.partitionBy("_f").orderBy("_b")
        offsets = (first.join(F.broadcast(heads), "_f")
                   .withColumn("_off", F.col("_base") + F.sum("_n").over(inner) - F.col("_n")).drop("_f", "_base"))
    offsets = offsets.checkpoint(eager=True)
    return offsets, offsets.count()


def _hashed(df: DataFrame, id_col: str, by: list[str], seed: int, digits: int | None) -> DataFrame:
    """Narrow rows (id, class, hash, bucket): all that ranking moves."""
    narrow = df.select(id_col, *by)
    d = digits or digits_for(narrow.count())
    return narrow.withColumn("_h", seeded_hash(id_col, seed)).withColumn("_b", F.substring("_h", 1, d))


def exact_rank(df: DataFrame, id_col: str, by: list[str] | None = None, seed: int = S.SEED,
               out: str = "position", digits: int | None = None,
               keep_below: Column | int | None = None) -> DataFrame:
    """Add ``out`` = 0-based rank of each row inside its ``by`` group, hash order.

    ``id_col`` is unique: only (id, class, hash) go through the rank, and the
    positions join the rows back by id. ``keep_below`` (int or column of the
    offsets/``by`` frame) drops whole buckets that start at or after that rank
    *before* the shuffle, so a top-n per class only moves about n rows per class.
    """
    by = list(by or [])
    d = _hashed(df, id_col, by, seed, digits)
    offsets, n_off = bucket_offsets(d, by)
    j = _join_small(d, offsets, [*by, "_b"], n_off)
    if keep_below is not None:
        lim = F.lit(keep_below) if isinstance(keep_below, int) else keep_below
        j = j.where(F.col("_off") < lim)
    w = Window.partitionBy(*by, "_b").orderBy("_h", id_col)
    r = j.withColumn(out, (F.col("_off") + F.row_number().over(w) - 1).cast("long"))
    if keep_below is not None:
        r = r.where(F.col(out) < lim)
    return _positions_back(df, r.select(id_col, *by, out), id_col, by)


def _positions_back(df: DataFrame, ranked: DataFrame, id_col: str, by: list[str]) -> DataFrame:
    """Rows of ``df`` with the ranked columns; no join where there is no payload."""
    if set(df.columns) <= {id_col, *by}:
        return ranked.select(*df.columns, *[c for c in ranked.columns if c not in df.columns])
    return null_safe_join(df, ranked.drop(*by), [id_col])


def shuffle_positions(df: DataFrame, id_col: str, seed: int = S.SEED, out: str = "position",
                      digits: int | None = None) -> DataFrame:
    """Random (seeded, repeatable) order of all rows as a 0-based position."""
    return exact_rank(df, id_col, None, seed, out, digits)


def row_at(df: DataFrame, id_col: str, n: int, seed: int = S.SEED, out: str = "position",
           digits: int | None = None) -> DataFrame:
    """The row at 0-based position ``n`` of the seeded order.

    The bucket table says which bucket holds the position; only that bucket's
    rows are read and ranked, whatever ``n`` is.
    """
    d = _hashed(df, id_col, [], seed, digits)
    offsets, _ = bucket_offsets(d, [])
    hit = offsets.where((F.col("_off") <= n) & (F.col("_off") + F.col("_n") > n)).first()
    if hit is None:
        return df.withColumn(out, F.lit(None).cast("long")).where(F.lit(False))
    rows = df.withColumn("_h", seeded_hash(id_col, seed)).where(F.substring("_h", 1, len(hit["_b"])) == hit["_b"])
    w = Window.orderBy("_h", id_col)  # over one bucket only
    return (rows.withColumn(out, (F.lit(hit["_off"]) + F.row_number().over(w) - 1).cast("long"))
            .where(F.col(out) == n).drop("_h"))


def minibatch(position: Column | str, batch_size: int = S.BATCH_SIZE) -> Column:
    p = F.col(position) if isinstance(position, str) else position
    return F.floor(p / F.lit(batch_size)).cast("long")


def balance_sample(df: DataFrame, id_col: str, label_col: str, n: int, classes: list[str] | None = None,
                   seed: int = S.SEED, digits: int | None = None, strict: bool = True) -> DataFrame:
    """Exact-n sample without replacement per class (hash order); other classes whole.

    ``classes`` = the classes to cut down (None: every class). A sampled class
    with fewer than n rows is an error; ``strict=False`` keeps it whole.
    """
    if classes is None:
        part = df
        rest = None
    else:
        part = df.where(F.col(label_col).isin(classes))
        rest = df.where(~F.col(label_col).isin(classes) | F.col(label_col).isNull())
    if strict:
        short = (part.groupBy(label_col).count().where(F.col("count") < n).limit(1).collect())
        if short:
            raise ValueError(f"class {short[0][0]!r} has {short[0][1]} rows, fewer than n={n}")
    sampled = exact_rank(part, id_col, [label_col], seed, "_pos", digits, keep_below=n).drop("_pos")
    return sampled if rest is None else sampled.unionByName(rest)


def _ceil_frac(n: Column, frac: float) -> Column:
    """ceil(frac * n) for frac = 1/k exactly as integer arithmetic would give it."""
    inv = round(1 / frac)
    if abs(inv * frac - 1) < 1e-12:
        return F.floor((n + F.lit(inv - 1)) / F.lit(inv)).cast("long")
    return F.ceil(n * F.lit(frac)).cast("long")


def stratified_split(df: DataFrame, id_col: str, label_col: str, test: float = S.TEST_FRACTION,
                     validation: float = S.VALIDATION_FRACTION, seed: int = S.SEED,
                     digits: int | None = None, out: str = "split") -> DataFrame:
    """Per-class test / validation / train split with exact sizes.

    n_test = ceil(test * n); n_val = ceil(validation * (n - n_test)); the rest
    is train. Positions come from the hash order; only rows in buckets that
    straddle a split boundary need the in-bucket ``row_number`` (at most two
    buckets per class), every other row is assigned from its bucket offset
    without a second shuffle of the data.
    """
    d = _hashed(df, id_col, [label_col], seed, digits)
    offsets, n_off = bucket_offsets(d, [label_col])
    totals = offsets.groupBy(label_col).agg(F.sum("_n").alias("_tot"))
    n_test = _ceil_frac(F.col("_tot"), test)
    cuts = (null_safe_join(offsets, totals, [label_col])
            .withColumn("_c1", n_test)
            .withColumn("_c2", F.col("_c1") + _ceil_frac(F.col("_tot") - F.col("_c1"), validation))
            .withColumn("_straddle",
                        ((F.col("_off") < F.col("_c1")) & (F.col("_off") + F.col("_n") > F.col("_c1")))
                        | ((F.col("_off") < F.col("_c2")) & (F.col("_off") + F.col("_n") > F.col("_c2"))))
            .select(label_col, "_b", "_off", "_c1", "_c2", "_straddle"))
    j = _join_small(d, cuts, [label_col, "_b"], n_off)

    def name(pos: Column) -> Column:
        return (F.when(pos < F.col("_c1"), F.lit("test"))
                .when(pos < F.col("_c2"), F.lit("validation")).otherwise(F.lit("train")))

    whole = j.where(~F.col("_straddle")).withColumn(out, name(F.col("_off")))
    w = Window.partitionBy(label_col, "_b").orderBy("_h", id_col)
    cut = (j.where(F.col("_straddle"))
           .withColumn("_pos", F.col("_off") + F.row_number().over(w) - 1)
           .withColumn(out, name(F.col("_pos"))).drop("_pos"))
    named = whole.unionByName(cut).select(id_col, label_col, out)
    return _positions_back(df, named, id_col, [label_col])
