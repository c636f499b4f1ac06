"""SimHash near-dedup with vantage-point trees over the fingerprints.

A document's 64-bit fingerprint has the bits that more than half of its shingles'
hashes set. Fingerprints within ``max_bits`` differing bits link; a component of
links is one group. Equal fingerprints are one point. The points are dealt to
shards by a vantage-point tree (pivot and median distance at each node, built
from a bounded sample): a point lives in one shard and is also sent to every
shard whose bounds its ball of ``max_bits`` overlaps, which the triangle
inequality shows to be all that can hold a partner. Each shard builds its own
tree below that, prunes by the same bounds, compares the remaining leaves
exactly and keeps a spanning forest of its links, so a dense group costs one edge
a point. Components then join the forests.

Defined results: null, empty or blank text has fingerprint zero and is linked like
any other; fewer words than a shingle: the whole sequence; rows with a null id
belong to their group but never name it (a group of null ids only has a null
name); rows that repeat an id are all returned; no rows give no rows; other
columns are ignored; long texts are hashed in bounded slices.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import one_row_each, text_bytes, written
from alertflow.llm.components import components

SHARD_POINTS = 4096  # points a shard holds on average
MAX_SHARDS = 1 << 16  # bound of the broadcast tree; above it shards grow and their own trees deepen
SAMPLE_PER_SHARD = 16
LEAF = 512  # points compared exactly
_SLICE = 1 << 15  # shingles hashed at a time
_BIT_ORDER = np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    words = text.lower().split()  # on bytes: lower-cases A-Z, splits at \x20 and \x09-\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[shingle - 1:].tolist() if len(words) >= shingle else [len(line)]
    one, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, _SLICE):
        h = np.array([one(line[a:b], seed) for a, b in zip(starts[at:at + _SLICE], stops[at:at + _SLICE])],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.bitwise_or.reduce(np.where(2 * ones > n, np.uint64(1) << _BIT_ORDER, np.uint64(0))))


def _row_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, th, fp``: a hash that tells rows of one id apart, the fingerprint as a signed long."""
    def hashed(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("th"), pa.array(fps.view(np.int64))],
                                             ["doc_id", "th", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), _row_hash(text_col).alias("th"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(hashed, "doc_id long, th long, fp long")


class VantageTree:
    """Pivots and radii in arrays; a leaf is a shard number. Children of node i are at ``left`` and ``right``."""

    def __init__(self, sample: np.ndarray, leaves: int, rng: np.random.Generator):
        self.pivot, self.radius, self.left, self.right, self.shards = [], [], [], [], 0
        self.root = self._grow(sample, leaves, rng)

    def _grow(self, points: np.ndarray, leaves: int, rng) -> int:
        """Node number, or -1 - shard for a leaf."""
        cut = best_cut(points, rng) if leaves > 1 else None
        if cut is None:
            self.shards += 1
            return -self.shards
        pivot, radius, near = cut
        at = len(self.pivot)
        for a, x in zip((self.pivot, self.radius, self.left, self.right), (pivot, radius, 0, 0)):
            a.append(x)
        self.left[at] = self._grow(points[near], (leaves + 1) // 2, rng)
        self.right[at] = self._grow(points[~near], leaves // 2, rng)
        return at

    def route(self, points: np.ndarray, reach: int):
        """(shard, positions, home) triples: every shard a point's ball of ``reach`` overlaps.

        A pair parted by a node is found on the far side, so points at home cross
        only outwards; a point already away from home crosses both ways.
        """
        work = [(self.root, np.arange(len(points)), np.ones(len(points), dtype=bool))]
        while work:
            node, at, home = work.pop()
            if not len(at):
                continue
            if node < 0:
                yield -node - 1, at, home
                continue
            d = np.bitwise_count(points[at] ^ self.pivot[node]).astype(np.int64) - self.radius[node]
            near = d <= 0
            to_left = near | (~home & (d <= reach))
            to_right = ~near | (d + reach > 0)
            work.append((self.left[node], at[to_left], (home & near)[to_left]))
            work.append((self.right[node], at[to_right], (home & ~near)[to_right]))


def best_cut(points: np.ndarray, rng: np.random.Generator):
    """(pivot, radius, mask of the near half), or None when no pivot parts the points."""
    if len(points) < 4:
        return None
    for pivot in points[rng.choice(len(points), size=min(4, len(points)), replace=False)]:
        d = np.bitwise_count(points ^ pivot)
        radius = int(np.median(d))
        near = d <= radius
        if near.all():
            radius -= 1
            near = d <= radius
        if near.any() and not near.all():
            return pivot, radius, near
    return None


def linked(points: np.ndarray, home: np.ndarray, reach: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as index pairs, of the links within ``reach`` of one shard's points."""
    parent = np.arange(len(points))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    a_out, b_out = [], []

    def compare(q: np.ndarray, m: np.ndarray) -> None:
        for at in range(0, len(q), 128):
            part = q[at:at + 128]
            for lo in range(0, len(m), 8192):
                near = m[lo:lo + 8192]
                i, j = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[near][None, :]) <= reach)
                # pairs already joined are left out at once, so a dense group costs about one step a point
                while (parent != parent[parent]).any():
                    parent[:] = parent[parent]
                apart = parent[part[i]] != parent[near[j]]
                for a, b in zip(part[i[apart]].tolist(), near[j[apart]].tolist()):
                    if (ra := find(a)) != (rb := find(b)):
                        parent[max(ra, rb)] = min(ra, rb)
                        a_out.append(a)
                        b_out.append(b)

    # members are the points at home in a branch; visitors come from beyond one of its bounds
    work = [(np.flatnonzero(home), np.flatnonzero(~home))]
    while work:
        members, visitors = work.pop()
        if not len(members):
            continue
        cut = best_cut(points[members], rng) if len(members) > LEAF else None
        if cut is None:
            compare(np.concatenate((members, visitors)), members)
            continue
        pivot, radius, near = cut
        d = np.bitwise_count(points[members] ^ pivot).astype(np.int64) - radius
        v = np.bitwise_count(points[visitors] ^ pivot).astype(np.int64) - radius
        work.append((members[near], visitors[v <= reach]))
        work.append((members[~near], np.concatenate((visitors[v + reach > 0], members[near & (d + reach > 0)]))))
    return np.array(a_out, dtype=np.int64), np.array(b_out, dtype=np.int64)


def links(points: DataFrame, reach: int, seed: int = 42) -> DataFrame:
    """A spanning forest ``a, b`` of all pairs of distinct ``fp`` within ``reach`` bits."""
    spark = points.sparkSession
    n = points.count()
    shards = int(min(MAX_SHARDS, max(1, -(-n // SHARD_POINTS))))
    want = shards * SAMPLE_PER_SHARD
    # the sample that shapes the tree: at most twice MAX_SHARDS * SAMPLE_PER_SHARD numbers
    share = min(1.0, 1.2 * want / max(n, 1))
    picked = points.where(F.shiftrightunsigned(F.xxhash64("fp", F.lit(seed)), 11) < F.lit(int(share * (1 << 53))))
    sample = np.array([r[0] for r in picked.limit(2 * want).collect()], dtype=np.int64).view(np.uint64)
    sample = np.sort(sample)
    tree = spark.sparkContext.broadcast(VantageTree(sample, shards, np.random.default_rng(seed)))

    def route(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for shard, at, home in tree.value.route(fp.view(np.uint64), reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard)), pa.array(fp[at]), pa.array(home)], ["shard", "fp", "home"])

    def search(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fp", ignore_index=True)
        fp = pdf["fp"].to_numpy()
        a, b = linked(fp.view(np.uint64), pdf["home"].to_numpy(), reach, np.random.default_rng(seed))
        return pd.DataFrame({"a": fp[a], "b": fp[b]})

    routed = points.select("fp").mapInArrow(route, "shard long, fp long, home boolean")
    return routed.groupBy("shard").applyInPandas(search, "a long, b long")


def _groups(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, th, fp, component_id`` of every row."""
    rows = written(fingerprints(docs, shingle, id_col, text_col), "simhash-rows")
    points = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")),
                     "simhash-points")
    roots = components(written(links(points, max_bits), "simhash-links"))
    rooted = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    rooted = written(rooted, "simhash-rooted")
    # only groups of several rows need a name from elsewhere
    named = rooted.where("linked").groupBy("root").agg(F.min("first_id").alias("component_id"))
    names = written(rooted.where("linked").select("fp", "root").join(named, "root").select("fp", "component_id")
                    .unionByName(rooted.where("not linked and n > 1")
                                 .select("fp", F.col("first_id").alias("component_id"))), "simhash-names")
    names = names.withColumn("known", F.lit(True))
    return rows.join(names, "fp", "left").select(
        "doc_id", "th", "fp", F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return _groups(docs, shingle, max_bits, id_col, text_col).select("doc_id", hexed.alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group stays, of its smallest id, with all columns; rows without an id all stay."""
    groups = written(_groups(docs, shingle, max_bits, id_col, text_col).select("doc_id", "th", "component_id"), "simhash-decided")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # several texts may share the id that stays: the one with the least hash does
    first = written(groups.where(stays & F.col("component_id").isNotNull()).groupBy("component_id").agg(F.min("th").alias("first_th"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1"), "simhash-first")
    lead = groups.join(first.select(F.col("component_id").alias("c"), "first_th"), F.col("component_id") == F.col("c"), "left")
    gone = written(lead.where(~stays | (F.col("th") != F.col("first_th"))).select(
        F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_text")).distinct(), "simhash-gone")
    again = written(lead.where(stays & (F.col("th") == F.col("first_th"))).groupBy(
        F.col("doc_id").alias("_twice_id"), F.col("th").alias("_twice_text")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "simhash-twice")
    # the rows to drop grow with the data, so the join is a merge at every size
    stay = docs.join(gone.hint("merge"), F.col(id_col).eqNullSafe(F.col("_gone_id")) & (_row_hash(text_col) == F.col("_gone_text")), "left_anti")
    return one_row_each(stay, again, F.col(id_col).eqNullSafe(F.col("_twice_id")) & (_row_hash(text_col) == F.col("_twice_text")))
