"""Embedding near-dedup: PCA-ordered tiled comparison of vectors of one label.

Equal vectors of a label are one class with a number of copies, so a vector that
holds a third of the table is one point. Classes are turned into principal
directions (second moments summed over all of them, an eigenproblem of
dimensions squared on the driver), ordered by the first coordinate and cut into
tiles of about ``TILE`` rows. Two tiles of a label are compared where their ranges
of that coordinate leave room for the threshold. A comparison accumulates products
over the leading directions first and adds the product of the remaining norms,
the largest the rest can give; pairs whose bound is under the threshold are out,
and a tile pair ends when none is left. Pairs that reach the end are decided by
the cosine of the original vectors in double precision.

A tile pair returns link counts per vector and a spanning forest of its links, so
its output is linear in its rows however dense a group is. Components come from
contraction in joins. Nothing but the moments and the counts reaches the driver.

Every vector takes part in full: the bound only leaves out pairs that cannot
link. For vectors without dominant directions the tile pairs of one label grow with the
square of its rows; each is one small task.

Defined results: one row per input row. Vectors that are null, empty, zero or
hold null or non-finite components, and rows with a null label, link with nothing
(their component is their own id). Vectors of different lengths do not link.
Repeated rows link with each other. A component takes the smallest id of its rows,
null only if all are null. No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertflow.llm.common import written
from alertflow.llm.components import components
from alertflow.llm.vectors import all_finite, matrix

THRESHOLD = 0.98
TILE = 2048
BINS = 1024  # bins of the first coordinate from -1 to 1
STEPS = (8, 16, 32)  # leading directions after which the bound is tried
MARGIN = 1e-9  # far over the rounding of turned vectors, so the bound never loses a pair
_PLACED = "node long, d int, copies long, lead double, bin int"


def unit_rows(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled by powers of two to safe sizes, and their norms."""
    v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])
    return v, np.sqrt(np.einsum("ij,ij->i", v, v))


def _moments(classes: DataFrame, d: int) -> np.ndarray:
    """Second moments of the unit vectors of length ``d``."""
    def work(batches):
        m = np.zeros((d, d))
        for b in batches:
            if b.num_rows:
                v, norm = unit_rows(matrix(b.column("vec"), np.float64))
                u = v / norm[:, None]
                m += u.T @ u
        i, j = np.indices((d, d))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(m.ravel())], ["i", "j", "m"])

    sums = (classes.where(F.size("vec") == d).select("vec").mapInArrow(work, "i long, j long, m double")
            .groupBy("i", "j").agg(F.sum("m").alias("m")))
    out = np.zeros((d, d))
    for r in sums.collect():  # d x d rows
        out[r["i"], r["j"]] = r["m"]
    return out


def principal(moments: np.ndarray) -> np.ndarray:
    """Directions as columns, the strongest first."""
    return np.ascontiguousarray(np.linalg.eigh(moments)[1][:, ::-1])


def linked_pairs(a: np.ndarray, b: np.ndarray, turn: np.ndarray | None, threshold: float):
    """Index pairs of rows of ``a`` and ``b`` whose cosine reaches the threshold."""
    va, na = unit_rows(a)
    vb, nb = unit_rows(b)
    ya, yb = va / na[:, None], vb / nb[:, None]
    if turn is not None:
        ya, yb = ya @ turn, yb @ turn
    d = ya.shape[1]
    at = None  # pairs still open, once they are few
    done, part = 0, np.zeros((len(ya), len(yb)))
    for stop in [s for s in STEPS if s < d] + [d]:
        rest = [np.sqrt(np.einsum("ij,ij->i", y[:, stop:], y[:, stop:])) for y in (ya, yb)]
        if at is None:
            part += ya[:, done:stop] @ yb[:, done:stop].T
            open_ = part + rest[0][:, None] * rest[1][None, :] >= threshold - MARGIN
            if np.count_nonzero(open_) * 8 < open_.size or stop == d:
                at = np.nonzero(open_)
                part = part[at]
        else:
            part = part + _products(ya[:, done:stop], yb[:, done:stop], *at)
            open_ = part + rest[0][at[0]] * rest[1][at[1]] >= threshold - MARGIN
            at, part = (at[0][open_], at[1][open_]), part[open_]
        done = stop
        if at is not None and not len(at[0]):
            break
    cosine = _products(va, vb, *at) / (na[at[0]] * nb[at[1]])
    return at[0][cosine >= threshold], at[1][cosine >= threshold]


def _products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of chosen row pairs, in slices."""
    out = np.empty(len(i))
    for s in range(0, len(i), 65536):
        out[s:s + 65536] = np.einsum("ij,ij->i", x[i[s:s + 65536]], y[j[s:s + 65536]])
    return out


def forest(p: np.ndarray, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (p, q) over nodes 0..n-1 that connect what all of them connect, fewer than ``n``."""
    comp, out = np.arange(n), []
    while len(p):
        cp, cq = comp[p], comp[q]
        apart = cp != cq
        p, q, cp, cq = p[apart], q[apart], cp[apart], cq[apart]
        if not len(p):
            break
        low, high = np.minimum(cp, cq), np.maximum(cp, cq)
        order = np.lexsort((low, high))
        one = order[np.r_[True, high[order][1:] != high[order][:-1]]]  # each component hooks to its smallest smaller neighbour
        out.append((p[one], q[one]))
        up = np.arange(n)
        up[high[one]] = low[one]
        while (up[up] != up).any():
            up = up[up]
        comp = up[comp]
    if not out:
        return p[:0], q[:0]
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _compared(turn: np.ndarray, threshold: float):
    """One tile pair: ``a, b`` edges of a forest and ``a, n`` link counts."""
    def work(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        tile, i, j = t["tile"].to_numpy(), t["i"][0].as_py(), t["j"][0].as_py()
        node, copies = t["node"].to_numpy(), t["copies"].to_numpy()
        vec = matrix(t["vec"].combine_chunks(), np.float64)
        ia, ib = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        p, q = linked_pairs(vec[ia], vec[ib], turn if vec.shape[1] == len(turn) else None, threshold)
        p, q = ia[p], ib[q]
        if i == j:
            p, q = p[p < q], q[p < q]
        links = np.bincount(p, copies[q], len(node)) + np.bincount(q, copies[p], len(node))
        some = np.flatnonzero(links)
        fp, fq = forest(p, q, len(node))
        edges, counts = len(fp), len(some)
        return pa.table({"a": pa.array(np.r_[node[fp], node[some]]),
                         "b": pa.array(np.r_[node[fq], np.zeros(counts, np.int64)], mask=np.r_[np.zeros(edges, bool), np.ones(counts, bool)]),
                         "n": pa.array(np.r_[np.zeros(edges, np.int64), links[some].astype(np.int64)])})
    return work


def _placed(classes: DataFrame, turn: np.ndarray) -> DataFrame:
    """Classes with their first coordinate and its bin; other lengths use their first component."""
    def place(batches):
        for b in batches:
            if not b.num_rows:
                continue
            size = b.column("d").to_numpy()
            lead = np.empty(b.num_rows)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                v, norm = unit_rows(matrix(b.column("vec").take(pa.array(at)), np.float64))
                lead[at] = (v @ turn[:, 0] if d == len(turn) else v[:, 0]) / norm
            spot = np.clip(np.floor((lead + 1) * (BINS / 2)), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("label", "vec", "node", "d", "copies")] + [pa.array(lead), pa.array(spot)],
                                             ["label", "vec", "node", "d", "copies", "lead", "bin"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    return classes.select("label", "vec", "node", "d", "copies").mapInArrow(
        place, f"label {kinds['label']}, vec {kinds['vec']}, {_PLACED}")


def _tiled(placed: DataFrame, tile: int) -> DataFrame:
    """Rows with their tile: consecutive bins of about ``tile`` rows, a fuller bin dealt over several tiles."""
    per_bin = placed.groupBy("label", "d", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("label", "d").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    spans = per_bin.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    spans = written(spans.select("label", "d", "bin", F.floor(F.col("before") / tile).alias("t0"),
                                 F.floor((F.col("before") + F.col("n") - 1) / tile).alias("t1")), "near-vec-bins")
    spread = F.pmod(F.xxhash64("node"), F.col("t1") - F.col("t0") + 1)
    return placed.join(spans, ["label", "d", "bin"]).withColumn("tile", F.col("t0") + spread).drop("t0", "t1", "bin")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    vec = F.col(vec_col)
    takes_part = (F.col(label_col).isNotNull() & all_finite(F.transform(vec, lambda x: x.cast("double")))
                  & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False)))
    rows = written(vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("vec_id"),
                                  F.col(label_col).alias("label"), vec.alias("vec"), takes_part.alias("ok")), "near-vec-rows")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                                        F.lit(True).alias("kept"))
    ok = rows.where("ok")
    classes = written(ok.groupBy("label", "vec").agg(F.min("rid").alias("node"), F.min("vec_id").alias("low"),
                                                     F.count(F.lit(1)).alias("copies"))
                      .withColumn("d", F.size("vec")), "near-vec-classes")
    main = classes.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if not main:
        return alone
    turn = principal(_moments(classes, main["d"]))
    tiled = written(_tiled(_placed(classes, turn), tile), "near-vec-tiled")
    ends = written(tiled.groupBy("label", "d", "tile").agg(F.min("lead").alias("lo"), F.max("lead").alias("hi")), "near-vec-tiles")
    left = ends.select("label", "d", F.col("tile").alias("i"), F.col("lo").alias("lo_i"), F.col("hi").alias("hi_i"))
    right = ends.select("label", "d", F.col("tile").alias("j"), F.col("lo").alias("lo_j"), F.col("hi").alias("hi_j"))
    # unit vectors of that cosine differ by no more than this in any coordinate
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + MARGIN
    pairs = left.join(right, ["label", "d"]).where(
        (F.col("i") <= F.col("j")) & (F.col("lo_j") - F.col("hi_i") <= reach) & (F.col("lo_i") - F.col("hi_j") <= reach))
    sides = F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j"))
    route = written(pairs.select("label", "d", "i", "j", F.explode(sides).alias("tile")), "near-vec-route")
    found = written(tiled.select("label", "d", "tile", "node", "copies", "vec").join(route, ["label", "d", "tile"])
                    .select("label", "d", "i", "j", "tile", "node", "copies", "vec").groupBy("label", "d", "i", "j")
                    .applyInArrow(_compared(turn, threshold), "a long, b long, n long"), "near-vec-found")
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    joined = components(found.where("b is not null").select("a", "b"))
    known = classes.join(links, "node", "left").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = written(known.select("label", "vec", "root", "low", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
                    "near-vec-known")
    lows = known.groupBy("root").agg(F.min("low").alias("component_id"))
    facts = known.join(lows, "root").select(F.col("label").alias("c_label"), F.col("vec").alias("c_vec"), "n_links", "component_id")
    held = ok.join(facts, (F.col("label") == F.col("c_label")) & (F.col("vec") == F.col("c_vec")))
    return held.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
                       F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")).unionByName(alone)
