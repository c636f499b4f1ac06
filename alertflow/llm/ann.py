"""Approximate nearest neighbours: NN-descent graph, greedy graph search.

The graph starts from the nearest of two random blocks of each vector. Each
NN-descent round is a set of joins: a node's neighbours and reverse neighbours
are gathered by a block of centre nodes, the neighbours of one centre are compared
with each other where one of them is new, and the best candidates of every node
are merged into its list. Rounds stop when few lists change. A query starts from
its own node's neighbours and the best of a fixed set of entry points and walks
greedily: the nearest unexpanded nodes of its beam are expanded in joined rounds,
along edges of both directions, until every node of the beam is expanded.

The largest inner product is searched. For the graph, vectors get one more
component that gives all the same length; a query has 0 there, so its nearest by
angle are its nearest by inner product. With vectors of unequal length a query is
thus another point than its own node, whose neighbours are of like length: the
entry points (the longest vectors and a seeded choice) lead to the long vectors,
reverse edges from the long vectors to the others. Scores are inner products in
double precision of the original vectors.

Vectors never gather by key: blocks of rows are dealt by a hash of the id, a block
receives each vector it needs once, reverse lists are cut to ``k`` by a
group-limited window that keeps ``k`` rows a task before the shuffle (the sampling
step of NN-descent; the forward lists it leaves out still meet at the next centre).

Defined results: vectors that are null, zero, or hold null or non-finite
components, or are not of the most common length, take no part, nor do rows with
a null id; of rows that repeat an id one stays (smallest by content hash); ties go
to the smaller id; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertflow.llm.common import written

K = 40  # neighbours kept per node
BLOCK = 1024  # rows of a block that is compared or merged
REACH = 8192  # rows of a block whose vectors score a walk's candidates: a query travels to each of them once a round
CENTRES = 256  # centres whose neighbours' vectors meet in one group
ROUNDS = 6
STOP_SHARE = 0.01  # a round that renews fewer list places than this share is the last
BEAM = 192  # nodes a query keeps
EXPAND = 48  # nodes a query expands in a round
ENTRIES = 256  # nodes every query is compared with at the start, half of them the longest
_LIST = "id long, nbr array<bigint>, sim array<double>, fresh array<boolean>"
# list entries on their way to the block that merges them: one row per pair of blocks
_PACK = "home long, owner array<bigint>, nbr array<bigint>, sim array<double>, fresh array<boolean>"


def clean_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (array of doubles) of the rows that take part, one per id."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).where("id is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(finite & F.exists("vec", lambda x: x != 0))
    dims = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    rows = rows.where(F.size("vec") == F.lit(dims["d"] if dims else 0))
    return rows.withColumn("h", F.xxhash64("vec")).groupBy("id").agg(F.min_by("vec", "h").alias("vec"))


def _matrix(col) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)


def _top(owner: np.ndarray, nbr: np.ndarray, sim: np.ndarray, fresh: np.ndarray, k: int):
    """The ``k`` best distinct neighbours of each owner; an old entry wins over its fresh copy."""
    order = np.lexsort((fresh, nbr, owner))
    owner, nbr, sim, fresh = owner[order], nbr[order], sim[order], fresh[order]
    one = np.ones(len(owner), dtype=bool)
    one[1:] = (owner[1:] != owner[:-1]) | (nbr[1:] != nbr[:-1])
    owner, nbr, sim, fresh = owner[one], nbr[one], sim[one], fresh[one]
    order = np.lexsort((nbr, -sim, owner))
    owner, nbr, sim, fresh = owner[order], nbr[order], sim[order], fresh[order]
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
    rank = np.arange(len(owner)) - np.repeat(start, np.diff(np.r_[start, len(owner)]))
    keep = rank < k
    return owner[keep], nbr[keep], sim[keep], fresh[keep]


def _lists(owner, nbr, sim, fresh) -> pd.DataFrame:
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
    cut = start[1:]
    return pd.DataFrame({"id": owner[start], "nbr": np.split(nbr, cut) if len(owner) else [],
                         "sim": np.split(sim, cut) if len(owner) else [],
                         "fresh": np.split(fresh, cut) if len(owner) else []})


def _packed(home, owner, nbr, sim, fresh) -> pd.DataFrame:
    """Entries as one row for each home block of their owners."""
    order = np.argsort(home, kind="stable")
    home = home[order]
    start = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(home) else np.zeros(0, int)
    parts = {"owner": owner, "nbr": nbr, "sim": sim, "fresh": fresh}
    return pd.DataFrame({"home": home[start], **{c: np.split(v[order], start[1:]) if len(home) else [] for c, v in parts.items()}})


def _nothing() -> pd.DataFrame:
    return pd.DataFrame({"home": [], "owner": [], "nbr": [], "sim": [], "fresh": []})


def _flat(pdf: pd.DataFrame):
    """(owner, nbr, sim, fresh) arrays of packed rows."""
    return (np.concatenate(pdf["owner"].to_numpy()), np.concatenate(pdf["nbr"].to_numpy()),
            np.concatenate(pdf["sim"].to_numpy()), np.concatenate(pdf["fresh"].to_numpy()).astype(bool))


def _blocks(n: int, rows: int = 0) -> int:
    return max(1, -(-n // (rows or BLOCK)))


def _block_of(col: str, n: int, salt: int, rows: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.col(col)), F.lit(_blocks(n, rows)))


def _first_lists(points: DataFrame, n: int, k: int, salt: int) -> DataFrame:
    """Exact nearest within random blocks, packed."""
    def nearest(key, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf["id"].to_numpy(), _matrix(pdf["aug"])
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        kk = min(k, len(ids) - 1)
        if kk < 1:
            return _nothing()
        best = np.argpartition(-s, kk - 1, axis=1)[:, :kk]
        sim = np.take_along_axis(s, best, axis=1).ravel()
        return _packed(np.repeat(pdf["home"].to_numpy(), kk), np.repeat(ids, kk), ids[best.ravel()], sim,
                       np.ones(len(sim), bool))

    return points.withColumn("block", _block_of("id", n, salt)).groupBy("block").applyInPandas(nearest, _PACK)


def _merge(packs: list[DataFrame], k: int) -> DataFrame:
    """One list per node from packed entries, its ``k`` best."""
    def best(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return _lists(*_top(*_flat(pdf), k))

    every = packs[0]
    for more in packs[1:]:
        every = every.unionByName(more)
    return every.groupBy("home").applyInPandas(best, _LIST)


def _compare(k: int):
    """Neighbours of each centre of a block compared with each other; per node its ``k`` best candidates."""
    def work(key, edges: pd.DataFrame, vecs: pd.DataFrame) -> pd.DataFrame:
        if not len(edges) or not len(vecs):
            return _nothing()
        vecs = vecs.sort_values("id", ignore_index=True)
        ids, x, kth = vecs["id"].to_numpy(), _matrix(vecs["aug"]), vecs["kth"].to_numpy()
        e = edges.groupby(["centre", "member"], sort=True, as_index=False)["fresh"].max()
        centre, at, fresh = e["centre"].to_numpy(), np.searchsorted(ids, e["member"].to_numpy()), e["fresh"].to_numpy()
        starts = np.flatnonzero(np.r_[True, centre[1:] != centre[:-1]])
        out_o, out_n, out_s = [], [], []
        held = 0

        def shrink():
            o, m, s, _ = _top(np.concatenate(out_o), np.concatenate(out_n), np.concatenate(out_s),
                              np.ones(sum(map(len, out_o)), bool), k)
            out_o[:], out_n[:], out_s[:] = [o], [m], [s]
            return len(o)

        for a, b in zip(starts, np.r_[starts[1:], len(centre)]):
            m, f = at[a:b], fresh[a:b]
            new = m[f]
            if not len(new):
                continue
            s = x[new] @ x[m].T
            better = (s > kth[new][:, None]) | (s > kth[m][None, :])
            better &= new[:, None] != m[None, :]
            i, j = np.nonzero(better)
            p, q, v = new[i], m[j], s[i, j]
            for o, c in ((p, q), (q, p)):
                ok = v > kth[o]
                out_o.append(o[ok])
                out_n.append(c[ok])
                out_s.append(v[ok])
                held += int(ok.sum())
            if held > 4_000_000:
                held = shrink()
        if not out_o:
            return _nothing()
        shrink()
        o, c, s = out_o[0], out_n[0], out_s[0]
        return _packed(vecs["home"].to_numpy()[o], ids[o], ids[c], s, np.ones(len(o), bool))
    return work


def _both_ways(graph: DataFrame, k: int) -> DataFrame:
    """``centre, member, fresh``: the edges of the graph and of each node the ``k`` nearest reverse ones."""
    edges = graph.select("id", F.arrays_zip("nbr", "fresh", "sim").alias("e")).select("id", F.inline("e"))
    nearest = Window.partitionBy("nbr").orderBy(F.desc("sim"), "id")
    back = (edges.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k)
            .select(F.col("nbr").alias("centre"), F.col("id").alias("member"), "fresh"))
    ahead = edges.select(F.col("id").alias("centre"), F.col("nbr").alias("member"), "fresh")
    return ahead.unionByName(back)


def _round(points: DataFrame, graph: DataFrame, n: int, k: int) -> DataFrame:
    """Candidate lists from one pass over neighbours of neighbours."""
    pairs = written(_both_ways(graph, k).withColumn("block", _block_of("centre", n, 31, CENTRES)), "ann-pairs")
    needed = pairs.select("block", F.col("member").alias("id")).distinct()
    floor = graph.select("id", F.when(F.size("sim") < k, F.lit(float("-inf"))).otherwise(F.array_min("sim")).alias("kth"))
    vecs = needed.join(points.join(floor, "id"), "id").select(F.col("block").alias("vec_block"), "id", "aug", "home", "kth")
    return pairs.groupBy("block").cogroup(vecs.groupBy("vec_block")).applyInPandas(_compare(k), _PACK)


def neighbour_graph(points: DataFrame, n: int, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """``id, nbr, sim, fresh``: each node's ``k`` nearest found by NN-descent over ``points`` (``id, aug``)."""
    points = points.withColumn("home", _block_of("id", n, 97))
    graph = written(_merge([_first_lists(points, n, k, s) for s in (1, 2)], k), "ann-graph")
    for _ in range(rounds if _blocks(n) > 1 else 0):
        found = _round(points, graph, n, k)
        known = graph.select(_block_of("id", n, 97).alias("home"), F.transform("nbr", lambda x: F.col("id")).alias("owner"),
                             "nbr", "sim", F.transform("fresh", lambda x: F.lit(False)).alias("fresh"))
        graph = written(_merge([known, found], k), "ann-graph")
        renewed = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        if renewed < STOP_SHARE * n * k:
            break
    return graph


def search_rounds(n: int) -> int:
    """Most rounds of a walk over ``n`` nodes; it ends earlier, when every beam is expanded."""
    return 8 + 2 * n.bit_length()


def _entries(points: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``q, id``: for each query the ``k`` best of the entry points."""
    half = ENTRIES // 2
    longest = points.orderBy(F.desc("norm2"), "id").limit(half).select("id", "vec").collect()
    chosen = points.orderBy(F.xxhash64(F.lit(53), "id"), "id").limit(half).select("id", "vec").collect()
    rows = list({r["id"]: r["vec"] for r in longest + chosen}.items())
    ids, x = np.array([i for i, _ in rows], dtype=np.int64), np.array([v for _, v in rows], dtype=np.float64)

    def best(batches):
        for pdf in batches:
            if not len(pdf) or not len(ids):
                continue
            s = _matrix(pdf["vec"]) @ x.T
            kk = min(k, len(ids))
            at = np.argpartition(-s, kk - 1, axis=1)[:, :kk]
            yield pd.DataFrame({"q": np.repeat(pdf["q"].to_numpy(), kk), "id": ids[at.ravel()]})

    return asked.select("q", "vec").mapInPandas(best, "q long, id long").where("id <> q")


def _search_round(beam: DataFrame, queries: DataFrame, points: DataFrame, links: DataFrame, n: int, width: int, expand: int):
    """Expand the nearest unexpanded nodes of every beam, score their neighbours, keep the best.

    Candidates are scored at the block where their vectors live: a block
    receives each query it needs once, with the similarity its beam asks for.
    """
    open_ = beam.where("fresh").withColumn("r", F.row_number().over(
        Window.partitionBy("q").orderBy(F.desc("sim"), "id"))).where(F.col("r") <= expand).select("q", "id")
    near = open_.join(links, "id").select("q", F.explode("nbr").alias("id")).where("id <> q").distinct()
    cand = written(near.join(beam.select("q", "id"), ["q", "id"], "left_anti")
                   .withColumn("block", _block_of("id", n, 97, REACH)), "ann-candidates")
    floor = beam.groupBy("q").agg(F.min("sim").alias("low"), F.count(F.lit(1)).alias("held")).select(
        "q", F.when(F.col("held") < width, F.lit(float("-inf"))).otherwise(F.col("low")).alias("low"))
    need = cand.select("block", "q").distinct().join(queries.join(floor, "q"), "q")

    def score(key, c: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        q, x = v[v["is_q"]].sort_values("id"), v[~v["is_q"]].sort_values("id")
        if not len(c) or not len(q) or not len(x):
            return pd.DataFrame({"q": [], "id": [], "sim": [], "fresh": []})
        qa, xa, low = _matrix(q["vec"]), _matrix(x["vec"]), q["low"].to_numpy()
        qi = np.searchsorted(q["id"].to_numpy(), c["q"].to_numpy())
        xi = np.searchsorted(x["id"].to_numpy(), c["cand"].to_numpy())
        sim = np.concatenate([np.einsum("ij,ij->i", qa[qi[a:a + 65536]], xa[xi[a:a + 65536]])
                              for a in range(0, len(c), 65536)])
        kept = sim >= low[qi]
        return pd.DataFrame({"q": c["q"].to_numpy()[kept], "id": c["cand"].to_numpy()[kept], "sim": sim[kept],
                             "fresh": np.ones(int(kept.sum()), bool)})

    both = (points.select(_block_of("id", n, 97, REACH).alias("vec_block"), "id", "vec", F.lit(False).alias("is_q"), F.lit(0.0).alias("low"))
            .unionByName(need.select(F.col("block").alias("vec_block"), F.col("q").alias("id"), "vec", F.lit(True).alias("is_q"), "low")))
    scored = cand.select("block", "q", F.col("id").alias("cand")).groupBy("block").cogroup(both.groupBy("vec_block")).applyInPandas(
        score, "q long, id long, sim double, fresh boolean")
    done = open_.withColumn("seen", F.lit(True))
    old = beam.join(done, ["q", "id"], "left").select("q", "id", "sim", (F.col("fresh") & F.col("seen").isNull()).alias("fresh"))
    best = Window.partitionBy("q").orderBy(F.desc("sim"), "id")
    return written(old.unionByName(scored).withColumn("r", F.row_number().over(best))
                   .where(F.col("r") <= width).drop("r"), "ann-beam")


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id",
                       vec_col: str = "embedding", graph_k: int = K, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows that ``queries`` (a condition on ``id``) picks."""
    points = written(clean_vectors(vectors, id_col, vec_col).withColumn(
        "norm2", F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)), "ann-clean")
    size = points.agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top")).first()
    n, top = size["n"], size["top"] or 0.0
    aug = F.concat("vec", F.array(F.sqrt(F.greatest(F.lit(0.0), F.lit(top) - F.col("norm2")))))
    # the graph is built on single-precision copies, half the bytes to move; scores read ``vec``
    points = written(points.select("id", "vec", "norm2", aug.cast("array<float>").alias("aug")), "ann-points")
    graph = neighbour_graph(points.select("id", "aug"), n, max(graph_k, k))
    asked = written(points.where(queries).select(F.col("id").alias("q"), "vec"), "ann-queries")
    links = written(_both_ways(graph, max(graph_k, k)).groupBy(F.col("centre").alias("id")).agg(
        F.collect_set("member").alias("nbr")), "ann-links")
    # the beam holds inner products of the original vectors; the best neighbours of a query's own node are among its entry points
    own = graph.join(asked.select(F.col("q").alias("id")), "id", "left_semi").select(F.col("id").alias("q"), F.explode("nbr").alias("id"))
    start = own.unionByName(_entries(points, asked, max(graph_k, k))).distinct()
    front = start.join(points.select("id", F.col("vec").alias("v")), "id").join(asked, "q").select(
        "q", "id", F.aggregate(F.zip_with("v", "vec", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x).alias("sim"),
        F.lit(True).alias("fresh"))
    state = written(front, "ann-beam")
    for _ in range(search_rounds(n)):
        if state.where("fresh").isEmpty():
            break
        state = _search_round(state, asked, points, links, n, max(beam, k), EXPAND)
    rank = Window.partitionBy("q").orderBy(F.desc("sim"), "id")
    return (state.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias("vec_id"), F.col("sim").alias("score")))
