"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated to their membership pattern (the set of sources they
belong to; one source each in the plain case). A flow routes the tokens of the
patterns to the quotas of the sources: the first use of a token is free, every
repetition costs more than the one before (convex), and a document is used at
most ``max_repeats`` times. The flow runs over patterns, never documents. Each
pattern's share then becomes whole documents in a seeded random order, and one
last document closes the gap to the quota as nearly as any can.

Defined results: null text has size 0 and an empty document is never taken; the
null source is a source of its own, last in order; rows that repeat an id are
separate documents (in ``mixed_documents``, rows alike in id and text are taken as
often as the one taken most); no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow.llm.common import bounded_rows, written

MAX_PATTERNS = 100_000  # bound of the aggregated table the flow is solved on


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: dict, weights: dict, total: float, max_repeats: int) -> dict:
    """Each source's target: ``total`` shared by weight, at most ``max_repeats`` times its size.

    The excess of a capped source is shared again by weight until none is above.
    """
    target = {s: 0.0 for s in sizes}
    free, left = [s for s in sizes if sizes[s]], float(total)
    while free:
        w = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / w > max_repeats * sizes[s]]
        if not over:
            for s in free:
                target[s] = left * weights[s] / w
            return target
        for s in over:
            target[s] = float(max_repeats * sizes[s])
            left -= target[s]
        gone = set(over)
        free = [s for s in free if s not in gone]
    return target


def min_cost_flow(capacity: list[int], member: list[list[int]], quota: list[int], max_repeats: int) -> list[dict[int, int]]:
    """Tokens of each pattern routed to each of its sources, at least convex repetition cost.

    A pattern of one source that shares it with no pattern of several is settled at
    once: the quota, as far as its repetitions reach. The others are a flow.
    """
    shared = {s for m in member if len(m) > 1 for s in m}
    alone: dict[int, int] = {}  # tokens the settled patterns of a source have taken
    out: list[dict[int, int]] = [{} for _ in capacity]
    tied = []
    for p, m in enumerate(member):
        if len(m) != 1 or m[0] in shared:
            tied.append(p)
        elif take := min(quota[m[0]] - alone.get(m[0], 0), capacity[p] * max_repeats):
            out[p][m[0]] = take
            alone[m[0]] = alone.get(m[0], 0) + take
    at = {s: i for i, s in enumerate(sorted({s for p in tied for s in member[p]}))}
    flow = _flow([capacity[p] for p in tied], [[at[s] for s in member[p]] for p in tied], [quota[s] for s in at], max_repeats)
    names = list(at)
    for p, routed in zip(tied, flow):
        out[p] = {names[s]: tokens for s, tokens in routed.items()}
    return out


def _flow(capacity: list[int], member: list[list[int]], quota: list[int], max_repeats: int) -> list[dict[int, int]]:
    """Successive shortest paths with potentials on: start -> pattern (one arc a
    repetition, cost 0, 1, 2, ...) -> its sources -> end (the quota)."""
    P, S, most = len(capacity), len(quota), sum(quota)
    start, end, n = P + S, P + S + 1, P + S + 2
    head: list[list[int]] = [[] for _ in range(n)]
    to, cap, cost = [], [], []

    def arc(a, b, c, w):
        head[a].append(len(to)), to.append(b), cap.append(c), cost.append(w)
        head[b].append(len(to)), to.append(a), cap.append(0), cost.append(-w)

    for p in range(P):
        for r in range(max_repeats):
            arc(start, p, capacity[p], r)
    link = {}
    for p in range(P):
        for s in member[p]:
            link[p, s] = len(to)
            arc(p, P + s, most, 0)
    for s in range(S):
        arc(P + s, end, quota[s], 0)
    potential = [0] * n
    while True:
        dist, via = [None] * n, [None] * n
        dist[start], queue = 0, [(0, start)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for e in head[a]:
                b = to[e]
                if cap[e] and (dist[b] is None or d + cost[e] + potential[a] - potential[b] < dist[b]):
                    dist[b] = d + cost[e] + potential[a] - potential[b]
                    via[b] = e
                    heapq.heappush(queue, (dist[b], b))
        if dist[end] is None:
            break
        potential = [p + (d if d is not None else dist[end]) for p, d in zip(potential, dist)]
        path, b = [], end
        while b != start:
            path.append(via[b])
            b = to[via[b] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push
    out: list[dict[int, int]] = [{} for _ in range(P)]
    for (p, s), e in link.items():
        if cap[e ^ 1]:
            out[p][s] = cap[e ^ 1]
    return out


def mix(docs: DataFrame, weights: list[float], total_share: float = 1.0, max_repeats: int = 3, seed: int = 42,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row.

    ``source_col`` holds a source or an array of overlapping sources. Weights are
    dealt to the sources in code-point order, repeating. ``source_size`` and
    ``target`` are of the document's source (summed over an array's sources).
    """
    return _mix(docs, weights, total_share, max_repeats, seed, id_col, text_col, source_col).drop("rnd")


def _mix(docs, weights, total_share, max_repeats, seed, id_col, text_col, source_col) -> DataFrame:
    rows, solved, schema = _plan(docs, weights, total_share, max_repeats, seed, id_col, text_col, source_col)
    return _select(rows, docs.sparkSession.createDataFrame(solved, schema))


def _random(seed: int, id_col: str, text_col: str) -> Column:
    """The seeded order of documents; also tells rows of one id apart."""
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def _plan(docs, weights, total_share, max_repeats, seed, id_col, text_col, source_col):
    src = F.col(source_col)
    many = isinstance(docs.schema[source_col].dataType, T.ArrayType)
    key = F.array_sort(F.array_distinct(src)) if many else F.array(src)
    key = F.when(F.size(key) > 0, key).otherwise(F.array(F.lit(None).cast("string"))) if many else key
    sized = docs.select(F.col(id_col).alias("doc_id"), key.alias("pattern"), word_count(F.col(text_col)).alias("size"),
                        _random(seed, id_col, text_col).alias("rnd"))
    rows = written(sized, "mix-sized")
    table = bounded_rows(rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")),
                         MAX_PATTERNS, "membership patterns")
    names = sorted({s for r in table for s in r["pattern"]}, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    sizes = dict.fromkeys(names, 0)
    for r in table:
        for s in r["pattern"]:
            sizes[s] += r["size"]
    total = total_share * sum(r["size"] for r in table)
    target = source_targets(sizes, weight, total, max_repeats)
    at = {s: i for i, s in enumerate(names)}
    flow = min_cost_flow([r["size"] for r in table], [[at[s] for s in r["pattern"]] for r in table],
                         [round(target[s]) for s in names], max_repeats)
    solved = []
    for r, f in zip(table, flow):
        routed = sum(f.values())
        full, quota = divmod(routed, r["size"]) if r["size"] else (0, 0)
        solved.append((r["pattern"], int(sum(sizes[s] for s in r["pattern"])),
                       float(sum(target[s] for s in r["pattern"])), int(full), int(quota),
                       math.isqrt(r["docs"]) + 1))
    schema = T.StructType([T.StructField("pattern", T.ArrayType(T.StringType())), T.StructField("source_size", T.LongType()),
                           T.StructField("target", T.DoubleType()), T.StructField("full", T.LongType()),
                           T.StructField("quota", T.LongType()), T.StructField("buckets", T.LongType())])
    return rows, solved, schema


def _select(rows: DataFrame, pattern: DataFrame) -> DataFrame:
    """``full`` uses of every document, one more of a seeded subset that fills the pattern's quota.

    A pattern's d documents lie in hash order, cut into about sqrt(d) buckets. The
    quota falls inside one bucket; only that bucket's documents are ranked. The
    pattern table has at most ``MAX_PATTERNS`` rows, so it is broadcast.
    """
    unit = F.shiftrightunsigned("rnd", 1) / F.lit(float(1 << 63))
    placed = (rows.join(F.broadcast(pattern.withColumnRenamed("pattern", "pat")), F.col("pattern").eqNullSafe(F.col("pat")))
              .withColumn("bucket", F.least(F.floor(unit * F.col("buckets")), F.col("buckets") - 1)))
    placed = written(placed.select("doc_id", "size", "rnd", "source_size", "target", "full", "quota", "bucket", "pattern"),
                     "mix-placed")
    sums = placed.groupBy("pattern", "bucket", "quota").agg(F.sum("size").alias("in_bucket"))
    w = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(w), F.lit(0)))
    cut = written(sums.where((F.col("before") < F.col("quota")) & (F.col("before") + F.col("in_bucket") > F.col("quota")))
                  .select("pattern", F.col("bucket").alias("cut_bucket"), "before"), "mix-cut")
    # a quota met exactly at a bucket's end has no cut bucket: then whole buckets are in or out
    last = (sums.where(F.col("before") + F.col("in_bucket") <= F.col("quota"))
            .groupBy("pattern").agg(F.max("bucket").alias("last_full")))
    edge = written(last.join(cut, "pattern", "full_outer"), "mix-edge").withColumnRenamed("pattern", "epat")
    joined = placed.join(F.broadcast(edge), F.col("pattern").eqNullSafe(F.col("epat")), "left")
    inside = joined.where(F.col("bucket") == F.col("cut_bucket"))
    order = Window.partitionBy("pattern", "bucket").orderBy("rnd", "doc_id", "size")
    run = (inside.withColumn("upto", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    ranked = written(run.select("doc_id", "size", "rnd", "source_size", "target", "full", "quota", "pattern",
                                "bucket", "upto"), "mix-ranked")
    taken_once = F.col("upto") <= F.col("quota")
    # the one document that closes most of the gap, among the bucket's documents left out
    gap = F.col("quota") - F.max(F.when(taken_once, F.col("upto"))).over(Window.partitionBy("pattern"))
    best = (ranked.withColumn("gap", F.coalesce(gap, F.col("quota") - (F.min(F.col("upto") - F.col("size"))
                                                                       .over(Window.partitionBy("pattern")))))
            .withColumn("miss", F.abs(F.col("size") - F.col("gap")))
            .withColumn("n", F.row_number().over(Window.partitionBy("pattern").orderBy(taken_once.cast("int"), "miss", "rnd", "doc_id"))))
    closes = ~taken_once & (F.col("n") == 1) & (F.col("miss") < F.col("gap"))
    extra = F.when(taken_once | closes, 1).otherwise(0)
    out = ["doc_id", "rnd", "size", "source_size", "target"]
    picked = best.select(*out, (F.col("size") * (F.col("full") + extra)).alias("taken"))
    whole = joined.where(~F.coalesce(F.col("bucket") == F.col("cut_bucket"), F.lit(False)))
    once = F.when(F.col("bucket") <= F.coalesce(F.least(F.col("last_full"), F.coalesce(F.col("cut_bucket"), F.col("last_full"))),
                                                F.lit(-1)), 1).otherwise(0)
    rest = whole.select(*out, (F.col("size") * (F.col("full") + once)).alias("taken"))
    return picked.unionByName(rest)


def mixed_documents(docs: DataFrame, weights: list[float], total_share: float = 1.0, max_repeats: int = 3, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns kept."""
    chosen = _mix(docs, weights, total_share, max_repeats, seed, id_col, text_col, source_col)
    times = written(chosen.where("taken > 0").select(F.col("doc_id").alias("_mix_id"), F.col("rnd").alias("_mix_row"),
                                                     (F.col("taken") / F.col("size")).cast("int").alias("_times"))
                    .groupBy("_mix_id", "_mix_row").agg(F.max("_times").alias("_times")), "mix-times")
    joined = docs.join(times.hint("merge"), F.col(id_col).eqNullSafe(F.col("_mix_id")) & (_random(seed, id_col, text_col) == F.col("_mix_row")))
    copies = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return copies.drop("_mix_id", "_mix_row", "_times", "_copy")
