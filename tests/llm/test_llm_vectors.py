"""Vector operators (codes, clusters, near-dedup) against brute force and on odd input."""

import hashlib
import math

import numpy as np
import pytest

from alertflow.llm import centroids, vector_codes, vector_dedup

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, node long, d int, n long, rid string, code int"


def frame(spark, ids, vectors, labels):
    """Vectors with columns whose names clash with the operators' own."""
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], label, "c", 7, 1, 2, "r", 3)
            for i, v, label in zip(ids, vectors, labels)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clouds(n, dim, seed=0, groups=6, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    v = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))
    v[::9] = v[0]  # one vector in many rows
    return v


ODD = [None, [], [float("nan")] * 8, [float("inf")] + [0.0] * 7, [None] + [1.0] * 7, [0.0] * 8, [1e30] * 8, [1.0] * 5]


def odd_frame(spark, extra=40, dim=8):
    v = clouds(extra, dim, 3)
    ids = [*range(100, 100 + len(ODD)), *range(extra - 4), None, None, 0, 0]  # null and repeated ids
    labels = [1] * len(ODD) + [None if i % 5 == 0 else i % 3 for i in range(extra)]
    return frame(spark, ids, ODD + v.tolist(), labels), v, ids[len(ODD):], labels[len(ODD):]


# ---------------------------------------------------------------- vector codes

def brute_codes(rows, parts, entries, rounds, scale):
    """rows: (id, vector, label) in codebook order."""
    ints = [[math.floor(scale * x) for x in v] for _, v, _ in rows]
    width = len(ints[0]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    books = [[cut[i][p] for i in range(min(entries, len(rows)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p])) for p, x in enumerate(v)] for v in cut]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[i][p] for i in range(len(rows)) if got[i][p][1] == e]
                if mine:
                    books[p][e] = [sum(x[j] for x in mine) // len(mine) for j in range(width)]
    return [("".join(f"{e:02x}" for _, e in g), sum(d for d, _ in g)) for g in assign()], books


@pytest.mark.parametrize("n,rounds", [(1, 2), (50, 0), (300, 2), (300, 4)])
def test_codes_equal_brute_force(spark, n, rounds, monkeypatch):
    monkeypatch.setattr(vector_codes, "OWNER_ROWS", 64)  # salted owners
    v = clouds(n, 8, n)
    rows = sorted((i, x, i % 4 or None) for i, x in enumerate(v.tolist()))
    codes, books = vector_codes.compress(frame(spark, range(n), v, [r[2] for r in rows]), 4, 16, rounds, 256.0)
    want, want_books = brute_codes(rows, 4, 16, rounds, 256.0)
    assert books.tolist() == want_books
    got = {r["vec_id"]: r for r in vector_codes.code_digests(codes, books).collect()}
    per_label = {}
    for (i, _, label), (_, error) in zip(rows, want):
        per_label[label] = per_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in want_books for e in b for x in e).encode()).hexdigest()
    for (i, _, label), (code, error) in zip(rows, want):
        assert (got[i]["code"], got[i]["error"], got[i]["label_error"]) == (code, error, per_label[label])
        assert got[i]["codebooks_sha256"] == digest
    assert len(got) == n


def test_codes_only_moving_parts_are_dealt_again(spark, monkeypatch):
    """The tables dealt after the first one hold the parts that changed entry, no others."""
    dealt = []
    owned = vector_codes._owned
    monkeypatch.setattr(vector_codes, "_owned", lambda m: dealt.append(m) or owned(m))
    n = 300
    v = clouds(n, 8, 5)
    vector_codes.compress(frame(spark, range(n), v, [0] * n), 4, 16, 3)
    moved = [m.count() for m in dealt]
    assert moved[0] == n * 4 and all(0 < m < n * 2 for m in moved[1:]) and len(moved) == 3


def test_codes_odd_rows(spark):
    df, v, ids, labels = odd_frame(spark)
    codes, books = vector_codes.compress(df, 4, 8, 2)
    order = sorted(zip(ids, v.tolist(), labels), key=lambda r: (r[0] is None, r[0] or 0, [math.floor(256 * x) for x in r[1]]))
    # a vector of zeros takes part
    order.insert(sum(r[0] is not None and r[0] < 105 for r in order), (105, [0.0] * 8, 1))
    want, want_books = brute_codes(order, 4, 8, 2, 256.0)
    assert books.tolist() == want_books
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"]) for r in codes.collect())
    assert got == sorted((o[0] is None, o[0] or 0, *w) for o, w in zip(order, want))
    none, no_books = vector_codes.compress(df.where("vec_id = -1"))
    assert vector_codes.code_digests(none, no_books).collect() == []


def test_nearest_is_exact_at_large_values():
    rng = np.random.default_rng(1)
    big = vector_codes.LARGEST if hasattr(vector_codes, "LARGEST") else 1 << 27
    p, book = rng.integers(-big, big, (40, 4)), rng.integers(-big, big, (9, 4))
    at, error = vector_codes.nearest(p, book)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book)) for x in p]
    assert [(int(d), int(e)) for d, e in zip(error, at)] == want


def test_codes_decode_to_the_nearest_entries(spark):
    n = 200
    v = clouds(n, 8, 2)
    codes, books = vector_codes.compress(frame(spark, range(n), v, [0] * n), 4, 16, 2)
    rows = codes.orderBy("vec_id").collect()
    index = np.array([[int(r["code"][2 * p:2 * p + 2], 16) for p in range(4)] for r in rows])
    gap = ((vector_codes.decode(index, books) - np.floor(256 * v).astype(int)) ** 2).sum(1)
    assert gap.tolist() == [r["error"] for r in rows]


# ---------------------------------------------------------------- centroid clusters

def brute_clusters(rows, k, rounds, scale):
    """rows: (id, vector) in centroid order."""
    ints = [[math.floor(scale * x) for x in v] for _, v in rows]
    cents = [list(v) for v in ints[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(cents)) for v in ints]

    for _ in range(rounds):
        got = assign()
        for e in range(len(cents)):
            mine = [v for v, g in zip(ints, got) if g[1] == e]
            if mine:
                cents[e] = [sum(x[j] for x in mine) // len(mine) for j in range(len(mine[0]))]
    return assign(), cents


def _hash(i):
    return hashlib.sha256(f"3:{i}".encode()).hexdigest()


@pytest.mark.parametrize("n,k", [(1, 8), (5, 8), (200, 8), (200, 3)])
def test_clusters_equal_brute_force(spark, n, k):
    v = clouds(n, 6, n)
    rows = sorted(enumerate(v.tolist()), key=lambda r: _hash(r[0]))
    assigned, cents = centroids.cluster(frame(spark, range(n), v, [0] * n), k, 5, dim=6)
    want, want_cents = brute_clusters(rows, k, 5, 1024.0)
    assert cents.tolist() == want_cents
    got = {r["vec_id"]: r for r in centroids.cluster_digests(assigned, cents).collect()}
    assert len(got) == n
    per = {}
    for d, e in want:
        per[e] = per.get(e, 0) + d
    for (i, _), (d, e) in zip(rows, want):
        r = got[i]
        digest = hashlib.sha256(",".join(map(str, want_cents[e])).encode()).hexdigest()
        assert (r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) == (e, d, per[e], sum(per.values()), digest)


def test_tournament_equals_nearest_with_ties():
    rng = np.random.default_rng(4)
    for big in (3, 1 << 27):
        c = rng.integers(-big, big, (9, 4))
        c[5] = c[2]  # equal centroids: the smaller number
        x = np.concatenate([rng.integers(-big, big, (300, 4)), c])
        won = centroids.winners(x, *centroids.bisectors(c))
        want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(r, m)), e) for e, m in enumerate(c))[1] for r in x]
        assert won.tolist() == want


def test_clusters_odd_rows(spark):
    df, v, ids, _ = odd_frame(spark)
    assigned, cents = centroids.cluster(df, 4, 3, dim=8)
    order = sorted([*zip(ids, v.tolist()), (105, [0.0] * 8)],
                   key=lambda r: (r[0] is None, _hash(r[0]), [math.floor(1024 * x) for x in r[1]]))
    want, want_cents = brute_clusters(order, 4, 3, 1024.0)
    assert cents.tolist() == want_cents
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["cluster"], r["distance"]) for r in assigned.collect())
    assert got == sorted((o[0] is None, o[0] or 0, e, d) for o, (d, e) in zip(order, want))
    none = centroids.cluster(df.where("vec_id = -1"))
    assert centroids.cluster_digests(*none).collect() == []


# ---------------------------------------------------------------- vector near-dedup

def brute_links(ids, vectors, labels, threshold):
    """(row count of links, smallest id of the component) per row."""
    n = len(ids)

    def usable(i):
        v = vectors[i]
        return labels[i] is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [i for i in range(n) if usable(i)]
    near = {i: [] for i in range(n)}
    for i in ok:
        for j in ok:
            if i != j and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.ldexp(vectors[i], -90), np.ldexp(vectors[j], -90)
                if (a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                    near[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        known = [ids[j] for j in seen if ids[j] is not None]
        out.append((len(near[i]), min(known) if known else None))
    return out


def told(df):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"] if r["component_id"] is not None else -1, r["kept"])
                  for r in df.collect())


def wanted(ids, links):
    return sorted((i is None, i or 0, n, c if c is not None else -1, i == c) for i, (n, c) in zip(ids, links))


@pytest.mark.parametrize("n,dim,tile,spread", [(1, 4, 8, 0.1), (150, 4, 8, 0.2), (400, 24, 64, 0.02), (400, 40, 2048, 0.05), (300, 2, 16, 0.05)])
def test_near_vectors_equal_brute_force(spark, n, dim, tile, spread):
    v = clouds(n, dim, n + dim, 12, spread)
    labels = [None if i % 11 == 0 else 1 if i % 3 else 2 for i in range(n)]
    got = vector_dedup.near_vectors(frame(spark, range(n), v, labels), 0.98, tile=tile)
    assert told(got) == wanted(list(range(n)), brute_links(list(range(n)), v.tolist(), labels, 0.98))


def test_near_vectors_odd_rows(spark):
    df, v, ids, labels = odd_frame(spark)
    vectors, every, tags = ODD + v.tolist(), [*range(100, 100 + len(ODD)), *ids], [1] * len(ODD) + labels
    # a tiny, a huge and an opposite multiple of one vector
    more = [[1e-150, 2e-150], [1e160, 2e160], [-1.0, -2.0], [1.0, 2.0]]
    extra = frame(spark, range(200, 204), more, [9] * 4)
    got = vector_dedup.near_vectors(df.unionByName(extra), 0.98, tile=4)
    links = brute_links(every, vectors, tags, 0.98) + [(2, 200), (2, 200), (0, 202), (2, 200)]
    assert told(got) == wanted([*every, *range(200, 204)], links)
    assert vector_dedup.near_vectors(df.where("vec_id = -1")).collect() == []
    assert told(vector_dedup.near_vectors(df.where("label is null"))) == wanted(
        [i for i, t in zip(every, tags) if t is None], [(0, i) for i, t in zip(every, tags) if t is None])


def test_dense_group_gives_a_forest():
    rng = np.random.default_rng(8)
    p, q = np.nonzero(np.triu(rng.random((200, 200)) < 0.5, 1))
    a, b = vector_dedup.forest(p, q, 200)
    assert len(a) == 199 and set(zip(a.tolist(), b.tolist())) <= set(zip(p.tolist(), q.tolist()))
    for edges in ([], [(0, 1)], [(3, 4), (4, 5), (0, 5), (1, 2)], [(i, i + 1) for i in range(60)], [(59 - i, (i * 7) % 60) for i in range(60)]):
        p, q = np.array([x for x, _ in edges], int), np.array([y for _, y in edges], int)
        a, b = vector_dedup.forest(p, q, 61)

        def groups(x, y):
            root = list(range(61))
            for s, t in zip(list(x) * 61, list(y) * 61):
                root[s] = root[t] = min(root[s], root[t])
            return root

        assert groups(a, b) == groups(p, q) and len(a) <= 60


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(2)
    for dim in (3, 8, 20, 64):
        v = rng.normal(size=(8, dim))[rng.integers(0, 8, 120)] + 0.1 * rng.normal(size=(120, dim))
        u = v / np.sqrt((v * v).sum(1))[:, None]
        turn = vector_dedup.principal(u.T @ u)
        for threshold in (0.5, 0.9, 0.98):
            i, j = vector_dedup.linked_pairs(v, v, turn, threshold)
            want = np.nonzero((v @ v.T) / np.sqrt((v * v).sum(1))[:, None] / np.sqrt((v * v).sum(1))[None, :] >= threshold)
            off = {(a, b) for a, b in zip(*want) if a != b}
            assert {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a != b} == off
