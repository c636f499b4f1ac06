"""Registered keys: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow.llm import (ann, centroids, exact, langid, lines, mixing, packing, quality, secrets, simhash, token_files,
                           vector_codes, vector_dedup)
from alertflow.llm.common import table
from alertflow.session import scratch_path

VOCAB = "word_bpe_49k.json"
SEQUENCE = 2048
SHINGLE, MAX_BITS = 3, 2
SOURCE_WEIGHTS = [1.0, 2.0, 3.0]


def host(source: str = "source"):
    """Host of a document: its source."""
    return F.col(source)


def path(source: str = "source", lang: str = "lang"):
    """Path below the host: one branch a language."""
    return F.concat_ws("/", F.coalesce(F.col(source), F.lit("")), F.coalesce(F.col(lang), F.lit("")))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    return langid.identify(docs, train=fold != 0, extra=lambda: [(fold == 0).alias("held_out")])


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), SHINGLE, MAX_BITS)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCAB), SEQUENCE, end_id=0)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scratch_path(spark, "llm-token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), files, public_tokenizers.path(VOCAB), end_id=1)
    return token_files.read_token_digests(spark, files)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), host(), path())
    return judged.select("doc_id", F.col("_llr").alias("evidence"), F.col("_site_rate").alias("site_rate"),
                         F.col("_posterior").alias("posterior"), (F.col("_posterior") >= quality.KEEP_FROM).alias("keep"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digests(*vector_codes.compress(table(spark, sf_dir, "embeddings")))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_digests(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def op13_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def all_queries() -> dict:
    import corpus_pipeline
    ops = (op1_language_id, op2_simhash_near_dedup, op3_best_fit_packing, op4_nearest_neighbours, op5_line_dedup,
           op6_token_files, op7_quality_classifier, op8_secret_scan, op9_exact_dedup, op10_source_mixing,
           op11_vector_codes, op12_centroid_clusters, op13_vector_near_dedup)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


OP5_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, ls, unnest(generate_series(1, len(ls) - 2)) AS p FROM d WHERE len(ls) >= 3),
k AS (SELECT doc_id, p, row_number() OVER (PARTITION BY ls[p], ls[p + 1], ls[p + 2] ORDER BY doc_id, p) AS n,
             ls[p] = '' AND ls[p + 1] = '' AND ls[p + 2] = '' AS blank FROM w),
gone AS (SELECT DISTINCT doc_id, p + unnest([0, 1, 2]) AS i FROM k WHERE n > 1 AND NOT blank),
l AS (SELECT doc_id, unnest(generate_series(1, len(ls))) AS i, unnest(ls) AS line FROM d),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text, count(*) AS n
         FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i WHERE g.i IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(kept.text, '') AS text, CAST(len(d.ls) AS BIGINT) AS n_lines,
       CAST(len(d.ls) - coalesce(kept.n, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP9_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
# floor of s / n, for sums of either sign
_MEAN = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"


def op11_sql(parts: int = 16, entries: int = 64, rounds: int = 2, dim: int = 64) -> str:
    """Unrolled Lloyd rounds over (part position, entry)."""
    width = dim // parts
    gap = " + ".join(f"(part[{j}] - c[{j}]) * (part[{j}] - c[{j}])" for j in range(1, width + 1))
    ctes = [f"""k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_FINITE})""",
            f"""p AS (SELECT vec_id, label, pos, v[pos * {width} + 1:pos * {width} + {width}] AS part
  FROM k, (SELECT unnest(range({parts})) AS pos))""",
            f"""b0 AS (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS e, part AS c
  FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, p.pos, any_value(label) AS label, any_value(part) AS part,
  min(({gap}) * {entries} + e) AS m FROM p JOIN b{r} b ON p.pos = b.pos GROUP BY vec_id, p.pos)""")
        if r < rounds:
            ctes.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.pos, b.e, coalesce(u.c, b.c) AS c FROM b{r} b LEFT JOIN
  (SELECT pos, e, list({_MEAN} ORDER BY j) AS c FROM (SELECT pos, m % {entries} AS e, j, sum(part[j]) AS s, count(*) AS n
   FROM a{r}, (SELECT unnest(range(1, {width + 1})) AS j) GROUP BY ALL) GROUP BY pos, e) u ON b.pos = u.pos AND b.e = u.e)""")
    return "WITH " + ",\n".join(ctes) + f""",
o AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY pos) AS code,
  CAST(sum(m // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY pos, e)) FROM b{rounds}) AS codebooks_sha256 FROM o"""


def op12_sql(k: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """Unrolled Lloyd rounds over whole vectors; doubles hold these sums exactly."""
    gap = "CAST(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS BIGINT)"
    ctes = [f"""v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE {_FINITE} AND len(embedding) = {dim})""",
            f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS e, x AS c
  FROM v ORDER BY sha256('3:' || vec_id) LIMIT {k})"""]
    for r in range(rounds + 1):
        ctes.append(f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(x) AS x, min({gap} * {k} + e) AS m FROM v, c{r} GROUP BY vec_id)")
        if r < rounds:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.e, coalesce(u.c, c{r}.c) AS c FROM c{r} LEFT JOIN
  (SELECT e, list(CAST({_MEAN} AS DOUBLE) ORDER BY j) AS c FROM (SELECT m % {k} AS e, j, sum(CAST(x[j] AS BIGINT)) AS s, count(*) AS n
   FROM a{r}, (SELECT unnest(range(1, {dim + 1})) AS j) GROUP BY ALL) GROUP BY e) u ON c{r}.e = u.e)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(m % {k} AS INTEGER) AS cluster, m // {k} AS distance,
  CAST(sum(m // {k}) OVER (PARTITION BY m % {k}) AS BIGINT) AS cluster_inertia, CAST(sum(m // {k}) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c, lambda y: CAST(y AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON m % {k} = e"""


OP13_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE {_FINITE} AND label IS NOT NULL),
u AS (SELECT * FROM v WHERE list_dot_product(x, x) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT m.vec_id, (SELECT count(*) FROM e WHERE e.a = m.vec_id) AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN c ON m.vec_id = c.a
"""


def all_sql() -> dict[str, str]:
    import corpus_pipeline
    sql = {"op5_line_dedup": OP5_SQL, "op9_exact_dedup": OP9_SQL, "op11_vector_codes": op11_sql(),
           "op12_centroid_clusters": op12_sql(), "op13_vector_near_dedup": OP13_SQL}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
