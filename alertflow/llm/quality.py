"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts.

A logistic model on shape measures of the whole text gives each document's
evidence, a log likelihood ratio for good against bad. Soft counts of good
documents are summed by path and host. A host's rate is shrunk to the global
rate, a path's to its host's, by prior strengths fitted from the spread of the
rates (method of moments): a site with few documents stays near its parent. The
document's posterior joins its evidence with its path's rate; its own share of
that rate is taken out first, so no document votes for itself.

The fit reads a bounded sample of labelled rows (``SAMPLE`` rows); evidence and
site rates cover all rows. Rates are sums combined map-side, so a site with a third
of the documents costs one row a task.

Defined results: null text counts as empty; a null host or path is a site of its
own; without labelled rows of both classes all documents are kept on evidence 0;
rows that repeat an id are judged each; no rows give no rows; columns of other
names pass through ``filter_quality`` untouched (names of its own begin with an underscore).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow.llm.common import text_bytes, written

SAMPLE = 8000  # labelled rows the fit expects at most
KEEP_FROM = 0.5
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\x0b\x0c\r"
_HIGH = bytes(range(128, 256))
_STOPS = b".,;:'\"()-?"
_SLICE = 1 << 22
MEASURES = 8


def measures(text: bytes) -> list[float]:
    """Shares of character classes, word repetition, word length and size of a whole text."""
    n = max(1, len(text))
    counts = [n - len(text.translate(None, c)) if text else 0 for c in (_UPPER, _DIGIT, _SPACE)]
    rest = len(text.translate(None, _UPPER + _LOWER + _DIGIT + _SPACE + _HIGH + _STOPS))
    bang = text.count(b"!")
    words = distinct = runs = 0
    seen: set[bytes] = set()
    last = b""
    for part in _parts(text):
        w = part.split()
        words += len(w)
        seen.update(w)
        runs += sum(map(bytes.__eq__, w, [last, *w[:-1]]))
        last = w[-1] if w else last
    distinct = len(seen)
    k = max(1, words)
    return [counts[0] / n, counts[1] / n, rest / n, bang / n, distinct / k ** 0.9, runs / k, (n - counts[2]) / k / 10,
            np.log1p(words) / 10]


def _parts(text: bytes) -> Iterator[bytes]:
    """Pieces of a text cut at spaces, so that a long one is not split into words at once."""
    at = 0
    while at < len(text):
        end = at + _SLICE
        cut = text.find(b" ", end) if end < len(text) else len(text)
        end = cut if cut >= 0 else len(text)
        yield text[at:end]
        at = end


class Evidence:
    """Logistic regression fitted by Newton steps with a ridge; returns log likelihood ratios."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._expand(x)
        w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
            w += np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        self.w = w
        self.prior = float(np.log(y.sum() / (len(y) - y.sum())))

    def _expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -8, 8)
        return np.hstack((np.ones((len(z), 1)), z, z * z / 8))

    def ratio(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._expand(x) @ self.w, -30, 30) - self.prior


def fit_evidence(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", sample: int = SAMPLE, seed: int = 11) -> Evidence | None:
    """Fit on labelled rows picked by a hash of the id; about ``sample``, never over twice that."""
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("l_id"),
                                                              F.col(label_col).cast("double").alias("good"))
    share = min(1.0, sample / max(1, known.count()))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "l_id"), 11) / F.lit(float(1 << 53))
    picked = known.where(unit < share).groupBy("l_id").agg(F.max("good").alias("good")).limit(2 * sample)
    texts = docs.select(F.col(id_col).alias("l_id"), text_bytes(text_col).alias("text"))
    # at most 2 * sample ids: the bound that makes the broadcast safe
    rows = texts.join(F.broadcast(picked), "l_id").select("l_id", "good", "text")

    def measured(batches):
        for batch in batches:
            m = [measures(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("l_id"), batch.column("good"), pa.array(m, pa.list_(pa.float64()))],
                                             ["l_id", "good", "m"])

    id_type = rows.schema["l_id"].dataType.simpleString()
    got = rows.mapInArrow(measured, f"l_id {id_type}, good double, m array<double>").limit(4 * sample).collect()
    got.sort(key=lambda r: (r["l_id"], r["m"]))
    y = np.array([r["good"] for r in got])
    if not len(y) or y.min() == y.max():
        return None
    return Evidence(np.array([r["m"] for r in got]), y)


def with_evidence(docs: DataFrame, model: Evidence | None, text_col: str = "text", name: str = "_llr") -> DataFrame:
    """``docs`` with the evidence of each whole text in a new column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches):
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            m = shared.value
            x = np.array([measures((t or "").encode("utf-8", "surrogatepass")) for t in texts]).reshape(len(texts), MEASURES)
            ratio = m.ratio(x) if m is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ratio, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(judged, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
    return F.log(p / (1 - p))


def _strength(rates: DataFrame, parent: str) -> float:
    """Prior strength of sites below a parent: rate variance against what counting alone would give."""
    r = rates.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
                  F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(parent), 2)).alias("between"),
                  F.sum(F.col(parent) * (1 - F.col(parent))).alias("within"),
                  F.sum(F.col("n") * F.col(parent) * (1 - F.col(parent))).alias("base")).first()
    if not r["n"] or not r["base"]:
        return 1.0
    excess = max(0.0, r["between"] - r["within"]) / r["base"]  # variance share between sites
    return float(min(1e6, max(1.0, 1 / max(excess, 1e-6) - 1)))


def site_rates(judged: DataFrame, llr: str = "_llr", host: str = "_host", path: str = "_path",
               prior: float = 0.0) -> tuple[DataFrame, dict]:
    """Per (host, path): the shrunk rate of good documents, with its strengths.

    Columns ``host_key, path_key, n, good, host_rate``; the path's shrunk rate is
    ``(good + s * host_rate) / (n + s)`` with ``s = strengths["path"]``.
    """
    p = 1 / (1 + F.exp(-(F.col(llr) + F.lit(prior))))
    paths = written(judged.groupBy(F.col(host).alias("host_key"), F.col(path).alias("path_key"))
                    .agg(F.sum(p).alias("good"), F.count(F.lit(1)).alias("n")), "quality-paths")
    hosts = written(paths.groupBy("host_key").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "quality-hosts")
    total = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    rate = (total["good"] / total["n"]) if total["n"] else 0.5
    s_host = _strength(hosts.withColumn("rate", F.lit(rate)), "rate")
    host_rate = hosts.select(F.col("host_key").alias("h"),
                             ((F.col("good") + s_host * rate) / (F.col("n") + s_host)).alias("host_rate"))
    sites = written(paths.join(host_rate, F.col("host_key").eqNullSafe(F.col("h")), "left").drop("h"), "quality-sites")
    return sites, {"rate": rate, "host": s_host, "path": _strength(sites, "host_rate")}


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` with ``_llr``, ``_host``, ``_path``, ``_site_rate`` and ``_posterior``; evidence is computed on whole texts."""
    model = fit_evidence(docs, labels, id_col, text_col, label_col)
    prior = model.prior if model is not None else 0.0
    sited = docs.withColumns({"_host": host, "_path": path})
    narrow = written(with_evidence(sited.select("_host", "_path", text_col), model, text_col)
                     .select("_host", "_path", "_llr"), "quality-evidence")
    sites, s = site_rates(narrow, prior=prior)
    # names that no document's column has
    sites = sites.withColumnsRenamed({"host_key": "_site_host", "path_key": "_site_path", "n": "_site_n", "good": "_site_good",
                                      "host_rate": "_host_rate"})
    judged = with_evidence(sited, model, text_col)
    own = 1 / (1 + F.exp(-(F.col("_llr") + F.lit(prior))))
    rate = (F.col("_site_good") - own + s["path"] * F.col("_host_rate")) / (F.col("_site_n") - 1 + s["path"])
    joined = judged.join(sites, F.col("_host").eqNullSafe(F.col("_site_host")) & F.col("_path").eqNullSafe(F.col("_site_path")), "left")
    return (joined.withColumn("_site_rate", rate)
            .withColumn("_posterior", 1 / (1 + F.exp(-(F.col("_llr") + _logit(F.col("_site_rate"))))))
            .drop("_site_host", "_site_path", "_site_good", "_site_n", "_host_rate"))


def filter_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, keep_from: float = KEEP_FROM,
                   **columns) -> DataFrame:
    """The rows of ``docs`` judged good, all columns kept."""
    return judge(docs, labels, host, path, **columns).where(F.col("_posterior") >= keep_from).select(*docs.columns)
