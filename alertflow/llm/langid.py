"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its words' character n-grams, hashed
into ``BUCKETS`` rows; a linear softmax reads the language off it. Both are
trained by stochastic gradient descent in numpy on a bounded sample of labelled
rows; a held-back part of the sample fits the softmax temperature and the
rejection threshold. Prediction is a map job over whole texts: embeddings times
output weights are folded into one score row a bucket. The words of many texts at
a time are found and numbered in arrays, and each distinct one is hashed once.

Defined results: null text or text without a letter is ``und`` with score 0 and
rejected; rows without a label train nothing; with no labelled row every text is
``und``; equal scores go to the first language in code-point order; rows that
repeat an id are predicted each; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import sys
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
DIM = 16
MIN_N, MAX_N = 2, 4
SAMPLE_PER_LANG = 600  # labelled rows a language gives, on average, to the fit
MAX_LANGS = 500  # languages the fit learns: the commonest labels, ties by name
HELD_BYTES = 192 << 20  # of a worker's word scores
MAX_SAMPLE_TEXT = 20_000  # characters of a *training* text's middle; predictions read whole texts
_WORD = re.compile(r"[^\W\d_]+")
_SEGMENT = 1 << 20
_SLICE = 1 << 23  # characters of the texts whose words are looked up together


def ngrams(letters: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' character n-grams, their edges marked, and each word's count of them.

    ``letters`` has the words' code points end to end. One rolling hash over all of them; a word's
    n-grams come by n, then by place.
    """
    size = length + 2
    stop = np.cumsum(size)
    c, inner = np.empty(size.sum(), dtype=np.uint64), np.ones(size.sum(), dtype=bool)
    for places, mark in ((stop - size, "<"), (stop - 1, ">")):
        c[places], inner[places] = ord(mark), False
    c[inner] = letters
    left = np.repeat(stop, size) - np.arange(len(c))
    of_n = {n: np.maximum(size - n + 1, 0) for n in range(MIN_N, MAX_N + 1)}
    count = sum(of_n.values())
    ids, at = np.empty(count.sum(), dtype=np.int64), np.cumsum(count) - count
    h = np.zeros(len(c), dtype=np.uint64)
    for n in range(1, MAX_N + 1):
        h = h[:len(c) - n + 1] * np.uint64(1_000_003) + c[n - 1:]
        if n >= MIN_N:
            g = h[left[:len(h)] >= n] + np.uint64(n)
            g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            to = np.repeat(at - np.cumsum(of_n[n]) + of_n[n], of_n[n]) + np.arange(len(g))
            ids[to] = (g >> np.uint64(40)) % np.uint64(BUCKETS)
            at = at + of_n[n]
    return ids, count


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``ngrams`` of words given as strings."""
    return ngrams(code_points("".join(words)), np.array([len(w) for w in words], dtype=np.int64))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


@functools.cache
def letter_table() -> np.ndarray:
    """Whether ``_WORD`` takes a code point."""
    table = np.zeros(sys.maxunicode + 1, dtype=bool)
    every = np.arange(len(table), dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for run in _WORD.finditer(every):
        table[run.start():run.end()] = True
    return table


def word_runs(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all parts' words end to end, the words' lengths, and each part's first word; the last entry is their number."""
    c = code_points("\n" + "\n".join(parts) + "\n")
    inside = letter_table().take(c)
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first = np.searchsorted(edge[::2], np.cumsum([0, *(len(p) + 1 for p in parts)]))
    return c[inside], edge[1::2] - edge[::2], first


def pieces(text: str):
    """The text lower-cased, in bounded pieces cut at spaces."""
    at = 0
    while at < len(text):
        end = at + _SEGMENT
        if end < len(text):
            cut = text.find(" ", end)
            end = cut if cut >= 0 else len(text)
        yield text[at:end].lower()
        at = end


def words_of(text: str):
    """Lower-cased runs of letters, found piece by piece."""
    for piece in pieces(text):
        yield _WORD.findall(piece)


def slices(texts: list[str | None]):
    """Pieces of many texts at a time, bounded in all, and the number of the text that each is of."""
    owners, parts, held = [], [], 0
    for i, text in enumerate(texts):
        for piece in pieces(text or ""):
            owners.append(i)
            parts.append(piece)
            held += len(piece)
            if held >= _SLICE:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # BUCKETS x languages: embedding times output weights
    bias: np.ndarray
    temperature: float
    reject_below: float

    def predict(self, texts: list[str | None], words: "WordScores") -> list[tuple[str, float]]:
        """(language or ``und``, calibrated score) of each text."""
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), dtype=np.int64)
        for owners, parts in slices(texts):
            s, k = words.sums(parts, self.scores)
            np.add.at(total, owners, s)
            np.add.at(n, owners, k)
        out = [("und", 0.0)] * len(texts)
        known = [i for i in np.flatnonzero(n).tolist() if any(map(str.isalpha, texts[i]))]
        for at in range(0, len(known), 1024):
            some = known[at:at + 1024]
            p = softmax((total[some] / n[some, None] + self.bias) / self.temperature)
            best = p.argmax(axis=1)
            sure = p[np.arange(len(some)), best].clip(0.0, 1.0)
            for i, k, v in zip(some, best.tolist(), sure.tolist()):
                out[i] = (self.langs[k], v)
        return out


class WordScores:
    """Summed scores and n-gram counts of texts' words; a word is hashed once for all its places in a slice.

    At most ``limit`` distinct words' rows of scores are held.
    """

    def __init__(self, width: int, limit: int = 400_000, held: int = HELD_BYTES):
        self.width = width
        self.limit = min(limit, held // (8 * width + 150))  # a row of scores, the word and its place

    def rows(self, letters: np.ndarray, length: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed scores and n-gram count of each word, hashed in blocks that caches hold."""
        rows, sizes = np.empty((len(length), self.width)), np.empty(len(length), dtype=np.int64)
        stop = np.cumsum(length)
        block = max(1024, (1 << 19) // self.width)
        at = 0
        while at < len(length):
            done = stop[at] - length[at]
            end = max(at + 1, int(np.searchsorted(stop, done + block, side="right")))
            ids, count = ngrams(letters[done:stop[end - 1]], length[at:end])
            rows[at:end] = np.add.reduceat(scores.take(ids, axis=0), np.cumsum(count) - count, axis=0)
            sizes[at:end] = count
            at = end
        return rows, sizes

    def sums(self, parts: list[str], scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed scores and n-gram count of each lower-cased part."""
        total, n = np.zeros((len(parts), self.width)), np.zeros(len(parts), dtype=np.int64)
        letters, length, first = word_runs(parts)
        at = np.concatenate([[0], np.cumsum(length)])
        todo = [(0, len(length))]
        while todo:
            a, b = todo.pop()
            if a == b:
                continue
            place, own, size = distinct(letters[at[a]:at[b]], at[a:b + 1] - at[a])
            if len(size) > self.limit and b - a > 1:
                todo += [((a + b) // 2, b), (a, (a + b) // 2)]
                continue
            rows, sizes = self.rows(own, size, scores)
            for i in range(np.searchsorted(first, a, side="right") - 1, np.searchsorted(first, b)):
                for k in range(max(a, first[i]), min(b, first[i + 1]), self.limit):
                    some = place[k - a:min(b, first[i + 1], k + self.limit) - a]
                    total[i] += rows.take(some, axis=0).sum(axis=0)
                    n[i] += sizes.take(some).sum()
        return total, n


def distinct(letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words end to end: each word's place among the distinct ones, and these ones' letters and lengths."""
    width = letters.itemsize
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                  [None, pa.py_buffer(offsets * width), pa.py_buffer(np.ascontiguousarray(letters))]).dictionary_encode()
    own = words.dictionary
    stops = np.frombuffer(own.buffers()[1], dtype=np.int64, count=len(own) + 1) // width
    return words.indices.to_numpy(), np.frombuffer(own.buffers()[2], dtype=letters.dtype, count=stops[-1]), np.diff(stops)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], seed: int = 7, epochs: int = 12, rate: float = 2.0,
        batch: int = 32, held: float = 0.2, target: float = 0.99) -> Model | None:
    """Train on a sample; its ``held`` part calibrates temperature and rejection."""
    langs = sorted(set(labels))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    y = np.array([langs.index(v) for v in labels])
    docs = []
    for t in texts:
        words = [w for part in words_of(t) for w in part]
        ids, counts = np.unique(subwords(words)[0] if words else np.zeros(0, np.int64), return_counts=True)
        docs.append((ids, (counts / max(1, counts.sum())).astype(np.float32)))
    order = rng.permutation(len(docs))
    n_held = int(held * len(docs)) if len(docs) >= 20 else 0
    test, train = order[:n_held], order[n_held:]
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(langs)), dtype=np.float32), np.zeros(len(langs), dtype=np.float32)
    weight = len(train) / (len(langs) * np.maximum(1, np.bincount(y[train], minlength=len(langs))))
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs)
        for at in range(0, len(train), batch):
            part = rng.permutation(train)[:batch] if at == 0 and epoch == 0 else train[at:at + batch]
            mean = np.stack([f @ emb[i] if len(i) else np.zeros(DIM, np.float32) for i, f in (docs[d] for d in part)])
            grad = softmax(mean @ out + bias)
            grad[np.arange(len(part)), y[part]] -= 1
            grad *= (weight[y[part]] / len(part))[:, None]
            back = grad @ out.T
            out -= lr * (mean.T @ grad)
            bias -= lr * grad.sum(axis=0)
            for d, g in zip(part, back):
                i, f = docs[d]
                emb[i] -= (lr * 20) * f[:, None] * g[None, :]
        train = rng.permutation(train)
    scores = emb @ out

    def logits(some):
        return np.stack([f @ scores[i] + bias if len(i) else bias for i, f in (docs[d] for d in some)])

    temperature, threshold = 1.0, 0.0
    if n_held:
        z, yt = logits(test), y[test]
        grid = np.geomspace(0.05, 20, 61)
        loss = [-np.log(softmax(z / t)[np.arange(len(yt)), yt] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / temperature)
        conf, right = p.max(axis=1), p.argmax(axis=1) == yt
        threshold = rejection_threshold(conf, right, target)
    return Model(langs, scores.astype(np.float64), bias.astype(np.float64), temperature, threshold)


def rejection_threshold(conf: np.ndarray, right: np.ndarray, target: float) -> float:
    """Smallest confidence from which the accepted part reaches the target accuracy."""
    order = np.argsort(-conf, kind="stable")
    accuracy = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(accuracy >= target)
    return float(conf[order][good[-1]]) if len(good) else 1.0


def train_sample(docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str,
                 per_lang: int = SAMPLE_PER_LANG, seed: int = 7, max_langs: int = MAX_LANGS) -> tuple[list[str], list[str]]:
    """About ``per_lang`` labelled rows of every language, picked by a hash of the id.

    Languages are counted first, so the share of each is set and no group is
    ever gathered; beyond ``max_langs`` the commonest are learned. At most twice the expected rows reach the driver, each with
    at most ``MAX_SAMPLE_TEXT`` characters.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = (rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(max_langs).collect())
    if not counts:
        return [], []
    share = F.coalesce(*[F.when(F.col(lang_col) == r["lang"], F.lit(min(1.0, per_lang / r["n"]))) for r in counts])
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 11) / F.lit(float(1 << 53))
    extra = F.greatest(F.lit(0), F.length(text_col) - MAX_SAMPLE_TEXT)
    piece = F.substring(F.col(text_col), F.floor(extra / 2).cast("int") + 1, F.lit(MAX_SAMPLE_TEXT))
    picked = rows.where(unit < share).select(F.col(id_col).alias("doc_id"), piece.alias("text"), F.col(lang_col).alias("lang"))
    got = sorted(picked.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "text").limit(2 * per_lang * len(counts)).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"]))
    return [r["text"] for r in got], [r["lang"] for r in got]


def identify(docs: DataFrame, train: Column, extra: Callable[[], list[Column]] = list,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` of every row, plus the columns of ``extra()``."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(*train_sample(docs, train, id_col, text_col, lang_col)))
    more = list(extra())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    passed = rows.drop("text").columns

    def predict(batches):
        m = model.value
        words = WordScores(len(m.langs)) if m else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got = m.predict(texts, words) if m else [("und", 0.0)] * len(texts)
            lang, score = [g[0] for g in got], [g[1] for g in got]
            sure = [v != "und" and p >= m.reject_below for v, p in got]
            kept = [batch.column(c) for c in passed]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(sure, pa.bool_())],
                                             [*passed, "lang_pred", "score", "accepted"])

    schema = rows.drop("text").schema.add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return rows.mapInArrow(predict, schema)
