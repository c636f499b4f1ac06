"""Image network fused with metadata, trained by data-parallel gradient rounds.

The image branch looks at four rotated views of the zero-padded image with one
set of weights: 3x3 convolution, rectifier, 2x2 maximum, then a dense layer over
the views together. The metadata branch is a dense layer; both meet in a softmax
layer. Every gradient round is one pass: each task sums the gradient of its rows
batch by batch, the sums are added in a tree of tasks, and the driver, which holds
nothing but the parameters, takes one Adam step (gradients clipped per layer).
An epoch is ``steps`` rounds over disjoint, seeded parts of the rows. The
validation loss of every epoch drives an ``operators.training.Watch``: patience,
best parameters restored, step cut on a plateau.

Sums are over rows, so the number of partitions changes results by rounding only.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.operators.training import Watch

FAN = 32  # sums that one task of the tree, or the driver, adds
ROWS = 256  # rows of one forward and backward pass
_SUM = "total binary, loss double, n long"


@dataclass(frozen=True)
class Shape:
    """Sizes of the network; images are square, channel last."""

    side: int = S.CROP_SIZE
    channels: int = 3
    meta: int = len(S.METADATA_COLUMNS)
    classes: int = len(S.CLASS_LABELS)
    pad: int = 3
    filters: int = 16
    image_units: int = 64
    meta_units: int = 32

    @property
    def pooled(self) -> int:
        return (self.side + 2 * self.pad) // 2

    def layers(self) -> list[tuple[str, tuple[int, ...]]]:
        return [("conv", (9 * self.channels, self.filters)), ("conv_bias", (self.filters,)),
                ("image", (4 * self.pooled ** 2 * self.filters, self.image_units)), ("image_bias", (self.image_units,)),
                ("meta", (self.meta, self.meta_units)), ("meta_bias", (self.meta_units,)),
                ("out", (self.image_units + self.meta_units, self.classes)), ("out_bias", (self.classes,))]

    def split(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Views of a flat vector, one per layer."""
        out, at = {}, 0
        for name, size in self.layers():
            n = int(np.prod(size))
            out[name] = flat[at:at + n].reshape(size)
            at += n
        return out

    def start(self, seed: int = S.SEED) -> np.ndarray:
        """Seeded uniform weights scaled by the layer's width, zero biases."""
        rng = np.random.default_rng(seed)
        parts = [np.zeros(size) if len(size) == 1 else rng.uniform(-1, 1, size) * np.sqrt(6 / sum(size)) for _, size in self.layers()]
        return np.concatenate([p.ravel() for p in parts])


def _views(shape: Shape, images: np.ndarray) -> np.ndarray:
    """(4n, side, side, channels): the padded images turned by 0..3 quarter turns."""
    x = images.reshape(-1, shape.side, shape.side, shape.channels)
    x = np.pad(x, ((0, 0), (shape.pad,) * 2, (shape.pad,) * 2, (0, 0)))
    return np.concatenate([np.rot90(x, k, axes=(1, 2)) for k in range(4)])


def _patches(x: np.ndarray) -> np.ndarray:
    """Rows of 3x3 neighbourhoods of every pixel (zeros outside)."""
    w = np.lib.stride_tricks.sliding_window_view(np.pad(x, ((0, 0), (1, 1), (1, 1), (0, 0))), (3, 3), axis=(1, 2))
    return w.transpose(0, 1, 2, 4, 5, 3).reshape(-1, 9 * x.shape[3])


def _forward(shape: Shape, p: dict, images: np.ndarray, meta: np.ndarray) -> dict:
    n, m, q = len(images), shape.side + 2 * shape.pad, shape.pooled
    cols = _patches(_views(shape, images))
    conv = np.maximum(cols @ p["conv"] + p["conv_bias"], 0).reshape(4 * n, m, m, -1)
    blocks = conv[:, :2 * q, :2 * q].reshape(4 * n, q, 2, q, 2, -1).transpose(0, 1, 3, 5, 2, 4).reshape(4 * n, q, q, shape.filters, 4)
    top = blocks.argmax(-1)
    pooled = np.take_along_axis(blocks, top[..., None], -1)[..., 0]
    seen = pooled.reshape(4, n, -1).transpose(1, 0, 2).reshape(n, -1)  # the four views of an image side by side
    image = np.maximum(seen @ p["image"] + p["image_bias"], 0)
    told = np.maximum(meta @ p["meta"] + p["meta_bias"], 0)
    both = np.concatenate([image, told], axis=1)
    z = both @ p["out"] + p["out_bias"]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return {"cols": cols, "conv": conv, "top": top, "seen": seen, "both": both, "probs": z / z.sum(axis=1, keepdims=True)}


def probabilities(shape: Shape, flat: np.ndarray, images: np.ndarray, meta: np.ndarray) -> np.ndarray:
    parts = [_forward(shape, shape.split(flat), images[a:a + ROWS], meta[a:a + ROWS])["probs"] for a in range(0, len(images), ROWS)]
    return np.concatenate(parts) if parts else np.zeros((0, shape.classes))


def loss_of(probs: np.ndarray, label: np.ndarray) -> float:
    return float(-np.log(np.maximum(probs[np.arange(len(label)), label], 1e-300)).sum())


def gradient(shape: Shape, flat: np.ndarray, images: np.ndarray, meta: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient and loss, both summed over the rows."""
    p, n, q, m = shape.split(flat), len(images), shape.pooled, shape.side + 2 * shape.pad
    f = _forward(shape, p, images, meta)
    g = np.zeros_like(flat)
    d = shape.split(g)  # views: written in place
    out = f["probs"].copy()
    out[np.arange(n), label] -= 1
    d["out"][:], d["out_bias"][:] = f["both"].T @ out, out.sum(0)
    back = (out @ p["out"].T) * (f["both"] > 0)
    image, told = back[:, :shape.image_units], back[:, shape.image_units:]
    d["meta"][:], d["meta_bias"][:] = meta.T @ told, told.sum(0)
    d["image"][:], d["image_bias"][:] = f["seen"].T @ image, image.sum(0)
    pooled = (image @ p["image"].T).reshape(n, 4, -1).transpose(1, 0, 2).reshape(4 * n, q, q, shape.filters)
    blocks = np.zeros((*pooled.shape, 4))
    np.put_along_axis(blocks, f["top"][..., None], pooled[..., None], -1)
    conv = np.zeros_like(f["conv"])
    conv[:, :2 * q, :2 * q] = blocks.reshape(4 * n, q, q, shape.filters, 2, 2).transpose(0, 1, 4, 2, 5, 3).reshape(4 * n, 2 * q, 2 * q, -1)
    conv = (conv * (f["conv"] > 0)).reshape(4 * n * m * m, -1)
    d["conv"][:], d["conv_bias"][:] = f["cols"].T @ conv, conv.sum(0)
    return g, loss_of(f["probs"], label)


def _arrays(batch: pa.RecordBatch, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def matrix(name):
        col = batch.column(name).slice(a, b - a)
        return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1).astype(np.float64)
    return matrix("image"), matrix("meta"), batch.column("label_idx").slice(a, b - a).to_numpy().astype(np.int64)


def _pass(shape: Shape, flat: np.ndarray, with_gradient: bool):
    """One row per task: the summed gradient (empty for a pass that only asks for the loss), loss and rows."""
    def work(batches):
        total, loss, n = np.zeros_like(flat) if with_gradient else np.zeros(0), 0.0, 0
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                images, meta, label = _arrays(batch, a, min(a + ROWS, batch.num_rows))
                if with_gradient:
                    g, s = gradient(shape, flat, images, meta, label)
                    total += g
                else:
                    s = loss_of(probabilities(shape, flat, images, meta), label)
                loss, n = loss + s, n + len(label)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([loss]), pa.array([n])], ["total", "loss", "n"])
    return work


def _added(batches):
    """The sum of a task's rows."""
    total, loss, n = None, 0.0, 0
    for batch in batches:
        for r in batch.to_pylist():
            g = np.frombuffer(r["total"])
            total, loss, n = g.copy() if total is None else total + g, loss + r["loss"], n + r["n"]
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([loss]), pa.array([n])], ["total", "loss", "n"])


def summed_gradient(rows: DataFrame, shape: Shape, flat: np.ndarray, with_gradient: bool = True) -> tuple[np.ndarray, float, int]:
    """``(gradient, loss, rows)`` summed over ``rows`` (``image, meta, label_idx``) by a tree of tasks."""
    sums = rows.select("image", "meta", "label_idx").mapInArrow(_pass(shape, flat, with_gradient), _SUM)
    parts = rows.rdd.getNumPartitions()
    while parts > FAN:
        parts = -(-parts // FAN)
        sums = sums.repartition(parts).mapInArrow(_added, _SUM)
    total, loss, n = np.zeros_like(flat) if with_gradient else np.zeros(0), 0.0, 0
    for r in sums.collect():  # FAN rows at most, each as long as the parameters
        total, loss, n = total + np.frombuffer(bytes(r["total"])), loss + r["loss"], n + r["n"]
    return total, loss, n


def _clipped(shape: Shape, g: np.ndarray, most: float | None) -> np.ndarray:
    if most:
        for part in shape.split(g).values():
            norm = np.sqrt((part * part).sum())
            if norm > most:
                part *= most / norm
    return g


def train_fused(train: DataFrame, validation: DataFrame, shape: Shape, epochs: int = 100, steps: int = 1,
                watch: Watch | None = None, clip: float | None = 0.001, seed: int = S.SEED, id_col: str = "object_id") -> tuple:
    """``(parameters, history)`` with the least validation loss.

    Rows: ``image`` (array of side x side x channels values), ``meta`` (array),
    ``label_idx`` and the id that deals them to the steps of an epoch.
    """
    from pyspark import StorageLevel

    watch = watch or Watch()
    cols = [id_col, "image", "meta", "label_idx"]
    train = train.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    validation = validation.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        flat = shape.start(seed)
        best, history, t = flat.copy(), [], 0
        mean, square = np.zeros_like(flat), np.zeros_like(flat)
        for epoch in range(epochs):
            loss = n = 0
            for step in range(steps):
                part = train if steps == 1 else train.where(F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), F.col(id_col)), F.lit(steps)) == step)
                g, s, rows = summed_gradient(part, shape, flat)
                if not rows:
                    continue
                loss, n, t = loss + s, n + rows, t + 1
                g = _clipped(shape, g / rows, clip)
                mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
                flat = flat - watch.step * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.999 ** t)) + 1e-7)
            if not n:
                raise ValueError("the training split has no rows")
            _, held, m = summed_gradient(validation, shape, flat, with_gradient=False)
            if not m:
                raise ValueError("the validation split has no rows")
            history.append({"epoch": epoch, "step": watch.step, "train_loss": loss / n, "loss": held / m})
            if watch.see(epoch, held / m):
                best = flat.copy()
            if watch.stopped:
                break
        return best, history
    finally:
        train.unpersist()
        validation.unpersist()


def predictor(shape: Shape, flat: np.ndarray):
    """``predict(X)`` over feature rows (image values, then metadata) for ``model.score_with_function`` and the stream."""
    n = shape.side * shape.side * shape.channels

    def predict(x: np.ndarray) -> np.ndarray:
        return probabilities(shape, flat, x[:, :n], x[:, n:])
    return predict


def save(spark: SparkSession, path: str, shape: Shape, flat: np.ndarray) -> str:
    row = (json.dumps(shape.__dict__), [float(v) for v in flat])
    spark.createDataFrame([row], "shape string, parameters array<double>").coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load(spark: SparkSession, path: str) -> tuple[Shape, np.ndarray]:
    row = spark.read.parquet(path).first()
    return Shape(**json.loads(row["shape"])), np.array(row["parameters"])
