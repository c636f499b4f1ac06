"""The image network fused with metadata: gradients, partitions, training, scoring."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from alertflow.operators import fused as FU
from alertflow.operators import model as ML
from alertflow.operators.training import Watch
from alertflow.session import scratch_path

SHAPE = FU.Shape(side=5, channels=2, meta=3, classes=3, pad=1, filters=3, image_units=5, meta_units=4)


def data(n, seed=0):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 3, n)
    images = rng.normal(size=(n, 50)) + (label == 1)[:, None]
    meta = rng.normal(size=(n, 3)) + 2 * (label == 2)[:, None]
    return images, meta, label


def rows(spark, n, parts, seed=0):
    images, meta, label = data(n, seed)
    got = [(i, [float(v) for v in a], [float(v) for v in b], int(c)) for i, (a, b, c) in enumerate(zip(images, meta, label))]
    return spark.createDataFrame(got, "object_id long, image array<float>, meta array<double>, label_idx int").repartition(parts)


def test_gradient_equals_a_finite_difference():
    images, meta, label = data(7)
    flat = SHAPE.start(1) + 0.01
    g, loss = FU.gradient(SHAPE, flat, images, meta, label)
    assert loss == pytest.approx(FU.loss_of(FU.probabilities(SHAPE, flat, images, meta), label))
    step = 1e-6
    for at in np.random.default_rng(2).permutation(len(flat))[:120].tolist() + list(range(-8, 0)):
        near = [flat.copy(), flat.copy()]
        near[0][at] += step
        near[1][at] -= step
        up, down = (FU.loss_of(FU.probabilities(SHAPE, x, images, meta), label) for x in near)
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=2e-4, abs=2e-5)


def test_the_views_share_weights():
    """An image and its quarter turn see the same four views, only in another order."""
    images, _, _ = data(2)
    turned = np.rot90(images.reshape(2, 5, 5, 2), 1, axes=(1, 2)).reshape(2, -1)
    a, b = FU._views(SHAPE, images).reshape(4, 2, -1), FU._views(SHAPE, turned).reshape(4, 2, -1)
    assert np.array_equal(a[[1, 2, 3, 0]], b)


def test_partitions_do_not_change_the_gradient_or_the_weights(spark, monkeypatch):
    flat = SHAPE.start(3)
    one = FU.summed_gradient(rows(spark, 60, 1), SHAPE, flat)
    whole, loss = FU.gradient(SHAPE, flat, *[np.float32(x).astype(float) if i == 0 else x for i, x in enumerate(data(60))])
    four = FU.summed_gradient(rows(spark, 60, 4), SHAPE, flat)
    monkeypatch.setattr(FU, "FAN", 2)  # a tree of several levels
    tree = FU.summed_gradient(rows(spark, 60, 7), SHAPE, flat)
    for g, s, n in (one, four, tree):
        assert n == 60 and s == pytest.approx(loss) and np.allclose(g, whole, rtol=1e-9, atol=1e-10)
    args = dict(epochs=2, steps=2, watch=None, clip=None)
    a, _ = FU.train_fused(rows(spark, 60, 1), rows(spark, 20, 1, 1), SHAPE, **args)
    b, _ = FU.train_fused(rows(spark, 60, 4), rows(spark, 20, 3, 1), SHAPE, **args)
    assert np.allclose(a, b, atol=1e-6) and not np.allclose(a, SHAPE.start())


def test_training_is_watched_and_scores(spark):
    train, held = rows(spark, 150, 2), rows(spark, 60, 1, 5)
    flat, history = FU.train_fused(train, held, SHAPE, epochs=12, watch=Watch(patience=4, step=0.02, min_step=0.001), clip=None)
    losses = [e["loss"] for e in history]
    assert min(losses) < 0.75 * losses[0]
    _, loss, n = FU.summed_gradient(held, SHAPE, flat, with_gradient=False)
    assert loss / n == pytest.approx(min(losses))
    shape, again = FU.load(spark, FU.save(spark, scratch_path(spark, "fused"), SHAPE, flat))
    assert shape == SHAPE and np.array_equal(again, flat)
    features = held.withColumn("features_arr", F.concat(F.transform("image", lambda x: x.cast("double")), "meta"))
    scored = ML.score_with_function(features, FU.predictor(shape, again), 3).collect()
    right = np.mean([int(np.argmax(r["probs"])) == r["label_idx"] for r in scored])
    assert right > 0.6 and all(abs(sum(r["probs"]) - 1) < 1e-9 for r in scored)


def test_empty_splits_are_errors(spark):
    df = rows(spark, 5, 1)
    with pytest.raises(ValueError, match="training"):
        FU.train_fused(df.where("object_id < 0"), df, SHAPE, epochs=1)
    with pytest.raises(ValueError, match="validation"):
        FU.train_fused(df, df.where("object_id < 0"), SHAPE, epochs=1)
