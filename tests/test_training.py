"""Training watched by a validation split."""
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from alertflow.operators import model as ML
from alertflow.operators import training as TR
from alertflow.session import scratch_path

CLASSES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def split(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int) + (x[:, 2] > 1)
    rows = [([float(v) for v in a], CLASSES[b], i) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x array<double>, label string, i int").withColumn("features", array_to_vector("x"))
    return df.where("i < 200"), df.where("i >= 200")


def loss_of(model, df):
    return TR.cross_entropy(ML.score(model, df.withColumn("label_idx", ML.label_to_index("label", CLASSES))))["loss"]


def test_restored_model_has_the_least_validation_loss(split):
    train, held = split
    model, history = TR.train_watched(train, held, "label", CLASSES, 6, TR.Watch(patience=3), epochs=15, passes=3, hidden=(6,))
    losses = [e["loss"] for e in history]
    assert loss_of(model, held) == pytest.approx(min(losses), rel=1e-9)
    best = losses.index(min(losses))
    assert len(losses) == min(15, best + 1 + 3) and all(math.isfinite(x) for x in losses)
    assert history[0]["n"] == 100 and 0 <= history[0]["accuracy"] <= 1


def test_a_new_driver_goes_on_from_the_written_rounds(spark, split):
    train, held = split
    args = ("label", CLASSES, 6)
    settings = {"passes": 2, "hidden": (5,), "solver": "gd"}
    watch = dict(patience=4, cut_patience=1, factor=0.5, step=0.5, min_step=0.1, cut_delta=10.0)
    whole, history = TR.train_watched(train, held, *args, TR.Watch(**watch), epochs=5, **settings)
    state = scratch_path(spark, "watched")
    TR.train_watched(train, held, *args, TR.Watch(**watch), epochs=2, state=state, **settings)
    resumed, again = TR.train_watched(train, held, *args, TR.Watch(**watch), epochs=5, state=state, **settings)
    assert [e["step"] for e in again] == [0.5, 0.5, 0.25, 0.125, 0.1] == [e["step"] for e in history]
    assert np.allclose([e["loss"] for e in again], [e["loss"] for e in history])
    assert np.allclose(whole.weights.toArray(), resumed.weights.toArray())
    done, same = TR.train_watched(train, held, *args, TR.Watch(**watch), epochs=5, state=state, **settings)
    assert same == again and np.allclose(done.weights.toArray(), resumed.weights.toArray())


def test_empty_validation_and_unknown_labels_are_errors(split):
    train, held = split
    with pytest.raises(ValueError, match="no rows"):
        TR.train_watched(train, held.where("i < 0"), "label", CLASSES, 6, epochs=1, hidden=(3,))
    with pytest.raises(ValueError, match="label"):
        TR.train_watched(train, held, "label", CLASSES[:2], 6, epochs=1, hidden=(3,))


def test_watch_on_hand_written_losses():
    w = TR.Watch(patience=3, cut_patience=2, factor=0.5, step=1.0, min_step=0.3, cut_delta=0.0)
    seen = [w.see(i, x) for i, x in enumerate([None, float("nan"), 3.0, 2.0, 2.0, 2.5, 1.0, 1.5, float("nan"), 1.0])]
    assert seen == [False, False, True, True, False, False, True, False, False, False]
    assert w.stopped and (w.best, w.best_epoch, w.step) == (1.0, 6, 0.3)
    never = TR.Watch(patience=2)
    assert [never.see(i, None) for i in range(2)] == [False, False] and never.stopped and never.best_epoch is None


def test_source_callbacks_never_cut_under_the_first_step():
    w = TR.Watch()  # the fixed values: the least step is the first one
    w.see(0, 1.0)
    for i in range(1, 40):
        w.see(i, 2.0)
    assert not w.stopped and w.step == TR.STEP
    w.see(40, 2.0)
    assert w.stopped and w.best_epoch == 0
