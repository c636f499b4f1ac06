"""Training watched by a validation split: stop, restore the best weights, cut the step.

:class:`Watch` takes one validation loss after another and says what to do: the
loss improves when it falls by more than ``min_delta`` under the best one; after
``patience`` rounds without improvement training stops and the best round's
weights are restored; after ``cut_patience`` such rounds the step is multiplied by
``factor``, not below ``min_step``. A loss that is NaN or null never improves.

:func:`train_watched` runs that loop over MLlib: every round warm-starts the
estimator with the last weights, so a round is a handful of distributed passes,
and the validation loss is one more aggregate. With ``state`` every round's
history and weights are written to a folder, and a new driver goes on from there.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.operators import model as ML

# The source's callbacks (stop after 40, cut to a fifth after 25) and its first and least step.
PATIENCE, CUT_PATIENCE, FACTOR, STEP, MIN_STEP, CUT_DELTA = 40, 25, 0.2, 0.001, 0.001, 1e-4

DECISION_SCHEMA = ("epoch long, loss double, improved boolean, best_epoch long, best_loss double, wait long, "
                   "step double, stopped boolean")


@dataclass
class Watch:
    """State of a watched training; :meth:`see` takes the next round's loss."""

    patience: int = PATIENCE
    cut_patience: int = CUT_PATIENCE
    factor: float = FACTOR
    step: float = STEP
    min_step: float = MIN_STEP
    min_delta: float = 0.0
    cut_delta: float = CUT_DELTA
    best: float | None = None
    best_epoch: int | None = None
    wait: int = 0
    cut_best: float | None = None
    cut_wait: int = 0
    stopped: bool = False

    def see(self, epoch: int, loss: float | None) -> bool:
        """Take the loss of ``epoch``; True if it is the best so far."""
        known = loss is not None and not math.isnan(loss)
        improved = known and (self.best is None or loss < self.best - self.min_delta)
        if improved:
            self.best, self.best_epoch, self.wait = loss, epoch, 0
        else:
            self.wait += 1
            self.stopped = self.stopped or self.wait >= self.patience
        if known and (self.cut_best is None or loss < self.cut_best - self.cut_delta):
            self.cut_best, self.cut_wait = loss, 0
        else:
            self.cut_wait += 1
            if self.cut_wait >= self.cut_patience:
                self.step, self.cut_wait = max(self.step * self.factor, self.min_step), 0
        return improved


def watch_losses(losses: DataFrame, run_col: str, epoch_col: str, loss_col: str, **settings) -> DataFrame:
    """What a watch decides after each epoch of each run; epochs after the stop have no row.

    A run is one training (its epochs are few); the runs are spread over the cluster.
    """
    kind = losses.schema[run_col].dataType.simpleString()

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        watch, rows = Watch(**settings), []
        for epoch, loss in pdf.sort_values("epoch")[["epoch", "loss"]].itertuples(index=False):
            improved = watch.see(int(epoch), None if pd.isna(loss) else float(loss))
            rows.append((pdf["run"].iloc[0], epoch, loss, improved, watch.best_epoch, watch.best, watch.wait, watch.step, watch.stopped))
            if watch.stopped:
                break
        out = pd.DataFrame(rows, columns=["run", "epoch", "loss", "improved", "best_epoch", "best_loss", "wait", "step", "stopped"])
        return out.astype({"best_epoch": "Int64"})

    named = losses.select(F.col(run_col).alias("run"), F.col(epoch_col).cast("long").alias("epoch"), F.col(loss_col).cast("double").alias("loss"))
    return named.groupBy("run").applyInPandas(decide, f"run {kind}, {DECISION_SCHEMA}").withColumnRenamed("run", run_col)


def cross_entropy(scored: DataFrame, label_idx: str = "label_idx", probs: str = "probs") -> dict:
    """Mean of -log of the true class's probability, and accuracy, over all rows; one aggregate."""
    p = F.greatest(F.get(probs, F.col(label_idx).cast("int")), F.lit(1e-15))
    hit = (F.array_position(probs, F.array_max(probs)) - 1 == F.col(label_idx)).cast("double")
    row = scored.agg(F.avg(-F.log(p)).alias("loss"), F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n")).first()
    return row.asDict()


def _state_path(state: str, epoch: int) -> str:
    return f"{state.rstrip('/')}/epoch={epoch}"


def _write_state(spark: SparkSession, state: str, epoch: int, watch: Watch, entry: dict, weights, best) -> None:
    """One folder a round, complete with its success marker; a torn one is written again."""
    row = (json.dumps(asdict(watch)), json.dumps(entry), list(map(float, weights)), list(map(float, best)))
    spark.createDataFrame([row], "watch string, entry string, weights array<double>, best array<double>") \
        .coalesce(1).write.mode("overwrite").parquet(_state_path(state, epoch))


def _read_state(spark: SparkSession, state: str):
    """(watch, history, weights, best weights) of the rounds that were written, or None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(state)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    epochs = 0
    while fs.exists(spark._jvm.org.apache.hadoop.fs.Path(_state_path(state, epochs) + "/_SUCCESS")):
        epochs += 1
    if not epochs:
        return None
    told = spark.read.parquet(*[_state_path(state, e) for e in range(epochs)]).select("watch", "entry")
    history = sorted((json.loads(r["entry"]) for r in told.collect()), key=lambda e: e["epoch"])  # one small row a round
    last = spark.read.parquet(_state_path(state, epochs - 1)).first()
    return Watch(**json.loads(last["watch"])), history, last["weights"], last["best"]


def train_watched(train: DataFrame, validation: DataFrame, label: str, classes: list[str], n_features: int,
                  watch: Watch | None = None, epochs: int = 100, passes: int = 5, hidden: tuple[int, ...] = (64, 32),
                  solver: str = "l-bfgs", seed: int = S.SEED, state: str | None = None) -> tuple:
    """``(model, history)``: the perceptron with the least validation loss, one entry a round.

    A round is ``passes`` iterations of the solver from the last round's weights.
    ``solver="gd"`` uses the watch's step; the quasi-Newton solver finds its own.
    An empty validation split is an error: there is nothing to watch.
    """
    from pyspark import StorageLevel

    spark = train.sparkSession
    watch = watch or Watch()
    layers = [n_features, *hidden, len(classes)]
    index = ML.label_to_index(label, classes).alias("label_idx")
    data = train.select("features", label, index).persist(StorageLevel.MEMORY_AND_DISK)
    held = validation.select("features", label, index).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ML.check_labels(data, label, classes)
        ML.check_labels(held, label, classes)
        if held.isEmpty():
            raise ValueError("the validation split has no rows")
        history, weights, best, model = [], None, None, None
        if state and (found := _read_state(spark, state)):
            watch, history, weights, best = found
        for epoch in range(len(history), epochs):
            if watch.stopped:
                break
            est = MultilayerPerceptronClassifier(layers=layers, maxIter=passes, seed=seed, blockSize=256, solver=solver,
                                                 stepSize=watch.step, labelCol="label_idx")
            if weights is not None:
                est.setInitialWeights(Vectors.dense(weights))
            model = est.fit(data)
            weights = model.weights.toArray()
            entry = {"epoch": epoch, "step": watch.step, **cross_entropy(ML.score(model, held))}
            if watch.see(epoch, entry["loss"]):
                best = weights
            elif best is None:
                best = weights  # no finite loss yet: the first round's weights
            history.append(entry)
            if state:
                _write_state(spark, state, epoch, watch, entry, weights, best)
        return _with_weights(data, layers, seed, best), history
    finally:
        data.unpersist()
        held.unpersist()


def _with_weights(data: DataFrame, layers: list[int], seed: int, weights):
    """A fitted model that carries ``weights``: one pass of a zero step on one row of each class."""
    few = data.dropDuplicates(["label_idx"])
    est = MultilayerPerceptronClassifier(layers=layers, maxIter=1, seed=seed, solver="gd", stepSize=1e-300, tol=1.0,
                                         labelCol="label_idx")
    return est.setInitialWeights(Vectors.dense(weights)).fit(few)
