"""Feature assembly, training and scoring with Spark MLlib.

The source trains a Keras network on one machine; here the classifier is an
MLlib estimator (multilayer perceptron by default; logistic regression or a
random forest on request) fitted on executors. The class list is fixed and
stored with the model, so probability position i is always ``classes[i]``.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import (LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.functions import images as I


def label_to_index(label: Column | str, classes: list[str] = S.CLASS_LABELS) -> Column:
    """Fixed class list -> index (unknown label -> null, caught by ``check_labels``)."""
    c = F.col(label) if isinstance(label, str) else label
    return (F.array_position(F.array(*[F.lit(x) for x in classes]), c) - 1).cast("double")


def check_labels(df: DataFrame, label: str, classes: list[str]) -> None:
    """Unseen label is an error (label-encoder behaviour)."""
    bad = df.where(~F.col(label).isin(classes) | F.col(label).isNull()).select(label).limit(1).collect()
    if bad:
        raise ValueError(f"label {bad[0][0]!r} not in {classes}")


def assemble(df: DataFrame, image_col: str | None, meta_cols: list[str], out: str = "features") -> DataFrame:
    """One vector per row: image values then metadata values."""
    parts = []
    if image_col:
        parts.append(F.transform(image_col, lambda x: x.cast("double")))
    if meta_cols:
        parts.append(F.array(*[F.col(c).cast("double") for c in meta_cols]))
    arr = parts[0] if len(parts) == 1 else F.concat(*parts)
    return df.withColumn(out, array_to_vector(arr))


def augment_rotations(df: DataFrame, image_col: str, h: int, w: int, channels: int = 1) -> DataFrame:
    """Four rotated views of each training image as extra rows (k = 0..3)."""
    return (df.select("*", F.inline(I.rotations(image_col, h, w, channels)))
              .drop(image_col).withColumnRenamed("image", image_col))


def make_estimator(kind: str, n_features: int, n_classes: int, seed: int = S.SEED, max_iter: int = 50,
                   hidden: tuple[int, ...] = (64, 32)):
    if kind == "mlp":
        return MultilayerPerceptronClassifier(layers=[n_features, *hidden, n_classes], maxIter=max_iter,
                                              seed=seed, blockSize=256, labelCol="label_idx")
    if kind == "lr":
        return LogisticRegression(maxIter=max_iter, labelCol="label_idx", family="multinomial")
    if kind == "rf":
        return RandomForestClassifier(numTrees=50, seed=seed, labelCol="label_idx")
    raise ValueError(kind)


def train(df: DataFrame, label: str, classes: list[str], kind: str = "mlp", n_features: int | None = None,
          **kw):
    """Fit on rows with ``features`` and a string ``label`` from ``classes``.

    The two training columns are persisted (memory, spilling to disk) for the
    optimiser's passes, so the feature pipeline upstream -- image decoding,
    scaling -- runs once instead of once per pass.
    """
    from pyspark import StorageLevel
    data = (df.select("features", label, label_to_index(label, classes).alias("label_idx"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        check_labels(data, label, classes)
        if n_features is None:
            n_features = len(data.select("features").first()[0])
        est = make_estimator(kind, n_features, len(classes), **kw)
        return est.fit(data)
    finally:
        data.unpersist()


def score(model, df: DataFrame, out: str = "probs") -> DataFrame:
    """Probabilities as ``array<double>`` in class order, plus the index."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")).drop("rawPrediction", "probability")


def save(model, path: str, classes: list[str]) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(classes),)], "classes string").write.mode("overwrite").json(f"{path}/classes")


def load(path: str, kind: str = "mlp"):
    from pyspark.ml.classification import (LogisticRegressionModel, MultilayerPerceptronClassificationModel,
                                           RandomForestClassificationModel)
    cls = {"mlp": MultilayerPerceptronClassificationModel, "lr": LogisticRegressionModel,
           "rf": RandomForestClassificationModel}[kind]
    model = cls.load(f"{path}/model")
    spark = SparkSession.getActiveSession()
    classes = json.loads(spark.read.json(f"{path}/classes").first()[0])
    return model, classes


def score_with_function(df: DataFrame, predict, n_classes: int, features: str = "features_arr",
                        out: str = "probs") -> DataFrame:
    """Score with any batch predictor ``predict(X: ndarray[n, f]) -> ndarray[n, k]``
    (an exported network, an ONNX session, ...) through ``mapInPandas``: one
    Arrow batch at a time, rows never leave their partition.

    ``features`` is an ``array<double>`` column; the output adds ``out``
    (``array<double>`` of length ``n_classes``). A batch the predictor fails on
    is scored row by row; a row it fails on gets a null (routed to ``ERROR``).
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql import types as T

    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.DoubleType()), True)])

    def scores_of(x):
        try:
            return np.asarray(predict(x), dtype=np.float64).reshape(len(x), n_classes)
        except Exception:  # noqa: BLE001 - any error of a user's predictor is a failed score
            return None

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                yield pdf.assign(**{out: pd.Series([], dtype=object)})
                continue
            x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[features]])
            p = scores_of(x)
            if p is None:
                p = [None if (one := scores_of(row[None, :])) is None else one[0] for row in x]
            yield pdf.assign(**{out: pd.Series(list(p), index=pdf.index, dtype=object)})

    return df.mapInPandas(run, schema)
