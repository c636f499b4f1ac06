"""Dataset preparation and training plans (the batch side of the pipeline).

Each function composes the operators into one lazy plan; the shuffles are
the dedup aggregate, the catalogue join and the rank of the balanced sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.functions import images as I
from alertflow.functions import metadata as M
from alertflow.operators import cutouts as C
from alertflow.operators import fused as FU
from alertflow.operators import joins as J
from alertflow.operators import metrics as X
from alertflow.operators import model as ML
from alertflow.operators import ranking as R
from alertflow.operators import training as TR
from alertflow.operators.scaler import apply_scaler, fit_scaler
from alertflow.plans import standins as SI
from alertflow.session import scratch_path
from alertflow.sinks.writers import write_by_class


def labelled_per_class(spark: SparkSession, d: str) -> DataFrame:
    """Dataset rows cross-matched with the label catalogue, counted per class."""
    docs = SI.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("object_id"))
    labels = J.catalog_labels(SI.catalog_from_labels(SI.table(spark, d, "labels")))
    return X.value_counts(J.crossmatch(docs, labels), "label", out="n")


def alert_records(alerts: DataFrame, shape: tuple[int, int] = (S.CUTOUT_SIZE, S.CUTOUT_SIZE),
                  crop: int | None = S.CROP_SIZE, crop_start: int | None = S.CROP_START,
                  order: str = "candid", catalog: DataFrame | None = None) -> DataFrame:
    """Alerts -> one record per decodable alert: object_id, channel-first cube
    ``data`` and the 23 metadata columns (alerts with a bad cutout dropped).

    With the ``catalog``, alerts of objects it does not hold are dropped before
    any cutout is decoded. ``folder_rank`` is carried when present.
    """
    if catalog is not None:
        # ids may come twice here; without an aggregate Spark can split the alerts of one frequent id (skew join)
        known = catalog.select(F.col("oid").alias("_oid"))
        alerts = alerts.join(known, M.object_id_value() == F.col("_oid"), "left_semi")
    folder = [c for c in ("folder_rank",) if c in alerts.columns]
    keep = ["objectId", order, *folder, "candidate", *S.TOP_LEVEL_DOUBLE_FIELDS]
    decoded = C.valid_alerts(C.ingest_cutouts(alerts, keep, shape=shape, crop=crop, crop_start=crop_start))
    return decoded.select(M.object_id(), F.col(order).alias("alert_order"), *folder,
                          I.stack_channels(*[F.col(c) for c in S.CUTOUT_CHANNELS]).alias("data"),
                          *M.metadata_columns())


def one_record_per_object(records: DataFrame, keep: str = "first") -> DataFrame:
    """The last alert of each object in each folder (a later file overwrites), then
    the object's record of the first folder (``keep="last"``: of the last one).

    Only object, folder and alert order are aggregated; the chosen keys join the
    records back, so no cube is sorted or carried through an aggregate. Alert
    order is unique per object and folder.
    """
    pick = {"first": F.min, "last": F.max}[keep]
    folder = ["folder_rank"] if "folder_rank" in records.columns else []
    chosen = records.groupBy("object_id", *folder).agg(F.max("alert_order").alias("alert_order"))
    if folder:
        first = chosen.groupBy("object_id").agg(pick("folder_rank").alias("folder_rank"))
        chosen = chosen.join(first, ["object_id", "folder_rank"], "left_semi")
    return records.join(chosen, ["object_id", *folder, "alert_order"], "left_semi")


DEFAULT_BALANCE = dict.fromkeys(S.BALANCED_CLASSES, S.BALANCE_SIZE)


def build_dataset(records: DataFrame, catalog: DataFrame, balance: dict[str, int] | None = None,
                  keep: str = "first", seed: int = S.SEED) -> DataFrame:
    """Records -> labelled, deduplicated, balanced, normalised dataset.

    * one record per object (:func:`one_record_per_object`);
    * inner cross-match with the catalogue (raw class -> 5 classes);
    * exact-n hash sample of the classes in ``balance`` (others whole); by
      default 12,000 of Other and of VS, ``{}`` for none; a class with fewer
      rows is an error;
    * whole-cube ``(x - min) / max`` normalisation of ``data``, as float32.

    The records are written once to the shared folder, so every cutout is
    decoded once however often the choice and the sample read them.
    """
    path = scratch_path(records.sparkSession, "records")
    records.write.parquet(path)
    records = records.sparkSession.read.schema(records.schema).parquet(path)
    labelled = J.crossmatch(one_record_per_object(records, keep), J.catalog_labels(catalog))
    balance = DEFAULT_BALANCE if balance is None else balance
    if balance:
        labelled = _balanced(labelled, balance, seed)
    return I.minmax_cube(labelled, "data", "data")


def _balanced(labelled: DataFrame, balance: dict[str, int], seed: int) -> DataFrame:
    """One ranking of the (object, class) pairs for all balanced classes; the rows follow by a semi-join."""
    pairs = labelled.select("object_id", "label").checkpoint(eager=True)
    sizes = {r["label"]: r["count"] for r in pairs.where(F.col("label").isin(list(balance))).groupBy("label").count().collect()}
    for label, n in balance.items():
        if sizes.get(label, 0) < n:
            raise ValueError(f"class {label!r} has {sizes.get(label, 0)} rows, fewer than n={n}")
    ranked = R.exact_rank(pairs.where(F.col("label").isin(list(balance))), "object_id", ["label"], seed, "_pos")
    limit = F.coalesce(*[F.when(F.col("label") == c, F.lit(n)) for c, n in balance.items()])
    out = ranked.where(F.col("_pos") >= limit).select(F.col("object_id").alias("_out_id"))
    return labelled.join(out, F.col("object_id") == F.col("_out_id"), "left_anti")


def save_dataset(dataset: DataFrame, root: str) -> str:
    """One partition folder per class."""
    return write_by_class(dataset, root, "label")


def train_and_evaluate(dataset: DataFrame, image_shape: tuple[int, int, int], classes: list[str] = S.CLASS_LABELS,
                       meta_cols: list[str] = S.METADATA_COLUMNS, kind: str = "mlp", rotations: bool = True,
                       seed: int = S.SEED, watch: TR.Watch | None = None, **train_kw) -> dict:
    """Split per class (64/16/20), scale metadata with train statistics,
    transpose the cube to channel-last, train, score validation and test.

    With a ``watch`` the perceptron is trained in rounds against the validation
    split (``operators.training``) and the best round is kept; its ``history`` is
    returned too. ``kind="fused"`` trains the image network fused with metadata
    (``operators.fused``), which turns its images itself: ``model`` is then
    ``(shape, parameters)``, and ``layers`` sets sizes of the shape. Returns the model, the statistics and the evaluation frames (lazy).
    """
    c, h, w = image_shape
    # the rank reads (id, label) alone and the parts read the rows: written once
    dataset = dataset.checkpoint(eager=True)
    split = R.stratified_split(dataset, "object_id", "label", seed=seed)
    split = split.withColumn("data", I.chw_to_hwc("data", c, h, w)).checkpoint(eager=True)
    stats = fit_scaler(split.where(F.col("split") == "train"), meta_cols).checkpoint(eager=True)
    scaled = apply_scaler(split, stats, meta_cols)
    train = scaled.where(F.col("split") == "train")
    if kind == "fused":
        return {"stats": stats} | _fused(scaled, (h, c), classes, meta_cols, watch, seed, **train_kw)
    if rotations:
        train = ML.augment_rotations(train, "data", h, w, c)
    train = ML.assemble(train, "data", meta_cols)
    n_features = c * h * w + len(meta_cols)
    out = {"stats": stats}
    if watch is None:
        model = ML.train(train, "label", classes, kind=kind, n_features=n_features, seed=seed, **train_kw)
    elif kind == "mlp":
        held = ML.assemble(scaled.where(F.col("split") == "validation"), "data", meta_cols)
        model, out["history"] = TR.train_watched(train, held, "label", classes, n_features, watch, seed=seed, **train_kw)
    else:
        raise ValueError(f"kind {kind!r} has no warm start to watch")
    out["model"] = model
    for part in ("validation", "test"):
        out |= _evaluated(part, ML.score(model, ML.assemble(scaled.where(F.col("split") == part), "data", meta_cols)), classes)
    return out


def _evaluated(part: str, scored: DataFrame, classes: list[str]) -> dict:
    """Predictions of a split, their report and their confusion matrix."""
    pred = scored.select("object_id", "label", I.argmax_label("probs", classes).alias("predicted"))
    return {part: pred, f"{part}_report": X.classification_report(pred, "label", "predicted", classes),
            f"{part}_confusion": X.confusion_matrix(pred, "label", "predicted", classes)}


def _fused(scaled: DataFrame, image: tuple[int, int], classes: list[str], meta_cols: list[str], watch: TR.Watch | None, seed: int,
           layers: dict | None = None, **train_kw) -> dict:
    """The image network fused with metadata: trained on the train split, watched and evaluated on the others."""
    side, channels = image
    shape = FU.Shape(side=side, channels=channels, meta=len(meta_cols), classes=len(classes), **(layers or {}))
    rows = scaled.select("object_id", "label", "split", F.col("data").alias("image"), F.array(*[F.col(c).cast("double") for c in meta_cols]).alias("meta"),
                         ML.label_to_index("label", classes).cast("int").alias("label_idx"))
    ML.check_labels(rows, "label", classes)
    flat, history = FU.train_fused(rows.where("split = 'train'"), rows.where("split = 'validation'"), shape, watch=watch, seed=seed, **train_kw)
    out = {"model": (shape, flat), "history": history}
    told = rows.withColumn("features_arr", F.concat(F.transform("image", lambda x: x.cast("double")), "meta"))
    for part in ("validation", "test"):
        out |= _evaluated(part, ML.score_with_function(told.where(F.col("split") == part), FU.predictor(shape, flat), len(classes)), classes)
    return out
