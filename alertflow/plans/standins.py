"""Alert-shaped data derived by Spark from the driver's tables.

The real inputs (alert containers, cutouts, a label catalogue) are not
available offline, so the registered queries run the operators on data that
Spark derives, row for row, from the given tables; every query's work grows
with those tables. The same derivations are written as SQL in
``alertflow.oracle`` for the independent check.

* ``events``      -> alert stream: ``event_id`` = alert id, ``user_id`` = object,
  ``value`` -> numeric candidate fields, ``props`` -> JSON payload,
  ``event_type`` -> raw flag / class.
* ``embeddings``  -> cutouts: 64 floats = one 8x8 image; with its negative and
  its double, the three channels of a 3x8x8 channel-first cube. Class scores
  are sums over all 64 values, by position modulo the number of classes.
* ``documents`` + ``labels`` -> dataset + label catalogue (partial coverage).
* ``lineitem``    -> numeric feature columns for the scaler.

Defects are injected by fixed rules on the id (e.g. null when ``id % 7 = 0``);
no row is ever dropped by these rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow import schemas as S

# Fixed values of the derivations (shared with the SQL side).
ISDIFFPOS_BY_TYPE = {"click": "t", "view": "1", "purchase": "f", "signup": "f"}  # error -> null
RAW_CLASSES = list(S.LABEL_MAP) + ["Unknown"]  # index doc_id % 17; 16 -> null class
IMG_H = IMG_W = 8
CUBE_C, CUBE_H, CUBE_W = 3, 8, 8
CUBE_VALUES = CUBE_C * CUBE_H * CUBE_W  # 192
CHANNEL_FACTORS = (1.0, -1.0, 2.0)  # science, reference, difference of the stand-in cube
N_SCORES = 5
N_LABELS = 10
N_CLASSES = N_LABELS + 1  # the metric keys' class list: the last class has no true rows
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def props_k(props: str = "props") -> Column:
    return F.from_json(F.col(props), "k INT").getField("k")


def alerts_from_events(events: DataFrame, extra: list[Column] | None = None,
                       stamps: list[Column] | None = None) -> DataFrame:
    """Nested alert records (objectId, candid, candidate{...}, sky frames);
    ``stamps`` = the three cutout binaries (default null); ``extra`` columns
    are carried along in the same projection."""
    v = F.col("value")
    eid = F.col("event_id")
    cand = []
    for i, name in enumerate(S.CANDIDATE_DOUBLE_FIELDS):
        e = v + F.lit(float(i))
        if name == "magpsf":
            e = null_when(eid % 7 == 0, e)
        cand.append(e.cast("double").alias(name))
    flag = F.lit(None).cast("string")
    for t, f in ISDIFFPOS_BY_TYPE.items():
        flag = F.when(F.col("event_type") == t, F.lit(f)).otherwise(flag)
    cand.append(flag.alias("isdiffpos"))
    cand.append(null_when(eid % 5 == 0, props_k()).cast("int").alias("ndethist"))
    cand.append(null_when(eid % 6 == 0, F.col("user_id")).cast("int").alias("ncovhist"))
    top = []
    for j, name in enumerate(S.TOP_LEVEL_DOUBLE_FIELDS):
        e = v + F.lit(float(len(S.CANDIDATE_DOUBLE_FIELDS) + j))
        if name == "gal_lat":
            e = null_when(eid % 9 == 0, e)
        top.append(e.cast("double").alias(name))
    stamps = stamps or [F.lit(None).cast("binary")] * len(S.CUTOUT_CHANNELS)
    return events.select(
        null_when(eid % 13 == 0, F.concat(F.lit("obj_"), F.col("user_id").cast("string"))).alias("objectId"),
        eid.alias("candid"),
        F.struct(*cand).alias("candidate"),
        *top,
        *[F.struct(b.alias("stampData")).alias(c) for b, c in zip(stamps, S.CUTOUT_CHANNELS)],
        F.col("ts"),
        *(extra or []),
    )


def object_key(col: str = "user_id") -> Column:
    return F.concat(F.lit("obj_"), F.col(col).cast("string"))


def catalog_from_labels(labels: DataFrame) -> DataFrame:
    """Label catalogue rows (oid, predicted_class): raw class by ``doc_id % 17``
    (15 known classes, one unknown class, one null class)."""
    classes = F.array(*[F.lit(c) for c in RAW_CLASSES])
    return labels.select(F.col("doc_id").cast("string").alias("oid"),
                         F.get(classes, (F.col("doc_id") % 17).cast("int")).alias("predicted_class"))


def channel(i: int, col: str = "embedding") -> Column:
    """i-th whole 8x8 channel of the cube."""
    return F.transform(F.col(col), lambda x: x * F.lit(CHANNEL_FACTORS[i]).cast("float"))


def cube(col: str = "embedding") -> Column:
    return F.concat(*[channel(i, col) for i in range(CUBE_C)])


def class_sums(col: str = "embedding", n: int = N_LABELS, shift: float = 0.0) -> Column:
    """Score k = left-to-right sum of (value + shift) at positions k modulo n."""
    def one(k: int) -> Column:
        part = F.filter(F.col(col), lambda x, i: i % n == k)
        return F.aggregate(part, F.lit(0.0), lambda s, x: s + (x.cast("double") + F.lit(shift)))
    return F.array(*[one(k) for k in range(n)])


def scores(col: str = "embedding", n: int = N_SCORES) -> Column:
    """Non-negative scores over all values (shifted by +1, as |x| <= 1)."""
    return class_sums(col, n, 1.0)
