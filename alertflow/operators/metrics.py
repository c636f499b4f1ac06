"""Counting and evaluation aggregates (all single-pass, map-side combined)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertflow.functions.metadata import success_rate


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.desc(out), F.col(col)))


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def distinct_objects(df: DataFrame, col: str = "object_id") -> DataFrame:
    return df.agg(F.count_distinct(col).alias("n_objects"))


def label_index(df: DataFrame, col: str, out: str = "label_index") -> DataFrame:
    """Sorted distinct labels with a 0-based index (label encoder).

    The window runs over the *distinct labels* only (a handful of rows).
    """
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return d.withColumn(out, (F.row_number().over(Window.orderBy(col)) - 1).cast("int"))


def pair_counts(df: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """(true, pred, n): the only pass over the predictions; classes^2 rows out."""
    return df.groupBy(true_col, pred_col).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, true_col: str, pred_col: str, classes: list,
                     prefix: str = "pred_") -> DataFrame:
    """Rows = every class of the list and any other true value; one column per predicted class.

    A class without true rows has a row of zeros; predictions outside the list
    (or null) are counted in ``<prefix>other``, so no row is lost.
    """
    pairs = pair_counts(df, true_col, pred_col)
    known = F.col(pred_col).isin(list(classes))
    cols = [F.coalesce(F.sum(F.when(F.col(pred_col) == F.lit(c), F.col("n"))), F.lit(0)).cast("long")
            .alias(f"{prefix}{c}") for c in classes]
    other = F.coalesce(F.sum(F.when(~F.coalesce(known, F.lit(False)), F.col("n"))), F.lit(0)).cast("long")
    # the class list joins the pair counts as zero-count rows (at most classes^2 + classes rows)
    kind = df.schema[true_col].dataType
    zero = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias(true_col))
    zero = zero.select(true_col, F.lit(classes[0]).cast(df.schema[pred_col].dataType).alias(pred_col), F.lit(0).cast("long").alias("n"))
    return pairs.unionByName(zero).groupBy(true_col).agg(*cols, other.alias(f"{prefix}other"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def classification_report(df: DataFrame, true_col: str, pred_col: str, classes: list) -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted
    averages; 0 where undefined. Output columns: label, precision, recall, f1, support.

    One pass over the predictions: a single aggregate row holds the per-class
    counts; every metric is derived from that row with array functions.
    """
    pairs = pair_counts(df, true_col, pred_col)
    per = []
    for c in classes:
        lit = F.lit(c)
        per.append(F.struct(
            F.lit(str(c)).alias("label"),
            F.coalesce(F.sum(F.when((F.col(true_col) == lit) & (F.col(pred_col) == lit), F.col("n"))), F.lit(0)).alias("tp"),
            F.coalesce(F.sum(F.when(F.col(true_col) == lit, F.col("n"))), F.lit(0)).alias("support"),
            F.coalesce(F.sum(F.when(F.col(pred_col) == lit, F.col("n"))), F.lit(0)).alias("predicted")))
    one = pairs.agg(F.array(*per).alias("per"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                    F.coalesce(F.sum(F.when(F.col(true_col) == F.col(pred_col), F.col("n"))), F.lit(0)).alias("correct"))

    def metrics(s):
        p = _safe_div(s["tp"], s["predicted"])
        r = _safe_div(s["tp"], s["support"])
        return F.struct(s["label"].alias("label"), p.alias("precision"), r.alias("recall"),
                        _safe_div(2 * p * r, p + r).alias("f1"), s["support"].cast("long").alias("support"))

    rows = one.select(F.transform("per", metrics).alias("m"), "total", "correct")
    k = len(classes)

    def total(field, weighted):
        if weighted:
            return F.aggregate("m", F.lit(0.0), lambda a, s: a + s[field] * s["support"])
        return F.aggregate("m", F.lit(0.0), lambda a, s: a + s[field])

    acc = _safe_div(F.col("correct"), F.col("total"))
    n = F.aggregate("m", F.lit(0).cast("long"), lambda a, s: a + s["support"])
    summary = F.array(
        F.struct(F.lit("accuracy").alias("label"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 F.col("total").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), (total("precision", False) / k).alias("precision"),
                 (total("recall", False) / k).alias("recall"), (total("f1", False) / k).alias("f1"),
                 n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), _safe_div(total("precision", True), n).alias("precision"),
                 _safe_div(total("recall", True), n).alias("recall"), _safe_div(total("f1", True), n).alias("f1"),
                 n.alias("support")))
    return rows.select(F.inline(F.concat("m", summary)))


def top_confusions(df: DataFrame, true_col: str, pred_col: str, k: int = 5) -> DataFrame:
    """The k most frequent off-diagonal (true, pred) pairs; ties by class."""
    return (pair_counts(df, true_col, pred_col).where(F.col(true_col) != F.col(pred_col))
            .orderBy(F.desc("n"), F.col(true_col), F.col(pred_col)).limit(k))


def batch_summary(df: DataFrame, batch: Column, object_col: str, scored: Column) -> DataFrame:
    """Per batch: rows, distinct objects, distinct scored objects and their rate in percent."""
    g = df.groupBy(batch).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(object_col).alias("new_objects"),
                              F.count_distinct(F.when(scored, F.col(object_col))).alias("scored"))
    return g.withColumn("success_rate", success_rate("scored", "new_objects"))
