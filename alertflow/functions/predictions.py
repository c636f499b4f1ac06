"""Scoring outputs: status routing, probability columns, the fixed output row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow import schemas as S
from alertflow.functions.images import argmax_label, confidence, prob_columns


def route_status(df: DataFrame, probs: str, image_ok: Column, metadata_ok: Column,
                 labels: list[str] = S.CLASS_LABELS, failed: Column | None = None) -> DataFrame:
    """Class, confidence and ``prob_<class>`` per row; the row is always kept.

    * both inputs present and scored -> argmax class, its probability;
    * an input missing               -> ``INCOMPLETE_DATA``, zeros;
    * scoring failed (``failed``, or a null or NaN score) -> ``ERROR``, zeros.
    """
    ok = image_ok & metadata_ok
    unusable = F.coalesce(F.exists(probs, lambda x: x.isNull() | F.isnan(x)), F.lit(True))
    bad = unusable if failed is None else F.coalesce(failed, F.lit(False)) | unusable
    status = (F.when(~ok, F.lit(S.INCOMPLETE_STATUS)).when(bad, F.lit(S.ERROR_STATUS))
              .otherwise(argmax_label(probs, labels)))
    scored = ok & ~bad
    cols = [F.when(scored, p.cast("double")).otherwise(F.lit(0.0)).alias(f"prob_{lab}")
            for p, lab in zip(prob_columns(probs, labels), labels)]
    produced = {"clase_predicha", "confianza", "image_processed", "metadata_processed",
                *[f"prob_{lab}" for lab in labels]}
    keep = [F.col(c) for c in df.columns if c not in produced]
    return df.select(*keep, status.alias("clase_predicha"),
                     F.when(scored, confidence(probs).cast("double")).otherwise(F.lit(0.0)).alias("confianza"),
                     *cols, image_ok.alias("image_processed"), metadata_ok.alias("metadata_processed"))


def prediction_row(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Shape rows to the 34-column output header; absent columns are null
    (written as blanks)."""
    present = set(df.columns)
    out = []
    for f in S.PREDICTION_SCHEMA.fields:
        if f.name == "timestamp" and "timestamp" not in present:
            e = stamp if stamp is not None else F.date_format(F.current_timestamp(), S.TIMESTAMP_FORMAT)
        elif f.name in present:
            e = F.col(f.name)
        else:
            e = F.lit(None)
        out.append(e.cast(f.dataType).alias(f.name))
    return df.select(*out)
