"""Column expressions for alert metadata (projection, defaults, cleaning)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow import schemas as S


def with_default(c: Column | str, default) -> Column:
    """Null -> default (a missing key and a present null are treated alike)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(default))


def flag_to_int(c: Column | str, true_text: str = S.TRUE_FLAG_TEXT) -> Column:
    """1 only when the text is exactly the true flag; anything else, null included, 0."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.coalesce(c, F.lit("f")) == F.lit(true_text)).cast("int")


def approx_nondet(ncovhist: Column | str, ndethist: Column | str) -> Column:
    """Non-detections = ncovhist - ndethist, each defaulting to -1."""
    return (with_default(ncovhist, S.INT_DEFAULT) - with_default(ndethist, S.INT_DEFAULT)).cast("int")


def sentinel(c: Column | str, value: float = S.SENTINEL) -> Column:
    """Null or NaN -> sentinel. Integer columns keep their type."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(value))


def sentinel_fill(df: DataFrame, columns: list[str], value: float = S.SENTINEL) -> DataFrame:
    """Apply :func:`sentinel` to every listed column (ints stay ints)."""
    out = []
    for name, dtype in df.dtypes:
        if name in columns:
            whole = dtype in ("int", "bigint")  # never through a double, which rounds beyond 2^53
            e = F.coalesce(F.col(name), F.lit(int(value)).cast(dtype)) if whole else sentinel(name, value)
            out.append(e.alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def metadata_columns(alert_struct: str | None = None) -> list[Column]:
    """The 23 metadata columns of an alert row, defaults applied.

    ``alert_struct`` names a struct column holding the alert; None means the
    alert fields are top-level columns of the frame.
    """
    p = f"{alert_struct}." if alert_struct else ""
    cand = f"{p}candidate"
    exprs = {}
    for c in S.CANDIDATE_DOUBLE_FIELDS:
        exprs[c] = with_default(F.col(f"{cand}.{c}").cast("double"), S.DOUBLE_DEFAULT)
    for c in S.TOP_LEVEL_DOUBLE_FIELDS:
        exprs[c] = with_default(F.col(f"{p}{c}").cast("double"), S.DOUBLE_DEFAULT)
    exprs["isdiffpos"] = flag_to_int(F.col(f"{cand}.isdiffpos"))
    for c in S.HISTORY_FIELDS:
        exprs[c] = with_default(F.col(f"{cand}.{c}").cast("int"), S.INT_DEFAULT)
    exprs["approx_nondet"] = approx_nondet(F.col(f"{cand}.ncovhist"), F.col(f"{cand}.ndethist"))
    return [exprs[c].alias(c) for c in S.METADATA_COLUMNS]


def object_id_value(alert_struct: str | None = None) -> Column:
    p = f"{alert_struct}." if alert_struct else ""
    return with_default(F.col(f"{p}objectId"), S.UNKNOWN_OBJECT_ID)


def object_id(alert_struct: str | None = None) -> Column:
    return object_id_value(alert_struct).alias("object_id")


def project_alerts(alerts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Alert records -> one flat metadata row per alert (object_id + 23 columns)."""
    keep = keep or []
    return alerts.select(*[F.col(k) for k in keep], object_id(), *metadata_columns())


def parse_json(c: Column | str, schema, mode: str = "PERMISSIVE") -> Column:
    """JSON text -> struct. PERMISSIVE gives all-null fields for broken text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.from_json(c, schema, {"mode": mode})


def to_json_text(*cols: str | Column) -> Column:
    """Serialise columns as one JSON object; null fields are written as null."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def message_cast(df: DataFrame, key_alias: str = "object_id", value_alias: str = "json_data",
                 value_as_text: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Key/value columns of a message source -> text key and (text or binary) value."""
    v = F.col("value").cast("string") if value_as_text else F.col("value")
    return df.select(*(keep or []), F.col("key").cast("string").alias(key_alias), v.alias(value_alias))


def processing_stamp() -> Column:
    """Processing-time stamp as text."""
    return F.date_format(F.current_timestamp(), S.TIMESTAMP_FORMAT)


def success_rate(ok: Column | str, n: Column | str) -> Column:
    """Percentage with a zero guard: 100 * ok / max(n, 1)."""
    ok = F.col(ok) if isinstance(ok, str) else ok
    n = F.col(n) if isinstance(n, str) else n
    return F.lit(100.0) * ok / F.greatest(n, F.lit(1))


def select_features(df: DataFrame, order: list[str] = S.METADATA_COLUMNS, keep: list[str] | None = None) -> DataFrame:
    """Feature columns in one declared order."""
    return df.select(*(keep or []), *order)


def cast_features(df: DataFrame, columns: list[str], to: str = "float") -> DataFrame:
    return df.select(*[F.col(c).cast(to).alias(c) if c in columns else F.col(c) for c in df.columns])
