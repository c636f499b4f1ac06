"""Independent SQL (DuckDB dialect) for each registered key.

The tables are the driver's views. Derivations of ``alertflow.plans.standins``
are re-stated here in SQL from the same fixed values.
"""

from __future__ import annotations

from alertflow import schemas as S
from alertflow.plans import standins as SI

_SQL: dict[str, str] = {}
_LATER: dict = {}  # texts made from settings of modules that import this one's tables


def sql(name: str, text: str) -> None:
    _SQL[name] = text.strip()


def all_sql() -> dict[str, str]:
    return dict(_SQL) | {name: make().strip() for name, make in _LATER.items()}


# ---------------------------------------------------------------- alert stand-in

def _alerts_cte() -> str:
    cand = []
    for i, name in enumerate(S.CANDIDATE_DOUBLE_FIELDS):
        e = f"CAST(value + {float(i)} AS DOUBLE)"
        if name == "magpsf":
            e = f"CASE WHEN event_id % 7 = 0 THEN NULL ELSE {e} END"
        cand.append(f"{e} AS {name}")
    flag = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{f}'" for t, f in SI.ISDIFFPOS_BY_TYPE.items()) + " ELSE NULL END"
    cand.append(f"{flag} AS isdiffpos_raw")
    cand.append("CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(props->>'k' AS INTEGER) END AS ndethist_raw")
    cand.append("CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(user_id AS INTEGER) END AS ncovhist_raw")
    for j, name in enumerate(S.TOP_LEVEL_DOUBLE_FIELDS):
        e = f"CAST(value + {float(len(S.CANDIDATE_DOUBLE_FIELDS) + j)} AS DOUBLE)"
        if name == "gal_lat":
            e = f"CASE WHEN event_id % 9 = 0 THEN NULL ELSE {e} END"
        cand.append(f"{e} AS {name}")
    obj = "CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'obj_' || CAST(user_id AS VARCHAR) END AS objectId"
    return f"alerts AS (SELECT event_id AS alert_id, {obj}, ts, " + ", ".join(cand) + " FROM events)"


def _metadata_select() -> str:
    cols = []
    for c in S.METADATA_COLUMNS:
        if c == "isdiffpos":
            cols.append("CAST(COALESCE(isdiffpos_raw, 'f') = 't' AS INTEGER) AS isdiffpos")
        elif c in S.HISTORY_FIELDS:
            cols.append(f"COALESCE({c}_raw, -1) AS {c}")
        elif c == "approx_nondet":
            cols.append("CAST(COALESCE(ncovhist_raw, -1) - COALESCE(ndethist_raw, -1) AS INTEGER) AS approx_nondet")
        else:
            cols.append(f"COALESCE({c}, -999.0) AS {c}")
    return "alert_id, COALESCE(objectId, 'Unknown') AS object_id, " + ", ".join(cols)


ALERTS = _alerts_cte()
META = f"WITH {ALERTS}, meta AS (SELECT {_metadata_select()} FROM alerts)"

sql("metadata_defaults", f"{META} SELECT * FROM meta")
sql("scan_alerts", f"{META} SELECT * FROM meta")
sql("flag_to_int", f"WITH {ALERTS} SELECT alert_id, isdiffpos_raw, "
    "CAST(COALESCE(isdiffpos_raw, 'f') = 't' AS INTEGER) AS isdiffpos FROM alerts")
sql("approx_nondet", f"WITH {ALERTS} SELECT alert_id, ndethist_raw AS ndethist, ncovhist_raw AS ncovhist, "
    "CAST(COALESCE(ncovhist_raw, -1) - COALESCE(ndethist_raw, -1) AS INTEGER) AS approx_nondet FROM alerts")
sql("sentinel_fill", """
SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN -999.0 WHEN event_id % 11 = 0 THEN -999.0 ELSE value END AS value,
  CASE WHEN event_id % 3 = 0 THEN -999 ELSE CAST(user_id AS INTEGER) END AS n
FROM events""")
sql("json_parse", "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events")
sql("struct_expand", "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS z FROM events")
sql("message_cast", "SELECT event_id, 'obj_' || CAST(user_id AS VARCHAR) AS object_id, props AS json_data FROM events")
sql("metadata_messages", f"{META} SELECT 'Metadata' AS topic, object_id, {', '.join(S.METADATA_COLUMNS)} FROM meta")

_PIXELS = SI.IMG_H * SI.IMG_W


def _class_sum(k: int, n: int, shift: float) -> str:
    """Left-to-right sum of all values at positions k modulo n."""
    return "(" + " + ".join(f"(CAST(embedding[{i + 1}] AS DOUBLE) + {shift})" for i in range(k, _PIXELS, n)) + ")"


def _scored(n: int, shift: float) -> str:
    """embeddings with the columns s1..sn."""
    return "(SELECT *, " + ", ".join(f"{_class_sum(k, n, shift)} AS s{k + 1}" for k in range(n)) + " FROM embeddings)"


SCORED = _scored(SI.N_SCORES, 1.0)
_SUM5 = "(" + " + ".join(f"s{i}" for i in range(1, 6)) + ")"
_PROBS = [f"(s{i} / {_SUM5})" for i in range(1, 6)]
_ARGMAX = ("CASE " + " ".join(f"WHEN s{i} = greatest(s1, s2, s3, s4, s5) THEN '{lab}'"
                              for i, lab in enumerate(S.CLASS_LABELS, start=1)) + " END")
_MAXP = f"greatest({', '.join(_PROBS)})"


def _prediction_row_sql() -> str:
    cols = []
    for f in S.PREDICTION_SCHEMA.fields:
        n = f.name
        if n == "timestamp":
            cols.append("CAST(NULL AS VARCHAR) AS timestamp")
        elif n == "object_id":
            cols.append("'vec_' || CAST(vec_id AS VARCHAR) AS object_id")
        elif n == "clase_predicha":
            cols.append(f"{_ARGMAX} AS clase_predicha")
        elif n == "confianza":
            cols.append(f"round({_MAXP}, 6) AS confianza")
        elif n.startswith("prob_"):
            i = S.CLASS_LABELS.index(n[5:])
            cols.append(f"round({_PROBS[i]}, 6) AS {n}")
        elif n == "ra":
            cols.append("CAST(embedding[6] AS DOUBLE) AS ra")
        elif n == "dec":
            cols.append("CAST(embedding[7] AS DOUBLE) AS dec")
        elif n in ("image_processed", "metadata_processed"):
            cols.append(f"TRUE AS {n}")
        else:
            t = "INTEGER" if n in S.INT_METADATA_COLUMNS else "DOUBLE"
            cols.append(f"CAST(NULL AS {t}) AS {n}")
    return "SELECT " + ", ".join(cols) + f" FROM {SCORED}"


sql("prediction_row", _prediction_row_sql())
sql("prob_columns", "SELECT vec_id, " + ", ".join(
    f"round({p}, 6) AS prob_{lab}" for p, lab in zip(_PROBS, S.CLASS_LABELS)) + f" FROM {SCORED}")
sql("batch_summary", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows, count(DISTINCT user_id) AS new_objects,
  count(DISTINCT CASE WHEN value >= 10 THEN user_id END) AS scored,
  round(100.0 * count(DISTINCT CASE WHEN value >= 10 THEN user_id END)
        / greatest(count(DISTINCT user_id), 1), 6) AS success_rate
FROM events GROUP BY 1""")
sql("feature_select", "SELECT l_orderkey, " + ", ".join(SI.LINEITEM_FEATURES) + " FROM lineitem")
sql("feature_cast", "SELECT l_returnflag, " + ", ".join(
    f"round(sum(CAST(CAST({c} AS FLOAT) AS DOUBLE)), 2) AS sum_{c}" for c in SI.LINEITEM_FEATURES)
    + " FROM lineitem GROUP BY l_returnflag")

# ---------------------------------------------------------------- labels / catalogue

_RAW = "CASE doc_id % 17 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(SI.RAW_CLASSES)) + " ELSE NULL END"
_MAP = "COALESCE(CASE predicted_class " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in S.LABEL_MAP.items()) + f" END, '{S.FALLBACK_CLASS}')"
CATALOG = f"catalog AS (SELECT CAST(doc_id AS VARCHAR) AS oid, {_RAW} AS predicted_class FROM labels)"

sql("label_catalog", f"WITH {CATALOG} SELECT * FROM catalog")
sql("label_map", f"WITH {CATALOG} SELECT {_MAP} AS label, count(*) AS n FROM catalog GROUP BY 1")
sql("crossmatch", f"""WITH {CATALOG}
SELECT CAST(d.doc_id AS VARCHAR) AS object_id, d.lang, d.n_chars, c.label
FROM documents d JOIN (SELECT oid, {_MAP} AS label FROM catalog) c ON CAST(d.doc_id AS VARCHAR) = c.oid""")
sql("value_counts", """
SELECT event_type, count(*) AS n FROM
  (SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END AS event_type FROM events)
WHERE event_type IS NOT NULL GROUP BY 1""")
sql("label_index", "SELECT event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS label_index "
    "FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)")
sql("one_hot", "SELECT event_id, " + ", ".join(
    f"CAST(idx = {i} AS INTEGER) AS oh_{i}" for i in range(5))
    + " FROM (SELECT event_id, dense_rank() OVER (ORDER BY event_type) - 1 AS idx FROM events)")

# ---------------------------------------------------------------- filters

sql("class_filter", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
sql("anti_seen", "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
sql("all_channels_valid", "SELECT vec_id, label FROM embeddings WHERE vec_id % 5 <> 0 AND vec_id % 7 <> 0 AND vec_id % 11 <> 0")
sql("reject_report", f"""
SELECT '{S.CUTOUT_CHANNELS[0]}' AS channel, count(*) AS n_invalid FROM embeddings WHERE vec_id % 5 = 0
UNION ALL SELECT '{S.CUTOUT_CHANNELS[1]}', count(*) FROM embeddings WHERE vec_id % 7 = 0
UNION ALL SELECT '{S.CUTOUT_CHANNELS[2]}', count(*) FROM embeddings WHERE vec_id % 11 = 0""")
sql("shape_check", """
SELECT vec_id, CAST(CASE WHEN vec_id % 13 = 0 THEN 63 ELSE len(embedding) END AS INTEGER) AS n_values,
  (CASE WHEN vec_id % 13 = 0 THEN 63 ELSE len(embedding) END) = 64 AS valid FROM embeddings""")
_OK = "(vec_id % 17 <> 0 AND vec_id % 19 <> 0)"
_DONE = f"({_OK} AND vec_id % 23 <> 0 AND vec_id % 29 <> 0)"  # failed predictor, NaN score
sql("status_routing", f"SELECT vec_id, CASE WHEN NOT {_OK} THEN 'INCOMPLETE_DATA' WHEN NOT {_DONE} THEN 'ERROR' ELSE {_ARGMAX} "
    f"END AS clase_predicha, CASE WHEN {_DONE} THEN round({_MAXP}, 6) ELSE 0.0 END AS confianza, "
    + ", ".join(f"CASE WHEN {_DONE} THEN round({p}, 6) ELSE 0.0 END AS prob_{lab}" for p, lab in zip(_PROBS, S.CLASS_LABELS))
    + f", vec_id % 17 <> 0 AS image_processed, vec_id % 19 <> 0 AS metadata_processed FROM {SCORED}")

# ---------------------------------------------------------------- scaler

_STATS = ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS mean_{c}, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 "
    f"ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS std_{c}" for c in SI.LINEITEM_FEATURES)
sql("scaler_fit", "SELECT " + ", ".join(
    f"round(mean_{c}, 4) AS mean_{c}, round(std_{c}, 4) AS std_{c}" for c in SI.LINEITEM_FEATURES)
    + f" FROM (SELECT {_STATS} FROM lineitem)")
sql("scaler_apply", f"WITH st AS (SELECT {_STATS} FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - mean_{c}) / std_{c}, 4) + 0.0 AS {c}_z" for c in SI.LINEITEM_FEATURES)
    + " FROM lineitem, st")

# ---------------------------------------------------------------- metrics

_TEN = ", ".join(f"s{i}" for i in range(1, SI.N_LABELS + 1))
_PRED = (f"preds AS (SELECT vec_id, label AS true_label, CAST(list_position([{_TEN}], greatest({_TEN})) - 1 AS INTEGER) "
         f"AS pred_label FROM {_scored(SI.N_LABELS, 0.0)})")
# one row for every class, also one without true rows
sql("confusion_matrix", f"WITH {_PRED} SELECT c.true_label, " + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN pred_label = {i} THEN 1 ELSE 0 END), 0) AS BIGINT) AS pred_{i}" for i in range(SI.N_CLASSES))
    + ", CAST(0 AS BIGINT) AS pred_other"
    + f" FROM (SELECT CAST(unnest(generate_series(0, {SI.N_CLASSES - 1})) AS INTEGER) AS true_label) c "
      "LEFT JOIN preds p ON p.true_label = c.true_label GROUP BY c.true_label")
_CLS = " UNION ALL ".join(f"SELECT {i} AS c" for i in range(SI.N_CLASSES))
sql("classification_report", f"""WITH {_PRED},
cls AS ({_CLS}),
per AS (SELECT c,
  (SELECT count(*) FROM preds WHERE true_label = c AND pred_label = c) AS tp,
  (SELECT count(*) FROM preds WHERE true_label = c) AS support,
  (SELECT count(*) FROM preds WHERE pred_label = c) AS predicted FROM cls),
pr AS (SELECT c, support,
  CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
  CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM per),
prf AS (SELECT c, support, p, r, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pr),
tot AS (SELECT count(*) AS n, sum(CASE WHEN true_label = pred_label THEN 1 ELSE 0 END) AS ok FROM preds)
SELECT CAST(c AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM prf
UNION ALL SELECT 'accuracy', round(ok / n, 6), round(ok / n, 6), round(ok / n, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM prf""")
sql("top_confusions", f"""WITH {_PRED}
SELECT true_label, pred_label, count(*) AS n FROM preds WHERE true_label <> pred_label
GROUP BY 1, 2 ORDER BY n DESC, true_label, pred_label LIMIT 5""")
sql("distinct_objects", "SELECT count(DISTINCT user_id) AS n_objects FROM events")
sql("dataset_shape", "SELECT count(*) AS n_rows, 6 AS n_cols FROM events")

# ---------------------------------------------------------------- dedup

sql("dedup_batch", """
SELECT user_id, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
sql("dedup_first", """
SELECT user_id, folder_rank, event_id FROM (
  SELECT user_id, CAST(event_id % 3 AS INTEGER) AS folder_rank, event_id,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, ts, event_id) AS rn FROM events) WHERE rn = 1""")
sql("dedup_last", """
SELECT folder_rank, user_id, event_id FROM (
  SELECT user_id, CAST(event_id % 3 AS INTEGER) AS folder_rank, event_id,
    row_number() OVER (PARTITION BY event_id % 3, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")

# ---------------------------------------------------------------- sort / sampling

sql("head_k", "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id LIMIT 5")
_SHUF = ("shuf AS (SELECT event_id, event_type, row_number() OVER (ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), "
         "event_id) - 1 AS position FROM events)")
sql("shuffle_rows", f"WITH {_SHUF} SELECT event_id, position FROM shuf")
sql("example_lookup", f"WITH {_SHUF} SELECT event_id, event_type, position FROM shuf WHERE position = 9")
sql("minibatch", f"WITH {_SHUF} SELECT CAST(floor(position / 256) AS BIGINT) AS batch_id, count(*) AS n FROM shuf GROUP BY 1")
sql("balance_sample", """
SELECT vec_id, label FROM (SELECT vec_id, label, row_number() OVER (
  PARTITION BY label ORDER BY md5('42:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS pos FROM embeddings)
WHERE pos < (SELECT greatest(1, min(n) // 2) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label))""")
_SPLIT = """split AS (SELECT vec_id, label,
  CASE WHEN pos < n_test THEN 'test' WHEN pos < n_test + (n - n_test + 4) // 5 THEN 'validation' ELSE 'train' END AS split
FROM (SELECT vec_id, label,
  row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS pos,
  count(*) OVER (PARTITION BY label) AS n, (count(*) OVER (PARTITION BY label) + 4) // 5 AS n_test FROM embeddings))"""
sql("stratified_split", f"WITH {_SPLIT} SELECT vec_id, label, split FROM split")
sql("concat_splits", f"WITH {_SPLIT} SELECT split, label, count(*) AS n FROM split GROUP BY 1, 2")

# ---------------------------------------------------------------- arrays


def _exploded(n: int, src_expr: str, value_type: str = "DOUBLE") -> str:
    """(vec_id, pos, value) with value = src_expr(pos) over pos in 0..n-1."""
    return (f"SELECT vec_id, CAST(pos AS INTEGER) AS pos, CAST({src_expr} AS {value_type}) AS value "
            f"FROM embeddings, range(0, {n}) t(pos)")


sql("center_crop", _exploded(16, "embedding[1 + (2 + pos // 4) * 8 + (2 + pos % 4)]"))
sql("pixel_clean", _exploded(64, "CASE WHEN pos = vec_id % 64 THEN 0.0 "
                                 "WHEN pos = (vec_id + 1) % 64 THEN 3.4028234663852886e38 "
                                 "WHEN pos = (vec_id + 2) % 64 THEN -3.4028234663852886e38 "
                                 "ELSE CAST(embedding[1 + pos] AS DOUBLE) END"))
_FACTOR = "CASE {c} " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(SI.CHANNEL_FACTORS)) + " END"
_CHW = f"CAST(embedding[1 + pos % {_PIXELS}] AS DOUBLE) * {_FACTOR.format(c=f'(pos // {_PIXELS})')}"
_HWC = f"CAST(embedding[1 + pos // 3] AS DOUBLE) * {_FACTOR.format(c='(pos % 3)')}"
sql("stack_channels", _exploded(SI.CUBE_VALUES, _CHW))
sql("chw_to_hwc", _exploded(SI.CUBE_VALUES, _HWC))
sql("image_roundtrip", _exploded(SI.CUBE_VALUES, _CHW))
sql("image_messages", "SELECT 'Imagen' AS topic, 'vec_' || CAST(vec_id AS VARCHAR) AS object_id, "
    f"CAST(pos AS INTEGER) AS pos, {_HWC} AS value FROM embeddings, range(0, {SI.CUBE_VALUES}) t(pos)")
sql("minmax_channel", f"""
WITH px AS (SELECT vec_id, CAST(pos AS INTEGER) AS pos, pos % 3 AS ch,
  CAST(CASE WHEN vec_id % 10 = 0 AND pos % 3 = 1 THEN 0.5 ELSE {_HWC} END AS DOUBLE) AS x
  FROM embeddings, range(0, {SI.CUBE_VALUES}) t(pos)),
st AS (SELECT *, min(x) OVER (PARTITION BY vec_id, ch) AS mn, max(x) OVER (PARTITION BY vec_id, ch) AS mx FROM px)
SELECT vec_id, pos, round(CASE WHEN mx = mn THEN 0.0 ELSE (x - mn) / (mx - mn) END, 6) AS value FROM st""")
sql("minmax_cube", f"""
WITH px AS (SELECT vec_id, CAST(pos AS INTEGER) AS pos, {_CHW} AS x
  FROM embeddings, range(0, {SI.CUBE_VALUES}) t(pos)),
st AS (SELECT *, min(x) OVER (PARTITION BY vec_id) AS mn, max(x) OVER (PARTITION BY vec_id) AS mx FROM px)
SELECT vec_id, pos, round(CASE WHEN mx = 0 THEN NULL ELSE CAST(CAST((x - mn) / mx AS FLOAT) AS DOUBLE) END, 4) AS value
FROM st""")
sql("rescale", _exploded(64, "CAST(embedding[1 + pos] AS DOUBLE) / 255.0"))
sql("zero_pad", _exploded(196, "CASE WHEN pos // 14 BETWEEN 3 AND 10 AND pos % 14 BETWEEN 3 AND 10 "
                               "THEN CAST(embedding[1 + (pos // 14 - 3) * 8 + (pos % 14 - 3)] AS DOUBLE) ELSE 0.0 END"))
# np.rot90 (counter-clockwise) on an 8x8 grid: out[i, j] = in[src(i, j)]
_ROT = {0: "i * 8 + j", 1: "j * 8 + (7 - i)", 2: "(7 - i) * 8 + (7 - j)", 3: "(7 - j) * 8 + i"}
sql("rotations", " UNION ALL ".join(
    f"SELECT vec_id, {k} AS k, CAST(pos AS INTEGER) AS pos, CAST(embedding[1 + "
    + _ROT[k].replace("i", "(pos // 8)").replace("j", "(pos % 8)")
    + "] AS DOUBLE) AS value FROM embeddings, range(0, 64) t(pos)" for k in range(4)))
sql("image_range", "SELECT vec_id, CAST(list_min(embedding) AS DOUBLE) AS min_value, "
    "CAST(list_max(embedding) AS DOUBLE) AS max_value FROM embeddings")
sql("argmax_label", f"SELECT vec_id, {_ARGMAX} AS clase_predicha, greatest(s1, s2, s3, s4, s5) AS confianza FROM {SCORED}")
sql("score_normalize", f"SELECT vec_id, CAST(pos AS INTEGER) AS pos, round([{', '.join(_PROBS)}][1 + pos], 6) AS value "
    f"FROM {SCORED}, range(0, 5) t(pos)")
sql("feature_fuse", f"SELECT vec_id, CAST(pos AS INTEGER) AS pos, CASE pos WHEN {SI.CUBE_VALUES} THEN CAST(CAST(label AS FLOAT) AS DOUBLE) "
    f"WHEN {SI.CUBE_VALUES + 1} THEN CAST(CAST(vec_id AS FLOAT) AS DOUBLE) ELSE {_CHW} END AS value "
    f"FROM embeddings, range(0, {SI.CUBE_VALUES + 2}) t(pos)")

# ---------------------------------------------------------------- write + read back

sql("load_folders", "SELECT CAST(event_id % 3 AS INTEGER) AS folder_rank, count(*) AS n, round(sum(value), 2) AS sum_value "
    "FROM events GROUP BY 1")
sql("read_class_partition", "SELECT event_id, user_id, value, event_type FROM events WHERE event_type = 'purchase'")
sql("write_by_class", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
sql("dataset_roundtrip", "SELECT vec_id, label, CAST(pos AS INTEGER) AS pos, CAST(embedding[1 + pos] AS DOUBLE) AS value "
    f"FROM embeddings, range(0, {_PIXELS}) t(pos)")

# ---------------------------------------------------------------- streaming, CSV, cutouts

sql("stream_source", "SELECT 'obj_' || CAST(user_id AS VARCHAR) AS object_id, CAST(props->>'k' AS INTEGER) AS k FROM events")
sql("stream_join", "SELECT a.event_id AS alert_id, 'obj_' || CAST(a.user_id AS VARCHAR) AS object_id, a.value, b.props "
    "FROM events a JOIN events b ON a.event_id = b.event_id AND a.user_id = b.user_id "
    "AND b.ts BETWEEN a.ts - INTERVAL 1 HOUR AND a.ts + INTERVAL 1 HOUR")
sql("stream_dedup", "SELECT DISTINCT 'obj_' || CAST(user_id AS VARCHAR) AS object_id FROM events")
sql("prediction_csv", _prediction_row_sql())
_CUT_SRC = "((2 + (pos % 16) // 4) * 8 + 2 + (pos % 16) % 4)"
sql("cutout_ingest", f"""
SELECT vec_id, CAST(pos AS INTEGER) AS pos,
  CASE pos // 16
    WHEN 0 THEN CASE WHEN vec_id % 23 = 0 AND {_CUT_SRC} = 27 THEN 0.0 ELSE CAST(embedding[1 + {_CUT_SRC}] AS DOUBLE) END
    WHEN 1 THEN -CAST(embedding[1 + {_CUT_SRC}] AS DOUBLE)
    ELSE CAST(embedding[1 + {_CUT_SRC}] AS DOUBLE) * 2 END AS value
FROM embeddings, range(0, 48) t(pos) WHERE vec_id % 17 <> 0 AND vec_id % 19 <> 0""")

_RAW_USER = _RAW.replace("doc_id", "user_id")
# alerts whose cutouts decode; the record of an object: last alert of the folder, then first folder
_GOOD = "event_id % 29 <> 0 AND event_id % 31 <> 0"
_PREPARED = f"""good AS (SELECT *, 'obj_' || CAST(user_id AS VARCHAR) AS object_id, event_id % 3 AS folder_rank
  FROM events WHERE event_id % 13 <> 0 AND {_GOOD}),
lasts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY object_id, folder_rank ORDER BY event_id DESC) AS rn FROM good) WHERE rn = 1),
firsts AS (SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY object_id ORDER BY folder_rank) AS rn FROM lasts) WHERE rn = 1),
catalog AS (SELECT DISTINCT 'obj_' || CAST(user_id AS VARCHAR) AS oid, {_RAW_USER} AS predicted_class FROM events),
labelled AS (SELECT f.object_id, f.value, {_MAP} AS label FROM firsts f JOIN catalog c ON f.object_id = c.oid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || object_id), object_id) - 1 AS pos_in_class
  FROM labelled),
dataset AS (SELECT object_id, value, label FROM ranked WHERE label <> 'VS'
  OR pos_in_class < (SELECT greatest(1, count(*) // 4) FROM catalog WHERE {_MAP} = 'VS'))"""


def _crop_pixel(pos: str) -> str:
    """Channel-first cropped stand-in pixel at a position of 48, from ``value``."""
    at = f"((2 + ({pos} % 16) // 4) * 8 + 2 + ({pos} % 16) % 4)"
    base = f"CAST(fmod(value * ({at} + 1), 7.0) AS FLOAT)"
    return (f"CASE {pos} // 16 WHEN 0 THEN {base} WHEN 1 THEN CAST({base} * CAST(0.5 AS FLOAT) AS FLOAT) "
            f"ELSE CAST({base} + CAST(1.0 AS FLOAT) AS FLOAT) END")


sql("prepare_dataset", f"""WITH {_PREPARED},
px AS (SELECT label, object_id, value AS ra, CAST(pos AS INTEGER) AS pos, CAST({_crop_pixel('pos')} AS DOUBLE) AS x
  FROM dataset, range(0, 48) t(pos)),
st AS (SELECT *, min(x) OVER (PARTITION BY object_id) AS mn, max(x) OVER (PARTITION BY object_id) AS mx FROM px)
SELECT label, object_id, round(ra, 6) AS ra, pos, round(CAST(CAST((x - mn) / mx AS FLOAT) AS DOUBLE), 4) AS value FROM st""")
sql("record_choice", """
WITH lasts AS (SELECT 'obj_' || CAST(user_id AS VARCHAR) AS object_id, CAST(event_id % 3 AS INTEGER) AS folder_rank,
    event_id AS alert_order, value, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id DESC) AS rn FROM events)
SELECT object_id, folder_rank, alert_order, value FROM (
  SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY folder_rank) AS k FROM lasts WHERE rn = 1) WHERE k = 1""")
_HWC_POS = "((pos % 3) * 16 + pos // 3)"
sql("producer_flow", f"""{META}, src AS (SELECT m.*, e.value FROM meta m JOIN events e ON m.alert_id = e.event_id
  WHERE {_GOOD.replace('event_id', 'e.event_id')})
SELECT alert_id, object_id, {', '.join(S.METADATA_COLUMNS)}, CAST(pos AS INTEGER) AS pos,
  round(CAST({_crop_pixel(_HWC_POS)} AS DOUBLE), 4) AS pixel FROM src, range(0, 48) t(pos)""")
sql("stream_classify", """
SELECT DISTINCT 'obj_' || CAST(user_id AS VARCHAR) AS object_id, user_id % 17 <> 0 AS image_processed, TRUE AS metadata_processed,
  CASE WHEN user_id % 17 = 0 THEN 'INCOMPLETE_DATA' ELSE 'scored' END AS status, TRUE AS probabilities_sum FROM events""")
sql("train_score", f"""WITH {_SPLIT}
SELECT vec_id, CAST(label AS VARCHAR) AS label, TRUE AS probabilities_sum, TRUE AS known_class FROM split WHERE split = 'test'""")
_CLASS_ROWS = " UNION ALL ".join(f"SELECT '{c}' AS label" for c in S.CLASS_LABELS)
sql("train_evaluate", f"""WITH {_PREPARED},
held AS (SELECT label, (count(*) + 4) // 5 AS n FROM dataset GROUP BY label),
cls AS ({_CLASS_ROWS})
SELECT c.label, CAST(coalesce(h.n, 0) AS BIGINT) AS support, TRUE AS rates_valid FROM cls c LEFT JOIN held h ON c.label = h.label
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), CAST((SELECT sum(n) FROM held) AS BIGINT), TRUE""")

# ---------------------------------------------------------------- training watched by a validation split

def _watch_sql(w: dict) -> str:
    """Epoch by epoch: the state after a loss from the state before it."""
    improved = f"(l.loss IS NOT NULL AND (s.best_loss IS NULL OR l.loss < s.best_loss - {w['min_delta']}))"
    eased = f"(l.loss IS NOT NULL AND (s.cut_best IS NULL OR l.loss < s.cut_best - {w['cut_delta']}))"
    cut = f"(NOT {eased} AND s.cut_wait + 1 >= {w['cut_patience']})"
    return f"""
WITH RECURSIVE l AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS epoch,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS loss FROM events),
s AS (
  SELECT user_id, epoch, loss, loss IS NOT NULL AS improved, CASE WHEN loss IS NOT NULL THEN epoch END AS best_epoch, loss AS best_loss,
    CASE WHEN loss IS NULL THEN 1 ELSE 0 END AS wait, loss AS cut_best, CASE WHEN loss IS NULL THEN 1 ELSE 0 END AS cut_wait,
    CAST({w['step']} AS DOUBLE) AS step FROM l WHERE epoch = 0
  UNION ALL
  SELECT l.user_id, l.epoch, l.loss, {improved}, CASE WHEN {improved} THEN l.epoch ELSE s.best_epoch END,
    CASE WHEN {improved} THEN l.loss ELSE s.best_loss END, CASE WHEN {improved} THEN 0 ELSE s.wait + 1 END,
    CASE WHEN {eased} THEN l.loss ELSE s.cut_best END,
    CASE WHEN {eased} OR {cut} THEN 0 ELSE s.cut_wait + 1 END,
    CASE WHEN {cut} THEN greatest(s.step * {w['factor']}, {w['min_step']}) ELSE s.step END
  FROM s JOIN l ON l.user_id = s.user_id AND l.epoch = s.epoch + 1 WHERE s.wait < {w['patience']})
SELECT user_id, epoch, loss, improved, best_epoch, best_loss, CAST(wait AS BIGINT) AS wait, step, wait >= {w['patience']} AS stopped FROM s"""


def _watch_settings() -> dict:
    from alertflow.plans.registry_extra import WATCH_SETTINGS
    return WATCH_SETTINGS


_LATER["watch_losses"] = lambda: _watch_sql(_watch_settings())

sql("fused_gradient", """
WITH e AS (SELECT vec_id % 5 AS y, embedding FROM embeddings),
m AS (SELECT y, u, CAST(embedding[u + 1] AS DOUBLE) + 1 AS x FROM e, (SELECT unnest(range(4)) AS u))
SELECT CAST(c AS INTEGER) AS class, CAST(u AS INTEGER) AS unit,
  round(sum(x) / 5 - sum(CASE WHEN y = c THEN x ELSE 0 END), 6) + 0.0 AS gradient, round(ln(5), 6) AS loss, count(*) AS n_rows
FROM m, (SELECT unnest(range(5)) AS c) GROUP BY c, u""")

sql("stream_first_seen", """
SELECT object_id, event_id, ts, event_type, value FROM (
  SELECT 'obj_' || CAST(user_id AS VARCHAR) AS object_id, event_id, ts, event_type, value,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")

# ---------------------------------------------------------------- containers

_FILES = """WITH e AS (SELECT *, event_id // 250 AS f, row_number() OVER (PARTITION BY event_id // 250 ORDER BY event_id) - 1 AS i FROM events),
n AS (SELECT f, count(*) AS n, (count(*) + 99) // 100 AS nb FROM e GROUP BY f),
k AS (SELECT f, n, CASE f % 7 WHEN 3 THEN 100 * least(1, nb - 1) WHEN 5 THEN 100 * (nb - 1) WHEN 6 THEN 0 ELSE n END AS kept FROM n)"""
sql("container_records", f"""{_FILES}
SELECT event_id, CASE f % 3 WHEN 0 THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS value,
  CASE WHEN f % 3 < 2 THEN event_type END AS kind, CASE WHEN f % 3 = 1 THEN user_id END AS user_id, CASE WHEN f % 3 = 2 THEN props END AS props
FROM e JOIN k USING (f) WHERE i < kept""")
sql("container_rejects", f"""{_FILES}
SELECT 'part-' || lpad(CAST(f AS VARCHAR), 6, '0') || '.avro' AS path,
  CASE f % 7 WHEN 3 THEN 'payload does not decompress' WHEN 5 THEN 'truncated block' ELSE 'no container magic' END AS reason,
  f % 7 <> 6 AS behind_start, CAST(kept AS BIGINT) AS n_rows
FROM k WHERE f % 7 IN (3, 5, 6)""")

_SQL["producer_stream"] = _SQL["producer_flow"]
sql("stream_totals", "SELECT CAST(2 AS BIGINT) AS runs, CAST(count(*) AS BIGINT) AS input_rows, count(DISTINCT user_id) AS objects FROM events")

_SQL["unseen_bucketed"] = _SQL["anti_seen"]
_SQL["crossmatch_bucketed"] = _SQL["crossmatch"]
sql("saved_pipeline", f"""
WITH e AS (SELECT vec_id, embedding, CAST(label AS DOUBLE) AS a, CASE WHEN vec_id % 7 = 0 THEN -999.0 ELSE CAST(vec_id AS DOUBLE) END AS b FROM embeddings),
st AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM e)
SELECT vec_id, CAST(i AS INTEGER) AS pos, round(CASE
  WHEN i = {_PIXELS} THEN (a - ma) / CASE WHEN sa = 0 THEN 1 ELSE sa END
  WHEN i > {_PIXELS} THEN (b - mb) / CASE WHEN sb = 0 THEN 1 ELSE sb END
  ELSE CAST(CAST((CAST(embedding[i + 1] AS DOUBLE) - CAST(list_min(embedding) AS DOUBLE)) / CAST(list_max(embedding) AS DOUBLE) AS FLOAT) AS DOUBLE) END, 4) + 0.0 AS value
FROM e, st, (SELECT unnest(range({_PIXELS + 2})) AS i)""")
