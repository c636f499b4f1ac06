"""Schemas and fixed values shared by every job.

Everything that must agree between dataset preparation, training and the
streaming classifier is defined exactly once here.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's for identical results)
# ---------------------------------------------------------------------------

# Metadata columns in model order (the stream's order; training reads the same
# constant, see README "decisions").
METADATA_COLUMNS = [
    "ra", "dec", "magpsf", "sigmapsf", "isdiffpos", "diffmaglim", "fwhm",
    "sgscore1", "sgscore2", "sgscore3", "distpsnr1", "distpsnr2", "distpsnr3",
    "classtar", "ndethist", "ncovhist", "chinr", "sharpnr", "approx_nondet",
    "gal_lat", "gal_lng", "ecl_lat", "ecl_lng",
]
# Integer-typed metadata columns; all others are double.
INT_METADATA_COLUMNS = ["isdiffpos", "ndethist", "ncovhist", "approx_nondet"]
# Fields read from the alert's `candidate` struct (double, default -999).
CANDIDATE_DOUBLE_FIELDS = [
    "ra", "dec", "magpsf", "sigmapsf", "diffmaglim", "fwhm",
    "sgscore1", "sgscore2", "sgscore3", "distpsnr1", "distpsnr2", "distpsnr3",
    "classtar", "chinr", "sharpnr",
]
# Fields read from the alert's top level (double, default -999).
TOP_LEVEL_DOUBLE_FIELDS = ["gal_lat", "gal_lng", "ecl_lat", "ecl_lng"]
# History counts read from `candidate` (int, default -1).
HISTORY_FIELDS = ["ndethist", "ncovhist"]
DOUBLE_DEFAULT = -999.0
INT_DEFAULT = -1
UNKNOWN_OBJECT_ID = "Unknown"
TRUE_FLAG_TEXT = "t"
SENTINEL = -999.0

# Cutout channels, in stacking order.
CUTOUT_CHANNELS = ["cutoutScience", "cutoutTemplate", "cutoutDifference"]
CUTOUT_SIZE = 63
CROP_SIZE = 21
CROP_START = 21
IMAGE_VALUES = 3 * CROP_SIZE * CROP_SIZE  # 1,323
IMAGE_BYTES = IMAGE_VALUES * 4  # 5,292, little-endian float32

# Output classes of the streaming classifier, in probability order.
CLASS_LABELS = ["AGN", "QSO", "VS", "YSO", "Other"]
FALLBACK_CLASS = "Other"
INCOMPLETE_STATUS = "INCOMPLETE_DATA"
ERROR_STATUS = "ERROR"

# Raw catalogue class -> training class (unlisted and null -> "Other").
LABEL_MAP = {
    "AGN": "AGN",
    "Blazar": "AGN",
    "QSO": "QSO",
    "YSO": "YSO",
    "E": "VS",
    "LPV": "VS",
    "RRL": "VS",
    "DSCT": "VS",
    "CEP": "VS",
    "SNIa": "Other",
    "SNIbc": "Other",
    "SNII": "Other",
    "SLSN": "Other",
    "Periodic-Other": "Other",
    "CV/Nova": "Other",
}

# Balanced sample size for the over-represented classes, and the seed.
BALANCE_SIZE = 12000
BALANCED_CLASSES = ["Other", "VS"]
SEED = 42
# Split fractions: test first, then validation out of the rest (64/16/20).
TEST_FRACTION = 0.2
VALIDATION_FRACTION = 0.2
BATCH_SIZE = 256

# Message topics.
METADATA_TOPIC = "Metadata"
IMAGE_TOPIC = "Imagen"

# Prediction row header, in order (34 columns).
PREDICTION_HEADER = ["timestamp", "object_id", "clase_predicha", "confianza",
                     *[f"prob_{c}" for c in CLASS_LABELS], *METADATA_COLUMNS, "image_processed", "metadata_processed"]
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------


def metadata_type(name: str) -> T.DataType:
    return T.IntegerType() if name in INT_METADATA_COLUMNS else T.DoubleType()


# Parse schema of a metadata message (19 doubles + 4 ints, all nullable).
METADATA_SCHEMA = T.StructType(
    [T.StructField(c, metadata_type(c), True) for c in METADATA_COLUMNS]
)

CANDIDATE_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in CANDIDATE_DOUBLE_FIELDS]
    + [T.StructField("isdiffpos", T.StringType(), True)]
    + [T.StructField(c, T.IntegerType(), True) for c in HISTORY_FIELDS]
)

STAMP_SCHEMA = T.StructType([T.StructField("stampData", T.BinaryType(), True)])

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("objectId", T.StringType(), True),
        T.StructField("candid", T.LongType(), True),
        T.StructField("candidate", CANDIDATE_SCHEMA, True),
    ]
    + [T.StructField(c, T.DoubleType(), True) for c in TOP_LEVEL_DOUBLE_FIELDS]
    + [T.StructField(c, STAMP_SCHEMA, True) for c in CUTOUT_CHANNELS]
)

# File twin of a message topic (the columns a Kafka source yields).
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# Message headers, as a Kafka source yields them with ``includeHeaders``.
HEADERS_TYPE = T.ArrayType(T.StructType([T.StructField("key", T.StringType(), True),
                                         T.StructField("value", T.BinaryType(), True)]))
MESSAGE_SCHEMA_WITH_HEADERS = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField("headers", HEADERS_TYPE, True)])
ALERT_ID_HEADER = "candid"

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("oid", T.StringType(), True),
        T.StructField("predicted_class", T.StringType(), True),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType(), True),
     T.StructField("object_id", T.StringType(), True),
     T.StructField("clase_predicha", T.StringType(), True),
     T.StructField("confianza", T.DoubleType(), True)]
    + [T.StructField(f"prob_{c}", T.DoubleType(), True) for c in CLASS_LABELS]
    + [T.StructField(c, metadata_type(c), True) for c in METADATA_COLUMNS]
    + [T.StructField("image_processed", T.BooleanType(), True),
       T.StructField("metadata_processed", T.BooleanType(), True)]
)
assert [f.name for f in PREDICTION_SCHEMA.fields] == PREDICTION_HEADER
