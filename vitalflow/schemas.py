"""Schemas and fixed values shared by all operators."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Sensor columns in record order, features in model order.
SENSORS = ("X", "Y", "Z", "EDA", "HR", "TEMP")
FEATURES = ("X", "Y", "Z", "HR", "TEMP", "EDA")
RECORD_COLUMNS = (*SENSORS, "id", "datetime")

# Class numbers and texts, shown defaults.
CLASSES = (0, 1, 2)
STRESS_LABELS = {0: "No stress", 1: "Moderate stress", 2: "High stress"}
UNKNOWN_LABEL = "Unknown"
DISPLAY_BLANK = "-"
DEFAULT_CLASS = 1

# Model keys of the scoring interface.
MODEL_KEYS = ("lgbm", "gb")
DEFAULT_MODEL = "lgbm"

# Texts of refused requests; a parameter's name, or a model's key in between, goes in.
BAD_PARAMETER = "Missing or invalid parameter: "
BAD_MODEL = ("Unknown model '", "'. Choose 'lgbm' or 'gb'.")

# Measurement and field names of the line format.
LINE_MEASUREMENT = "flink_events"
POINT_MEASUREMENT = "nurse_stress"
PRIMARY = "primary"
FALLBACK = "fallback"

# Window, lateness, batching, monitoring and replay settings.
WINDOW = "5 seconds"
WINDOW_MS = 5_000
ALLOWED_DELAY = "5 seconds"
ALLOWED_DELAY_MS = 5_000
BATCH_RECORDS = 1_000
BATCH_SECONDS = 30
LAG_LIMIT_S = 300.0
RESUME_SHARE = 0.5
VIOLATIONS = 3
LAG_LOOKBACK_MS = 600_000
HISTORY = 60
EVENT_STEP_MS = 3
EVENTS_PER_SEND = 330
SCORE_TIMEOUT_S = 0.5
SCORE_IN_FLIGHT = 20
SCORE_ATTEMPTS = 3

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

SENSOR_RECORD = T.StructType(
    [T.StructField(c, T.FloatType()) for c in SENSORS]
    + [T.StructField("id", T.StringType()), T.StructField("datetime", T.StringType())]
)

WINDOW_METRICS = T.StructType(
    [T.StructField("id", T.StringType())]
    + [T.StructField(c, T.FloatType()) for c in SENSORS]
    + [T.StructField(c, T.LongType()) for c in ("datetime", "windowStart", "windowEnd")]
)

POINT = T.StructType(
    [
        T.StructField("measurement", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("time_ms", T.LongType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in SENSORS]
    + [T.StructField("stress_level", T.IntegerType())]
)

AVRO_SCHEMA = json.dumps(
    {
        "type": "record",
        "name": "SensorRecord",
        "fields": [{"name": c, "type": ["null", "float"], "default": None} for c in SENSORS]
        + [{"name": c, "type": ["null", "string"], "default": None} for c in ("id", "datetime")],
    }
)

# Header spellings that mean a canonical column.
HEADER_NAMES = {
    "id": "User_ID",
    "timestamp": "Timestamp",
    "x": "Orientation_X",
    "y": "Orientation_Y",
    "z": "Orientation_Z",
    "hr": "Heart_Rate",
    "temp": "Skin_Temp",
    "eda": "EDA",
    "label": "Stress_Label",
}
# The same headers under the names that the operators use.
COLUMN_NAMES = {c.lower(): c for c in SENSORS} | {"id": "id", "timestamp": "seq", "label": "label"}
