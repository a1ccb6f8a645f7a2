"""Column names, table schemas and fixed settings shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

SITE = "site"
TS = "timestamp"
KEYS = [SITE]

# The channels of the hourly tables.
POLLUTANTS = ["pm2_5", "pm10", "no2", "so2", "o3", "co"]
WEATHER = ["temperature", "wind_speed", "wind_direction", "humidity", "pressure", "precipitation"]
CHANNELS = POLLUTANTS + WEATHER
ANGLES = ["wind_direction"]
TAGS = ["city", "source", "ingested_at"]

# Look-back and look-ahead steps of the feature table, in hours.
AQI_LAGS = [1, 3, 6, 12, 24, 48, 72]
POLLUTANT_LAGS = [1, 3, 6, 12, 24]
WEATHER_LAGS = [1, 24]
ROLL_MEANS = [6, 12, 24]
ROLL_STDS = [12, 24]
DELTAS = [1, 3, 6, 24]
CLASS_HORIZONS = [24, 48, 72]
VALUE_HORIZON = 24
MAX_SHIFT = 72

VALUE_TARGET = "target_aqi_t_plus_24h"
CLASS_TARGETS = [f"target_aqi_class_t_plus_{h}h" for h in CLASS_HORIZONS]
TARGETS = [VALUE_TARGET, *CLASS_TARGETS]

# Quality and load settings.
MAX_MISSING_RATIO = 0.35
HISTORY_MONTHS = 6
LATE_HOURS = 3
MIN_TRAINING_ROWS = 50
TRAIN_SHARE = 0.8

# Versions of this library's training and scoring, noted in registry records and predictions.
PIPELINE_VERSION = "training-1"
PREDICTION_VERSION = "scoring-1"

HOUR = 3600

# One window task sees one (site, chunk); no site's whole history meets in a task.
CHUNK_HOURS = 2160

POLLUTION_PAYLOAD = T.StructType([
    T.StructField("list", T.ArrayType(T.StructType([
        T.StructField("dt", T.LongType()),
        T.StructField("components", T.StructType(
            [T.StructField(c, T.DoubleType()) for c in POLLUTANTS])),
    ]))),
])

# Weather payload field -> channel.
WEATHER_FIELDS = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "pressure_msl": "pressure",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_direction",
    "precipitation": "precipitation",
}

WEATHER_PAYLOAD = T.StructType([
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(f, T.ArrayType(T.DoubleType())) for f in WEATHER_FIELDS])),
])

METRICS_TYPE = T.StructType(
    [T.StructField(m, T.DoubleType()) for m in ("rmse", "mae", "r2", "accuracy", "f1_weighted")])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("target", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("task_type", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("metrics", METRICS_TYPE),
    T.StructField("training_date", T.TimestampType()),
    T.StructField("trained_at", T.TimestampType()),
    T.StructField("training_duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("feature_count", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("data_rows_used", T.LongType()),
    T.StructField("pipeline_version", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
