"""clean -> features: index, calendar, lags, rolling statistics, deltas, ratios, targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.airquality import aqi, class5
from gridcast.functions.clock import calendar_columns
from gridcast.functions.coerce import with_instants, with_numbers
from gridcast.names import (
    AQI_LAGS, CHANNELS, CHUNK_HOURS, CLASS_HORIZONS, CLASS_TARGETS, DELTAS, KEYS, MAX_SHIFT, POLLUTANT_LAGS,
    POLLUTANTS, ROLL_MEANS, ROLL_STDS, TARGETS, TS, VALUE_HORIZON, VALUE_TARGET, WEATHER, WEATHER_LAGS,
)
from gridcast.operators.gaps import interpolate_time
from gridcast.operators.rowspan import (
    TOTAL, Rows, delta, lag, lead, over_rows, rolling_mean, rolling_std, with_time_index,
)


def with_aqi(df: DataFrame, bands: dict | None = None, scales: dict | None = None) -> DataFrame:
    """Add `aqi`; rows without any sub-index drop out."""
    present = [p for p in POLLUTANTS if p in df.columns]
    return df.withColumn("aqi", aqi(present, bands, scales)).where(F.col("aqi").isNotNull())


def lag_columns(rows: Rows, columns: list[str]) -> dict[str, str]:
    spec = [("aqi", AQI_LAGS), *[(p, POLLUTANT_LAGS) for p in POLLUTANTS], *[(c, WEATHER_LAGS) for c in WEATHER]]
    return {f"{c}_lag_{k}h": lag(c, rows, k) for c, lags in spec if c in columns for k in lags}


def rolling_columns(rows: Rows) -> dict[str, str]:
    return {f"aqi_roll_mean_{n}h": rolling_mean("aqi", rows, n) for n in ROLL_MEANS} | {
        f"aqi_roll_std_{n}h": rolling_std("aqi", rows, n) for n in ROLL_STDS}


def delta_columns(rows: Rows) -> dict[str, str]:
    return {f"aqi_delta_{k}h": delta("aqi", rows, k) for k in DELTAS}


def target_columns(rows: Rows) -> dict[str, str]:
    """Future values; `with_target_classes` turns the class horizons into classes."""
    return {VALUE_TARGET: lead("aqi", rows, VALUE_HORIZON)} | {
        t: lead("aqi", rows, h) for t, h in zip(CLASS_TARGETS, CLASS_HORIZONS)}


def with_target_classes(df: DataFrame) -> DataFrame:
    return df.withColumns({t: class5(F.col(t)) for t in CLASS_TARGETS})


def ratio_columns(columns: list[str]) -> dict[str, Column]:
    pairs = [("pm2_5_pm10_ratio", "pm2_5", "pm10"), ("no2_o3_ratio", "no2", "o3")]
    return {name: F.try_divide(F.col(a), F.col(b) + F.lit(1e-6))
            for name, a, b in pairs if a in columns and b in columns}


def keep_complete_targets(df: DataFrame, targets: list[str], max_shift: int = MAX_SHIFT) -> DataFrame:
    """Drop rows without every target. Keys too short for the longest horizon get no targets
    at all and keep their rows."""
    short = F.col(TOTAL) <= max_shift
    d = df.withColumns({t: F.when(~short, F.col(t)) for t in targets})
    return d.where(short | ~F.greatest(*[F.col(t).isNull() for t in targets]))


def build_features(clean: DataFrame, mode: str = "training", keys: list[str] = KEYS, ts: str = TS,
                   filled: bool = False, bands: dict | None = None, scales: dict | None = None,
                   generated_at: Column | None = None, chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """The feature table. Lags count rows, so an hour dropped for want of an index shifts them.

    `filled=True` says that the channels have no gaps left (the output of `build_clean`).
    All window columns share one ordering and are evaluated with one sort.
    """
    channels = [c for c in CHANNELS if c in clean.columns]
    d = clean
    if not filled:
        d = interpolate_time(with_numbers(with_instants(d, ts), channels), channels, keys, ts,
                             chunk_hours=chunk_hours)
    d = with_time_index(with_aqi(d, bands, scales), keys, ts, chunk_hours)
    training = mode == "training"

    def build(rows: Rows) -> dict[str, str]:
        return (lag_columns(rows, channels + ["aqi"]) | rolling_columns(rows) | delta_columns(rows)
                | (target_columns(rows) if training else {}))

    d = over_rows(d, build, keys, ts, back=MAX_SHIFT, ahead=MAX_SHIFT if training else 0,
                  chunk_hours=chunk_hours)
    if training:
        d = keep_complete_targets(with_target_classes(d), TARGETS)
    d = calendar_columns(d, ts).withColumns(ratio_columns(channels))
    d = d.withColumn("feature_generated_at", generated_at if generated_at is not None else F.current_timestamp())
    return d.drop("_index", TOTAL)
