"""Parquet and CSV tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.coerce import floating_columns, null_nan
from gridcast.names import HISTORY_MONTHS, TS


def utc_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps stored without zone are UTC; give them the session's timestamp type."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain})


def nulls_for_nans(df: DataFrame) -> DataFrame:
    return df.withColumns({c: null_nan(F.col(c)) for c in floating_columns(df)})


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return utc_timestamps(spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def write_csv(df: DataFrame, path: str, check: bool = True) -> str:
    """Export with a header, as a folder of parts. An empty table is an error."""
    if check and df.isEmpty():
        raise ValueError("nothing to export: the table is empty")
    df.write.mode("overwrite").csv(path, header=True, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return path


def recent(df: DataFrame, now: Column, ts: str = TS, days: int = HISTORY_MONTHS * 30,
           hours: int | None = None) -> DataFrame:
    """Rows from the last `hours`, or `days`, up to `now`; a range predicate the scan can use."""
    seconds = hours * 3600 if hours is not None else days * 86400
    return df.where((F.col(ts) >= now - F.expr(f"interval {seconds} seconds")) & (F.col(ts) <= now))
