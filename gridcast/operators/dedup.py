"""One row per key and time. `row_number() = 1` is limited before the shuffle as well, so a
key with very many copies sends one row per map task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of every key in `order`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def keep_first(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    return first_rows(df, keys, [F.col(c).asc_nulls_last() for c in arrival])


def keep_last(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    return first_rows(df, keys, [F.col(c).desc_nulls_last() for c in arrival])


def latest_per_key(df: DataFrame, keys: list[str], ts: str, ties: list[str] | None = None) -> DataFrame:
    return keep_last(df, keys, [ts, *(ties or [])])


def recent_per_key(df: DataFrame, keys: list[str], ts: str, n: int = 48, ties: list[str] | None = None) -> DataFrame:
    """The newest n rows of every key, to be read from oldest to newest."""
    return first_rows(df, keys, [F.col(c).desc_nulls_last() for c in [ts, *(ties or [])]], n)
