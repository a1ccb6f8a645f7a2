"""Null-safe conversions. NaN and infinities never leave these helpers as values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def null_nan(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def finite(c: Column) -> Column:
    """NaN, +inf and -inf become null."""
    return F.when(F.abs(null_nan(c)) != INF, c)


def to_number(c: Column) -> Column:
    """Unparsable text becomes null instead of failing the query."""
    return null_nan(c.try_cast("double"))


def to_instant(c: Column) -> Column:
    """Unparsable text becomes null; a timestamp without zone is read as UTC."""
    return c.try_cast("timestamp")


def clip(c: Column, low: float, high: float) -> Column:
    # greatest/least skip nulls, so a null must be kept by hand.
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def safe_round(c: Column, digits: int = 2) -> Column:
    return F.round(to_number(c), digits)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def with_instants(df: DataFrame, ts: str) -> DataFrame:
    """Coerce `ts` and drop the rows where it does not parse."""
    return df.withColumn(ts, to_instant(F.col(ts))).where(F.col(ts).isNotNull())


def with_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in cols if c in df.columns})


def with_finite(df: DataFrame) -> DataFrame:
    """`finite` on every floating column."""
    doubles = set(floating_columns(df))
    return df.selectExpr(*[
        f"CASE WHEN abs(nanvl(`{c}`, NULL)) != double('inf') THEN `{c}` END AS `{c}`" if c in doubles else f"`{c}`"
        for c in df.columns])
