"""Calendar columns and age texts, always in UTC hours."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.names import TS


def hour_floor(c: Column) -> Column:
    return F.date_trunc("hour", c)


def calendar_columns(df: DataFrame, ts: str = TS) -> DataFrame:
    """hour, day_of_week (Monday 0), month, is_weekend and their places on the circle."""
    df = df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "is_weekend": F.weekday(ts).isin(5, 6).cast("int"),
    })

    def turn(c, period):
        return F.lit(2 * math.pi) * F.col(c) / F.lit(float(period))

    return df.withColumns({
        "hour_sin": F.sin(turn("hour", 24)),
        "hour_cos": F.cos(turn("hour", 24)),
        "dow_sin": F.sin(turn("day_of_week", 7)),
        "dow_cos": F.cos(turn("day_of_week", 7)),
    })


def day_label(c: Column) -> Column:
    """'Mon, 05 Feb', as the trend and prediction tables show days."""
    return F.date_format(c, "E, dd MMM")


def relative_age(c: Column, now: Column) -> Column:
    """'Just now', 'n minutes ago', 'n hours ago', 'n days ago' or 'N/A'."""
    minutes = F.floor((F.unix_micros(now) - F.unix_micros(c.cast("timestamp"))) / F.lit(60_000_000))
    hours = F.floor(minutes / 60)
    days = F.floor(hours / 24)
    return (F.when(minutes.isNull(), "N/A")
            .when(minutes < 1, "Just now")
            .when(minutes < 60, F.concat(minutes, F.lit(" minutes ago")))
            .when(hours < 24, F.concat(hours, F.lit(" hours ago")))
            .otherwise(F.concat(days, F.lit(" days ago"))))
