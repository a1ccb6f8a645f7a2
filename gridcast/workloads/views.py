"""Hourly, daily and registry views over the given tables.

events -> one row per site and hour; 50 users make a site, so the number of sites, and with it
the work behind the scan, grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.names import CHANNELS, POLLUTANTS, SITE, TAGS, TS, WEATHER
from gridcast.session import configure
from gridcast.sources.tables import load_table

USERS_PER_SITE = 50


def site_of(user: Column) -> Column:
    return F.floor(user / F.lit(USERS_PER_SITE))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with site, hour, and `k` taken from the JSON text."""
    events = load_table(configure(spark), sf_dir, "events")
    return event_columns(events)


def event_columns(events: DataFrame) -> DataFrame:
    return (events
            .withColumn(SITE, site_of(F.col("user_id")))
            .withColumn(TS, F.date_trunc("hour", "ts"))
            .withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
            .withColumn("k", F.get_json_object("props", "$.k").try_cast("double")))


def channel_means() -> list[Column]:
    """Channel definitions; means are rounded so that addition order cannot move a band edge."""
    def mean(c, kind=None):
        return F.avg(c if kind is None else F.when(F.col("event_type") == kind, F.col(c)))

    parts = {
        "pm2_5": mean("value", "click"), "pm10": mean("value", "view"), "no2": mean("value", "error"),
        "so2": mean("value", "purchase"), "o3": mean("value", "signup"), "co": mean("value") / 10,
        "temperature": mean("k", "click"), "wind_speed": mean("k") / 5,
        "wind_direction": mean("k", "signup") * 3.6, "humidity": mean("k", "view"),
        "pressure": mean("k", "error") + 950, "precipitation": mean("k", "purchase") / 10,
    }
    return [F.round(parts[c], 9).alias(c) for c in CHANNELS]


def cells_of(rows: DataFrame) -> DataFrame:
    cells = rows.groupBy(SITE, TS).agg(*channel_means(), F.max("ts").alias("ingested_at"))
    return cells.select(SITE, TS, *CHANNELS, F.concat(F.lit("site_"), F.col(SITE)).alias("city"),
                        F.lit("events").alias("source"), "ingested_at")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rows of every site; hours without events are absent."""
    return cells_of(event_rows(spark, sf_dir))


def air_and_weather(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The cells seen as two sources, each with its own hours."""
    hourly = cells(spark, sf_dir).drop(*TAGS)

    def side(cols):
        return hourly.select(SITE, TS, *cols).where(F.coalesce(*[F.col(c) for c in cols]).isNotNull())

    return side([c for c in POLLUTANTS if c != "co"]).withColumn("co", F.lit(None).cast("double")), side(
        [c for c in WEATHER if c != "wind_speed"])


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model record per order."""
    orders = load_table(configure(spark), sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "O", "active")
              .when(F.col("o_orderstatus") == "F", "archived"))
    return orders.select(
        F.col("o_orderpriority").alias("target"),
        F.lit("RandomForest").alias("model_name"),
        F.lit("regression").alias("task_type"),
        F.concat(F.lit("v"), F.col("o_orderkey")).alias("version"),
        F.struct(F.col("o_totalprice").alias("rmse"), F.lit(None).cast("double").alias("mae"),
                 F.lit(None).cast("double").alias("r2")).alias("metrics"),
        F.col("o_orderdate").alias("training_date"), F.col("o_orderdate").alias("trained_at"),
        status.alias("status"), F.col("o_totalprice").alias("score"), F.col("o_orderkey").alias("id"))
