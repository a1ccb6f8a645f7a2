"""Streaming queries: the events table read as landed files, run until all of it is processed."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.names import CHANNELS, SITE, TS
from gridcast.session import configure, scratch_path
from gridcast.sources.store import read_days
from gridcast.streaming.hourly import first_seen, read_stream, rolling, run_available, tumbling
from gridcast.streaming.lag_state import lag_stream
from gridcast.streaming.upsert import run_upsert
from gridcast.workloads import views
from gridcast.workloads.batch import query, tidy

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SLICES, FILES = 4, 4


def event_stream(spark, sf_dir) -> DataFrame:
    """The events as landed files: slices in the order of time, each a batch of its own, so that state goes from
    batch to batch. A last file holds a heartbeat, an event of no site two days later, by which all hours close."""
    configure(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    folder, step = scratch_path(spark, "landed"), (last - first) / SLICES
    for i in range(SLICES):
        low, high = first + i * step, first + (i + 1) * step
        part = events.where((F.col("ts") >= low) & ((F.col("ts") < high) if i < SLICES - 1 else F.lit(True)))
        part.repartition(FILES).write.mode("append").parquet(folder)
    beat = spark.range(1).select(*[(F.lit(last + timedelta(days=2)) if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name)
                                   for f in events.schema.fields])
    beat.coalesce(1).write.mode("append").parquet(folder)
    return views.event_columns(read_stream(spark, folder, events.schema, files_per_batch=FILES))


def _finished(spark, df, name) -> DataFrame:
    out = scratch_path(spark, name)
    run_available(df, f"{out}/table", f"{out}/state")
    return spark.read.schema(df.schema).parquet(f"{out}/table").where(F.col(SITE).isNotNull())


def _hourly(spark, sf_dir) -> DataFrame:
    aggs = [*views.channel_means(), F.max("ts").alias("ingested_at")]
    return tumbling(event_stream(spark, sf_dir).drop(TS), aggs).select(SITE, TS, *CHANNELS, "ingested_at")


@contextmanager
def _state_store(spark, provider):
    """The session's state store for the queries started inside; the old one comes back afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, provider)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


@query
def stream_hourly_tumbling(spark, sf_dir):
    return tidy(_finished(spark, _hourly(spark, sf_dir), "tumbling"))


@query
def stream_dedup(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select(SITE, "event_type", TS)
    return _finished(spark, first_seen(rows, [SITE, "event_type", TS], TS), "dedup")


@query
def stream_rolling_sliding(spark, sf_dir):
    return tidy(_finished(spark, rolling(event_stream(spark, sf_dir).drop(TS), "value", [6, 12, 24]), "rolling"), mean=10, std=4)


@query
def stream_upsert(spark, sf_dir):
    root = scratch_path(spark, "upsert")
    run_upsert(_hourly(spark, sf_dir), f"{root}/table", f"{root}/state")
    return tidy(read_days(spark, f"{root}/table").where(F.col(SITE).isNotNull()))


@query
def stream_lag_state(spark, sf_dir):
    hourly = _hourly(spark, sf_dir).select(SITE, TS, "co")
    with _state_store(spark, ROCKSDB):
        return tidy(_finished(spark, lag_stream(hourly, "co", [SITE]), "lags"))
