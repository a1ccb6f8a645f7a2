"""Hourly aggregation of an event stream.

Event time, watermark and state belong to Structured Streaming; the functions here only
declare the query. Late events are accepted for `LATE_HOURS`, as long as the hourly job
looks back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridcast.names import KEYS, LATE_HOURS, TS

DELAY = f"{LATE_HOURS} hours"


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Landed files as a stream. Without `files_per_batch` a run takes all that is there at once."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def tumbling(stream: DataFrame, aggs: list[Column], keys: list[str] = KEYS, event_time: str = "ts",
             delay: str = DELAY, width: str = "1 hour") -> DataFrame:
    """One row per key and closed hour."""
    w = F.window(event_time, width)
    return (stream.withWatermark(event_time, delay).groupBy(*keys, w.alias("_w")).agg(*aggs)
            .withColumn(TS, F.col("_w.start")).drop("_w"))


def sliding(stream: DataFrame, value: str, hours: int, keys: list[str] = KEYS, event_time: str = "ts",
            delay: str = DELAY) -> DataFrame:
    """Mean and standard deviation over the `hours` that end with each hour.

    Time-based: it equals the row-based rolling statistics where no hour is missing.
    """
    w = F.window(event_time, f"{hours} hours", "1 hour")
    return (stream.withWatermark(event_time, delay).groupBy(*keys, w.alias("_w"))
            .agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
            .withColumn(TS, F.col("_w.end") - F.expr("interval 1 hour")).drop("_w")
            .withColumn("hours", F.lit(hours)))


def _merged(a: Column, b: Column) -> Column:
    """Count, mean and squared deviations of two sets together; nothing is subtracted that is large against the result."""
    n, step = a["n"] + b["n"], b["mean"] - a["mean"]
    share = F.try_divide(b["n"], n)
    both = F.struct(n.alias("n"), (a["mean"] + step * share).alias("mean"), (a["m2"] + b["m2"] + step * step * a["n"] * share).alias("m2"))
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def rolling(stream: DataFrame, value: str, widths: list[int], keys: list[str] = KEYS, event_time: str = "ts",
            delay: str = DELAY) -> DataFrame:
    """`sliding` for several widths, two stateful steps in a row: events close into hourly cells of count, mean and
    squared deviations, and cells, not events, go to the windows they are in. The widest window's state holds one
    cell per hour; the shorter ones are read off it. Works on a batch as well.
    """
    cells = (stream.withWatermark(event_time, delay).groupBy(*keys, F.window(event_time, "1 hour").alias("_hour"))
             .agg(F.count(value).alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
                  F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2")))
    wide = cells.groupBy(*keys, F.window("_hour", f"{max(widths)} hours", "1 hour").alias("_w")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_hour.start").alias("hour"), "n", "mean", "m2"))).alias("_cells"))
    each = wide.withColumn("hours", F.explode(F.array(*[F.lit(w) for w in widths])))
    end = F.col("_w.end")
    own = F.filter("_cells", lambda c: c["hour"] >= end - F.make_dt_interval(hours=F.col("hours")))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    each = each.withColumn("_own", own).where(F.size("_own") > 0)
    each = each.withColumn("_sum", F.aggregate("_own", nothing, lambda a, c: _merged(a, F.struct(c["n"], c["mean"], c["m2"]))))
    n = F.col("_sum.n")
    return each.select(*keys, n.alias("n"), F.when(n > 0, F.col("_sum.mean")).alias("mean"),
                       F.when(n > 1, F.sqrt(F.col("_sum.m2") / (n - 1))).alias("std"),
                       (end - F.expr("interval 1 hour")).alias(TS), "hours")


def first_seen(stream: DataFrame, keys: list[str], event_time: str, delay: str = DELAY, salts: int = 16) -> DataFrame:
    """Drop rows whose key was seen within the delay (rows fetched again).

    Copies are first dropped per (key, input partition modulo `salts`), so a key with very many
    copies is spread over that many tasks and brings at most `salts` rows to the second step.
    """
    d = stream.withWatermark(event_time, delay)
    if salts > 1:
        d = (d.withColumn("_salt", F.spark_partition_id() % salts)
             .dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt"))
    return d.dropDuplicatesWithinWatermark(keys)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that has landed, write Parquet, stop. Reruns continue where it ended."""
    query: StreamingQuery = (df.writeStream.format("parquet").outputMode(mode)
                             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
    query.awaitTermination()
