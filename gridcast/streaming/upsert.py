"""Idempotent keyed upsert as a streaming sink."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gridcast.names import KEYS, TS
from gridcast.sources.store import upsert_days


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive plans for the jobs on a finished batch. A stream turns them off in its session, because its state keeps
    its partitions; a merge and a write would pay for all of these, however few rows there are."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def upsert_batch(root: str, keys: list[str], ts: str = TS):
    """foreachBatch function. Running a batch again gives the same table, so a retry is safe."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                with _adaptive(batch.sparkSession):
                    upsert_days(batch, root, keys, ts)
        finally:
            batch.unpersist()

    return write


def run_upsert(changes: DataFrame, root: str, checkpoint: str, keys: list[str] | None = None, ts: str = TS) -> None:
    """Upsert the changed rows of an aggregation (update mode) until all landed data is in."""
    query = (changes.writeStream.outputMode("update").foreachBatch(upsert_batch(root, keys or [*KEYS, TS], ts))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
