"""Landed payloads lie in as many files as there are sites, however many tasks wrote them."""

from pathlib import Path

from pyspark.sql import functions as F

from gridcast.workloads import batch


def test_a_site_lands_in_one_file(spark):
    rows = spark.range(0, 600, 1, 6).select((F.col("id") % 5).alias("site"), F.col("id").alias("v"))
    path = batch._landed(spark, rows, "few-files")
    assert len(list(Path(path).rglob("part-*.json"))) == 5
    back = spark.read.json(path)
    assert sorted(map(tuple, back.select("site", "v").collect())) == sorted(map(tuple, rows.collect()))
