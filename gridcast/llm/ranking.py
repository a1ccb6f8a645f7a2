"""Places of rows in a global order, without one task that sees them all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridcast.llm.tables import spread, stage

_ROW_BITS = 33  # of monotonically_increasing_id: the partition number is above, the row's place in it below


def ranked(rows: DataFrame, by: list[Column], within: list[str], name: str) -> DataFrame:
    """`rows` with `_place` (from 0, in the order `by` inside equal `within`) and `_of` (rows with that `within`).

    A range sort deals the rows out, so a hot group spreads over many tasks; what is counted centrally is one row
    per partition and group in it. `rows` should be a stored table: range borders are drawn from a first pass.
    """
    order = [*[F.col(c).asc_nulls_first() for c in within], *by]
    placed = rows.repartitionByRange(spread(rows.sparkSession), *order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("_row", F.monotonically_increasing_id()), name)
    part = F.shiftright("_row", _ROW_BITS).alias("_part")
    runs = stage(placed.groupBy(part, *within).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")), f"{name}-runs")
    group = [F.col(c) for c in within] or [F.lit(0)]  # without groups: as many rows as partitions
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", *[F.col(c).alias(f"_run_{c}") for c in within], "_first",
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                       F.sum("_n").over(Window.partitionBy(*group)).alias("_of"))
    same = reduce(lambda a, b: a & b, [F.shiftright(placed["_row"], _ROW_BITS) == runs["_part"],
                                       *[placed[c].eqNullSafe(runs[f"_run_{c}"]) for c in within]])
    return placed.join(runs, same).select(*[placed[c] for c in rows.columns],
                                          (F.col("_row") - F.col("_first") + F.col("_before")).alias("_place"), "_of")
