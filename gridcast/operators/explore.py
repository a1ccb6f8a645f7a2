"""Tables behind the exploration plots: summaries, histograms, densities, correlations, counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.airquality import CATEGORIES, category6
from gridcast.operators.quantiles import DIRECT_ROWS, exact_quantiles, unpivot

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, cols: list[str], direct: int = DIRECT_ROWS) -> DataFrame:
    """count, mean, std, min, exact quartiles and max of every column, one row per column."""
    cells = unpivot(df, cols)
    basic = cells.groupBy("column_name").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    marks = exact_quantiles(df, cols, list(QUARTILES.values()), direct)
    name = F.col("column_name")

    def pick(i):
        table = [x for c in cols for x in (F.lit(c), F.lit(marks[c][i]).cast("double"))]
        return F.element_at(F.create_map(*table), name)

    return basic.select("column_name", "n", "mean", "std", "min",
                        *[pick(i).alias(p) for i, p in enumerate(QUARTILES)], "max")


def _ranges(cells: DataFrame) -> DataFrame:
    return cells.groupBy("column_name").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.count("value").alias("n"), F.stddev_samp("value").alias("sd"))


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """Equal-width bins from 1; the last bin is closed. Empty bins have no row."""
    cells = unpivot(df, cols).where(F.col("value").isNotNull())
    # One row per column, so the broadcast is as small as the column list.
    d = cells.join(F.broadcast(_ranges(cells).select("column_name", "lo", "hi")), "column_name")
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    at = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)) + 1, F.lit(bins))).cast("int")
    return (d.withColumn("bin", at).groupBy("column_name", "bin")
            .agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
            .select("column_name", "bin", (F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins)
                    .alias("bin_from"), "n"))


def _kernel_sums(points: int):
    """Per Arrow batch of (column, value, start, step, h): the kernel sum of its values at every place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, codes = np.unique(np.array(b.column(0).to_pylist(), dtype=object), return_inverse=True)
            value, start, step, h = (b.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
            for k, name in enumerate(names):
                own = np.flatnonzero(codes == k)
                places = start[own[0]] + np.arange(points) * step[own[0]]
                z = (places[:, None] - value[own]) / h[own[0]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * points), pa.array(np.arange(points, dtype=np.int32)), pa.array(np.exp(-0.5 * z * z).sum(1))],
                    names=["column_name", "place", "part"])

    return run


def density(df: DataFrame, cols: list[str], points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on `points` places from lo - cut*h to hi + cut*h, h = sd * n^(-1/5).

    Values are never shuffled: each Arrow batch adds up its kernels at all places, and the
    partial sums, `points` rows a batch and column, are added per place.
    """
    cells = unpivot(df, cols).where(F.col("value").isNotNull())
    spans = _ranges(cells).withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    spans = spans.select("column_name", "n", "h", (F.col("lo") - cut * F.col("h")).alias("start"), (
        (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (points - 1)).alias("step")).where("h > 0")
    # One row per column, so the broadcasts are as small as the column list.
    sums = (cells.join(F.broadcast(spans), "column_name").select("column_name", "value", "start", "step", "h")
            .mapInArrow(_kernel_sums(points), "column_name string, place int, part double")
            .groupBy("column_name", "place").agg(F.sum("part").alias("part")))
    scale = 1 / math.sqrt(2 * math.pi)
    return sums.join(F.broadcast(spans), "column_name").select(
        "column_name", "place", (F.col("start") + F.col("place") * F.col("step")).alias("x"),
        (F.col("part") * scale / (F.col("n") * F.col("h"))).alias("density"))


#: Of the rows that have both a and b: how many, the means of a and b, their squared deviations, their co-moment.
MOMENTS = "a int, b int, n double, mean_a double, mean_b double, m2_a double, m2_b double, co double"


def _block_moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairwise moments of a block. [i, j] of the means and squares is about column i where j has a value too."""
    seen = np.isfinite(x)
    m, own = seen.astype(float), np.where(seen, x, 0.0)
    count = np.maximum(m.sum(0), 1)
    low, high = np.where(seen, x, np.inf).min(0), np.where(seen, x, -np.inf).max(0)
    # Centred first, so that large means do not cancel; the clip keeps a constant column at exactly zero.
    centre = np.where(m.any(0), np.clip(own.sum(0) / count, np.where(m.any(0), low, 0), np.where(m.any(0), high, 0)), 0.0)
    z = np.where(seen, x - centre, 0.0)
    n = m.T @ m
    per = np.maximum(n, 1)
    total = z.T @ m
    return n, centre[:, None] + total / per, (z * z).T @ m - total * total / per, z.T @ z - total * total.T / per


def _merged_moments(p: tuple, q: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    (n, mean, m2, co), (k, other, m2_k, co_k) = p, q
    both = n + k
    step, share = np.where((n > 0) & (k > 0), other - mean, 0.0), k / np.maximum(both, 1)
    return (both, np.where(n > 0, mean + step * share, other), m2 + m2_k + step * step * n * share,
            co + co_k + step * step.T * n * share)


def _pair_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per pair of columns for a whole partition."""
    found = None
    for b in batches:
        if b.num_rows:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            block = _block_moments(x)
            found = block if found is None else _merged_moments(found, block)
    if found is not None:
        n, mean, m2, co = found
        a, b = np.triu_indices(len(n))
        values = [n[a, b], mean[a, b], mean[b, a], m2[a, b], m2[b, a], co[a, b]]
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), *map(pa.array, values)],
                                         names=["a", "b", "n", "mean_a", "mean_b", "m2_a", "m2_b", "co"])


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson, pairwise complete, every ordered pair; one pass over the rows.

    A partition comes down to one row per pair; these are merged about their common means. Values that are not
    finite count as missing. A column that does not vary goes with none, itself included.
    """
    parts = df.select(*[F.col(c).cast("double") for c in cols]).mapInArrow(_pair_moments, MOMENTS)
    pair = Window.partitionBy("a", "b")
    # Constant columns have equal means in all parts; the bounds keep rounding from telling them apart.
    means = {f"all_{s}": F.greatest(F.least(F.try_divide(F.sum(F.col("n") * F.col(f"mean_{s}")).over(pair), F.sum("n").over(pair)),
                                            F.max(f"mean_{s}").over(pair)), F.min(f"mean_{s}").over(pair)) for s in "ab"}
    away = {s: F.col(f"mean_{s}") - F.col(f"all_{s}") for s in "ab"}
    sums = (parts.where("n > 0").withColumns(means).groupBy("a", "b")
            .agg(*[F.sum(F.col(f"m2_{s}") + F.col("n") * away[s] * away[s]).alias(f"m2_{s}") for s in "ab"],
                 F.sum(F.col("co") + F.col("n") * away["a"] * away["b"]).alias("co")))
    value = F.when((F.col("m2_a") > 0) & (F.col("m2_b") > 0), F.when(F.col("a") == F.col("b"), F.lit(1.0)).otherwise(
        F.greatest(F.least(F.col("co") / F.sqrt("m2_a") / F.sqrt("m2_b"), F.lit(1.0)), F.lit(-1.0))))
    # The pairs there are, also those that no row has both of: as many as the square of the column list.
    grid = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("a", "column_a")).select(
        "*", F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("b", "column_b"))
    named = grid.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "column_a", "column_b")
    return named.join(sums.select("a", "b", value.alias("corr")), ["a", "b"], "left").select("column_a", "column_b", "corr")


def class_distribution(df: DataFrame, targets: list[str]) -> DataFrame:
    """Rows per class of every target column."""
    cells = unpivot(df, targets, "class_value", "target").where(F.col("class_value").isNotNull())
    return cells.groupBy("target", "class_value").agg(F.count(F.lit(1)).alias("n"))


def category_distribution(df: DataFrame, value: Column, keys: list[str] | None = None) -> DataFrame:
    """Rows per category in fixed order, zero where a category does not occur."""
    keys = keys or []
    counts = df.groupBy(*keys).agg(*[
        F.count_if(category6(value) == c).alias(c) for c in CATEGORIES])
    long = counts.unpivot(keys, CATEGORIES, "category", "n")
    order = F.create_map(*[x for i, c in enumerate(CATEGORIES) for x in (F.lit(c), F.lit(i))])
    return long.withColumn("position", F.element_at(order, F.col("category")))
