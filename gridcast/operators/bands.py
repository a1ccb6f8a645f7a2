"""Sub-indices from a band table of any length, given as a DataFrame.

A band of width w belongs to the level with cells of the size of the next power of two, of which it touches at most
two, or three at the last digit. A value looks for its band in one cell of each level there is. Level, cell and pollutant make an equi-join,
and few bands share a cell as long as bands do not overlap, however unequal their widths are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.coerce import finite

#: Cells no smaller than 2^-DIGITS of a band's ends, so that cell numbers are exact.
DIGITS = 40


def _exponent(x: Column) -> Column:
    """The power of two that is not below x."""
    return F.ceil(F.log2(x)).cast("int")


def _cell(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), level))


def band_cells(bands: DataFrame) -> DataFrame:
    """Every band once per cell it touches. Bands without finite ends, or upside down, hold nothing."""
    low, high = finite(F.col("low").cast("double")), finite(F.col("high").cast("double"))
    d = bands.select("pollutant", low.alias("low"), high.alias("high"), F.col("index_low").cast("double").alias("index_low"),
                     F.col("index_high").cast("double").alias("index_high")).where("low <= high")
    size = F.greatest(F.abs("low"), F.abs("high"))
    # greatest() passes over nulls: a point has no width, and the point zero no size either.
    level = F.coalesce(F.greatest(_exponent(F.nullif(F.col("high") - F.col("low"), F.lit(0.0))),
                                  _exponent(F.nullif(size, F.lit(0.0))) - DIGITS), F.lit(0))
    d = d.withColumn("level", level)
    return d.withColumn("cell", F.explode(F.sequence(_cell(F.col("low"), F.col("level")), _cell(F.col("high"), F.col("level")))))


def sub_indices(df: DataFrame, bands: DataFrame, pollutants: list[str], keys: list[str],
                scales: dict[str, float] | None = None) -> DataFrame:
    """`keys` and one column `<pollutant>_index` per pollutant, a row for every row of `df`, which `keys` must name.

    `bands` has pollutant, low, high, index_low, index_high. Where bands overlap the one with the smallest low
    counts, then the smallest high. A band that is a point gives its index_low. Null outside all bands.
    """
    scales = scales or {}
    cells = band_cells(bands.where(F.col("pollutant").isin(pollutants)))
    # One row per pollutant, with at most one level per exponent of a double.
    levels = {r.pollutant: sorted(r.levels) for r in cells.groupBy("pollutant").agg(F.collect_set("level").alias("levels")).collect()}
    values = [F.struct(F.lit(p).alias("pollutant"), (finite(F.col(p).cast("double")) * F.lit(float(scales.get(p, 1.0)))).alias("value"),
                       F.array(*[F.lit(x) for x in levels.get(p, [])]).cast("array<int>").alias("levels")) for p in pollutants]
    long = df.select(*keys, F.explode(F.array(*values)).alias("v")).select(*keys, "v.pollutant", "v.value", F.explode_outer("v.levels").alias("level"))
    long = long.withColumn("cell", _cell(F.col("value"), F.col("level")))
    v, b = long.alias("v"), cells.alias("b")
    same = [F.col(f"v.{c}") == F.col(f"b.{c}") for c in ("pollutant", "level", "cell")]
    inside = F.col("v.value").between(F.col("b.low"), F.col("b.high"))
    joined = v.join(b, same[0] & same[1] & same[2] & inside, "left")
    slope = (F.col("index_high") - F.col("index_low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    index = F.coalesce(slope * (F.col("value") - F.col("low")), F.lit(0.0)) + F.col("index_low")
    place = F.when(F.col("low").isNotNull(), F.struct("low", "high"))
    return joined.groupBy(*[F.col(f"v.{k}").alias(k) for k in keys]).agg(*[
        F.min_by(index, F.when(F.col("v.pollutant") == p, place)).alias(f"{p}_index") for p in pollutants])
