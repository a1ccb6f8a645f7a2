"""Air-quality index: sub-indices from a band table, classes, categories and their texts."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridcast.functions.coerce import null_nan, to_number
from gridcast.names import POLLUTANTS

# Concentration low, concentration high, index low, index high (US EPA bands).
BANDS = {
    "pm2_5": [(0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150),
              (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 500.4, 301, 500)],
    "pm10": [(0, 54, 0, 50), (55, 154, 51, 100), (155, 254, 101, 150),
             (255, 354, 151, 200), (355, 424, 201, 300), (425, 604, 301, 500)],
    "no2": [(0, 53, 0, 50), (54, 100, 51, 100), (101, 360, 101, 150),
            (361, 649, 151, 200), (650, 1249, 201, 300), (1250, 2049, 301, 500)],
    "so2": [(0, 35, 0, 50), (36, 75, 51, 100), (76, 185, 101, 150),
            (186, 304, 151, 200), (305, 604, 201, 300), (605, 1004, 301, 500)],
    "o3": [(0, 54, 0, 50), (55, 70, 51, 100), (71, 85, 101, 150),
           (86, 105, 151, 200), (106, 200, 201, 300)],
    "co": [(0.0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150),
           (12.5, 15.4, 151, 200), (15.5, 30.4, 201, 300), (30.5, 50.4, 301, 500)],
}

# Upper bounds of classes 1..4 (class 5 is above) and of the six categories.
CLASS_BOUNDS = [50, 100, 150, 200]
CATEGORY_BOUNDS = [50, 100, 150, 200, 300]
CATEGORIES = ["Good", "Moderate", "Unhealthy (Sensitive)", "Unhealthy", "Very Unhealthy", "Hazardous"]
COLORS = ["#2ecc71", "#f1c40f", "#e67e22", "#e74c3c", "#8e44ad", "#7f0000"]
RANGES = ["0 – 50", "51 – 100", "101 – 150", "151 – 200", "201 – 300", "301+"]
UNKNOWN = "Unknown"
UNKNOWN_COLOR = "#95a5a6"
UNKNOWN_RANGE = "N/A"

#: Default advice per category, best air first.
TIPS = [
    "The air is clean: go out as you like.",
    "Fine for most people; those with sensitive airways should watch how they feel.",
    "People with heart or lung trouble should keep exercise outside short.",
    "Everyone should exert themselves less outside; a mask helps.",
    "Move exercise and errands indoors.",
    "Remain inside, shut the windows and run an air filter.",
]


def slope(band: tuple) -> float:
    low, high, index_low, index_high = band
    return (index_high - index_low) / (high - low)


def sub_index(c: Column, bands: list[tuple], scale: float = 1.0) -> Column:
    """Piecewise-linear index; null between bands, below zero and above the table."""
    value = null_nan(c.cast("double"))
    if scale != 1.0:
        value = value * F.lit(scale)

    def band_value(band):
        low, _, index_low, _ = band
        return F.lit(slope(band)) * (value - F.lit(float(low))) + F.lit(float(index_low))

    return F.coalesce(*[
        F.when(value.between(float(b[0]), float(b[1])), band_value(b)) for b in bands])


def aqi(pollutants: list[str] | None = None, bands: dict | None = None,
        scales: dict[str, float] | None = None) -> Column:
    """Largest sub-index of the row; null when no pollutant falls into a band."""
    bands, scales = bands or BANDS, scales or {}
    parts = [sub_index(F.col(p), bands[p], scales.get(p, 1.0)) for p in pollutants or POLLUTANTS]
    return F.greatest(*parts) if len(parts) > 1 else parts[0]


def steps(value: Column, bounds: list, labels: list, missing=None) -> Column:
    """labels[i] for the first bound not below `value`; the last label above all bounds."""
    above = reduce(
        lambda rest, pair: F.when(value <= F.lit(float(pair[0])), F.lit(pair[1])).otherwise(rest),
        reversed(list(zip(bounds, labels))), F.lit(labels[-1]))
    return F.when(value.isNull(), F.lit(missing)).otherwise(above)


def class5(c: Column) -> Column:
    return steps(null_nan(c.cast("double")), CLASS_BOUNDS, [1, 2, 3, 4, 5]).cast("int")


def category6(c: Column) -> Column:
    return steps(to_number(c), CATEGORY_BOUNDS, CATEGORIES, UNKNOWN)


def color_of_value(c: Column) -> Column:
    return steps(to_number(c), CATEGORY_BOUNDS, COLORS, UNKNOWN_COLOR)


def _lookup(key: Column, keys: list, values: list, default: str) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain(*zip(keys, values))])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def class_label(c: Column) -> Column:
    """Label of a class counted from 0."""
    return _lookup(c.try_cast("int"), list(range(6)), CATEGORIES, UNKNOWN)


def class_color(c: Column) -> Column:
    return _lookup(c.try_cast("int"), list(range(6)), COLORS, UNKNOWN_COLOR)


def class_info(c: Column) -> Column:
    spans = _lookup(c.try_cast("int"), list(range(6)), RANGES, UNKNOWN_RANGE)
    return F.struct(class_label(c).alias("label"), spans.alias("range"))


def health_tip(category: Column, tips: list[str] | None = None) -> Column:
    """Advice for a category name: one text per category, in their order."""
    return _lookup(category, CATEGORIES, tips or TIPS, "")
