"""Bring pollutant and weather rows onto one hourly grid per key.

Both inputs carry one row per (keys, hour). The sources meet in a full outer join on
(keys, ts); the grid and all fills then come from a single bracket pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.names import CHUNK_HOURS, HOUR, KEYS, POLLUTANTS, TS, WEATHER
from gridcast.operators.gaps import (
    bracket, carried_then_linear_at, gap_hours, linear_at, seconds, with_brackets, with_extent,
)
from gridcast.session import stage


def _filled_grid(both: DataFrame, values: dict, keys: list[str], ts: str, chunk_hours) -> DataFrame:
    """Explode the gaps between present rows and evaluate `values[c](t, bracket)` at every hour."""
    # Read twice, for the rows and for the chunk edges: the join is stored first.
    d = with_brackets(stage(both, "aligned"), list(values), keys, ts, chunk_hours).withColumn("_at", F.explode(gap_hours(ts)))
    return d.selectExpr(*keys, f"_at AS `{ts}`",
                        *[f"{fill(seconds('_at'), bracket(c))} AS `{c}`" for c, fill in values.items()],
                        f"_at != `{ts}` AS is_imputed")


def _carried(limit: int):
    return lambda t, b: carried_then_linear_at(t, b, limit * HOUR)


def align_and_merge(air: DataFrame, weather: DataFrame, keys: list[str] = KEYS, ts: str = TS,
                    extent: str = "union", carry_hours: int = 3,
                    chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """History merge: pollutants linear, weather carried `carry_hours`, then linear.

    `extent="union"` spans both inputs; `"left"` only the pollutant hours. Keys without any
    pm2_5 reading drop out.
    """
    side = [c for c in POLLUTANTS if c in air.columns]
    other = [c for c in WEATHER if c in weather.columns]
    if extent == "left":
        weather = with_extent(weather, air, keys, ts).select(*weather.columns)
    both = air.select(*keys, ts, *side).join(weather.select(*keys, ts, *other), [*keys, ts], "full")
    grid = _filled_grid(both, {**{c: linear_at for c in side}, **{c: _carried(carry_hours) for c in other}},
                        keys, ts, chunk_hours)
    return grid.where(F.col("pm2_5").isNotNull())


def align_and_merge_latest(air: DataFrame, weather: DataFrame, keys: list[str] = KEYS, ts: str = TS,
                           chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Hourly merge: pollutant extent only, every channel linear in time.

    A key without weather rows keeps null weather columns.
    """
    side = [c for c in POLLUTANTS if c in air.columns]
    other = [c for c in WEATHER if c in weather.columns]
    inside = with_extent(weather, air, keys, ts).select(*keys, ts, *other)
    both = air.select(*keys, ts, *side).join(inside, [*keys, ts], "full")
    return _filled_grid(both, {c: linear_at for c in [*side, *other]}, keys, ts, chunk_hours)
