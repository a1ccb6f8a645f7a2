"""raw -> clean: one row per site and hour, every channel filled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.coerce import with_instants, with_numbers
from gridcast.names import ANGLES, CHANNELS, CHUNK_HOURS, KEYS, TAGS, TS
from gridcast.operators.dedup import keep_last
from gridcast.operators.gaps import (
    NEXT_TS, Bracket, bracket, carried_at, gap_hours, linear_at, on_grid, seconds, turn_between, with_brackets,
)


def build_clean(raw: DataFrame, keys: list[str] = KEYS, ts: str = TS, arrival: list[str] | None = None,
                causal: bool = False, aligned: bool = True,
                chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Coerce, keep the last arrival of every hour, complete the grid, fill every channel.

    Channels are linear in time. Directions go through sine and cosine twice: first among the
    present rows, then across the absent hours between two present rows. Tags stay null on
    the added hours, which `is_imputed` marks. `causal=True` carries the past only.
    """
    arrival = ["ingested_at"] if arrival is None else arrival
    channels = [c for c in CHANNELS if c in raw.columns]
    tags = [c for c in TAGS if c in raw.columns]
    d = with_numbers(with_instants(raw, ts), channels)
    if arrival:
        d = keep_last(d, [*keys, ts], arrival)
    if not aligned:
        d = on_grid(d, keys, ts)
    d = with_brackets(d.select(*keys, ts, *channels, *tags), channels, keys, ts, chunk_hours)
    angles = [c for c in channels if c in ANGLES]
    here, there = "_t", seconds(NEXT_TS)
    # Between two present rows the bracket is the same, so the next row's direction is the
    # bracket's value at the next row's time.
    d = d.selectExpr("*", *[f"{turn_between(here, bracket(c))} AS _a0_{c}" for c in angles],
                     *[f"{turn_between(there, bracket(c))} AS _a1_{c}" for c in angles])
    d = d.withColumn("_at", F.explode(gap_hours(ts)))
    t, present = seconds("_at"), f"_at = `{ts}`"

    def filled(c):
        if c not in angles:
            return carried_at(t, bracket(c), None) if causal else linear_at(t, bracket(c))
        if causal:
            return f"pmod({bracket(c).v0}, 360D)"
        across = turn_between(t, Bracket(here, f"_a0_{c}", there, f"_a1_{c}"))
        return f"CASE WHEN {present} THEN _a0_{c} ELSE {across} END"

    return d.selectExpr(*keys, f"_at AS `{ts}`", *[f"{filled(c)} AS `{c}`" for c in channels],
                        *[f"CASE WHEN {present} THEN `{c}` END AS `{c}`" for c in tags],
                        f"NOT ({present}) AS is_imputed")
