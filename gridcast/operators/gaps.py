"""Hourly grid and gap filling.

Every operator here rests on one pass, `with_brackets`: for each row, the nearest valid
reading at or before it and the nearest one after it, per channel. Linear, bounded-forward
and circular fills are then plain expressions over the two readings, and grid hours that are
absent are produced by exploding the interval up to the next present row, so the grid needs
no join.

Windows run per (keys, time chunk). A chunk's outside neighbours come from a summary with one
row per (keys, chunk), so a site with a long history is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.coerce import numeric_columns
from gridcast.names import CHUNK_HOURS, HOUR, KEYS, TS
from gridcast.operators.quantiles import exact_medians

NEXT_TS = "_next_ts"
CHUNK = "_chunk"


def seconds(ts: str) -> str:
    return f"(unix_micros({ts}) / 1e6D)"


def chunk_of(ts: Column, chunk_hours: int) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(chunk_hours * HOUR))


def over(part: list[str], order: str, frame: str = "") -> str:
    """OVER clause; per-channel expressions are SQL text, one short string per column."""
    names = ", ".join(f"`{p}`" for p in part)
    return f"OVER (PARTITION BY {names} ORDER BY `{order}` {frame})"


@dataclass(frozen=True)
class Bracket:
    """SQL names of the readings around a time: (t0, v0) at or before it, (t1, v1) after it."""

    t0: str
    v0: str
    t1: str
    v1: str


def bracket(c: str) -> Bracket:
    return Bracket(f"_t0_{c}", f"_v0_{c}", f"_t1_{c}", f"_v1_{c}")


def _chunk_edges(df: DataFrame, cols: list[str], keys: list[str], ts: str) -> DataFrame:
    """Per (keys, chunk): the last valid reading before it and the first one after it."""
    aggs = [f"min(`{ts}`) AS _first_ts"]
    for c in cols:
        valid = f"CASE WHEN `{c}` IS NOT NULL THEN _t END"
        aggs += [f"min({valid}) AS _t0_{c}", f"min_by(`{c}`, {valid}) AS _v0_{c}",
                 f"max({valid}) AS _t1_{c}", f"max_by(`{c}`, {valid}) AS _v1_{c}"]
    edges = df.groupBy(*keys, CHUNK).agg(*map(F.expr, aggs)).selectExpr(
        *keys, CHUNK, "_first_ts",
        *[f"CASE WHEN _t{end}_{c} IS NOT NULL THEN struct(_t{end}_{c} AS t, _v{end}_{c} AS v) END AS _r{end}_{c}"
          for c in cols for end in (0, 1)])
    near, before = over(keys, CHUNK), over(keys, CHUNK, "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    return edges.selectExpr(
        *keys, CHUNK, f"lead(_first_ts) {near} AS _out_ts",
        *[f"last(_r1_{c}) IGNORE NULLS {before} AS _in_{c}" for c in cols],
        *[f"lead(_r0_{c}, 1) IGNORE NULLS {near} AS _out_{c}" for c in cols])


def with_brackets(df: DataFrame, cols: list[str], keys: list[str] = KEYS, ts: str = TS,
                  chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Add `_t`, `_next_ts` and, per channel, the four columns that `bracket(c)` names.

    `chunk_hours=None` keeps each key's history in one window partition; use it only where
    a key's row count is known to be small.
    """
    out = [f"`{c}`" for c in df.columns]
    rest = [c for c in out if c[1:-1] not in cols]
    d = df.selectExpr(*rest, f"{seconds(ts)} AS _t",
                      *[f"nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)) AS `{c}`" for c in cols])
    part = list(keys)
    if chunk_hours is not None:
        part = [*keys, CHUNK]
        d = d.withColumn(CHUNK, chunk_of(F.col(ts), chunk_hours))
        edges = _chunk_edges(d.select(*part, ts, "_t", *cols), cols, keys, ts)
    near, upto = over(part, ts), over(part, ts, "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    d = d.selectExpr("*", *[f"CASE WHEN `{c}` IS NOT NULL THEN struct(_t AS t, `{c}` AS v) END AS _r_{c}"
                            for c in cols])
    # lead ... IGNORE NULLS is linear in the partition; first() over a following frame is not.
    d = d.selectExpr("*", f"lead(`{ts}`) {near} AS {NEXT_TS}",
                     *[f"last(_r_{c}) IGNORE NULLS {upto} AS _p_{c}" for c in cols],
                     *[f"lead(_r_{c}, 1) IGNORE NULLS {near} AS _n_{c}" for c in cols])
    if chunk_hours is not None:
        # After the window the rows already lie by (keys, chunk): the join moves only the edges.
        d = d.join(edges, part, "left")

    def around(inside: str, outside: str) -> str:
        return inside if chunk_hours is None else f"coalesce({inside}, {outside})"

    return d.selectExpr(
        *out, "_t", f"{around(NEXT_TS, '_out_ts')} AS {NEXT_TS}",
        *[f"{around(f'_{side}_{c}.{field}', f'_{far}_{c}.{field}')} AS _{field}{end}_{c}"
          for c in cols for side, far, end in (("p", "in", 0), ("n", "out", 1)) for field in ("t", "v")])


# ---- values at a time t (seconds) inside a bracket, as SQL text ---------------------------

def _between(t: str, t0: str, v0: str, t1: str, v1: str) -> str:
    return f"{v0} + ({v1} - {v0}) * ({t} - {t0}) / ({t1} - {t0})"


def linear_at(t: str, b: Bracket) -> str:
    """Linear in elapsed time; the edges repeat the nearest reading."""
    return f"coalesce({_between(t, b.t0, b.v0, b.t1, b.v1)}, {b.v0}, {b.v1})"


def carried_at(t: str, b: Bracket, limit_seconds: int | None) -> str:
    """Last reading, at most `limit_seconds` old."""
    return b.v0 if limit_seconds is None else f"CASE WHEN {t} - {b.t0} <= {limit_seconds} THEN {b.v0} END"


def carried_then_linear_at(t: str, b: Bracket, limit_seconds: int) -> str:
    """Carry the last reading for a while, then go linearly from there to the next one."""
    start = f"({b.t0} + {limit_seconds})"
    later = _between(t, start, b.v0, b.t1, b.v1)
    return f"coalesce(CASE WHEN {t} > {start} THEN {later} END, {b.v0}, {b.v1})"


def turn_between(t: str, b: Bracket) -> str:
    """Degrees in [0, 360): sine and cosine linear in time, then back to an angle."""
    share = f"coalesce(({t} - {b.t0}) / ({b.t1} - {b.t0}), 0D)"
    first, second = f"radians(coalesce({b.v0}, {b.v1}))", f"radians(coalesce({b.v1}, {b.v0}))"

    def mix(f: str) -> str:
        return f"{f}({first}) + ({f}({second}) - {f}({first})) * {share}"

    return f"pmod(degrees(atan2({mix('sin')}, {mix('cos')})), 360D)"


# ---- operators ---------------------------------------------------------------------------

def with_extent(df: DataFrame, bounds: DataFrame, keys: list[str] = KEYS, ts: str = TS,
                chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """Rows of `df` between the first and last `bounds` row of their key, with `_from` and `_to`.

    The extent is repeated for every time chunk it covers and joined by (keys, chunk), so the
    rows of a long history do not meet under one join key.
    """
    extent = bounds.groupBy(*keys).agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"))
    extent = extent.withColumn(CHUNK, F.explode(F.sequence(
        chunk_of(F.col("_from"), chunk_hours), chunk_of(F.col("_to"), chunk_hours))))
    return (df.withColumn(CHUNK, chunk_of(F.col(ts), chunk_hours)).join(extent, [*keys, CHUNK])
            .where(F.col(ts).between(F.col("_from"), F.col("_to"))).drop(CHUNK))


def on_grid(df: DataFrame, keys: list[str] = KEYS, ts: str = TS, step: int = HOUR) -> DataFrame:
    """Drop rows that are not a whole number of steps after their key's first row."""
    offset = F.expr(f"(unix_micros(`{ts}`) - unix_micros(_from)) % {step * 1_000_000}")
    return with_extent(df, df, keys, ts).where(offset == 0).select(*df.columns)


def gap_hours(ts: str = TS, step: int = HOUR) -> Column:
    """Steps from a row up to, but not including, the next present row."""
    every = f"interval {step} seconds"
    return F.expr(f"sequence(`{ts}`, coalesce({NEXT_TS} - {every}, `{ts}`), {every})")


def grid_reindex(df: DataFrame, keys: list[str] = KEYS, ts: str = TS, step: int = HOUR,
                 aligned: bool = False, chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Complete grid from each key's first to last row; absent steps have null columns.

    `aligned=True` says that the timestamps are already on the grid. `is_imputed` marks
    the added rows.
    """
    d = df if aligned else on_grid(df, keys, ts, step)
    d = with_brackets(d, [], keys, ts, chunk_hours).withColumn("_at", F.explode(gap_hours(ts, step)))
    present = F.col("_at") == F.col(ts)
    rest = [c for c in df.columns if c not in keys and c != ts]
    return d.select(*keys, F.col("_at").alias(ts),
                    *[F.when(present, F.col(c)).alias(c) for c in rest], (~present).alias("is_imputed"))


def _replace(df: DataFrame, cols: list[str], keys, ts, chunk_hours, value) -> DataFrame:
    """Channels replaced by `value(c)`, SQL over the bracket of c at the row's own time."""
    d = with_brackets(df, cols, keys, ts, chunk_hours)
    return d.selectExpr(*[f"{value(c)} AS `{c}`" if c in cols else f"`{c}`" for c in df.columns])


def interpolate_time(df: DataFrame, cols: list[str], keys: list[str] = KEYS, ts: str = TS,
                     causal: bool = False, chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Fill nulls linearly in time, edges with the nearest reading. `causal` uses the past only."""
    def value(c):
        return carried_at("_t", bracket(c), None) if causal else linear_at("_t", bracket(c))
    return _replace(df, cols, keys, ts, chunk_hours, value)


def ffill_limit(df: DataFrame, cols: list[str], limit: int = 3, keys: list[str] = KEYS, ts: str = TS,
                step: int = HOUR, chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Carry readings forward over at most `limit` steps of a complete grid."""
    return _replace(df, cols, keys, ts, chunk_hours,
                    lambda c: carried_at("_t", bracket(c), limit * step))


def interpolate_circular(df: DataFrame, cols: list[str], keys: list[str] = KEYS, ts: str = TS,
                         chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Fill directions in degrees through their sine and cosine; every row is re-encoded."""
    return _replace(df, cols, keys, ts, chunk_hours,
                    lambda c: turn_between("_t", bracket(c)))


def carry_fill(df: DataFrame, cols: list[str], keys: list[str] = KEYS, ts: str = TS,
               chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Forward fill, then backward fill.

    After the forward fill only the rows before a key's first reading are null, so the
    backward fill is one value per key and needs no second window over the rows.
    """
    if not cols:
        return df
    if chunk_hours is None:
        upto = over(keys, ts, "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
        whole = over(keys, ts, "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING")
        return df.selectExpr(*[
            f"coalesce(last(`{c}`) IGNORE NULLS {upto}, first(`{c}`) IGNORE NULLS {whole}) AS `{c}`"
            if c in cols else f"`{c}`" for c in df.columns])
    part = [*keys, CHUNK]
    d = df.withColumn(CHUNK, chunk_of(F.col(ts), chunk_hours))
    ends = []
    for c in cols:
        valid = f"CASE WHEN `{c}` IS NOT NULL THEN `{ts}` END"
        ends += [f"min_by(`{c}`, {valid}) AS `_first_{c}`", f"max_by(`{c}`, {valid}) AS `_last_{c}`"]
    edges = d.select(*part, ts, *cols).groupBy(*part).agg(*map(F.expr, ends))
    before = over(keys, CHUNK, "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    whole = over(keys, CHUNK, "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING")
    edges = edges.selectExpr(*part, *[
        f"coalesce(last(`_last_{c}`) IGNORE NULLS {before}, first(`_first_{c}`) IGNORE NULLS {whole}) AS `_out_{c}`"
        for c in cols])
    upto = over(part, ts, "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    d = d.selectExpr("*", *[f"last(`{c}`) IGNORE NULLS {upto} AS `_upto_{c}`" for c in cols])
    return d.join(edges, part, "left").selectExpr(*[
        f"coalesce(`_upto_{c}`, `_out_{c}`) AS `{c}`" if c in cols else f"`{c}`" for c in df.columns])


def smart_fill(df: DataFrame, cols: list[str] | None = None, keys: list[str] = KEYS, ts: str = TS,
               medians: dict[str, float] | None = None, chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Forward fill, backward fill, then the column median for keys without any reading.

    Pass `medians` from a fitted profile to fill new rows; otherwise they are taken from
    the filled columns.
    """
    cols = [c for c in (numeric_columns(df) if cols is None else cols) if c not in keys]
    filled = carry_fill(df, cols, keys, ts, chunk_hours)
    if medians is None and cols:
        seen = df.groupBy(*keys).agg(*[F.count(c).alias(c) for c in cols]).agg(*[F.min(c).alias(c) for c in cols]).first()
        medians = exact_medians(filled, [c for c in cols if seen[c] == 0])
    kinds = dict(df.dtypes)
    known = {c: m for c, m in (medians or {}).items() if m is not None}
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast(kinds[c])) for c, m in known.items()})
