"""SQL with the same meaning as each query, for an independent engine on the same tables.

Text is put together from small pieces: a `WITH` list of named steps per query.
"""

from __future__ import annotations

from gridcast.functions import airquality as air
from gridcast.names import (
    AQI_LAGS, CHANNELS, CLASS_HORIZONS, CLASS_TARGETS, DELTAS, POLLUTANT_LAGS, POLLUTANTS, ROLL_MEANS, ROLL_STDS,
    VALUE_TARGET, WEATHER, WEATHER_LAGS,
)

STAMP = "TIMESTAMP '2024-02-01 00:00:00'"
ID = "site, timestamp"


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def r(e: str, name: str, digits: int = 6) -> str:
    return f"round({e}, {digits}) + 0.0 AS {name}"


def rs(cols: list[str], digits: int = 6, **special: int) -> str:
    return ", ".join(r(c, c, special.get(c, digits)) for c in cols)


def steps(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---- views -------------------------------------------------------------------------------

def events() -> str:
    return """ev AS (SELECT event_id, ts, event_type, value, user_id // 50 AS site,
      date_trunc('hour', ts) AS timestamp, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k
      FROM events)"""


def cell_table() -> str:
    def mean(c, kind=None):
        return f"avg({c})" + (f" FILTER (WHERE event_type = '{kind}')" if kind else "")

    parts = {
        "pm2_5": mean("value", "click"), "pm10": mean("value", "view"), "no2": mean("value", "error"),
        "so2": mean("value", "purchase"), "o3": mean("value", "signup"), "co": f"{mean('value')} / 10",
        "temperature": mean("k", "click"), "wind_speed": f"{mean('k')} / 5",
        "wind_direction": f"{mean('k', 'signup')} * {dbl(3.6)}", "humidity": mean("k", "view"),
        "pressure": f"{mean('k', 'error')} + 950", "precipitation": f"{mean('k', 'purchase')} / 10",
    }
    cols = ", ".join(f"round({parts[c]}, 9) AS {c}" for c in CHANNELS)
    return f"""cells AS (SELECT site, timestamp, {cols}, 'site_' || site AS city, 'events' AS source,
      max(ts) AS ingested_at FROM ev GROUP BY site, timestamp)"""


CELLS = [events(), cell_table()]


def grid(source: str = "cells", name: str = "grid", cols: list[str] | None = None, extent: str | None = None) -> list[str]:
    """Complete hours between the first and last row of every site in `extent`."""
    cols = CHANNELS if cols is None else cols
    picked = ", ".join(f"s.{c}" for c in cols)
    return [
        f"{name}_hours AS (SELECT site, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) "
        f"AS timestamp FROM {extent or source} GROUP BY site)",
        f"{name} AS (SELECT h.site, h.timestamp, {picked + ', ' if cols else ''}s.site IS NULL AS is_imputed "
        f"FROM {name}_hours h LEFT JOIN {source} s ON s.site = h.site AND s.timestamp = h.timestamp)"]


def neighbours(source: str, name: str, cols: list[str], keep: str = "") -> str:
    """Nearest valid readings around every row: p (at or before) and n (after)."""
    w = "OVER (PARTITION BY site ORDER BY timestamp ROWS BETWEEN"
    out = []
    for c in cols:
        t = f"CASE WHEN {c} IS NOT NULL THEN epoch(timestamp) END"
        for e, x in ((t, "t"), (c, "v")):
            out.append(f"last_value({e} IGNORE NULLS) {w} UNBOUNDED PRECEDING AND CURRENT ROW) AS p{x}_{c}")
            out.append(f"first_value({e} IGNORE NULLS) {w} 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n{x}_{c}")
    return f"{name} AS (SELECT site, timestamp, epoch(timestamp) AS t{keep}, {', '.join(out)} FROM {source})"


def linear(c: str, t: str = "t") -> str:
    return (f"CASE WHEN pv_{c} IS NULL THEN nv_{c} WHEN nv_{c} IS NULL OR pt_{c} = {t} THEN pv_{c} "
            f"ELSE pv_{c} + (nv_{c} - pv_{c}) * ({t} - pt_{c}) / (nt_{c} - pt_{c}) END")


def carried_linear(c: str, limit: int = 10800) -> str:
    start = f"(pt_{c} + {limit})"
    return (f"CASE WHEN pv_{c} IS NULL THEN nv_{c} WHEN nv_{c} IS NULL OR t <= {start} THEN pv_{c} "
            f"ELSE pv_{c} + (nv_{c} - pv_{c}) * (t - {start}) / (nt_{c} - {start}) END")


def circular(c: str) -> str:
    def mix(f):
        a, b = f"{f}(radians(coalesce(pv_{c}, nv_{c})))", f"{f}(radians(coalesce(nv_{c}, pv_{c})))"
        return f"{a} + ({b} - {a}) * coalesce((t - pt_{c}) / (nt_{c} - pt_{c}), 0)"

    angle = f"degrees(atan2({mix('sin')}, {mix('cos')}))"
    return f"(({angle} % 360.0::DOUBLE) + 360.0::DOUBLE) % 360.0::DOUBLE"


def clean_steps() -> list[str]:
    others = [c for c in CHANNELS if c != "wind_direction"]
    return [
        *CELLS, neighbours("cells", "turned_n", ["wind_direction"]),
        f"turned AS (SELECT site, timestamp, {circular('wind_direction')} AS wind_direction FROM turned_n)",
        "prepared AS (SELECT c.* REPLACE (w.wind_direction AS wind_direction) FROM cells c "
        "JOIN turned w ON c.site = w.site AND c.timestamp = w.timestamp)",
        *grid("prepared", "g", [*CHANNELS, "city", "source", "ingested_at"]),
        neighbours("g", "gn", CHANNELS, ", city, source, ingested_at, is_imputed, wind_direction AS own"),
        "clean AS (SELECT site, timestamp, "
        + ", ".join(f"coalesce(own, {circular(c)}) AS {c}" if c == "wind_direction" else f"{linear(c)} AS {c}"
                    for c in CHANNELS)
        + ", city, source, ingested_at, is_imputed FROM gn)"]


# ---- index -------------------------------------------------------------------------------

def sub_index(p: str) -> str:
    whens = " ".join(
        f"WHEN {p} BETWEEN {dbl(b[0])} AND {dbl(b[1])} THEN {dbl(air.slope(b))} * ({p} - {dbl(b[0])}) + {b[2]}"
        for b in air.BANDS[p])
    return f"CASE {whens} END"


AQI = f"greatest({', '.join(sub_index(p) for p in POLLUTANTS)})"


def ladder(e: str, bounds: list, labels: list[str], missing: str) -> str:
    whens = " ".join(f"WHEN {e} <= {b} THEN {x}" for b, x in zip(bounds, labels))
    return f"CASE WHEN {e} IS NULL THEN {missing} {whens} ELSE {labels[-1]} END"


def class5(e: str) -> str:
    return f"CAST({ladder(e, air.CLASS_BOUNDS, ['1', '2', '3', '4', '5'], 'NULL')} AS INTEGER)"


def text(xs: list[str]) -> list[str]:
    return [f"'{x}'" for x in xs]


def by_class(labels: list[str], missing: str) -> str:
    return "CASE aqi_class " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels)) + f" ELSE '{missing}' END"


CATEGORY = ladder("aqi", air.CATEGORY_BOUNDS, text(air.CATEGORIES), f"'{air.UNKNOWN}'")
COLOR = ladder("aqi", air.CATEGORY_BOUNDS, text(air.COLORS), f"'{air.UNKNOWN_COLOR}'")
TIP = ladder("aqi", air.CATEGORY_BOUNDS, text(air.TIPS), "''")


def series_steps() -> list[str]:
    return [*clean_steps(), f"scored AS (SELECT *, {AQI} AS aqi FROM clean)",
            "series AS (SELECT * FROM scored WHERE aqi IS NOT NULL)"]


# ---- features ------------------------------------------------------------------------------

W = "OVER (PARTITION BY site ORDER BY timestamp)"


def lags() -> dict[str, str]:
    spec = [("aqi", AQI_LAGS), *[(p, POLLUTANT_LAGS) for p in POLLUTANTS], *[(c, WEATHER_LAGS) for c in WEATHER]]
    return {f"{c}_lag_{k}h": f"lag({c}, {k}) {W}" for c, ks in spec for k in ks}


def full(f: str, c: str, n: int) -> str:
    frame = f"OVER (PARTITION BY site ORDER BY timestamp ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) {frame} = {n} THEN {f}({c}) {frame} END"


def rolls() -> dict[str, str]:
    return {f"aqi_roll_mean_{n}h": full("avg", "aqi", n) for n in ROLL_MEANS} | {
        f"aqi_roll_std_{n}h": full("stddev_samp", "aqi", n) for n in ROLL_STDS}


def deltas() -> dict[str, str]:
    return {f"aqi_delta_{k}h": f"aqi - lag(aqi, {k}) {W}" for k in DELTAS}


def targets() -> dict[str, str]:
    def ahead(h):
        return f"CASE WHEN count(*) OVER (PARTITION BY site) > 72 THEN lead(aqi, {h}) {W} END"

    return {VALUE_TARGET: ahead(24)} | {t: class5(ahead(h)) for t, h in zip(CLASS_TARGETS, CLASS_HORIZONS)}


RATIOS = {"pm2_5_pm10_ratio": "pm2_5 / nullif(pm10 + 1e-6::DOUBLE, 0)", "no2_o3_ratio": "no2 / nullif(o3 + 1e-6::DOUBLE, 0)"}
CALENDAR_INT = {
    "hour": "CAST(hour(timestamp) AS INTEGER)", "day_of_week": "CAST(isodow(timestamp) - 1 AS INTEGER)",
    "month": "CAST(month(timestamp) AS INTEGER)", "is_weekend": "CAST(isodow(timestamp) >= 6 AS INTEGER)"}
CALENDAR_DBL = {
    "hour_sin": "sin(2 * pi() * hour(timestamp) / 24)", "hour_cos": "cos(2 * pi() * hour(timestamp) / 24)",
    "dow_sin": "sin(2 * pi() * (isodow(timestamp) - 1) / 7)", "dow_cos": "cos(2 * pi() * (isodow(timestamp) - 1) / 7)"}
STD4 = {f"aqi_roll_std_{n}h": 4 for n in ROLL_STDS}


def named(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in exprs.items())


def feature_steps(training: bool = True) -> list[str]:
    exprs = lags() | rolls() | deltas() | RATIOS | CALENDAR_INT | CALENDAR_DBL
    out = [*series_steps()]
    keep = ""
    if training:
        exprs = exprs | targets()
        keep = f"WHERE ({' AND '.join(t + ' IS NOT NULL' for t in [VALUE_TARGET, *CLASS_TARGETS])}) OR site_rows <= 72"
    out.append(f"wide AS (SELECT *, {named(exprs)}, count(*) OVER (PARTITION BY site) AS site_rows FROM series)")
    out.append(f"features AS (SELECT * EXCLUDE (site_rows), {STAMP} AS feature_generated_at FROM wide {keep})")
    return out


FEATURE_DOUBLES = ["aqi", *CHANNELS, *lags(), *rolls(), *deltas(), *RATIOS, *CALENDAR_DBL]
FEATURE_INTS = list(CALENDAR_INT)
FEATURES = [*FEATURE_DOUBLES, *FEATURE_INTS]


def feature_select(training: bool) -> str:
    cols = [*FEATURE_DOUBLES, *([VALUE_TARGET] if training else [])]
    ints = [*FEATURE_INTS, *(CLASS_TARGETS if training else [])]
    return (f"SELECT {ID}, city, source, ingested_at, is_imputed, feature_generated_at, {rs(cols, 6, **STD4)}, "
            f"{', '.join(ints)} FROM features")


def unpivoted(cols: list[str], source: str, each: str) -> str:
    return "\nUNION ALL\n".join(each.format(c=c, source=source) for c in cols)


def hourly_grid_steps() -> list[str]:
    return [*CELLS, *grid()]


CLIPPED = {"aqi": (0, 500), VALUE_TARGET: (0, 500), **{t: (1, 5) for t in CLASS_TARGETS}}


def clip(e: str, lo: int, hi: int) -> str:
    return f"CASE WHEN {e} IS NOT NULL THEN least(greatest({e}, {lo}), {hi}) END"


def gate_steps() -> list[str]:
    """Training rows after the quality gate; the dropped columns are decided by `ratios`."""
    fill = "OVER (PARTITION BY site ORDER BY timestamp ROWS BETWEEN"
    lagged = [c for c in FEATURE_DOUBLES if c not in ("aqi", *CHANNELS, *CALENDAR_DBL)]

    def filled(c):
        return (f"coalesce(last_value({c} IGNORE NULLS) {fill} UNBOUNDED PRECEDING AND CURRENT ROW), "
                f"first_value({c} IGNORE NULLS) {fill} CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")

    complete = " AND ".join(f"{t} IS NOT NULL" for t in CLIPPED if t != "aqi")
    return [*feature_steps(),
            "gated AS (SELECT * REPLACE (" + ", ".join(
                f"{clip(c, *span)} AS {c}" for c, span in CLIPPED.items()) + f") FROM features WHERE {complete})",
            "filled AS (SELECT * REPLACE (" + ", ".join(filled(c) for c in lagged) + ") FROM gated)"]


def naive_steps() -> list[str]:
    return [*series_steps(), f"naive AS (SELECT site, timestamp, aqi, lag(aqi, 24) {W} AS forecast FROM series)"]


def line_cells(body: str) -> str:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return "\nUNION ALL\n".join(body.format(c=c) for c in cols)


def sides() -> list[str]:
    """The cells as two sources with their own hours."""
    air_cols = [c for c in POLLUTANTS if c != "co"]
    wet = [c for c in WEATHER if c != "wind_speed"]
    return [*CELLS,
            f"air AS (SELECT site, timestamp, {', '.join(air_cols)}, CAST(NULL AS DOUBLE) AS co FROM cells "
            f"WHERE coalesce({', '.join(air_cols)}) IS NOT NULL)",
            f"wet AS (SELECT site, timestamp, {', '.join(wet)} FROM cells WHERE coalesce({', '.join(wet)}) IS NOT NULL)"]


WET = [c for c in WEATHER if c != "wind_speed"]


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    q["json_pollution_parse"] = steps(*CELLS) + f"SELECT {ID}, {rs(POLLUTANTS)} FROM cells"
    q["json_weather_zip"] = steps(*CELLS) + f"SELECT {ID}, {rs(WEATHER)} FROM cells"
    q["recent_range_filter"] = ("SELECT event_id, ts, user_id FROM events WHERE ts BETWEEN "
                                "TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'")
    q["ts_coerce"] = """SELECT l_orderkey, l_linenumber, TRY_CAST(x AS TIMESTAMP) AS timestamp FROM (
      SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS VARCHAR)
      ELSE l_returnflag END AS x FROM lineitem) WHERE TRY_CAST(x AS TIMESTAMP) IS NOT NULL"""
    q["num_coerce"] = """SELECT p_partkey, TRY_CAST(p_brand AS DOUBLE) AS brand_as_number,
      TRY_CAST(substring(p_brand, 7, 10) AS DOUBLE) AS brand_number FROM part"""
    q["null_normalize"] = f"""SELECT l_orderkey, l_linenumber, {r('CASE WHEN l_tax = 0 OR l_discount = 0 THEN NULL '
                              'ELSE l_discount / l_tax END', 'ratio')} FROM lineitem"""

    moved = [*CELLS, "old AS (SELECT * FROM cells)",
              f"new AS (SELECT site, timestamp + INTERVAL 1 HOUR AS timestamp, {', '.join(POLLUTANTS)}, "
              "ingested_at + INTERVAL 1 HOUR AS ingested_at FROM cells)"]
    merged = ", ".join(f"round(CASE WHEN n.site IS NOT NULL THEN n.{c} ELSE o.{c} END, 6) + 0.0 AS {c}" for c in POLLUTANTS)
    q["upsert_merge"] = steps(*moved) + f"""SELECT coalesce(o.site, n.site) AS site,
      coalesce(o.timestamp, n.timestamp) AS timestamp, {merged}, {', '.join(f'round(o.{c}, 6) + 0.0 AS {c}' for c in WEATHER)},
      o.city, o.source, CASE WHEN n.site IS NOT NULL THEN n.ingested_at ELSE o.ingested_at END AS ingested_at
      FROM old o FULL JOIN new n ON o.site = n.site AND o.timestamp = n.timestamp"""
    differs = " OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in [*POLLUTANTS, "ingested_at"])
    q["upsert_report"] = steps(*moved) + f"""SELECT count(*) FILTER (WHERE o.site IS NULL) AS inserted,
      count(*) FILTER (WHERE o.site IS NOT NULL) AS matched,
      count(*) FILTER (WHERE o.site IS NOT NULL AND ({differs})) AS modified
      FROM new n LEFT JOIN old o ON o.site = n.site AND o.timestamp = n.timestamp"""

    reg = """reg AS (SELECT o_orderpriority AS target, 'RandomForest' AS model_name, 'regression' AS task_type,
      'v' || o_orderkey AS version, o_totalprice AS score, o_orderkey AS id, o_orderdate AS training_date,
      CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'archived' END AS status FROM orders)"""
    q["registry_archive"] = steps(reg) + """SELECT target, version, CASE WHEN status = 'active' AND target IN
      ('1-URGENT', '2-HIGH') THEN 'archived' ELSE status END AS status FROM reg"""
    q["next_version"] = steps(reg) + """SELECT target, 'v' || (max(CAST(substring(version, 2) AS BIGINT)) + 1)
      AS next_version FROM reg GROUP BY target"""
    q["best_model_select"] = steps(reg) + f"""SELECT target, model_name, version, {r('score', 'score')} FROM reg
      QUALIFY row_number() OVER (PARTITION BY target ORDER BY score DESC, id) = 1"""
    q["registry_summary"] = steps(reg) + """SELECT count(*) AS total_models,
      count(*) FILTER (WHERE status = 'active') AS active_models,
      count(*) FILTER (WHERE status = 'archived') AS archived_models FROM reg"""
    q["registry_table"] = steps(reg) + f"""SELECT model_name, version, strftime(training_date, '%Y-%m-%d %H:%M')
      AS training_date, task_type, {r('score', 'rmse')}, CASE status WHEN 'active' THEN 'Active'
      WHEN 'archived' THEN 'Archived' ELSE 'Unknown' END AS status FROM reg"""
    q["metric_presence"] = steps(reg) + """SELECT metric, metric = 'rmse' AND (SELECT count(score) FROM reg) > 0
      AS present FROM (VALUES ('rmse'), ('r2'), ('mae'), ('accuracy'), ('f1_weighted'), ('f1')) v(metric)"""

    for name, way in (("hour_floor_dedup", "ASC"), ("dedup_last", "DESC")):
        q[name] = steps(events()) + f"""SELECT site, event_type, timestamp, ts, event_id, {r('value', 'value')} FROM ev
          QUALIFY row_number() OVER (PARTITION BY site, event_type, timestamp ORDER BY ts {way}, event_id {way}) = 1"""
    q["grid_reindex"] = steps(*hourly_grid_steps()) + f"SELECT {ID}, {rs(CHANNELS)}, is_imputed FROM grid"

    air_cols = POLLUTANTS
    union = [*sides(),
             "span AS (SELECT site, timestamp FROM air UNION ALL SELECT site, timestamp FROM wet)",
             *grid("air", "ga", air_cols, "span"), *grid("wet", "gw", WET, "span"),
             neighbours("ga", "na", air_cols), neighbours("gw", "nw", WET)]
    q["align_merge_backfill"] = steps(*union) + f"""SELECT na.site, na.timestamp,
      {', '.join(r(linear(c, 'na.t'), c) for c in air_cols)},
      {', '.join(r(carried_linear(c).replace('t <=', 'nw.t <=').replace('(t -', '(nw.t -'), c) for c in WET)},
      NOT EXISTS (SELECT 1 FROM span s WHERE s.site = na.site AND s.timestamp = na.timestamp) AS is_imputed
      FROM na LEFT JOIN nw ON na.site = nw.site AND na.timestamp = nw.timestamp
      WHERE {linear('pm2_5', 'na.t')} IS NOT NULL"""
    latest = [*sides(), *grid("air", "ga", air_cols), *grid("wet", "gw", WET, "air"),
              neighbours("ga", "na", air_cols, ", is_imputed"), neighbours("gw", "nw", WET, ", is_imputed")]
    q["align_merge_latest"] = steps(*latest) + f"""SELECT na.site, na.timestamp,
      {', '.join(r(linear(c, 'na.t'), c) for c in air_cols)}, {', '.join(r(linear(c, 'nw.t'), c) for c in WET)},
      na.is_imputed AND nw.is_imputed AS is_imputed
      FROM na LEFT JOIN nw ON na.site = nw.site AND na.timestamp = nw.timestamp"""

    q["interpolate_time"] = steps(*CELLS, neighbours("cells", "n", CHANNELS)) + (
        f"SELECT {ID}, {', '.join(r(linear(c), c) for c in CHANNELS)} FROM n")
    q["ffill_limit"] = steps(*hourly_grid_steps()) + f"""SELECT {ID}, {', '.join(r(
        f'last_value({c} IGNORE NULLS) OVER (PARTITION BY site ORDER BY timestamp ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)', c)
        for c in WEATHER)} FROM grid"""
    med = ", ".join(f"median({c}) AS m_{c}" for c in CHANNELS)
    q["smart_fill"] = steps(
        *CELLS, neighbours("cells", "n", CHANNELS),
        f"f AS (SELECT {ID}, {', '.join(f'coalesce(pv_{c}, nv_{c}) AS {c}' for c in CHANNELS)} FROM n)",
        f"m AS (SELECT {med} FROM f)") + f"""SELECT {ID}, {', '.join(r(
        f'coalesce({c}, (SELECT m_{c} FROM m))', c) for c in CHANNELS)} FROM f"""
    q["interpolate_circular"] = steps(*CELLS, neighbours("cells", "n", ["wind_direction"])) + (
        f"SELECT {ID}, {r(circular('wind_direction'), 'wind_direction')} FROM n")
    q["clean_hourly"] = steps(*clean_steps()) + (
        f"SELECT {ID}, {rs(CHANNELS)}, city, source, ingested_at, is_imputed FROM clean")

    q["aqi_sub_index"] = steps(*CELLS) + f"SELECT {ID}, {', '.join(r(sub_index(p), p + '_index') for p in POLLUTANTS)} FROM cells"
    q["aqi_user_bands"] = steps(*CELLS, f"""bands AS (SELECT (p_partkey - 1) * {dbl(0.5)} AS low, (p_partkey - 1) * {dbl(0.5)} + {dbl(0.4375)} AS high,
      CAST(p_partkey AS DOUBLE) AS first, CAST(p_partkey + p_size AS DOUBLE) AS last FROM part)""") + f"""SELECT c.site, c.timestamp, {', '.join(r(
        f'({p}.last - {p}.first) / ({p}.high - {p}.low) * (c.{c} - {p}.low) + {p}.first', c + '_index') for c, p in (('pm2_5', 'a'), ('o3', 'b')))}
      FROM cells c LEFT JOIN bands a ON c.pm2_5 BETWEEN a.low AND a.high LEFT JOIN bands b ON c.o3 BETWEEN b.low AND b.high"""
    q["csv_export_scan"] = steps(*CELLS) + f"SELECT {ID}, {rs(CHANNELS)}, city, source, ingested_at FROM cells"
    q["scoring_history_rows"] = steps(*CELLS, f"""dated AS (SELECT {ID}, co, CASE WHEN hour(timestamp) % 7 = 0
      THEN timestamp - INTERVAL 100 HOUR ELSE timestamp END AS feature_generated_at FROM cells)""") + f"""SELECT {ID}, {r('co', 'co')}, feature_generated_at
      FROM dated QUALIFY row_number() OVER (PARTITION BY site ORDER BY feature_generated_at DESC, timestamp DESC) <= 73"""
    scored = [*CELLS, f"scored AS (SELECT {ID}, {AQI} AS aqi FROM cells)"]
    q["aqi_value"] = steps(*scored) + f"SELECT {ID}, {r('aqi', 'aqi')} FROM scored WHERE aqi IS NOT NULL"
    q["aqi_class"] = steps(*scored) + f"SELECT {ID}, {class5('aqi')} AS aqi_class FROM scored"
    q["aqi_category"] = steps(*scored) + (
        f"SELECT {ID}, CAST(round(CAST(CAST(aqi AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) AS aqi, {CATEGORY} AS category, {COLOR} AS color, {TIP} AS tip FROM scored")
    q["aqi_class_info"] = steps(*scored, f"c AS (SELECT {ID}, {class5('aqi')} AS aqi_class FROM scored)") + (
        f"SELECT {ID}, aqi_class, {by_class(air.CATEGORIES, air.UNKNOWN)} AS label, "
        f"{by_class(air.RANGES, air.UNKNOWN_RANGE)} AS span, {by_class(air.COLORS, air.UNKNOWN_COLOR)} AS color FROM c")

    q["calendar_features"] = steps(*CELLS) + (
        f"SELECT {ID}, {named(CALENDAR_INT)}, {', '.join(r(e, n) for n, e in CALENDAR_DBL.items())} FROM cells")
    q["ratio_features"] = steps(*CELLS) + f"SELECT {ID}, {', '.join(r(e, n) for n, e in RATIOS.items())} FROM cells"
    q["lag_features"] = steps(*series_steps()) + (
        f"SELECT {ID}, {r('aqi', 'aqi')}, {', '.join(r(e, n) for n, e in lags().items())} FROM series")
    q["rolling_stats"] = steps(*series_steps()) + (
        f"SELECT {ID}, {r('aqi', 'aqi')}, {', '.join(r(e, n, STD4.get(n, 6)) for n, e in rolls().items())} FROM series")
    q["delta_features"] = steps(*series_steps()) + (
        f"SELECT {ID}, {r('aqi', 'aqi')}, {', '.join(r(e, n) for n, e in deltas().items())} FROM series")
    q["targets_training"] = steps(*feature_steps()) + (
        f"SELECT {ID}, {rs(['aqi', VALUE_TARGET])}, {', '.join(CLASS_TARGETS)} FROM features")
    q["features_training"] = steps(*feature_steps()) + feature_select(True)
    q["features_inference"] = steps(*feature_steps(False)) + feature_select(False)
    q["feature_select"] = steps(*feature_steps()) + unpivoted(
        FEATURES, "features", "SELECT '{c}' AS column_name, count({c}) AS n FROM {source}")

    share = "SELECT '{c}' AS column_name, round(avg(CAST({c} IS NULL AS INTEGER)), 6) + 0.0 AS ratio FROM {source}"
    q["missing_ratio"] = steps(*hourly_grid_steps()) + (
        f"SELECT *, CAST(ratio > 0.35 AS INTEGER) AS dropped FROM ({unpivoted(CHANNELS, 'grid', share)})")
    flag = "SELECT '{c}' AS column_name, count(DISTINCT {c}) <= 1 AS is_constant FROM {source}"
    q["constant_columns"] = steps(
        *hourly_grid_steps(), "wide AS (SELECT *, CAST(NULL AS DOUBLE) AS no_value, "
        "CASE WHEN co IS NOT NULL THEN 1.0 END AS one_value FROM grid)") + unpivoted(
        [*CHANNELS, "no_value", "one_value"], "wide", flag)
    q["null_audit"] = steps(*hourly_grid_steps()) + unpivoted(
        CHANNELS, "grid", "SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM {source}")
    shifted = {"aqi": "aqi * 3 - 60", VALUE_TARGET: f"{VALUE_TARGET} * 4 - 90", CLASS_TARGETS[0]: f"{CLASS_TARGETS[0]} + 2",
               CLASS_TARGETS[1]: f"{CLASS_TARGETS[1]} - 2", CLASS_TARGETS[2]: CLASS_TARGETS[2]}
    q["clip_bounds"] = steps(*feature_steps()) + f"""SELECT {ID}, {', '.join(
        r(clip(shifted[c], *CLIPPED[c]), c) for c in ('aqi', VALUE_TARGET))}, {', '.join(
        f'CAST({clip(shifted[c], *CLIPPED[c])} AS INTEGER) AS {c}' for c in CLASS_TARGETS)} FROM features"""

    dropped = ["month"]  # thirty days of January: the only constant feature
    kept = [c for c in FEATURE_DOUBLES + [VALUE_TARGET] if c not in dropped]
    ints = [c for c in FEATURE_INTS + CLASS_TARGETS if c not in dropped]
    tags = "city, source, ingested_at, is_imputed"
    q["clean_features_training"] = steps(*gate_steps()) + f"""SELECT {ID}, {tags}, feature_generated_at,
      {rs(kept, 6, **STD4)}, {', '.join(ints)}, CAST((SELECT count(*) FROM gated) AS INTEGER) AS rows_after_cleaning
      FROM filled"""
    kept = [c for c in kept if c != VALUE_TARGET]
    ints = [c for c in ints if c not in CLASS_TARGETS]
    stand_in = {c: f"coalesce(CASE WHEN site % 2 = 0 THEN {c} END, (SELECT median({c}) FROM gated))" for c in ("co", "aqi_lag_24h")}
    q["inference_row"] = steps(*gate_steps(), *(x.replace("wide AS", "wide_now AS").replace("FROM wide", "FROM wide_now").replace("features AS", "rows_now AS")
                                                for x in feature_steps(False)[-2:])) + f"""SELECT {ID}, {tags}, feature_generated_at,
      {', '.join(r(stand_in.get(c, c), c, STD4.get(c, 6)) for c in kept if c != 'aqi')}, {r(clip('aqi', 0, 500), 'aqi')}, {', '.join(ints)},
      CAST(NULL AS DOUBLE) AS {VALUE_TARGET}, {', '.join(f'CAST(NULL AS INTEGER) AS {t}' for t in CLASS_TARGETS)},
      CAST(1 AS INTEGER) AS rows_after_cleaning
      FROM rows_now QUALIFY row_number() OVER (PARTITION BY site ORDER BY timestamp DESC) = 1"""

    q["describe_columns"] = line_cells(
        "SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) + 0.0 AS mean, "
        "round(stddev_samp({c}), 4) + 0.0 AS std, round(min({c}), 6) + 0.0 AS min, "
        "round(quantile_cont({c}, 0.25), 6) + 0.0 AS p25, round(quantile_cont({c}, 0.5), 6) + 0.0 AS p50, "
        "round(quantile_cont({c}, 0.75), 6) + 0.0 AS p75, round(max({c}), 6) + 0.0 AS max FROM lineitem")
    q["histogram"] = f"""WITH v AS ({line_cells("SELECT '{c}' AS column_name, {c} AS value FROM lineitem WHERE {c} IS NOT NULL")}),
      s AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM v GROUP BY column_name)
      SELECT column_name, bin, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 30, 6) + 0.0 AS bin_from,
      count(*) AS n FROM (SELECT column_name, lo, hi, CAST(CASE WHEN hi = lo THEN 1 ELSE
      least(floor((value - lo) / ((hi - lo) / 30)) + 1, 30) END AS INTEGER) AS bin FROM v JOIN s USING (column_name))
      GROUP BY column_name, bin"""
    dense = ["pm2_5", "pm10", "no2", "o3", "co"]
    q["kde_grid"] = steps(
        *CELLS, "v AS (" + unpivoted(dense, "cells", "SELECT '{c}' AS column_name, {c} AS value FROM {source} "
                                     "WHERE {c} IS NOT NULL") + ")",
        "s AS (SELECT column_name, min(value) AS lo, max(value) AS hi, count(*) AS n, "
        "stddev_samp(value) * pow(count(*), -0.2) AS h FROM v GROUP BY column_name)",
        "p AS (SELECT *, lo - 3 * h + place * ((hi - lo + 6 * h) / 199) AS x FROM s, "
        "(SELECT CAST(unnest(range(200)) AS INTEGER) AS place))") + f"""SELECT p.column_name, place,
      round(any_value(x), 4) + 0.0 AS x, {r("sum(exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))", 'density')}
      FROM p JOIN v ON p.column_name = v.column_name GROUP BY p.column_name, place"""
    cor = ["aqi", "pm2_5", "pm10", "no2", "o3", "co", "temperature", "humidity", "wind_speed", "pressure",
           "aqi_lag_24h", "aqi_lag_72h"]
    q["correlation_matrix"] = steps(*feature_steps(False)) + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 4) + 0.0 AS corr FROM features"
        for a in cor for b in cor)
    q["class_distribution"] = steps(*feature_steps()) + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS target, CAST({t} AS DOUBLE) AS class_value, count(*) AS n FROM features "
        f"WHERE {t} IS NOT NULL GROUP BY {t}" for t in CLASS_TARGETS)
    newest = [*series_steps(), "newest AS (SELECT site, timestamp, aqi FROM series QUALIFY row_number() OVER "
              "(PARTITION BY site ORDER BY timestamp DESC) <= 48)"]
    q["category_distribution"] = steps(*newest, f"cat AS (SELECT site, {CATEGORY} AS category FROM newest)") + f"""
      SELECT s.site, d.category, d.position, count(c.site) AS n FROM (SELECT DISTINCT site FROM cat) s
      CROSS JOIN (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(air.CATEGORIES))}) d(category, position)
      LEFT JOIN cat c ON c.site = s.site AND c.category = d.category GROUP BY ALL"""
    q["latest_per_site"] = steps(*CELLS) + f"""SELECT {ID}, {rs(CHANNELS)}, city, source, ingested_at FROM cells
      QUALIFY row_number() OVER (PARTITION BY site ORDER BY timestamp DESC) = 1"""
    q["recent_trend_ma3"] = steps(*newest) + f"SELECT {ID}, {r('aqi', 'aqi')}, {r(full('avg', 'aqi', 3), 'aqi_ma')} FROM newest"

    q["train_test_split"] = steps(*series_steps()) + f"""SELECT {ID}, CAST(row_number() {W} <=
      floor(count(*) OVER (PARTITION BY site) * {dbl(0.8)}) AS INTEGER) AS is_train FROM series"""
    q["oversample_balance"] = steps(
        *series_steps(), f"lab AS (SELECT {ID}, {class5('aqi')} AS aqi_class FROM series)",
        "drawn AS (SELECT *, row_number() OVER (PARTITION BY aqi_class ORDER BY md5(site || '|' || "
        "CAST(timestamp AS VARCHAR) || '|42'), site, timestamp) - 1 AS i, "
        "count(*) OVER (PARTITION BY aqi_class) AS n FROM lab)",
        "top AS (SELECT max(n) AS m FROM drawn)") + f"""SELECT {ID}, aqi_class,
      unnest(range(1, CAST(m // n + CAST(i < m % n AS INTEGER) + 1 AS BIGINT))) AS copy FROM drawn, top"""
    q["sample_rows"] = steps(*CELLS) + f"""SELECT {ID} FROM cells
      ORDER BY md5(site || '|' || CAST(timestamp AS VARCHAR) || '|42'), site, timestamp LIMIT 500"""
    q["regression_metrics"] = steps(*naive_steps()) + f"""SELECT count(*) AS n,
      {r('sqrt(avg(pow(forecast - aqi, 2)))', 'rmse')}, {r('avg(abs(forecast - aqi))', 'mae')},
      {r('1 - sum(pow(forecast - aqi, 2)) / (var_pop(aqi) * count(aqi))', 'r2')} FROM naive WHERE forecast IS NOT NULL"""
    q["classification_metrics"] = steps(
        *naive_steps(), f"c AS (SELECT site, {class5('aqi')} AS a, {class5('forecast')} AS p FROM naive WHERE forecast IS NOT NULL)",
        "k AS (SELECT site, a AS c FROM c UNION SELECT site, p FROM c)",
        "f AS (SELECT k.site, k.c, (SELECT count(*) FROM c WHERE c.site = k.site AND a = k.c) AS support, "
        "(SELECT count(*) FROM c WHERE c.site = k.site AND p = k.c) AS called, "
        "(SELECT count(*) FROM c WHERE c.site = k.site AND a = k.c AND p = k.c) AS hits FROM k)") + f"""
      SELECT site, CAST(sum(support) AS BIGINT) AS n, {r('sum(hits) / sum(support)', 'accuracy')},
      {r('sum(support * 2.0 * hits / (support + called)) / sum(support)', 'f1_weighted')} FROM f GROUP BY site"""

    def health(name, columns, ts, order):
        nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in columns)
        return f"""(SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS total_rows,
          CAST({len(columns)} AS INTEGER) AS columns, {ts} AS latest_ts, CAST({nulls} AS INTEGER) AS nulls_in_latest
          FROM {name} ORDER BY {order} LIMIT 1)"""

    q["health_check"] = "\nUNION ALL\n".join([
        health("events", ["event_id", "ts", "user_id", "event_type", "value", "props"], "ts", "ts DESC, event_id DESC"),
        health("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
               "o_orderdate", "o_orderdate DESC, o_orderkey DESC"),
        health("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
               "l_shipdate", "l_shipdate DESC, l_orderkey DESC, l_linenumber DESC"),
        health("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
               "CAST(NULL AS TIMESTAMP)", "c_custkey DESC")])
    q["missing_hours"] = steps(*CELLS) + """SELECT site, count(*) AS present,
      CAST((epoch(max(timestamp)) - epoch(min(timestamp))) / 3600 + 1 AS BIGINT) AS grid,
      CAST((epoch(max(timestamp)) - epoch(min(timestamp))) / 3600 + 1 AS BIGINT) - count(*) AS missing FROM cells GROUP BY site"""
    q["relative_age_text"] = """SELECT 'v' || o_orderkey AS version, CASE WHEN m IS NULL THEN 'N/A'
      WHEN m < 1 THEN 'Just now' WHEN m < 60 THEN m || ' minutes ago' WHEN m < 1440 THEN (m // 60) || ' hours ago'
      ELSE (m // 1440) || ' days ago' END AS age FROM (SELECT o_orderkey, CAST(floor((epoch(TIMESTAMP
      '1998-08-02 12:34:56') - epoch(o_orderdate)) / 60) AS BIGINT) AS m FROM orders)"""
    q["day_labels"] = "SELECT 'v' || o_orderkey AS version, strftime(o_orderdate, '%a, %d %b') AS day FROM orders"
    q["hourly_aqi_rolling_mean"] = steps(*series_steps()) + (
        f"SELECT {ID}, {r('aqi', 'aqi')}, {r(rolls()['aqi_roll_mean_24h'], 'aqi_roll_mean_24h')} FROM series")

    q["stream_hourly_tumbling"] = steps(*CELLS) + f"SELECT {ID}, {rs(CHANNELS)}, ingested_at FROM cells"
    q["stream_dedup"] = steps(events()) + "SELECT DISTINCT site, event_type, timestamp FROM ev"
    q["stream_upsert"] = q["stream_hourly_tumbling"]
    q["stream_rolling_sliding"] = "\nUNION ALL\n".join(
        f"""(WITH {events()}, e AS (SELECT site, value, unnest(generate_series(timestamp, timestamp + INTERVAL {n - 1} HOUR,
        INTERVAL 1 HOUR)) AS last_hour FROM ev)
        SELECT CAST({n} AS INTEGER) AS hours, site, last_hour AS timestamp, count(value) AS n, {r('avg(value)', 'mean', 10)},
        {r('stddev_samp(value)', 'std', 4)} FROM e GROUP BY site, last_hour)"""
        for n in (6, 12, 24))
    q["stream_lag_state"] = steps(*CELLS) + (
        f"SELECT {ID}, {r('co', 'co')}, {', '.join(r(f'lag(co, {k}) {W}', f'co_lag_{k}h') for k in AQI_LAGS)} FROM cells")

    def fetched(cols):
        return f"SELECT {ID}, {', '.join(r(f'{c} + CAST(hour(timestamp) >= 21 AS INTEGER)', c) for c in cols)} FROM cells"

    q["landed_pollution"], q["landed_weather"] = steps(*CELLS) + fetched(POLLUTANTS), steps(*CELLS) + fetched(WEATHER)
    q["upsert_by_days"] = q["publish_and_swap"] = q["upsert_merge"]
    q["append_rows"] = steps(*moved) + f"""SELECT {ID}, {rs(POLLUTANTS)} FROM old
      UNION ALL SELECT {ID}, {rs(POLLUTANTS)} FROM new"""

    # Models: what holds for any good fit.
    def tested(target, value):
        return steps(*gate_steps()) + f"""SELECT {ID}, {value}, true AS answered FROM filled
          QUALIFY row_number() {W} > floor(count(*) OVER (PARTITION BY site) * {dbl(0.8)})"""

    q["train_regression"] = tested(VALUE_TARGET, r(VALUE_TARGET, VALUE_TARGET))
    q["train_classification"] = tested(CLASS_TARGETS[0], CLASS_TARGETS[0])
    all_targets = f"(VALUES {', '.join(f'({chr(39)}{t}{chr(39)})' for t in [VALUE_TARGET, *CLASS_TARGETS])}) t(target)"
    used = len(FEATURES) - len(dropped)
    q["train_select_register"] = steps(*gate_steps()) + f"""SELECT target,
      CASE WHEN target LIKE '%class%' THEN 'classification' ELSE 'regression' END AS task_type, 'v1' AS version, 'active' AS status,
      CAST({used} AS BIGINT) AS feature_count, (SELECT count(*) FROM filled) AS data_rows_used, true AS scored FROM {all_targets}"""
    q["active_model_report"] = f"SELECT target, 'v1' AS version, CAST({used} AS BIGINT) AS features_used FROM {all_targets}"
    q["predict_latest"] = steps(*gate_steps()) + f"""SELECT site, {STAMP} AS predicted_at, target, true AS plausible
      FROM (SELECT DISTINCT site FROM filled), {all_targets}"""
    q["global_attribution_top15"] = """SELECT CAST(unnest(range(1, 16)) AS INTEGER) AS place, true AS is_feature,
      true AS not_negative"""
    q["local_attribution_top10"] = steps(*gate_steps()) + """SELECT site, max(timestamp) AS timestamp,
      CAST(unnest(range(1, 11)) AS INTEGER) AS place, true AS in_order, true AS adds_up FROM filled GROUP BY site"""
    return q
