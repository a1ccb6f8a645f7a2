"""Batch queries over the given tables, one function per operator group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions import airquality as air
from gridcast.functions.clock import calendar_columns, day_label, hour_floor, relative_age
from gridcast.functions.coerce import clip, finite, safe_round, to_number, with_instants
from gridcast.names import (
    CHANNELS, KEYS, POLLUTANTS, POLLUTION_PAYLOAD, SITE, TARGETS, TS, WEATHER, WEATHER_FIELDS, WEATHER_PAYLOAD,
)
from gridcast.operators import explore, gaps, quality, registry as reg, sampling, scores
from gridcast.operators.align import align_and_merge, align_and_merge_latest
from gridcast.operators.bands import sub_indices
from gridcast.operators.dedup import keep_first, keep_last, latest_per_key, recent_per_key
from gridcast.operators.monitor import grid_gaps, health_report
from gridcast.operators.rowspan import lag, over_rows, rolling_mean, with_time_index
from gridcast.plans.clean import build_clean
from gridcast.plans.features import (
    build_features, delta_columns, keep_complete_targets, lag_columns, ratio_columns, rolling_columns,
    target_columns, with_aqi, with_target_classes,
)
from gridcast.plans.gate import UNAUDITED, clean_inference, clean_training, training_rows
from gridcast.plans.scoring import scoring_history
from gridcast.session import configure, scratch_path, stage
from gridcast.sources.landing import FETCHED, parse_payload, pollution_rows, read_payloads, weather_rows
from gridcast.sources.store import append, merge_report, merge_upsert, publish, read_days, read_published, upsert_days, upsert_published
from gridcast.sources.tables import load_table, read_csv, recent, write_csv
from gridcast.workloads import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Windows and fills run per site and week, so that the month of the tables has several cuts in every series.
CUT_HOURS = 168
STAMP = "timestamp'2024-02-01 00:00:00'"
LAST_LOAD = "timestamp'2024-01-25 00:00:00'"
REVIEW_DAY = "timestamp'1998-08-02 12:34:56'"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round doubles for comparison; adding zero turns -0.0 into 0.0."""
    return df.selectExpr(*[
        f"round(`{c}`, {special.get(c, digits)}) + 0D AS `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes])


ROLL_DIGITS = {f"aqi_roll_std_{n}h": 4 for n in (12, 24)}


# ---- staged tables ----------------------------------------------------------------------

def hourly_cells(spark, sf_dir):
    """Cells as a stored table: the event scan happens once."""
    return stage(views.cells(spark, sf_dir), "raw")


def hourly_grid(spark, sf_dir):
    cells = hourly_cells(spark, sf_dir)
    return gaps.grid_reindex(cells.drop("city", "source", "ingested_at"), aligned=True, chunk_hours=CUT_HOURS)


def clean_table(spark, sf_dir):
    # The cells come out of an aggregation, one row per site and hour: nothing to deduplicate.
    cells = hourly_cells(spark, sf_dir)
    return stage(build_clean(cells, arrival=[], chunk_hours=CUT_HOURS), "clean")


def feature_table(spark, sf_dir, mode="training"):
    clean = clean_table(spark, sf_dir)
    return build_features(clean, mode, filled=True, generated_at=F.expr(STAMP), chunk_hours=CUT_HOURS)


def cleaned(spark, sf_dir):
    """Cleaned training rows and the fitted profile."""
    features = stage(feature_table(spark, sf_dir), "features")
    return clean_training(features, generated_at=F.expr(STAMP), arrival=None, chunk_hours=CUT_HOURS, medians=False)


def aqi_series(spark, sf_dir):
    return with_aqi(clean_table(spark, sf_dir))


# ---- landing ----------------------------------------------------------------------------

@query
def json_pollution_parse(spark, sf_dir):
    reading = F.struct(F.unix_seconds(TS).alias("dt"), F.struct(*POLLUTANTS).alias("components"))
    days = (views.cells(spark, sf_dir).groupBy(SITE, F.to_date(TS).alias("day"))
            .agg(F.to_json(F.struct(F.collect_list(reading).alias("list"))).alias("body")))
    parsed = days.select(SITE, parse_payload(F.col("body"), POLLUTION_PAYLOAD).alias("p")).select(SITE, "p.*")
    return tidy(pollution_rows(parsed))


@query
def json_weather_zip(spark, sf_dir):
    row = F.struct(TS, *[F.col(c).alias(f) for f, c in WEATHER_FIELDS.items()])
    days = (views.cells(spark, sf_dir).groupBy(SITE, F.to_date(TS).alias("day"))
            .agg(F.array_sort(F.collect_list(row)).alias("rows")))
    arrays = F.struct(F.transform("rows", lambda r: F.date_format(r[TS], "yyyy-MM-dd'T'HH:mm")).alias("time"),
                      *[F.col(f"rows.{f}").alias(f) for f in WEATHER_FIELDS])
    body = days.select(SITE, F.to_json(F.struct(arrays.alias("hourly"))).alias("body"))
    parsed = body.select(SITE, parse_payload(F.col("body"), WEATHER_PAYLOAD).alias("p")).select(SITE, "p.*")
    return tidy(weather_rows(parsed))


def _landed(spark, bodies, name):
    """Payload files, one folder per site, as the fetchers leave them. A site is written by one task: files are as
    many as sites, not as sites times tasks."""
    path = scratch_path(spark, name)
    bodies.repartition(SITE).write.partitionBy(SITE).json(path)
    return path


def _fetches(spark, sf_dir):
    """Readings as a daily fetch brings them: a day's hours, and the last three of the day before once more,
    corrected by one."""
    cells = hourly_cells(spark, sf_dir)
    day = F.date_trunc("day", TS)
    late = cells.where(F.hour(TS) >= 21).select(
        SITE, TS, *[(F.col(c) + 1).alias(c) for c in CHANNELS], (day + F.expr("interval 30 hours")).alias("fetched_at"))
    return cells.select(SITE, TS, *CHANNELS, (day + F.expr("interval 6 hours")).alias("fetched_at")).unionAll(late)


@query
def landed_pollution(spark, sf_dir):
    reading = F.struct(F.unix_seconds(TS).alias("dt"), F.struct(*POLLUTANTS).alias("components"))
    bodies = _fetches(spark, sf_dir).groupBy(SITE, "fetched_at").agg(F.collect_list(reading).alias("list"))
    path = _landed(spark, bodies, "pollution")
    return tidy(pollution_rows(read_payloads(spark, path, POLLUTION_PAYLOAD, {FETCHED: "timestamp", SITE: "long"}, multi_line=False)))


@query
def landed_weather(spark, sf_dir):
    row = F.struct(TS, *[F.col(c).alias(f) for f, c in WEATHER_FIELDS.items()])
    days = _fetches(spark, sf_dir).groupBy(SITE, "fetched_at").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    arrays = F.struct(F.transform("rows", lambda r: F.date_format(r[TS], "yyyy-MM-dd'T'HH:mm")).alias("time"),
                      *[F.col(f"rows.{f}").alias(f) for f in WEATHER_FIELDS])
    path = _landed(spark, days.select(SITE, "fetched_at", arrays.alias("hourly")), "weather")
    return tidy(weather_rows(read_payloads(spark, path, WEATHER_PAYLOAD, {FETCHED: "timestamp", SITE: "long"}, multi_line=False)))


@query
def recent_range_filter(spark, sf_dir):
    events = load_table(configure(spark), sf_dir, "events").select("event_id", "ts", "user_id")
    return recent(events, F.expr(LAST_LOAD), "ts", days=15)


@query
def ts_coerce(spark, sf_dir):
    lines = load_table(configure(spark), sf_dir, "lineitem")
    text = F.when(F.col("l_linestatus") == "O", F.col("l_shipdate").cast("string")).otherwise(F.col("l_returnflag"))
    return with_instants(lines.select("l_orderkey", "l_linenumber", text.alias(TS)), TS)


@query
def num_coerce(spark, sf_dir):
    part = load_table(configure(spark), sf_dir, "part")
    return part.select("p_partkey", to_number(F.col("p_brand")).alias("brand_as_number"),
                       to_number(F.substring("p_brand", 7, 10)).alias("brand_number"))


@query
def null_normalize(spark, sf_dir):
    lines = load_table(configure(spark), sf_dir, "lineitem")
    ratio = (F.when((F.col("l_tax") == 0) & (F.col("l_discount") == 0), F.lit(float("nan")))
             .when(F.col("l_tax") == 0, F.lit(float("inf")))
             .when(F.col("l_discount") == 0, F.lit(float("-inf")))
             .otherwise(F.col("l_discount") / F.nullif(F.col("l_tax"), F.lit(0.0))))
    return tidy(lines.select("l_orderkey", "l_linenumber", finite(ratio).alias("ratio")))


# ---- upsert, registry ---------------------------------------------------------------------

def _stored_and_fetched(spark, sf_dir):
    """The stored table, and pollutant rows of every site that arrive one hour later."""
    stored = hourly_cells(spark, sf_dir)
    hour = F.expr("interval 1 hour")
    fetched = stored.select(SITE, (F.col(TS) + hour).alias(TS), *POLLUTANTS, (F.col("ingested_at") + hour).alias("ingested_at"))
    return stored, fetched


@query
def upsert_merge(spark, sf_dir):
    target, source = _stored_and_fetched(spark, sf_dir)
    return tidy(merge_upsert(target, source, [SITE, TS]))


@query
def upsert_report(spark, sf_dir):
    target, source = _stored_and_fetched(spark, sf_dir)
    return merge_report(target, source, [SITE, TS])


@query
def upsert_by_days(spark, sf_dir):
    target, source = _stored_and_fetched(spark, sf_dir)
    root = scratch_path(spark, "days")
    upsert_days(target, root, [SITE, TS])
    # The fetch arrives twice; the later arrival of an hour counts.
    twice = source.unionAll(source.withColumns({"co": F.col("co") - 1, "ingested_at": F.col("ingested_at") - F.expr("interval 1 minute")}))
    upsert_days(twice, root, [SITE, TS], arrival=["ingested_at"])
    return tidy(read_days(spark, root))


@query
def publish_and_swap(spark, sf_dir):
    target, source = _stored_and_fetched(spark, sf_dir)
    root = scratch_path(spark, "published")
    publish(target, root)
    upsert_published(source, root, [SITE, TS])
    return tidy(read_published(spark, root))


@query
def csv_export_scan(spark, sf_dir):
    cells = hourly_cells(spark, sf_dir)
    return tidy(read_csv(spark, write_csv(cells, scratch_path(spark, "export")), cells.schema))


@query
def append_rows(spark, sf_dir):
    target, source = _stored_and_fetched(spark, sf_dir)
    path = scratch_path(spark, "log")
    append(target.select(SITE, TS, *POLLUTANTS), path)
    append(source.select(SITE, TS, *POLLUTANTS), path)
    return tidy(spark.read.parquet(path))


@query
def registry_archive(spark, sf_dir):
    models = views.registry(spark, sf_dir)
    return reg.archive_active(models, ["1-URGENT", "2-HIGH"]).select("target", "version", "status")


@query
def next_version(spark, sf_dir):
    return reg.next_versions(views.registry(spark, sf_dir))


@query
def best_model_select(spark, sf_dir):
    best = reg.best_models(views.registry(spark, sf_dir))
    return tidy(best.select("target", "model_name", "version", "score"))


@query
def registry_summary(spark, sf_dir):
    return reg.registry_counts(views.registry(spark, sf_dir))


@query
def registry_table(spark, sf_dir):
    return tidy(reg.display_columns(reg.flat_registry(views.registry(spark, sf_dir))))


@query
def metric_presence(spark, sf_dir):
    return reg.metric_presence(reg.flat_registry(views.registry(spark, sf_dir)))


# ---- dedup, grid, alignment, fills ----------------------------------------------------------

def _hour_rows(spark, sf_dir):
    return views.event_rows(spark, sf_dir).withColumn(TS, hour_floor(F.col("ts"))).select(
        SITE, "event_type", TS, "ts", "event_id", "value")


@query
def hour_floor_dedup(spark, sf_dir):
    return tidy(keep_first(_hour_rows(spark, sf_dir), [SITE, "event_type", TS], ["ts", "event_id"]))


@query
def dedup_last(spark, sf_dir):
    return tidy(keep_last(_hour_rows(spark, sf_dir), [SITE, "event_type", TS], ["ts", "event_id"]))


@query
def grid_reindex(spark, sf_dir):
    return tidy(hourly_grid(spark, sf_dir))


@query
def align_merge_backfill(spark, sf_dir):
    air_rows, weather = views.air_and_weather(spark, sf_dir)
    return tidy(align_and_merge(stage(air_rows, "air"), stage(weather, "weather"), chunk_hours=CUT_HOURS))


@query
def align_merge_latest(spark, sf_dir):
    air_rows, weather = views.air_and_weather(spark, sf_dir)
    return tidy(align_and_merge_latest(stage(air_rows, "air"), stage(weather, "weather"), chunk_hours=CUT_HOURS))


@query
def interpolate_time(spark, sf_dir):
    cells = hourly_cells(spark, sf_dir).select(SITE, TS, *CHANNELS)
    return tidy(gaps.interpolate_time(cells, CHANNELS, chunk_hours=CUT_HOURS))


@query
def ffill_limit(spark, sf_dir):
    return tidy(gaps.ffill_limit(hourly_grid(spark, sf_dir), WEATHER, chunk_hours=CUT_HOURS).select(SITE, TS, *WEATHER))


@query
def smart_fill(spark, sf_dir):
    cells = hourly_cells(spark, sf_dir).select(SITE, TS, *CHANNELS)
    return tidy(gaps.smart_fill(cells, CHANNELS, chunk_hours=CUT_HOURS))


@query
def interpolate_circular(spark, sf_dir):
    cells = hourly_cells(spark, sf_dir).select(SITE, TS, "wind_direction")
    return tidy(gaps.interpolate_circular(cells, ["wind_direction"], chunk_hours=CUT_HOURS))


@query
def clean_hourly(spark, sf_dir):
    cells = hourly_cells(spark, sf_dir)
    return tidy(build_clean(cells, chunk_hours=CUT_HOURS))


# ---- index ------------------------------------------------------------------------------------

@query
def aqi_sub_index(spark, sf_dir):
    cells = views.cells(spark, sf_dir)
    return tidy(cells.select(SITE, TS, *[air.sub_index(F.col(p), air.BANDS[p]).alias(f"{p}_index") for p in POLLUTANTS]))


@query
def aqi_user_bands(spark, sf_dir):
    """A band per part, with gaps between them: the band table grows with the tables."""
    key = F.col("p_partkey").cast("double")
    parts = load_table(configure(spark), sf_dir, "part").select(
        ((key - 1) * 0.5).alias("low"), ((key - 1) * 0.5 + 0.4375).alias("high"), key.alias("index_low"), (key + F.col("p_size")).alias("index_high"))
    bands = parts.withColumn("pollutant", F.explode(F.array(F.lit("pm2_5"), F.lit("o3"))))
    return tidy(sub_indices(hourly_cells(spark, sf_dir), bands, ["pm2_5", "o3"], [SITE, TS]))


@query
def aqi_value(spark, sf_dir):
    return tidy(with_aqi(views.cells(spark, sf_dir)).select(SITE, TS, "aqi"))


@query
def aqi_class(spark, sf_dir):
    cells = views.cells(spark, sf_dir).withColumn("aqi", air.aqi())
    return cells.select(SITE, TS, air.class5(F.col("aqi")).alias("aqi_class"))


@query
def aqi_category(spark, sf_dir):
    cells = views.cells(spark, sf_dir).withColumn("aqi", air.aqi())
    label = air.category6(F.col("aqi"))
    return tidy(cells.select(SITE, TS, safe_round(F.col("aqi"), 2).alias("aqi"), label.alias("category"),
                             air.color_of_value(F.col("aqi")).alias("color"), air.health_tip(label).alias("tip")))


@query
def aqi_class_info(spark, sf_dir):
    cells = views.cells(spark, sf_dir).withColumn("c", air.class5(air.aqi()))
    info = air.class_info(F.col("c"))
    return cells.select(SITE, TS, F.col("c").alias("aqi_class"), info["label"].alias("label"),
                        info["range"].alias("span"), air.class_color(F.col("c")).alias("color"))


# ---- features ---------------------------------------------------------------------------------

@query
def calendar_features(spark, sf_dir):
    return tidy(calendar_columns(views.cells(spark, sf_dir).select(SITE, TS)))


@query
def ratio_features(spark, sf_dir):
    cells = views.cells(spark, sf_dir)
    return tidy(cells.withColumns(ratio_columns(cells.columns)).select(SITE, TS, "pm2_5_pm10_ratio", "no2_o3_ratio"))


@query
def lag_features(spark, sf_dir):
    series = aqi_series(spark, sf_dir)
    series = series.select(SITE, TS, "aqi", *CHANNELS)
    lags = over_rows(series, lambda rows: lag_columns(rows, series.columns), chunk_hours=CUT_HOURS)
    return tidy(lags.drop(*CHANNELS))


@query
def rolling_stats(spark, sf_dir):
    series = aqi_series(spark, sf_dir)
    return tidy(over_rows(series.select(SITE, TS, "aqi"), rolling_columns, back=24, chunk_hours=CUT_HOURS), **ROLL_DIGITS)


@query
def delta_features(spark, sf_dir):
    series = aqi_series(spark, sf_dir)
    return tidy(over_rows(series.select(SITE, TS, "aqi"), delta_columns, back=24, chunk_hours=CUT_HOURS))


@query
def targets_training(spark, sf_dir):
    series = aqi_series(spark, sf_dir)
    series = with_time_index(series.select(SITE, TS, "aqi"), chunk_hours=CUT_HOURS)
    rows = with_target_classes(over_rows(series, target_columns, back=0, ahead=72, chunk_hours=CUT_HOURS))
    rows = keep_complete_targets(rows, TARGETS)
    return tidy(rows.select(SITE, TS, "aqi", *TARGETS))


@query
def features_training(spark, sf_dir):
    return tidy(feature_table(spark, sf_dir), **ROLL_DIGITS)


@query
def features_inference(spark, sf_dir):
    return tidy(feature_table(spark, sf_dir, "inference"), **ROLL_DIGITS)


@query
def feature_select(spark, sf_dir):
    table = feature_table(spark, sf_dir)
    names = quality.feature_names(table)
    return quality.as_rows(table.agg(*[F.count(c).alias(c) for c in names]), "n")


# ---- quality ----------------------------------------------------------------------------------

@query
def missing_ratio(spark, sf_dir):
    ratios = quality.as_rows(quality.missing_ratios(hourly_grid(spark, sf_dir), CHANNELS), "ratio")
    return tidy(ratios.withColumn("dropped", (F.col("ratio") > 0.35).cast("int")))


@query
def constant_columns(spark, sf_dir):
    # A column without values and one with a single value stand beside the channels.
    table = hourly_grid(spark, sf_dir).withColumns({
        "no_value": F.lit(None).cast("double"),
        "one_value": F.when(F.col("co").isNotNull(), F.lit(1.0))})
    flags = quality.constant_flags(table, [*CHANNELS, "no_value", "one_value"])
    return quality.as_rows(flags, "is_constant")


@query
def null_audit(spark, sf_dir):
    return quality.as_rows(quality.null_counts(hourly_grid(spark, sf_dir), CHANNELS), "nulls")


@query
def clip_bounds(spark, sf_dir):
    table = feature_table(spark, sf_dir).select(SITE, TS, "aqi", *TARGETS)
    wide = table.withColumns({"aqi": F.col("aqi") * 3 - 60, TARGETS[0]: F.col(TARGETS[0]) * 4 - 90,
                              TARGETS[1]: F.col(TARGETS[1]) + 2, TARGETS[2]: F.col(TARGETS[2]) - 2})
    return tidy(quality.clip_bounds(wide))


@query
def clean_features_training(spark, sf_dir):
    return tidy(cleaned(spark, sf_dir)[0], **ROLL_DIGITS)


@query
def scoring_history_rows(spark, sf_dir):
    # Every seventh hour was generated four days before its neighbours.
    cells = views.cells(spark, sf_dir).select(SITE, TS, "co")
    late = F.when(F.hour(TS) % 7 == 0, F.col(TS) - F.expr("interval 100 hours")).otherwise(F.col(TS))
    return tidy(scoring_history(cells.withColumn("feature_generated_at", late)))


@query
def inference_row(spark, sf_dir):
    clean, stamp = clean_table(spark, sf_dir), F.expr(STAMP)
    training = stage(build_features(clean, filled=True, generated_at=stamp, chunk_hours=CUT_HOURS), "features")
    profile = quality.fit_profile(training_rows(training, arrival=None), extra_protected=UNAUDITED, medians=True)
    scoring = build_features(clean, "inference", filled=True, generated_at=stamp, chunk_hours=CUT_HOURS)
    # Sites with an odd number come without two readings; the training medians stand in.
    odd = F.col(SITE) % 2 == 1
    scoring = scoring.withColumns({c: F.when(~odd, F.col(c)) for c in ("co", "aqi_lag_24h")})
    return tidy(clean_inference(scoring, profile, generated_at=stamp), **ROLL_DIGITS)


# ---- exploration ------------------------------------------------------------------------------

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def describe_columns(spark, sf_dir):
    return tidy(explore.describe(load_table(configure(spark), sf_dir, "lineitem"), LINE_COLUMNS), std=4)


@query
def histogram(spark, sf_dir):
    return tidy(explore.histogram(load_table(configure(spark), sf_dir, "lineitem"), LINE_COLUMNS, 30))


@query
def kde_grid(spark, sf_dir):
    cells = hourly_cells(spark, sf_dir)
    return tidy(explore.density(cells, ["pm2_5", "pm10", "no2", "o3", "co"], 200), x=4)


CORRELATED = ["aqi", "pm2_5", "pm10", "no2", "o3", "co", "temperature", "humidity", "wind_speed", "pressure",
              "aqi_lag_24h", "aqi_lag_72h"]


@query
def correlation_matrix(spark, sf_dir):
    return tidy(explore.correlation_matrix(feature_table(spark, sf_dir, "inference"), CORRELATED), 4)


@query
def class_distribution(spark, sf_dir):
    return tidy(explore.class_distribution(feature_table(spark, sf_dir), TARGETS[1:]))


@query
def category_distribution(spark, sf_dir):
    newest = recent_per_key(with_aqi(clean_table(spark, sf_dir)).select(SITE, TS, "aqi"), KEYS, TS, 48)
    return explore.category_distribution(newest, F.col("aqi"), KEYS)


@query
def latest_per_site(spark, sf_dir):
    return tidy(latest_per_key(views.cells(spark, sf_dir), KEYS, TS))


@query
def recent_trend_ma3(spark, sf_dir):
    newest = recent_per_key(with_aqi(clean_table(spark, sf_dir)).select(SITE, TS, "aqi"), KEYS, TS, 48)
    # At most 48 rows per site are left.
    return tidy(over_rows(newest, lambda rows: {"aqi_ma": rolling_mean("aqi", rows, 3)}, chunk_hours=None))


# ---- split, balance, sample, scores -----------------------------------------------------------

@query
def train_test_split(spark, sf_dir):
    series = aqi_series(spark, sf_dir)
    return sampling.time_split(series.select(SITE, TS), chunk_hours=CUT_HOURS).withColumn("is_train", F.col("is_train").cast("int"))


@query
def oversample_balance(spark, sf_dir):
    rows = with_aqi(clean_table(spark, sf_dir)).select(SITE, TS, air.class5(F.col("aqi")).alias("aqi_class"))
    return sampling.oversample(stage(rows, "labels"), "aqi_class", [SITE, TS])


@query
def sample_rows(spark, sf_dir):
    return sampling.sample_rows(views.cells(spark, sf_dir).select(SITE, TS), 500, [SITE, TS])


def _naive_forecast(spark, sf_dir):
    series = aqi_series(spark, sf_dir)
    return over_rows(series.select(SITE, TS, "aqi"), lambda rows: {"forecast": lag("aqi", rows, 24)}, back=24,
                     chunk_hours=CUT_HOURS)


@query
def regression_metrics(spark, sf_dir):
    return tidy(scores.regression_scores(_naive_forecast(spark, sf_dir), "aqi", "forecast"))


@query
def classification_metrics(spark, sf_dir):
    classes = _naive_forecast(spark, sf_dir).select(
        SITE, air.class5(F.col("aqi")).alias("actual"), air.class5(F.col("forecast")).alias("called"))
    return tidy(scores.classification_scores(classes, "actual", "called", [SITE]))


# ---- monitoring ---------------------------------------------------------------------------------

@query
def health_check(spark, sf_dir):
    def table(name, ts=None, ties=None):
        return load_table(configure(spark), sf_dir, name), ts, ties

    return health_report({
        "events": table("events", "ts", ["event_id"]),
        "orders": table("orders", "o_orderdate", ["o_orderkey"]),
        "lineitem": table("lineitem", "l_shipdate", ["l_orderkey", "l_linenumber"]),
        "customer": table("customer", None, ["c_custkey"]),
    })


@query
def missing_hours(spark, sf_dir):
    return grid_gaps(views.cells(spark, sf_dir).select(SITE, TS), KEYS, TS)


@query
def relative_age_text(spark, sf_dir):
    models = views.registry(spark, sf_dir)
    return models.select("version", relative_age(F.col("training_date"), F.expr(REVIEW_DAY)).alias("age"))


@query
def day_labels(spark, sf_dir):
    models = views.registry(spark, sf_dir)
    return models.select("version", day_label(F.col("training_date")).alias("day"))


@query
def hourly_aqi_rolling_mean(spark, sf_dir):
    """Flagship: events -> hourly index with its 24 h rolling mean per site."""
    series = aqi_series(spark, sf_dir)
    mean = over_rows(series.select(SITE, TS, "aqi"), lambda rows: {"aqi_roll_mean_24h": rolling_mean("aqi", rows, 24)},
                     back=24, chunk_hours=CUT_HOURS)
    return tidy(mean)
