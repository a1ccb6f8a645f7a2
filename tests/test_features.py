import math

import numpy as np
import pandas as pd
import pytest
from helpers import START, column, hours, random_series, same
from pyspark.sql import functions as F

from gridcast.functions import airquality as air
from gridcast.functions.clock import calendar_columns, relative_age
from gridcast.functions.coerce import clip, finite, safe_round, to_number
from gridcast.names import CHANNELS, TARGETS
from gridcast.operators.bands import sub_indices
from gridcast.operators.rowspan import over_rows, rolling_mean, rolling_std, with_time_index
from gridcast.plans.clean import build_clean
from gridcast.plans.features import build_features, ratio_columns, with_aqi


def values(spark, xs, fn):
    d = spark.createDataFrame([(i, None if x is None else float(x)) for i, x in enumerate(xs)], "i int, x double")
    return [r.y for r in d.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_sub_index_golden(spark):
    got = values(spark, [0, 6, 12.0, 12.1, 20, 35.4, 40, 12.05, 35.45, -1, 500.5, None, float("nan")],
                 lambda c: air.sub_index(c, air.BANDS["pm2_5"]))
    same(got, [0, 25, 50, 51, 67.61373390557941, 100, 112.08040201005025] + [None] * 6)
    same(values(spark, [200, 200.1], lambda c: air.sub_index(c, air.BANDS["o3"])), [300, None])


def test_index_is_the_largest_sub_index_and_needs_one(spark):
    d = spark.createDataFrame([(40.0, 12.0, None), (12.05, None, None)], "pm2_5 double, pm10 double, no2 double")
    same(column(with_aqi(d), "aqi", ("pm2_5",)), [112.08040201005025])


BAND = "pollutant string, low double, high double, index_low double, index_high double"


def test_band_table_gives_what_the_list_gives(spark):
    rows = [(p, float(b[0]), float(b[1]), float(b[2]), float(b[3])) for p in ("pm2_5", "o3") for b in air.BANDS[p]]
    x = [0.0, 6.0, 12.0, 12.05, 12.1, 20.0, 35.4, 500.4, 500.5, -1.0, 200.0, None, float("nan"), float("inf")]
    d = spark.createDataFrame(list(enumerate(x)), "i int, pm2_5 double").withColumn("o3", F.col("pm2_5") / 2)
    got = sub_indices(d, spark.createDataFrame(rows, BAND), ["pm2_5", "o3"], ["i"])
    assert got.count() == len(x)
    want = d.select("i", *[air.sub_index(F.col(p), air.BANDS[p]).alias(f"{p}_index") for p in ("pm2_5", "o3")])
    for c in ("pm2_5_index", "o3_index"):
        same(column(got, c, ("i",)), column(want, c, ("i",)))


def test_odd_bands(spark):
    rows = [("x", 0.0, 0.0, 7.0, 9.0), ("x", 5.0, 5.0, 3.0, 4.0), ("x", 1.0, 1e12, 10.0, 10.0), ("x", 2.0, 3.0, 0.0, 1.0),
            ("x", 9.0, 8.0, 1.0, 2.0), ("x", None, 8.0, 1.0, 2.0), ("x", -3.0, -1e-9, 100.0, 200.0), ("y", 0.0, 10.0, 0.0, 100.0)]
    bands = spark.createDataFrame(rows, BAND)
    d = spark.createDataFrame([(i, float(x), float(x)) for i, x in enumerate([0, 5, 2.5, 0.5, 1e12, -3, 1e300])], "i int, x double, z double")
    got = sub_indices(d, bands, ["x", "z"], ["i"])
    same(column(got, "x_index", ("i",)), [7, 10, 10, None, 10, 100, None])  # the band that starts first counts
    assert column(got, "z_index", ("i",)) == [None] * 7
    same(column(sub_indices(d, bands.where("pollutant = 'y'").withColumn("pollutant", F.lit("x")), ["x"], ["i"], {"x": 2.0}), "x_index", ("i",)),
         [0, 100, 50, 10, None, None, None])
    assert sub_indices(d, bands.limit(0), ["x"], ["i"]).where("x_index IS NULL").count() == 7


def test_a_hundred_thousand_bands(spark):
    n = 100_000
    # Widths from 2^-20 to 2^20: uneven, and with gaps.
    width = F.pow(F.lit(2.0), (F.col("id") % 41 - 20).cast("double"))
    lows = np.concatenate([[0.0], np.cumsum(2.0 ** (np.arange(n - 1) % 41 - 20.0) * 2)])
    low = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "low": lows}))
    number = F.col("id").cast("double")
    bands = low.select(F.lit("x").alias("pollutant"), "low", (F.col("low") + width).alias("high"), number.alias("index_low"), number.alias("index_high"))
    x = np.random.default_rng(0).uniform(0, lows[-1], 20_000)
    x[:5000] = x[0]
    d = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(x)), "x": x}))
    got = column(sub_indices(d, bands, ["x"], ["i"]), "x_index", ("i",))
    at = np.searchsorted(lows, x, side="right") - 1
    inside = (at >= 0) & (x <= lows[at] + 2.0 ** (at % 41 - 20.0))
    same(got, [float(a) if k else None for a, k in zip(at, inside)])


def test_classes_and_categories(spark):
    assert values(spark, [50, 50.01, 100, 150, 200, 200.01, None], air.class5) == [1, 2, 2, 3, 4, 5, None]
    assert values(spark, [50, 100, 150, 200, 300, 300.01, None], air.category6) == [*air.CATEGORIES, "Unknown"]
    assert values(spark, [50, None], air.color_of_value) == ["#2ecc71", "#95a5a6"]
    assert values(spark, [0, 5, 6, None], air.class_label) == ["Good", "Hazardous", "Unknown", "Unknown"]
    assert [tuple(r) for r in values(spark, [1, 9], air.class_info)] == [("Moderate", "51 – 100"), ("Unknown", "N/A")]
    assert values(spark, [250, None], lambda c: air.health_tip(air.category6(c))) == [air.TIPS[4], ""]


def test_text_is_no_category(spark):
    d = spark.createDataFrame([("x",), ("75",)], "v string")
    assert [r[0] for r in d.select(air.category6(F.col("v"))).collect()] == ["Unknown", "Moderate"]


def test_coercions(spark):
    assert values(spark, [float("inf"), float("-inf"), float("nan"), 2, None], finite) == [None, None, None, 2, None]
    assert values(spark, [-5, 600, 7, None], lambda c: clip(c, 0, 500)) == [0, 500, 7, None]
    assert values(spark, [1.236, None], safe_round) == [1.24, None]
    d = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in d.select(to_number(F.col("v"))).collect()] == [1.5, None, None]


def test_relative_age(spark):
    now = F.lit("2024-01-10 12:00:00").cast("timestamp")
    ages = {"2024-01-10 11:59:30": "Just now", "2024-01-10 11:58:59": "1 minutes ago", "2024-01-10 10:00:00": "2 hours ago",
            "2024-01-08 11:00:00": "2 days ago", None: "N/A"}
    d = spark.createDataFrame([(k, v) for k, v in ages.items()], "t string, want string")
    for r in d.select("want", relative_age(F.col("t").cast("timestamp"), now).alias("got")).collect():
        assert r.got == r.want


def test_calendar(spark):
    r = calendar_columns(hours(spark, range(150))).orderBy("timestamp").collect()
    assert (r[0].day_of_week, r[0].hour, r[0].month, r[0].is_weekend) == (0, 0, 1, 0)
    assert r[5 * 24].is_weekend == 1
    assert math.isclose(r[6].hour_sin, 1) and math.isclose(r[24].dow_sin, math.sin(2 * math.pi / 7))


def test_ratio_never_divides_by_zero(spark):
    d = spark.createDataFrame([(1.0, -1e-6), (3.0, 2.0)], "pm2_5 double, pm10 double")
    got = column(d.withColumns(ratio_columns(d.columns)), "pm2_5_pm10_ratio", ("pm2_5",))
    assert got[0] is None and math.isclose(got[1], 3 / (2 + 1e-6))


def test_rolling_needs_a_full_window(spark):
    d = hours(spark, [1, 2, None, 4, 5, 6])
    got = over_rows(d, lambda w: {"m": rolling_mean("v", w, 3)}, back=3, chunk_hours=4)
    same(column(got, "m"), [None, None, None, None, None, 5])


@pytest.mark.parametrize("chunk", [None, 72, 100, 2160])
def test_windows_equal_pandas_for_every_chunk(spark, chunk):
    d, pdf = random_series(spark, sites=2, n=500, null=0.0, drop=0.3)
    got = over_rows(d, lambda w: {
        "lag": f"lag(v, 72) {w.all}", "lead": f"lead(v, 48) {w.all}", "sd": rolling_std("v", w, 24)},
        back=72, ahead=72, chunk_hours=chunk).orderBy("site", "timestamp").toPandas()
    assert len(got) == len(pdf)
    for site, part in pdf.groupby("site"):
        mine = got[got.site == site]
        for name, want in (("lag", part.v.shift(72)), ("lead", part.v.shift(-48)), ("sd", part.v.rolling(24).std())):
            assert mine[name].isna().tolist() == want.isna().tolist()
            assert abs(mine[name].fillna(0).to_numpy() - want.fillna(0).to_numpy()).max() < 1e-6


def test_row_numbers_do_not_depend_on_buckets(spark):
    d, pdf = random_series(spark, sites=2, n=200, drop=0.5)
    for chunk in (None, 10, 1000):
        got = with_time_index(d, chunk_hours=chunk).orderBy("site", "timestamp").toPandas()
        for site, part in pdf.groupby("site"):
            mine = got[got.site == site]
            assert list(mine._index) == list(range(len(part))) and set(mine._total) == {len(part)}


def feature_input(spark, n, sites=1):
    d, _ = random_series(spark, sites=sites, n=n, channels=tuple(CHANNELS), drop=0.0, null=0.2)
    tags = {"city": F.lit("x"), "source": F.lit("y"), "ingested_at": F.current_timestamp()}
    return build_clean(d.withColumns(tags), arrival=[])


@pytest.mark.parametrize("chunk", [None, 80])
def test_feature_table_shape(spark, chunk):
    clean = feature_input(spark, 200)
    kept = with_aqi(clean).count()
    training = build_features(clean, filled=True, chunk_hours=chunk)
    inference = build_features(clean, "inference", filled=True, chunk_hours=chunk)
    # 86 / 90 columns, besides the key and the mark of added hours.
    assert len(inference.columns) - 2 == 86 and len(training.columns) - 2 == 90
    assert inference.count() == kept and training.count() == kept - 72
    assert set(TARGETS) <= set(training.columns)


def test_short_sites_keep_their_rows_without_targets(spark):
    t = build_features(feature_input(spark, 60), filled=True)
    assert t.where(F.col(TARGETS[0]).isNotNull()).count() == 0 and t.count() > 0


def test_dropped_hours_shift_lags(spark):
    # 12.05 lies between two bands: the row drops out, and lag 1 reaches back two hours.
    d = hours(spark, [10, 12.05, 20], name="pm2_5")
    f = build_features(d, "inference")
    assert f.count() == 2
    same(column(f, "aqi_lag_1h"), [None, column(with_aqi(d), "aqi")[0]])
