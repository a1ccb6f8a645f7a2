import numpy as np
import pandas as pd
import pytest
from helpers import START, column, hours, random_series, same

from gridcast.names import CHANNELS
from gridcast.operators import gaps
from gridcast.operators.align import align_and_merge, align_and_merge_latest
from gridcast.plans.clean import build_clean

CHUNKS = [None, 2160, 7]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_interpolation_golden(spark, chunk):
    d = hours(spark, [None, 10, None, ..., ..., 40, None, None, None])
    same(column(gaps.interpolate_time(d, ["v"], chunk_hours=chunk)), [10, 10, 17.5, 40, 40, 40, 40])


@pytest.mark.parametrize("chunk", CHUNKS)
def test_interpolation_equals_pandas(spark, chunk):
    d, pdf = random_series(spark, channels=("v", "u"))
    got = gaps.interpolate_time(d, ["v", "u"], chunk_hours=chunk).orderBy("site", "timestamp").toPandas()
    for site, part in pdf.groupby("site"):
        for c in ("v", "u"):
            want = part.set_index("timestamp")[c].interpolate(method="time").ffill().bfill()
            same(list(got[got.site == site][c]), list(want))


def test_interpolation_is_idempotent_and_skips_empty_columns(spark):
    d, _ = random_series(spark, sites=2, n=100)
    once = gaps.interpolate_time(d, ["v"], chunk_hours=11)
    same(column(gaps.interpolate_time(once, ["v"], chunk_hours=11)), column(once))
    assert column(gaps.interpolate_time(hours(spark, [None, None]), ["v"])) == [None, None]


def test_order_and_other_sites_do_not_matter(spark):
    d, _ = random_series(spark, sites=2, n=120)
    alone = gaps.interpolate_time(d.where("site = 's0'").repartition(3), ["v"], chunk_hours=13)
    both = gaps.interpolate_time(d.orderBy("v"), ["v"], chunk_hours=13).where("site = 's0'")
    assert column(alone) == column(both)


def test_nan_is_a_missing_reading(spark):
    d = hours(spark, [1, float("nan"), 3])
    same(column(gaps.interpolate_time(d, ["v"])), [1, 2, 3])


def test_causal_fill_uses_the_past_only(spark):
    d = hours(spark, [None, 1, None, 5])
    assert column(gaps.interpolate_time(d, ["v"], causal=True)) == [None, 1, 1, 5]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_bounded_forward_fill(spark, chunk):
    d = hours(spark, [1, None, None, None, None, None, 13])
    assert column(gaps.ffill_limit(d, ["v"], 3, chunk_hours=chunk)) == [1, 1, 1, 1, None, None, 13]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_circular(spark, chunk):
    got = column(gaps.interpolate_circular(hours(spark, [350, None, None, 10]), ["v"], chunk_hours=chunk))
    assert abs(got[0] - 350) < 1e-9 and abs(got[3] - 10) < 1e-9
    assert abs((got[1] + got[2]) % 360) < 1e-6 or abs((got[1] + got[2]) % 360 - 360) < 1e-6
    assert all(min(a, 360 - a) < 10 for a in got[1:3])
    assert column(gaps.interpolate_circular(hours(spark, [360.0]), ["v"]))[0] == 0.0


@pytest.mark.parametrize("chunk", CHUNKS)
def test_grid_has_every_hour_and_drops_rows_off_the_grid(spark, chunk):
    d = hours(spark, [1, ..., ..., 4, ..., 6]).union(
        spark.createDataFrame([("a", (START + pd.Timedelta(minutes=90)).to_pydatetime(), 9.0)], "site string, timestamp timestamp, v double"))
    g = gaps.grid_reindex(d, chunk_hours=chunk)
    assert column(g) == [1, None, None, 4, None, 6]
    assert column(g, "is_imputed") == [False, True, True, False, True, False]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_smart_fill(spark, chunk):
    d, pdf = random_series(spark, sites=3, n=60, null=0.5)
    got = gaps.smart_fill(d, ["v"], chunk_hours=chunk).orderBy("site", "timestamp").toPandas()
    for site, part in pdf.groupby("site"):
        same(list(got[got.site == site]["v"]), list(part["v"].ffill().bfill()))
    lone = hours(spark, [1, 2, None, 10]).union(hours(spark, [None, None], site="b"))
    assert column(gaps.smart_fill(lone, ["v"], chunk_hours=chunk)) == [1, 2, 2, 10, 2, 2]


def reference_clean(pdf):
    """The cleaning rules in pandas, for one site."""
    d = pdf.set_index("timestamp").drop(columns="site")

    def circle(s):
        a = np.deg2rad(s)
        parts = [f(a).interpolate(method="time").ffill().bfill() for f in (np.sin, np.cos)]
        return np.rad2deg(np.arctan2(*parts)) % 360

    def fill(d):
        return d.apply(lambda s: circle(s) if s.name == "wind_direction" else s.interpolate(method="time").ffill().bfill())

    d = fill(d)
    full = pd.date_range(d.index.min(), d.index.max(), freq="h")
    return fill(d.reindex(full)) if len(full) > len(d) else d


@pytest.mark.parametrize("chunk", CHUNKS)
def test_build_clean_equals_pandas(spark, chunk):
    d, pdf = random_series(spark, sites=2, n=150, channels=tuple(CHANNELS))
    got = build_clean(d, arrival=[], chunk_hours=chunk).orderBy("site", "timestamp").toPandas()
    for site, part in pdf.groupby("site"):
        want = reference_clean(part)
        mine = got[got.site == site]
        assert list(mine.timestamp) == list(want.index)
        for c in CHANNELS:
            gap = np.abs(mine[c].to_numpy() - want[c].to_numpy())
            if c == "wind_direction":
                gap = np.minimum(gap, 360 - gap)
            assert gap.max() < 1e-6, c


def test_build_clean_keeps_the_last_arrival(spark):
    rows = [("a", START.to_pydatetime(), "1.5", "2024-01-01 01:00:00"), ("a", START.to_pydatetime(), "2.5", "2024-01-01 02:00:00")]
    d = spark.createDataFrame(rows, "site string, timestamp timestamp, pm2_5 string, ingested_at string")
    assert column(build_clean(d), "pm2_5") == [2.5]


def two_sources(spark):
    air = hours(spark, [None, 10, ..., 30], name="pm2_5")
    weather = hours(spark, [1, ..., ..., ..., ..., ..., 13], name="temperature", start=START - pd.Timedelta(hours=1))
    return air, weather


@pytest.mark.parametrize("chunk", CHUNKS)
def test_history_merge_spans_both_sources(spark, chunk):
    m = align_and_merge(*two_sources(spark), chunk_hours=chunk)
    # Weather is carried three hours from -1, then goes linearly from hour 2 to hour 5.
    same(column(m, "temperature"), [1, 1, 1, 1, 5, 9, 13])
    same(column(m, "pm2_5"), [10, 10, 10, 20, 30, 30, 30])


def test_history_merge_left_extent(spark):
    m = align_and_merge(*two_sources(spark), extent="left")
    same(column(m, "pm2_5"), [10, 10, 20, 30])


@pytest.mark.parametrize("chunk", CHUNKS)
def test_hourly_merge_keeps_the_pollutant_hours(spark, chunk):
    air, weather = two_sources(spark)
    m = align_and_merge_latest(air, weather, chunk_hours=chunk)
    same(column(m, "pm2_5"), [10, 10, 20, 30])
    assert column(m, "temperature") == [None] * 4  # both weather rows lie outside the hours
    inside = hours(spark, [..., 2, ..., 6], name="temperature")
    same(column(align_and_merge_latest(air, inside, chunk_hours=chunk), "temperature"), [2, 2, 4, 6])
