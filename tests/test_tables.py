import random
import datetime as dt
import json
import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pytest
from helpers import START, column, hours, random_series, same
from pyspark.sql import functions as F

from gridcast.names import POLLUTION_PAYLOAD, TARGETS, WEATHER_PAYLOAD
from gridcast.operators import explore, quality, registry as reg, sampling, scores
from gridcast.operators.dedup import keep_first, keep_last, latest_per_key, recent_per_key
from gridcast.operators.monitor import grid_gaps, latest_predictions, table_health
from gridcast.operators import quantiles
from gridcast.operators.quantiles import exact_quantiles
from gridcast.plans.gate import clean_inference, clean_training
from gridcast.plans.scoring import scoring_history, scoring_rows
from gridcast.session import scratch_path, scratch_root, stage
from gridcast.sources import landing, store, tables, versions


# ---- sources and sinks -------------------------------------------------------------------

def test_pollution_payload_files(spark, tmp_path):
    at = int(START.timestamp())
    body = {"list": [{"dt": at + 5, "components": {"pm2_5": 1.0}}, {"dt": at + 3000, "components": {"pm2_5": 2.0}},
                     {"dt": at + 3700, "components": {"pm10": 3.5, "no2": 1}}]}
    (tmp_path / "site=a").mkdir()
    (tmp_path / "site=a" / "one.json").write_text(json.dumps(body, indent=1))
    rows = landing.pollution_rows(landing.read_payloads(spark, str(tmp_path), POLLUTION_PAYLOAD, {"site": "string"}))
    got = rows.orderBy("timestamp").collect()
    assert [(r.site, r.pm2_5, r.pm10) for r in got] == [("a", 1.0, None), ("a", None, 3.5)]
    assert got[0].timestamp == START.to_pydatetime()


def test_empty_history_is_an_error(spark):
    empty = spark.createDataFrame([("a", '{"list": []}')], "site string, body string").select(
        "site", landing.parse_payload(F.col("body"), POLLUTION_PAYLOAD)["list"].alias("list"))
    assert landing.pollution_rows(empty).count() == 0
    with pytest.raises(ValueError):
        landing.pollution_rows(empty, require_rows=True)


def test_weather_payload(spark):
    body = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "bad"], "temperature_2m": [1.0, None, 3],
                       "wind_direction_10m": [350, 10, 20]}}
    d = spark.createDataFrame([("a", json.dumps(body))], "site string, body string").select(
        "site", landing.parse_payload(F.col("body"), WEATHER_PAYLOAD).alias("p")).select("site", "p.*")
    got = landing.weather_rows(d).orderBy("timestamp").collect()
    assert [(r.temperature, r.wind_direction, r.humidity) for r in got] == [(1.0, 350.0, None), (None, 10.0, None)]


def test_upsert_overwrites_supplied_fields_even_with_null(spark):
    target = spark.createDataFrame([("a", 1, 1.0, "x"), ("a", 2, 2.0, "y")], "site string, t int, v double, keep string")
    source = spark.createDataFrame([("a", 2, None), ("a", 3, 3.0)], "site string, t int, v double")
    merged = store.merge_upsert(target, source, ["site", "t"])
    want = [("a", 1, 1.0, "x"), ("a", 2, None, "y"), ("a", 3, 3.0, None)]
    assert [tuple(r) for r in merged.orderBy("t").collect()] == want
    again = store.merge_upsert(merged, source, ["site", "t"])
    assert [tuple(r) for r in again.orderBy("t").collect()] == want
    assert tuple(store.merge_report(target, source, ["site", "t"]).first()) == (1, 1, 1)
    assert tuple(store.merge_report(merged, source, ["site", "t"]).first()) == (0, 2, 0)


def test_upsert_last_arrival_wins_and_new_columns_appear(spark):
    target = spark.createDataFrame([("a", 1)], "site string, t int")
    source = spark.createDataFrame([("a", 1, 5.0, 1), ("a", 1, 6.0, 2)], "site string, t int, v double, n int")
    assert column(store.merge_upsert(target, source, ["site", "t"], ["n"]), "v", ("t",)) == [6.0]


def test_upsert_without_arrival_refuses_repeated_keys(spark):
    target = spark.createDataFrame([("a", 1, 1.0)], "site string, t int, v double")
    twice = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 6.0)], "site string, t int, v double")
    for run in (store.merge_upsert, store.merge_report):
        with pytest.raises(Exception, match="a key repeats"):
            run(target, twice, ["site", "t"]).collect()
    with pytest.raises(Exception, match="a key repeats"):
        store.upsert_published(twice, scratch_path(spark, "published"), ["site", "t"])


def test_upsert_matches_null_keys(spark):
    target = spark.createDataFrame([("a", None, 1.0), (None, 1, 2.0)], "site string, t int, v double")
    merged = store.merge_upsert(target, target.withColumn("v", F.col("v") + 1), ["site", "t"])
    assert sorted((r.site or "", r.t or 0, r.v) for r in merged.collect()) == [("", 1, 3.0), ("a", 0, 2.0)]


def test_day_upserts_keep_rows_without_a_time(spark):
    root, kinds = scratch_path(spark, "days"), "site int, timestamp timestamp, v int"
    noon = dt.datetime(2024, 1, 1, 12)
    store.upsert_days(spark.createDataFrame([(2, None, 2), (2, noon, 7)], kinds), root, ["site", "timestamp"])
    store.upsert_days(spark.createDataFrame([(3, None, 9), (2, None, 4)], kinds), root, ["site", "timestamp"])
    store.upsert_days(spark.createDataFrame([(2, noon, 8)], kinds), root, ["site", "timestamp"])
    got = sorted((r.site, r.timestamp is None, r.v) for r in store.read_days(spark, root).collect())
    assert got == [(2, False, 8), (2, True, 4), (3, True, 9)]
    with pytest.raises(Exception, match="a key repeats"):
        store.upsert_days(spark.createDataFrame([(2, noon, 8), (2, noon, 9)], kinds), root, ["site", "timestamp"])


@pytest.mark.parametrize("seed", range(4))
def test_newest_fetch_wins_whatever_the_order(spark, seed):
    def body(*values):
        return json.dumps({"list": [{"dt": 0, "components": {"co": v}} for v in values]})

    rows = [("a", 1, body(1.0, 9.0)), ("a", 3, body(3.0, 8.0)), ("a", 2, body(2.0)), ("a", None, body(4.0))]
    random.Random(seed).shuffle(rows)
    d = spark.createDataFrame(rows, "site string, at long, body string").repartition(seed + 1).select(
        "site", F.timestamp_seconds("at").alias("fetched_at"), landing.parse_payload(F.col("body"), POLLUTION_PAYLOAD).alias("p"))
    assert [r.co for r in landing.pollution_rows(d.select("site", "fetched_at", "p.*")).collect()] == [3.0]


def test_oversample_in_blocks(spark):
    d = spark.createDataFrame([(i, int(i == 0)) for i in range(100)], "i int, y int")
    got = sampling.oversample(d, "y", ["i"], block=7)
    rare = sorted(r.copy for r in got.where("y = 1").collect())
    assert rare == list(range(1, 100)) and got.count() == 198
    assert [(r.y, r.n) for r in sampling.copy_counts(d, "y", ["i"]).groupBy("y").agg(F.sum("copies").alias("n")).orderBy("y").collect()] == [(0, 99), (1, 99)]


def test_published_versions(spark):
    root = scratch_path(spark, "published")
    assert store.read_published(spark, root) is None
    d = hours(spark, [1, 2])
    assert store.upsert_published(d, root) == 1
    assert store.upsert_published(hours(spark, [9, ..., 3]), root) == 2
    assert column(store.read_published(spark, root)) == [9, 2, 3]
    assert column(store.read_published(spark, root, 1)) == [1, 2]


def test_a_version_number_is_given_once(spark, tmp_path):
    path = str(tmp_path / "x.json")
    assert versions.create(spark, path, "a") and not versions.create(spark, path, "b")
    for name in ("p", "q"):
        (tmp_path / name).write_text(name)
    other = str(tmp_path / "y.json")
    assert versions._rename(spark, str(tmp_path / "p"), other) and not versions._rename(spark, str(tmp_path / "q"), other)
    assert (tmp_path / "x.json").read_text() == "a" and (tmp_path / "y.json").read_text() == "p"


@pytest.mark.parametrize("upsert", [store.upsert_days, store.upsert_published])
def test_two_writers_lose_no_row(spark, upsert):
    root = scratch_path(spark, "shared")
    upsert(hours(spark, [0] * 30), root)
    # Both change the first day; each adds rows and a site of its own.
    sources = [hours(spark, [5, *[...] * 40, i], site=s) for i, s in enumerate("ab")] + [hours(spark, [..., 7])]
    with ThreadPoolExecutor(3) as pool:
        numbers = list(pool.map(lambda d: upsert(d, root), sources))
    assert sorted(numbers) == [2, 3, 4]
    got = {(r.site, r.timestamp.day, r.timestamp.hour): r.v for r in store.read_published(spark, root).collect()}
    assert len(got) == 30 + 1 + 2 and got["a", 1, 0] == 5 and got["b", 1, 0] == 5 and got["a", 1, 1] == 7
    assert got["a", 2, 17] == 0 and got["b", 2, 17] == 1


def test_a_reader_sees_all_days_of_a_write_or_none(spark, monkeypatch):
    root = scratch_path(spark, "shared")
    store.upsert_days(hours(spark, [1] * 30), root)
    before, seen = store.read_days(spark, root), []
    commit = versions.commit

    def watched(*args):
        seen.append(column(store.read_days(spark, root)))
        return commit(*args)

    monkeypatch.setattr(versions, "commit", watched)
    store.upsert_days(hours(spark, [2] * 30), root)
    assert seen == [[1] * 30] and column(before) == [1] * 30 and column(store.read_days(spark, root)) == [2] * 30
    assert column(store.read_days(spark, root, first="2024-01-02")) == [2] * 6


def test_old_versions_expire_and_columns_appear(spark):
    root = scratch_path(spark, "shared")
    store.upsert_days(hours(spark, [1] * 30), root)
    store.upsert_days(hours(spark, [..., 2]).withColumn("w", F.lit(3.0)), root)
    store.upsert_days(hours(spark, [..., 4]), root)
    assert store.expire_versions(spark, root, keep=1) == 2  # the first day as it was twice
    d = store.read_days(spark, root)
    assert column(d)[:3] == [1, 4, 1] and column(d, "w")[:3] == [None, 3, None] and d.count() == 30
    with pytest.raises(ValueError, match="column v is double in the table, string"):
        versions.commit(spark, root, versions.newest(spark, root), {}, d.select(F.lit("x").alias("v")).schema)


def test_csv_round_trip_and_empty_export(spark, tmp_path):
    d = hours(spark, [1.5, None])
    path = tables.write_csv(d, str(tmp_path / "out"))
    back = tables.read_csv(spark, path, d.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, d.collect()), key=str)
    with pytest.raises(ValueError):
        tables.write_csv(d.limit(0), str(tmp_path / "none"))


def test_recent_rows_reach_the_scan_as_a_filter(spark, tmp_path):
    hours(spark, range(10)).write.parquet(str(tmp_path / "t"))
    now = F.expr("timestamp'2024-01-01 09:00:00'")
    d = tables.recent(spark.read.parquet(str(tmp_path / "t")), now, hours=3)
    assert column(d) == [6, 7, 8, 9]
    plan = d._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(timestamp" in plan


def test_scratch_is_the_folder_the_session_names(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    staged = stage(spark.range(3).toDF("i"), "numbers")
    assert staged.count() == 3 and staged.inputFiles()[0].startswith("file:")


# ---- dedup, newest rows --------------------------------------------------------------------

def test_first_last_latest_recent(spark):
    d = spark.createDataFrame([("a", 1, 3, "x"), ("a", 1, 1, "y"), ("a", 2, 5, "z"), ("b", 1, None, "w")],
                              "k string, t int, n int, v string")
    assert column(keep_first(d, ["k", "t"], ["n"]), "v", ("k", "t")) == ["y", "z", "w"]
    assert column(keep_last(d, ["k", "t"], ["n"]), "v", ("k", "t")) == ["x", "z", "w"]
    assert column(latest_per_key(d, ["k"], "t"), "v", ("k",)) == ["z", "w"]
    assert recent_per_key(d, ["k"], "t", 2, ["n"]).count() == 3


def test_dedup_limits_before_the_shuffle(spark):
    d = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    plan = latest_per_key(d, ["k"], "t")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


# ---- quality ---------------------------------------------------------------------------------

def quality_table(spark):
    rows = []
    for i in range(20):
        rows.append(("a", (START + pd.Timedelta(hours=i)).to_pydatetime(), float(700 if i == 3 else i), 1.0,
                     None if i < 8 else 1.0 * i, None if i < 5 else float(i), float("inf") if i == 2 else 2.0 * i,
                     float(i), 2, 3, 4 if i else 9, "city"))
    return spark.createDataFrame(rows, "site string, timestamp timestamp, aqi double, same double, sparse double, "
                                 "late double, wild double, " + f"{TARGETS[0]} double, "
                                 + ", ".join(f"{t} int" for t in TARGETS[1:]) + ", city string")


@pytest.mark.parametrize("chunk", [None, 6])
def test_gate_training_then_inference(spark, chunk):
    table = quality_table(spark)
    done, profile = clean_training(table, audit=True, chunk_hours=chunk)
    assert profile.dropped_missing == ["sparse"] and profile.dropped_constant == ["same"]
    got = done.orderBy("timestamp").toPandas()
    assert list(got.late[:6]) == [5, 5, 5, 5, 5, 5] and got.wild[2] == 2.0 and got.aqi.max() == 500
    assert got[TARGETS[3]].max() == 5 and set(got.rows_after_cleaning) == {20}
    # One scored row must not count as constant: the profile decides, not the row itself.
    row = clean_inference(table.drop(*TARGETS), profile)
    assert row.count() == 1 and {"late", "wild"} <= set(row.columns) and not {"same", "sparse"} & set(row.columns)
    assert row.first()[TARGETS[0]] is None
    # A reading that the scored row lacks becomes the median of the training rows.
    newest = table.drop(*TARGETS).withColumns({c: F.lit(None).cast("double") for c in ("late", "wild")})
    filled = clean_inference(newest, profile).first()
    assert (filled.late, filled.wild) == (12, 20)
    with pytest.raises(ValueError, match="late"):
        clean_inference(newest, clean_training(table, chunk_hours=chunk, medians=False)[1])


def test_scoring_rests_on_the_rows_generated_last(spark):
    def at(h):
        return (START + pd.Timedelta(hours=h)).to_pydatetime()

    rows = [("a", at(i), at(1000 + i)) for i in range(100)] + [("a", at(500), at(900)), ("b", at(3), None), ("b", at(1), at(7))]
    d = spark.createDataFrame(rows, "site string, timestamp timestamp, feature_generated_at timestamp")
    kept = scoring_history(d).where("site = 'a'")
    assert kept.count() == 73 and kept.agg(F.min("timestamp")).first()[0] == at(27)
    assert {r.site: r.timestamp for r in scoring_rows(d).collect()} == {"a": at(99), "b": at(3)}
    assert {r.site: r.timestamp for r in scoring_rows(d.drop("feature_generated_at")).collect()} == {"a": at(500), "b": at(3)}


def test_targets_are_required(spark):
    with pytest.raises(ValueError, match="missing target"):
        clean_training(quality_table(spark).drop(TARGETS[0]))


def test_audit_names_the_column(spark):
    with pytest.raises(ValueError, match="late"):
        quality.assert_no_nulls(quality_table(spark), ["sparse"])


def test_all_null_column_is_constant(spark):
    d = spark.createDataFrame([(None, 1.0, 1.0), (None, 1.0, 2.0)], "a double, b double, c double")
    assert tuple(quality.constant_flags(d, ["a", "b", "c"]).first()) == (True, True, False)


# ---- exploration -----------------------------------------------------------------------------

def test_heavy_tails_take_no_further_passes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.column_stack([np.exp(rng.normal(0, 12, 40_000)), rng.standard_cauchy(40_000) ** 3, rng.integers(0, 3, 40_000) * 1e9])
    d = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")))
    cuts = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: cuts.append(narrow(*a)) or cuts[-1])
    probs = [0.0, 0.25, 0.5, 0.75, 0.9999, 1.0]
    got = exact_quantiles(d, list("abc"), probs)
    assert cuts == [False]  # after the sketch and the count, every bin is short
    for c, want in zip("abc", np.quantile(x, probs, axis=0).T):
        assert got[c] == pytest.approx(list(want), rel=1e-12)


def test_a_sketch_that_is_off_costs_passes_and_no_exactness(spark, monkeypatch):
    x = np.random.default_rng(4).lognormal(0, 3, 3000)
    d = spark.createDataFrame(pd.DataFrame({"a": x}))
    monkeypatch.setattr(quantiles, "_sketched", lambda *_: {"a": (3000, [(0.5, 0.6), (2.0, 2.0), (9.0, 40.0)])})
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    assert exact_quantiles(d, ["a"], probs, 20)["a"] == pytest.approx(list(np.quantile(x, probs)), rel=1e-12)


def test_quantiles_are_exact_while_narrowing(spark):
    rng = np.random.default_rng(3)
    n = 4000
    pdf = pd.DataFrame({"a": rng.lognormal(0, 3, n), "b": np.where(rng.random(n) < 0.4, 5.0, rng.normal(size=n)),
                        "c": np.full(n, 7.0)})
    d = spark.createDataFrame(pdf).repartition(5)
    for direct in (20, 100_000):
        got = exact_quantiles(d, list("abc"), [0.0, 0.25, 0.5, 0.999, 1.0], direct)
        for c in "abc":
            assert np.allclose(got[c], np.percentile(pdf[c], [0, 25, 50, 99.9, 100]), rtol=1e-12)


def test_describe_golden(spark):
    d = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 10.0, None)], "v double")
    r = explore.describe(d, ["v"]).first()
    same([r.n, r.mean, r["std"], r["min"], r.p25, r.p50, r["max"]], [4, 4, 4.08248290463863, 1, 1.75, 2.5, 10])


def test_histogram_closes_the_last_bin(spark):
    d = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    got = {r.bin: r.n for r in explore.histogram(d, ["v"], 5).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}


def test_density_integrates_to_one(spark):
    d = spark.createDataFrame(pd.DataFrame({"v": np.random.default_rng(0).normal(size=300)}))
    g = explore.density(d, ["v"], 200).orderBy("x").toPandas()
    area = ((g.density[1:].to_numpy() + g.density[:-1].to_numpy()) / 2 * np.diff(g.x)).sum()
    assert abs(area - 1) < 0.01


def test_correlations_equal_pandas(spark):
    pdf = pd.DataFrame(np.random.default_rng(1).normal(size=(50, 3)), columns=list("abc"))
    pdf.loc[:5, "a"] = None
    want = pdf.corr()
    for r in explore.correlation_matrix(spark.createDataFrame(pdf).replace(float("nan"), None), list("abc")).collect():
        assert abs(r["corr"] - want.loc[r.column_a, r.column_b]) < 1e-9


def test_correlations_with_large_means_gaps_and_constants(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)) + 1e8, columns=list("abc"))
    pdf["d"], pdf["e"], pdf["f"] = 0.1, pdf.a.where(pdf.index < 200), pdf.b.where(pdf.index >= 200)
    pdf.loc[5, "c"] = np.inf
    want = pdf.replace(np.inf, np.nan).corr()
    got = explore.correlation_matrix(spark.createDataFrame(pdf).repartition(7), list("abcdef")).collect()
    assert len(got) == 36
    for r in got:
        x = want.loc[r.column_a, r.column_b]
        assert r["corr"] is None if "d" in (r.column_a, r.column_b) or math.isnan(x) else abs(r["corr"] - x) < 1e-7, r
    empty = explore.correlation_matrix(spark.createDataFrame(pdf).limit(0), ["a", "b"])
    assert [r["corr"] for r in empty.collect()] == [None] * 4


def test_correlation_is_one_pass_of_small_rows(spark):
    d = spark.range(100).selectExpr("id * 1.0 AS a", "id * id * 1.0 AS b")
    plan = explore.correlation_matrix(d, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning(a") <= 2


def test_categories_appear_with_zero(spark):
    d = hours(spark, [10, 60, 70])
    got = explore.category_distribution(d, F.col("v"), ["site"]).orderBy("position").collect()
    assert [r.n for r in got] == [1, 2, 0, 0, 0, 0]


# ---- split, balance, scores --------------------------------------------------------------------

@pytest.mark.parametrize("chunk", [None, 3])
def test_split_by_time(spark, chunk):
    d = sampling.time_split(hours(spark, range(10)), chunk_hours=chunk).orderBy("timestamp").collect()
    assert [r.is_train for r in d] == [True] * 8 + [False] * 2


def test_oversample_counts_and_determinism(spark):
    rows = [(i, 1 if i < 5 else 2) for i in range(17)]
    d = spark.createDataFrame(rows, "i int, y int")
    one, two = sampling.oversample(d, "y", ["i"]), sampling.oversample(d.repartition(7), "y", ["i"], part_rows=1)
    assert {r.y: r["count"] for r in one.groupBy("y").count().collect()} == {1: 12, 2: 12}
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert {r.i for r in one.collect()} == set(range(17))
    weights = {r.y: r.weight for r in sampling.balance_weights(d, "y").collect()}
    assert abs(weights[1] - 17 / 10) < 1e-12 and abs(weights[2] - 17 / 24) < 1e-12


def test_sample_size_and_repeatability(spark):
    d, _ = random_series(spark, sites=1, n=100)
    a, b = (sampling.sample_rows(x, 10, ["site", "timestamp"]).collect() for x in (d, d.repartition(5)))
    assert len(a) == 10 and sorted(a) == sorted(b)


def test_scores(spark):
    d = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0), (None, 1.0)], "a double, p double")
    r = scores.regression_scores(d, "a", "p").first()
    same([r.n, r.rmse, r.mae, r.r2], [3, (5 / 3) ** 0.5, 1, 1 - 5 / 2])
    c = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 1)], "a int, p int")
    r = scores.classification_scores(c, "a", "p").first()
    same([r.n, r.accuracy, r.f1_weighted], [4, 0.5, (2 * 0.5 + 1 * (2 / 3) + 0) / 4])


# ---- registry and monitoring --------------------------------------------------------------------

def models(spark):
    rows = [("t", "v1", "active", 0.5, 1), ("t", "v9", None, 0.7, 2), ("t", "v10", "archived", 0.7, 3), ("u", "x", "active", 0.1, 4)]
    return spark.createDataFrame(rows, "target string, version string, status string, score double, id int")


def test_versions_count_as_numbers(spark):
    assert {r.target: r.next_version for r in reg.next_versions(models(spark)).collect()} == {"t": "v11", "u": "v1"}


def test_best_archive_counts(spark):
    m = models(spark)
    assert column(reg.best_models(m), "version", ("target",)) == ["v9", "x"]
    assert column(reg.archive_active(m, ["t"]), "status", ("id",)) == ["archived", None, "archived", "active"]
    assert tuple(reg.registry_counts(reg.flat_registry(m)).first()) == (4, 2, 1)


def test_flat_registry_and_metric_presence(spark):
    d = spark.createDataFrame([("m", "regression", "active", (1.0, None), START.to_pydatetime(), "v1")],
                              "model_name string, task_type string, status string, metrics struct<rmse:double,accuracy:double>, "
                              "training_date timestamp, version string")
    flat = reg.flat_registry(d)
    r = flat.first()
    assert (r.status, r.training_date, r.rmse, r.f1) == ("Active", "2024-01-01 00:00", 1.0, None)
    assert reg.display_columns(flat).columns == ["model_name", "version", "training_date", "task_type", "rmse", "status"]


def test_health_and_gaps(spark):
    d = hours(spark, [1, ..., None])
    r = table_health(d, "t").first()
    assert (r.total_rows, r["columns"], r.nulls_in_latest) == (2, 3, 1)
    assert table_health(d.limit(0), "t").first().total_rows == 0
    assert tuple(grid_gaps(d, ["site"], "timestamp").first()) == ("a", 2, 3, 1)


def test_latest_predictions(spark):
    t = START.to_pydatetime()
    log = spark.createDataFrame([("a", t, t, {"x": 1.0}), ("a", (START + pd.Timedelta(hours=1)).to_pydatetime(), t, {"x": 2.0, "y": 3.0})],
                                "site string, predicted_at timestamp, created_at timestamp, predictions map<string,double>")
    assert {(r.target, r.prediction) for r in latest_predictions(log, ["site"]).collect()} == {("x", 2.0), ("y", 3.0)}
