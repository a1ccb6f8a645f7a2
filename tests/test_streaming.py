import numpy as np
import pandas as pd
from helpers import START, column, hours
from pyspark.sql import functions as F

from gridcast.session import scratch_path
from gridcast.sources.store import read_days
from gridcast.streaming.hourly import first_seen, read_stream, rolling, run_available, sliding, tumbling
from gridcast.streaming.lag_state import lag_stream
from gridcast.streaming.upsert import run_upsert, upsert_batch


def land(spark, folder, rows):
    """One landed file of (site, minutes after start, value)."""
    data = [(s, (START + pd.Timedelta(minutes=m)).to_pydatetime(), float(v)) for s, m, v in rows]
    d = spark.createDataFrame(data, "site string, ts timestamp, v double")
    d.coalesce(1).write.mode("append").parquet(folder)
    return d.schema


def test_hours_close_after_the_delay_and_reruns_go_on(spark):
    folder, out = scratch_path(spark, "land"), scratch_path(spark, "out")
    schema = land(spark, folder, [("a", 0, 1), ("a", 30, 3), ("a", 70, 5)])

    def run():
        stream = read_stream(spark, folder, schema)
        run_available(tumbling(stream, [F.avg("v").alias("v")]), f"{out}/t", f"{out}/s")
        return spark.read.parquet(f"{out}/t").orderBy("timestamp").select("v").collect()

    assert [r.v for r in run()] == []  # nothing is three hours old yet
    land(spark, folder, [("a", 100, 7), ("a", 60 * 6, 9)])
    assert [r.v for r in run()] == [2, 6]
    land(spark, folder, [("a", 5, 1000), ("a", 60 * 12, 1)])  # the first row is too late
    assert [r.v for r in run()] == [2, 6, 9]


def test_sliding_windows_end_with_their_hour(spark):
    folder, out = scratch_path(spark, "land"), scratch_path(spark, "out")
    schema = land(spark, folder, [("a", 60 * h, h) for h in range(12)])
    run_available(sliding(read_stream(spark, folder, schema), "v", 6), f"{out}/t", f"{out}/s")
    got = spark.read.parquet(f"{out}/t").where("timestamp = timestamp'2024-01-01 06:00:00'").first()
    assert (got.n, got["mean"]) == (6, 3.5)


def test_rolling_equals_sliding_and_does_not_cancel(spark):
    folder, out = scratch_path(spark, "land"), scratch_path(spark, "out")
    rows = [("a", 60 * h + m, 1e8 + (7 * h + m) % 5) for h in range(30) if h % 9 for m in (0, 20, 40)]
    schema = land(spark, folder, rows[:40])
    land(spark, folder, [*rows[40:], ("z", 60 * 90, 0)])
    for i, n in enumerate((3, 6)):
        run_available(sliding(read_stream(spark, folder, schema, files_per_batch=1), "v", n), f"{out}/{i}", f"{out}/s{i}")
    run_available(rolling(read_stream(spark, folder, schema, files_per_batch=1), "v", [3, 6]), f"{out}/t", f"{out}/s")
    order = ["hours", "site", "timestamp"]
    got = spark.read.parquet(f"{out}/t").where("site = 'a'").orderBy(*order).toPandas()
    want = spark.read.parquet(f"{out}/0", f"{out}/1").where("site = 'a'").orderBy(*order).toPandas()
    assert len(got) == len(want) > 50 and (got[[*order, "n"]] == want[[*order, "n"]]).all().all()
    events = pd.DataFrame(rows, columns=["site", "m", "v"])
    for r in got.itertuples():
        last = (r.timestamp - START).total_seconds() / 60
        own = events.v[(events.m >= last - 60 * (r.hours - 1)) & (events.m < last + 60)] - 1e8
        assert abs(r.mean - 1e8 - own.mean()) < 1e-7 and abs(r.std - own.std()) < 1e-7


def test_rows_seen_before_are_dropped(spark):
    folder, out = scratch_path(spark, "land"), scratch_path(spark, "out")
    schema = land(spark, folder, [("a", 0, 1), ("a", 0, 1), ("b", 0, 2)])

    def run():
        run_available(first_seen(read_stream(spark, folder, schema), ["site", "ts"], "ts"), f"{out}/t", f"{out}/s")
        return spark.read.parquet(f"{out}/t").count()

    assert run() == 2
    land(spark, folder, [("a", 0, 1), ("a", 60, 1)])
    assert run() == 3


def test_upsert_over_batches_equals_batch_result(spark):
    folder, out = scratch_path(spark, "land"), scratch_path(spark, "out")
    schema = land(spark, folder, [("a", 0, 1), ("a", 60, 4)])

    def run():
        stream = tumbling(read_stream(spark, folder, schema), [F.sum("v").alias("v")])
        run_upsert(stream, f"{out}/t", f"{out}/s")
        return column(read_days(spark, f"{out}/t"))

    assert run() == [1, 4]
    land(spark, folder, [("a", 10, 2), ("a", 120, 8)])
    assert run() == [3, 4, 8]


def test_a_repeated_batch_changes_nothing_and_other_days_stay(spark):
    root = scratch_path(spark, "table")
    d = hours(spark, [1, 2] + [...] * 22 + [3])  # two days
    write = upsert_batch(root, ["site", "timestamp"])
    write(d, 0)
    other_day = {f for f in read_days(spark, root).inputFiles() if "2024-01-02" in f}
    change = d.where("v = 1").withColumn("v", F.col("v") + 9)
    write(change, 1)
    write(change, 1)
    assert column(read_days(spark, root)) == [10, 2, 3]
    assert {f for f in read_days(spark, root).inputFiles() if "2024-01-02" in f} == other_day


def test_lag_state_survives_between_runs(spark):
    folder, out = scratch_path(spark, "land"), scratch_path(spark, "out")
    schema = land(spark, folder, [("a", 60 * h, h) for h in range(8)])

    def run():
        hourly = tumbling(read_stream(spark, folder, schema), [F.avg("v").alias("v")])
        run_available(lag_stream(hourly, "v", ["site"], [1, 3]), f"{out}/t", f"{out}/s")
        return spark.read.parquet(f"{out}/t").orderBy("timestamp")

    assert column(run(), "v_lag_1h") == [None, 0, 1, 2]
    land(spark, folder, [("a", 60 * h, h) for h in range(8, 12)])
    done = run()
    assert column(done, "v") == [0, 1, 2, 3, 4, 5, 6, 7]
    assert column(done, "v_lag_1h") == [None, 0, 1, 2, 3, 4, 5, 6]
    assert column(done, "v_lag_3h") == [None, None, None, 0, 1, 2, 3, 4]


def test_late_hours_take_their_place_among_the_kept_rows(spark):
    folder, out = scratch_path(spark, "land"), scratch_path(spark, "out")
    for rows in ([5, 1, 0, 2, 8], [6], [9, 10], [3]):
        schema = land(spark, folder, [("a", 60 * h, h) for h in rows])
        stream = read_stream(spark, folder, schema)
        run_available(lag_stream(stream, "v", ["site"], [1, 2, 3], "ts"), f"{out}/t", f"{out}/s")
    got = {int(r.v): (r.v_lag_1h, r.v_lag_2h) for r in spark.read.parquet(f"{out}/t").collect()}
    assert got == {0: (None, None), 1: (0, None), 2: (1, 0), 5: (2, 1), 8: (5, 2), 6: (5, 2), 9: (8, 6), 10: (9, 8),
                   3: (None, None)}  # by then the rows before hour 3 are gone


def test_a_long_history_in_one_batch_goes_through_the_state_in_spans(spark):
    folder, out = scratch_path(spark, "land"), scratch_path(spark, "out")
    hours_ = [int(h) for h in np.random.default_rng(1).permutation(3000)]
    schema = land(spark, folder, [(s, 60 * h, h) for h in hours_ for s in "ab"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    spark.conf.set("spark.sql.execution.arrow.transformWithStateInPandas.maxRecordsPerBatch", "200")
    try:
        stream = read_stream(spark, folder, schema)
        run_available(lag_stream(stream, "v", ["site"], [1, 72], "ts", piece_rows=500, span_hours=300), f"{out}/t", f"{out}/s")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.execution.arrow.transformWithStateInPandas.maxRecordsPerBatch")
    done = spark.read.parquet(f"{out}/t")
    assert done.count() == 6000
    wrong = done.where("NOT (v_lag_1h <=> IF(v >= 1, v - 1, NULL) AND v_lag_72h <=> IF(v >= 72, v - 72, NULL))")
    assert wrong.count() == 0
