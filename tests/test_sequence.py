"""Order-dependent operators: the bucketed (skew-safe) forms against plain
sequential definitions, on data where one key holds most rows and buckets
are small, so carries across (and over empty) buckets are exercised."""

import datetime as dt
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cabgrid.operators import congestion, drivers
from cabgrid.operators import sequence as seq
from cabgrid.session import shared_path

T0 = dt.datetime(2024, 1, 1)


def make_rides(n=400, seed=7, hot_share=0.6, span_hours=60):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < hot_share, "hot", rng.choice(["a", "b", "c"], n))
    drop = np.sort(rng.integers(0, span_hours * 3600, n))
    # gaps: remove a window of 10 hours so some buckets are empty
    drop = np.where(drop > 20 * 3600, drop + 10 * 3600, drop)
    dur = rng.integers(1, 8, n) * 600  # ties on purpose
    rng.shuffle(drop)
    pdf = pd.DataFrame({
        "trip_id": np.arange(n, dtype="int64"), "route": keys, "hack_license": keys,
        "dropoff_datetime": [T0 + dt.timedelta(seconds=int(s)) for s in drop],
        "trip_time": dur.astype(float),
        "pickup_longitude": rng.random(n), "pickup_latitude": rng.random(n),
        "cell_pickup": rng.choice(["x", "y"], n), "cell_dropoff": rng.choice(["x", "y"], n),
    })
    pdf["pickup_datetime"] = pdf["dropoff_datetime"] - pd.to_timedelta(pdf["trip_time"], unit="s")
    return pdf


@pytest.fixture(scope="module")
def rides(spark):
    pdf = make_rides()
    df = spark.createDataFrame(pdf).withColumns({
        "dropoff_datetime": F.col("dropoff_datetime").cast("timestamp_ntz"),
        "pickup_datetime": F.col("pickup_datetime").cast("timestamp_ntz")})
    return pdf, df


def test_previous_ride_matches_lag(spark, rides):
    pdf, df = rides
    got = drivers.previous_ride(df, bucket_seconds=3600).toPandas().set_index("trip_id")
    exp = pdf.sort_values(["hack_license", "pickup_datetime", "trip_id"])
    exp["prev"] = exp.groupby("hack_license")["cell_dropoff"].shift(1)
    exp["prev_t"] = exp.groupby("hack_license")["dropoff_datetime"].shift(1)
    exp = exp.set_index("trip_id")
    assert len(got) == len(exp)
    for tid, r in exp.iterrows():
        g = got.loc[tid]
        assert (g.prev_cell_dropoff if isinstance(g.prev_cell_dropoff, str) else None) == \
               (r.prev if isinstance(r.prev, str) else None)
        assert (pd.isna(g.prev_dropoff_datetime) and pd.isna(r.prev_t)) or g.prev_dropoff_datetime == r.prev_t


def test_rising_runs_match_sequential(spark, rides):
    pdf, df = rides
    got = congestion.route_rising_runs(df, bucket_seconds=3600).toPandas().set_index("trip_id")
    for _, g in pdf.sort_values(["dropoff_datetime", "trip_id"]).groupby("route"):
        prev, run, first = None, 0, None
        for r in g.itertuples():
            if prev is not None and r.trip_time > prev:
                run += 1
            else:
                run, first = 0, r
            prev = r.trip_time
            o = got.loc[r.trip_id]
            assert o.run_length == run
            assert o.first_trip_time == first.trip_time
            assert o.first_pickup_longitude == first.pickup_longitude


def test_run_counter_example(spark):
    rows = [(i, "r", T0 + dt.timedelta(minutes=i), float(d), 0.0, 0.0)
            for i, d in enumerate([100, 200, 300, 250])]
    df = spark.createDataFrame(rows, "trip_id long, route string, dropoff_datetime timestamp_ntz, "
                                     "trip_time double, pickup_longitude double, pickup_latitude double")
    got = congestion.route_rising_runs(df).orderBy("trip_id").collect()
    assert [r.run_length for r in got] == [0, 1, 2, 0]


def test_trailing_mean_matches_range_window(spark, rides):
    pdf, df = rides
    got = seq.trailing_range_avg(df, ["route"], "dropoff_datetime", "trip_time", 4 * 3600, "m",
                                 bucket_seconds=2 * 3600).toPandas().set_index("trip_id")
    for _, g in pdf.groupby("route"):
        t = g["dropoff_datetime"].to_numpy()
        for r in g.itertuples():
            inside = (t >= np.datetime64(r.dropoff_datetime - dt.timedelta(hours=4))) & \
                     (t <= np.datetime64(r.dropoff_datetime))
            assert got.loc[r.trip_id].m == pytest.approx(g["trip_time"][inside].mean(), rel=1e-12)


def test_trailing_mean_with_buckets_shorter_than_range(spark, rides):
    pdf, df = rides
    got = seq.trailing_range_avg(df, ["route"], "dropoff_datetime", "trip_time", 4 * 3600, "m",
                                 bucket_seconds=3600).toPandas().set_index("trip_id")
    exp = seq.trailing_range_avg(df, ["route"], "dropoff_datetime", "trip_time", 4 * 3600, "m",
                                 bucket_seconds=4 * 3600).toPandas().set_index("trip_id")
    assert len(got) == len(pdf)
    for tid in exp.index:
        assert got.loc[tid].m == pytest.approx(exp.loc[tid].m, rel=1e-12)


def test_trailing_mean_is_linear(spark):
    """80,000 rows of one key in two hours: growing frames, not sliding ones."""
    import time
    took = {}
    for n in (40_000, 40_000, 80_000):
        df = spark.range(n).selectExpr("id AS trip_id", "'r' AS route", "CAST(id % 97 AS DOUBLE) AS trip_time",
                                       f"TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * {7200 / n}) AS dropoff_datetime")
        began = time.time()
        seq.trailing_range_avg(df, ["route"], "dropoff_datetime", "trip_time", 4 * 3600, "m").agg(F.sum("m")).collect()
        took[n] = time.time() - began
    assert took[80_000] < 5 and took[80_000] < 3 * max(took[40_000], 0.5)


def test_trailing_range_must_fit_the_buckets(spark, rides):
    with pytest.raises(ValueError):
        seq.trailing_range_avg(rides[1], ["route"], "dropoff_datetime", "trip_time", 5000, "m")


def test_route_mean_reset_matches_sequential(spark, rides):
    pdf, df = rides
    got = congestion.route_mean_reset(df).toPandas().set_index("trip_id")
    assert len(got) == len(pdf)
    span = dt.timedelta(hours=4)
    for _, g in pdf.sort_values(["dropoff_datetime", "trip_id"]).groupby("route"):
        total, n, start = 0.0, 0, None
        for r in g.itertuples():
            if start is None:
                start = r.pickup_datetime
            total, n = total + r.trip_time, n + 1
            if r.dropoff_datetime - start > span:
                total, n, start = r.trip_time, 1, r.pickup_datetime
            assert got.loc[r.trip_id].route_mean_reset == pytest.approx(total / n, rel=1e-12)


def test_idle_gap_longer_than_a_day(spark):
    rows = [(1, "d", "x", "x", T0, T0 + dt.timedelta(minutes=10)),
            (2, "d", "x", "x", T0 + dt.timedelta(hours=25, minutes=10), T0 + dt.timedelta(hours=26))]
    df = spark.createDataFrame(rows, "trip_id long, hack_license string, cell_pickup string, "
                                     "cell_dropoff string, pickup_datetime timestamp_ntz, "
                                     "dropoff_datetime timestamp_ntz")
    prev = drivers.previous_ride(df)
    assert drivers.idle_rides(prev, None).first().idle_seconds == 90_000.0
    assert drivers.idle_rides(prev, 3600).count() == 0


def test_shuffled_input_same_result(spark, rides):
    pdf, df = rides
    a = congestion.congestion_alerts(df, bucket_seconds=4 * 3600).toPandas()
    b = congestion.congestion_alerts(df.repartition(7), bucket_seconds=4 * 3600).toPandas()
    key = ["route", "trip_id"]
    pd.testing.assert_frame_equal(a.sort_values(key).reset_index(drop=True),
                                  b.sort_values(key).reset_index(drop=True))


@pytest.fixture(scope="module")
def dense(spark):
    """Half of all rides on one route in one hour, a fifth of those in a minute."""
    n = 12_000
    hot = "id % 2 = 0"
    second = "CASE WHEN id % 2 = 0 AND id % 10 = 0 THEN 1800 + pmod(hash(id), 60) WHEN id % 2 = 0 THEN pmod(hash(id), 3600) ELSE pmod(hash(id), 200000) END"
    df = spark.range(n).selectExpr(
        "id AS trip_id", f"IF({hot}, 'hot', concat('r', id % 41)) AS route", f"IF({hot}, 'hot', concat('r', id % 41)) AS hack_license",
        f"TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, {second}) AS dropoff_datetime",
        "CAST(pmod(hash(id, 1), 31) * 60 AS DOUBLE) AS trip_time", "rand(1) AS pickup_longitude", "rand(2) AS pickup_latitude",
        "IF(id % 3 = 0, 'x', 'y') AS cell_pickup", "IF(id % 3 = 1, 'x', 'y') AS cell_dropoff")
    path = shared_path(spark, f"dense-{uuid.uuid4().hex}")
    df.withColumn("pickup_datetime", F.col("dropoff_datetime")).write.parquet(path)
    return spark.read.parquet(path)


def test_no_window_partition_grows_with_a_dense_hour(spark, dense):
    moments = seq.moments(dense, ["route"], "dropoff_datetime", 4 * 3600)
    widths = seq.dense_widths(moments, ["route"], max_rows=400)
    found = {(r.route, r._wide): r._width for r in widths.collect()}
    start = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    # The hour of the rides, and the hour in which they leave the trailing mean.
    assert set(found) == {("hot", start), ("hot", start + 4 * 3600)}
    slices = seq.in_buckets(moments, ["route"], F.col("_t"), 3600, widths).groupBy("route", seq.BUCKET).count()
    assert slices.agg(F.max("count")).first()[0] <= 400
    assert slices.agg(F.sum("count")).first()[0] == moments.count()
    # Rides of one second stay together, however many there are.
    assert {r._width for r in seq.dense_widths(moments, ["route"], max_rows=1).collect()} >= {1}


@pytest.mark.parametrize("max_rows", [1, 400])
def test_sliced_hours_equal_plain_windows(spark, dense, max_rows):
    from pyspark.sql import Window
    w = Window.partitionBy("hack_license").orderBy("pickup_datetime", "trip_id")
    prev = drivers.previous_ride(dense, max_rows=max_rows).select("trip_id", "prev_cell_dropoff", "prev_dropoff_datetime")
    plain = dense.select("trip_id", F.lag("cell_dropoff").over(w), F.lag("dropoff_datetime").over(w))
    assert prev.exceptAll(plain).isEmpty() and prev.count() == dense.count()
    runs = congestion.route_rising_runs(dense, max_rows=max_rows).select("trip_id", "run_length", "first_trip_time", "first_pickup_longitude")
    whole = congestion.route_rising_runs(dense, bucket_seconds=400_000).select(runs.columns)
    assert runs.exceptAll(whole).isEmpty() and runs.count() == dense.count()
    alerts = congestion.congestion_alerts(dense, max_rows=max_rows)
    range_ = Window.partitionBy("route").orderBy(F.unix_micros(F.col("dropoff_datetime").cast("timestamp"))).rangeBetween(-4 * 3600 * 1_000_000, 0)
    means = dense.select("trip_id", F.avg("trip_time").over(range_).alias("mean"))
    expected = (whole.filter("run_length >= 2").join(means, "trip_id").filter("first_trip_time > mean")
                .select("trip_id", "run_length", F.round("mean", 6)))
    assert alerts.count() >= 20
    assert alerts.select("trip_id", "run_length", F.round("route_mean", 6)).exceptAll(expected).isEmpty()
    assert alerts.count() == expected.count()


def test_slices_of_empty_and_null_rows(spark, dense):
    nothing = dense.limit(0)
    assert drivers.previous_ride(nothing, max_rows=5).count() == 0
    assert congestion.congestion_alerts(nothing, max_rows=5).count() == 0
    holes = dense.withColumns({"route": F.when(F.col("trip_id") % 3 > 0, F.col("route")),
                               "dropoff_datetime": F.when(F.col("trip_id") % 5 > 0, F.col("dropoff_datetime"))})
    got = congestion.route_rising_runs(holes, max_rows=50)
    assert got.count() == holes.dropna(subset=["route", "dropoff_datetime"]).count()
