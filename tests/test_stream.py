"""Batch = stream: the fixture replayed as time-ordered files, one file per
micro-batch, through the streaming twins; restarts, live reports, bad times."""

import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cabgrid.operators import congestion, drivers
from cabgrid.operators.grid import grid_cells, routed_trips
from cabgrid.plans.catalog import FEED_SCHEMA, REPLAY, valid
from cabgrid.sources.trips import load_trips, to_trip_lines
from cabgrid.session import shared_path
from cabgrid.streaming import jobs
from cabgrid.streaming.admission import Admission
from cabgrid.streaming.sources import closing_line, read_trip_stream, stage_time_slices
from conftest import SF_ORACLE, SF_SMALL


def feed(spark, time_col, slices=5, sf=SF_SMALL, per_batch=1, wrong=()):
    """Trip lines in time order and a closing line, ``per_batch`` files a batch;
    ``wrong``: lines that come in the middle."""
    trips = load_trips(spark, sf).withColumn("at", F.coalesce(time_col, "pickup_datetime"))
    rows = to_trip_lines(trips, keep_id=True, keep=("at",)).unionByName(spark.range(1).select(
        F.lit(-1).cast("long").alias("trip_id"), F.lit(closing_line()).alias("value"), F.expr("TIMESTAMP_NTZ'2100-01-01 00:00:00'").alias("at")))
    if wrong:
        middle = trips.selectExpr("percentile(unix_micros(cast(at as timestamp)), 0.3) AS m").first().m
        rows = rows.unionByName(spark.createDataFrame([(-2 - i, v) for i, v in enumerate(wrong)], "trip_id long, value string")
                                .withColumn("at", F.timestamp_micros(F.lit(int(middle))).cast("timestamp_ntz")))
    glob = stage_time_slices(rows, "at", slices)
    return read_trip_stream(spark, "parquet", glob, {"maxFilesPerTrigger": str(per_batch)}, FEED_SCHEMA,
                            keep=("trip_id",))


def frame(df, key):
    return df.toPandas().sort_values(key).reset_index(drop=True)


def test_congestion_stream_equals_batch(spark):
    batch = congestion.congestion_alerts(routed_trips(valid(spark, SF_ORACLE)))
    stream = jobs.congestion_stream(feed(spark, "dropoff_datetime", 12, SF_ORACLE, per_batch=3), admit=REPLAY)
    assert batch.count() >= 100
    key = ["route", "trip_id"]
    pd.testing.assert_frame_equal(frame(stream.select(*batch.columns), key), frame(batch, key),
                                  check_dtype=False)


def test_idle_stream_equals_batch(spark):
    batch = drivers.idle_time(drivers.previous_ride(grid_cells(valid(spark, SF_SMALL), 500)))
    stream = jobs.idle_time_stream(feed(spark, "pickup_datetime"), admit=REPLAY)
    assert stream.count() > 0
    pd.testing.assert_frame_equal(frame(stream, ["cell"]), frame(batch, ["cell"]), check_dtype=False)


def test_mean_reset_stream_equals_batch(spark):
    batch = congestion.route_mean_reset(routed_trips(valid(spark, SF_SMALL)))
    stream = jobs.route_mean_reset_stream(feed(spark, "dropoff_datetime"), admit=REPLAY)
    key = ["route", "trip_id"]
    pd.testing.assert_frame_equal(frame(stream, key), frame(batch, key), check_dtype=False)


def test_top_routes_stream_equals_batch(spark):
    batch = entry.queries()["top_routes"](spark, SF_SMALL)
    stream = jobs.top_routes_stream(feed(spark, "dropoff_datetime"))
    key = ["window_start", "route"]
    pd.testing.assert_frame_equal(frame(stream, key), frame(batch, key), check_dtype=False)


WRONG = ["m,h,2090-05-05 00:00:00,2090-05-05 00:10:00,600,1.5,-73.99,40.75,-73.98,40.76,CSH,5.0,0.5,0.5,1.0,0.0,7.0",
         "m,h,2013-01-01 00:00:00,2100-01-01 00:00:00,600,1.5,-73.99,40.75,-73.98,40.76,CSH,5.0,0.5,0.5,1.0,0.0,7.0",
         "m,h,2091-01-01 00:00:00,2013-01-01 00:00:00,0,0,0,0,0,0,CSH,0,0,0,0,0,0"]


@pytest.mark.parametrize("query, time", [("congestion", "dropoff_datetime"), ("route_mean_reset", "dropoff_datetime"),
                                         ("idle_time", "pickup_datetime")])
def test_wrong_dates_in_mid_stream_change_only_the_reject_count(spark, query, time):
    batch = {"congestion": lambda: congestion.congestion_alerts(routed_trips(valid(spark, SF_SMALL))),
             "route_mean_reset": lambda: congestion.route_mean_reset(routed_trips(valid(spark, SF_SMALL))),
             "idle_time": lambda: drivers.idle_time(drivers.previous_ride(grid_cells(valid(spark, SF_SMALL), 500)))}[query]()
    job = getattr(jobs, f"start_{query}")(feed(spark, time, wrong=WRONG), admit=REPLAY)
    got, key = job.finish(), batch.columns[:2]
    pd.testing.assert_frame_equal(frame(got.select(*batch.columns), key), frame(batch, key), check_dtype=False)
    assert job.rejected()["future"] == len(WRONG) and job.rejected()["invalid"] > 0


def test_wrong_dates_do_not_evict_open_windows(spark):
    key = ["window_start", "route"]
    got = jobs.top_routes_stream(feed(spark, "dropoff_datetime", wrong=WRONG), output_mode="update")
    pd.testing.assert_frame_equal(frame(got, key), frame(entry.queries()["top_routes"](spark, SF_SMALL), key), check_dtype=False)


def test_rejects_are_a_side_output(spark):
    rows = jobs.start_rejects(feed(spark, "dropoff_datetime", wrong=WRONG), admit=REPLAY).finish().collect()
    assert sorted(r.value for r in rows if r.reason == "future") == sorted(WRONG)
    trips = load_trips(spark, SF_SMALL)
    kept = valid(spark, SF_SMALL).filter("dropoff_datetime is not null").count()
    assert len(rows) == trips.count() + len(WRONG) - kept and {r.reason for r in rows} == {"future", "invalid", "no_time"}
    fixed = jobs.start_rejects(feed(spark, "dropoff_datetime"), admit=Admission(None, "2024-01-10 00:00:00", closing_line()))
    late = fixed.finish().filter("reason = 'future'").count()
    assert late == trips.filter("pickup_datetime > '2024-01-10' or dropoff_datetime > '2024-01-10'").count() > 0


def folders(spark, name):
    return [shared_path(spark, f"{name}-{uuid.uuid4().hex}") for _ in range(2)]


def test_stop_and_restart(spark):
    """Stopped after two micro-batches and started again with the same output
    and checkpoint: every alert once, as in an uninterrupted run."""
    out, ckpt = folders(spark, "restart")
    lines = feed(spark, "dropoff_datetime", slices=6, sf=SF_ORACLE)
    job = jobs.start_congestion(lines, output=out, checkpoint=ckpt, trigger={"processingTime": "0 seconds"}, admit=REPLAY)
    q = job.queries[0]
    while q.lastProgress is None or q.lastProgress["batchId"] < 1:
        q.awaitTermination(0.5)
    q.stop()
    got = jobs.congestion_stream(lines, output=out, checkpoint=ckpt, admit=REPLAY)
    batch = congestion.congestion_alerts(routed_trips(valid(spark, SF_ORACLE)))
    assert batch.count() >= 100
    key = ["route", "trip_id"]
    pd.testing.assert_frame_equal(frame(got.select(*batch.columns), key), frame(batch, key), check_dtype=False)


def test_job_called_twice_reads_each_row_once(spark):
    """A scheduler's two calls with files added in between."""
    trips = load_trips(spark, SF_ORACLE).filter("dropoff_datetime is not null")
    half = trips.selectExpr("percentile(unix_micros(cast(dropoff_datetime as timestamp)), 0.5) AS m").first().m
    early = F.unix_micros(F.col("dropoff_datetime").cast("timestamp")) <= half
    path, (out, ckpt) = shared_path(spark, f"lines-{uuid.uuid4().hex}"), folders(spark, "twice")

    def call():
        lines = read_trip_stream(spark, "parquet", path, {}, FEED_SCHEMA, keep=("trip_id",))
        return jobs.top_routes_stream(lines, output_mode="update", output=out, checkpoint=ckpt)

    to_trip_lines(trips.filter(early), keep_id=True).write.parquet(path)
    call().count()
    to_trip_lines(trips.filter(~early), keep_id=True).write.mode("append").parquet(path)
    got = frame(call(), ["window_start", "route"])
    assert frame(call(), ["window_start", "route"]).equals(got)  # nothing new: nothing changes
    pd.testing.assert_frame_equal(got, frame(entry.queries()["top_routes"](spark, SF_ORACLE), ["window_start", "route"]), check_dtype=False)


def test_report_while_running_and_before_the_first_batch(spark):
    out, ckpt = folders(spark, "live")
    job = jobs.start_area_profitability(feed(spark, "dropoff_datetime", 4), output=out, checkpoint=ckpt,
                                        trigger={"processingTime": "1 second"})
    assert job.report().count() in range(6)
    while any(q.lastProgress is None or q.lastProgress["batchId"] < 2 for q in job.queries):
        job.queries[0].awaitTermination(0.5)
    assert job.report().count() == 5 and all(q.isActive for q in job.queries)
    for q in job.queries:
        q.stop()


def test_idle_report_after_every_batch(spark):
    seen = []
    lines = feed(spark, "pickup_datetime", 4, SF_ORACLE)
    last = jobs.idle_time_stream(lines, admit=REPLAY, on_batch=lambda report, i: seen.append((i, [r.avg_idle_seconds for r in report.collect()])))
    assert len(seen) >= 4 and all(v == sorted(v, reverse=True) for _, v in seen)
    assert sorted(seen[-1][1]) == sorted(r.avg_idle_seconds for r in last.collect())


def test_malformed_time_never_reaches_the_state(spark):
    path = shared_path(spark, f"text-{uuid.uuid4().hex}")
    good = "m1,h1,2013-01-01 00:00:00,2013-01-01 00:10:00,600,0.44,-73.99,40.75,-73.98,40.76,CSH,5.0,0.5,0.5,1.0,0.0,7.0"
    bad = good.replace("2013-01-01 00:10:00", "garbage")
    spark.createDataFrame([(x,) for x in (good, bad, closing_line())], "value string").write.text(path)
    got = jobs.route_mean_reset_stream(read_trip_stream(spark, "text", path), admit=REPLAY).collect()
    assert [(r.route_mean_reset, str(r.dropoff_datetime)) for r in got] == [(600.0, "2013-01-01 00:10:00")]


def test_expired_route_starts_anew(spark):
    line = "m1,h1,{},{},{},0.44,-73.99,40.75,-73.98,40.76,CSH,5.0,0.5,0.5,1.0,0.0,7.0"
    rides = [line.format("2013-01-01 00:00:00", "2013-01-01 00:10:00", 600), line.format("2013-01-01 00:05:00", "2013-01-01 00:20:00", 900),
             line.format("2013-01-03 00:00:00", "2013-01-03 00:30:00", 1800), closing_line()]
    paths = shared_path(spark, f"expire-{uuid.uuid4().hex}")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rides)], "trip_id long, value string")
    glob = stage_time_slices(df, "trip_id", 4, root=paths)
    for hours, runs in ((None, 2), (24, 0)):
        lines = read_trip_stream(spark, "parquet", glob, {"maxFilesPerTrigger": "1"}, FEED_SCHEMA, keep=("trip_id",))
        alerts = jobs.congestion_stream(lines, min_run=0, expire_hours=hours, admit=REPLAY).collect()
        last = [r.run_length for r in alerts if r.trip_id == 2]
        assert last in ([], [runs])


def test_batch_and_stream_agree_in_another_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        batch = frame(entry.queries()["most_pleasant_driver"](spark, SF_SMALL), ["window_start"])
        stream = frame(jobs.most_pleasant_driver_stream(feed(spark, "dropoff_datetime")), ["window_start"])
        idle = frame(entry.queries()["idle_time"](spark, SF_SMALL), ["cell"])
        idle_stream = frame(jobs.idle_time_stream(feed(spark, "pickup_datetime"), admit=REPLAY), ["cell"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert batch.equals(frame(entry.queries()["most_pleasant_driver"](spark, SF_SMALL), ["window_start"]))
    pd.testing.assert_frame_equal(batch, stream, check_dtype=False)
    pd.testing.assert_frame_equal(idle, idle_stream, check_dtype=False)


def test_text_feed_gets_trip_ids(spark):
    """A plain-text feed has no id column: one is derived from the line, so
    the stateful twins still have a tiebreak."""
    path = shared_path(spark, f"text-{uuid.uuid4().hex}")
    to_trip_lines(load_trips(spark, SF_SMALL)).union(spark.createDataFrame([(closing_line(),)], "value string")).write.text(path)
    lines = read_trip_stream(spark, "text", path)
    assert set(lines.columns) == {"value", "trip_id"}
    assert jobs.route_mean_reset_stream(lines, admit=REPLAY).count() == valid(spark, SF_SMALL).filter("dropoff_datetime is not null").count()


def test_top_routes_update_mode_equals_batch(spark):
    """Update mode (state evicted behind the watermark, changed counts
    appended per batch) gives the same top k as the batch query."""
    batch = entry.queries()["top_routes"](spark, SF_SMALL)
    stream = jobs.top_routes_stream(feed(spark, "dropoff_datetime", 8, per_batch=2), output_mode="update")
    key = ["window_start", "route"]
    pd.testing.assert_frame_equal(frame(stream, key), frame(batch, key), check_dtype=False)


def test_windows_are_ranked_once_when_they_close(spark):
    """Five batches: every closed window's whole top, once; a window that the
    watermark has not passed is not reported."""
    from cabgrid.operators import routes
    counts = routes.route_counts(routed_trips(valid(spark, SF_SMALL)))
    batch = routes.top_routes_per_window(counts, 3)
    got = jobs.closed_top_routes_stream(feed(spark, "dropoff_datetime"), 3, admit=REPLAY)
    key = ["window_start", "rank"]
    pd.testing.assert_frame_equal(frame(got.select(*batch.columns), key), frame(batch, key), check_dtype=False)
    open_ = jobs.closed_top_routes_stream(feed(spark, "dropoff_datetime"), 3)  # the closing record is turned away
    last = valid(spark, SF_SMALL).agg(F.max("dropoff_datetime").alias("m")).first().m
    ends = [r.window_end for r in open_.select("window_end").distinct().collect()]
    assert ends and max(ends) <= last
    closed = open_.select(*batch.columns)
    assert closed.exceptAll(batch).isEmpty() and 0 < closed.count() < batch.count()
