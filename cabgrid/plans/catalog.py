"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables whole (trips are derived from ``events``
row for row) and returns the operator's full result; limits appear only in
the top-k reports, where they are the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import areas, congestion, drivers, fleet, routes
from ..operators.clean import (ENRICHED_COLUMNS, trip_clean, trip_date_parts, trip_enriched,
                               trip_typed_json, trip_valid)
from ..operators.grid import grid_cells, routed_trips
from ..operators.sequence import MAX_ROWS
from ..sources.decode import trip_decode_csv, trip_decode_json
from ..sources.trips import load_table, load_trips, to_trip_json, to_trip_lines
from ..streaming import jobs
from ..streaming.admission import Admission
from ..streaming.sinks import kafka_payload, topic_fanout
from ..streaming.sources import closing_line, read_json_stream, read_trip_stream, stage_time_slices

TOPICS = ["topic2", "topic3", "topic4"]
# The ``_sliced`` keys: so few rows a slice that every busy hour of the tables is cut.
FEW_ROWS = 2


def valid(spark: SparkSession, d: str) -> DataFrame:
    return trip_valid(load_trips(spark, d))


def routed500(spark, d):
    return routed_trips(valid(spark, d), 500)


def cells250(spark, d):
    return grid_cells(valid(spark, d), 250)


def json_records(spark, d):
    return trip_decode_json(to_trip_json(load_trips(spark, d), keep_id=True), keep=["trip_id"])


def q_trip_decode_csv(spark, d):
    lines = to_trip_lines(load_trips(spark, d), keep_id=True)
    return trip_decode_csv(lines, keep=["trip_id"])


def q_trip_date_parts(spark, d):
    t = trip_date_parts(trip_typed_json(json_records(spark, d)), names="archive")
    return t.select("trip_id", "pickup_datetime", "TripStartDT", "TripEndDT", "TripStartDay",
                    "TripStartMonth", "TripStartYear", "hour", "minute", "second", "dayofweek",
                    "week_day_full")


def q_trip_clean(spark, d):
    return trip_clean(json_records(spark, d))


def q_trip_valid_routes(spark, d):
    return trip_enriched(json_records(spark, d)).select("trip_id", *ENRICHED_COLUMNS)


def q_grid_cells(size):
    def run(spark, d):
        return grid_cells(valid(spark, d), size).select("trip_id", "cell_pickup", "cell_dropoff")
    return run


def q_trip_routes(spark, d):
    return routed500(spark, d).select("trip_id", "cell_pickup", "cell_dropoff", "route")


def q_route_counts(spark, d):
    return routes.route_counts(routed500(spark, d))


def q_area_profit_avg(spark, d):
    return areas.area_profit_avg(cells250(spark, d))


def q_area_dropoffs(spark, d):
    return areas.area_dropoffs(cells250(spark, d))


def q_area_profitability(spark, d):
    c = cells250(spark, d)
    return areas.area_profitability(areas.area_profit_avg(c), areas.area_dropoffs(c))


def tip_rates(spark, d):
    return drivers.driver_tip_rate(valid(spark, d))


def q_driver_tip_rate(spark, d):
    return drivers.reported_rates(tip_rates(spark, d))


def q_price_breakdown(spark, d):
    return areas.price_breakdown(grid_cells(valid(spark, d), 500))


def q_amount_per_mile(spark, d):
    return routes.amount_per_mile(routed500(spark, d))


def previous_ride(spark, d, max_rows):
    p = drivers.previous_ride(grid_cells(valid(spark, d), 500), max_rows=max_rows)
    return p.select("trip_id", "hack_license", "pickup_datetime", "dropoff_datetime",
                    "cell_pickup", "cell_dropoff", "prev_cell_dropoff", "prev_dropoff_datetime")


def q_previous_ride(spark, d):
    return previous_ride(spark, d, MAX_ROWS)


def q_idle_time(spark, d):
    return drivers.idle_time(drivers.previous_ride(grid_cells(valid(spark, d), 500), max_rows=MAX_ROWS))


def rising_runs(spark, d, max_rows):
    r = congestion.route_rising_runs(routed500(spark, d), max_rows=max_rows)
    return r.select("route", "trip_id", "dropoff_datetime", "trip_time", "run_length",
                    "first_trip_time", "first_pickup_longitude", "first_pickup_latitude")


def q_rising_runs(spark, d):
    return rising_runs(spark, d, MAX_ROWS)


def q_congestion_alerts(spark, d):
    return congestion.congestion_alerts(routed500(spark, d), max_rows=MAX_ROWS)


def q_previous_ride_sliced(spark, d):
    return previous_ride(spark, d, FEW_ROWS)


def q_rising_runs_sliced(spark, d):
    return rising_runs(spark, d, FEW_ROWS)


def q_congestion_alerts_sliced(spark, d):
    return congestion.congestion_alerts(routed500(spark, d), max_rows=FEW_ROWS)


def q_vendor_revenue(spark, d):
    return fleet.vendor_revenue(trip_clean(json_records(spark, d)))


def q_vendor_revenue_report(spark, d):
    return fleet.vendor_revenue_report(fleet.vendor_revenue(trip_clean(json_records(spark, d))))


def q_fleet_totals(spark, d):
    return fleet.fleet_totals(trip_enriched(json_records(spark, d)))


def q_table_preview(spark, d):
    return fleet.table_preview(load_table(spark, d, "part"), ["p_partkey"], 5)


def q_table_filter_eq(spark, d):
    return fleet.table_filter_eq(load_table(spark, d, "lineitem"), "l_partkey", 3)


# (l_orderkey, l_linenumber) repeats in the test tables; these four are unique.
LINEITEM_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def q_table_preview_lineitem(spark, d):
    return fleet.table_preview(load_table(spark, d, "lineitem"), LINEITEM_KEY, 5)


def q_table_preview_supplier(spark, d):
    return fleet.table_preview(load_table(spark, d, "supplier"), ["s_suppkey"], 5)


def q_table_filter_eq_head(spark, d):
    rows = fleet.table_filter_eq(load_table(spark, d, "lineitem"), "l_partkey", 3)
    return fleet.table_preview(rows, LINEITEM_KEY, 2)


def q_topic_fanout(spark, d):
    return topic_fanout(to_trip_json(load_trips(spark, d), keep_id=True), TOPICS).select(
        "topic", "trip_id", "value")


def q_route_mean_reset(spark, d):
    return congestion.route_mean_reset(routed500(spark, d))


# --- stream twins: the fixture replayed as time-ordered files -------------------

FEED_SCHEMA = T.StructType([T.StructField("trip_id", T.LongType()), T.StructField("value", T.StringType())])


def _feed(spark, d, form: str = "csv", time_col: str = "dropoff_datetime", files: int = 32, per_batch: int = 8,
          late_seconds: int = 0):
    """Stage the trips' wire form as ``files`` files in order of arrival in
    the shared folder and open a file stream over them, ``per_batch`` files a
    micro-batch. A trip arrives up to ``late_seconds`` after its event time
    (by a hash of its id); a closing line ends the trip lines."""
    trips = load_trips(spark, d)
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod(F.xxhash64("trip_id"), F.lit(late_seconds + 1)).cast("decimal(18,6)"))
    arrival = (F.coalesce(time_col, "pickup_datetime") + delay).alias("arrival")
    if form == "csv":
        rows = to_trip_lines(trips, keep_id=True, keep=("pickup_datetime", "dropoff_datetime")).select("trip_id", "value", arrival)
        last = spark.range(1).select(F.lit(-1).cast("long").alias("trip_id"), F.lit(closing_line()).alias("value"),
                                     F.expr("TIMESTAMP_NTZ'2100-01-01 00:00:00'").alias("arrival"))
        glob = stage_time_slices(rows.unionByName(last), "arrival", files)
    else:
        glob = stage_time_slices(trips.withColumn("arrival", arrival), "arrival", files,
                                 form=lambda rows: to_trip_json(rows, keep_id=True, keep=("arrival",)))
    read = read_trip_stream if form == "csv" else read_json_stream
    return read(spark, "parquet", glob, {"maxFilesPerTrigger": str(per_batch)}, FEED_SCHEMA,
                keep=("trip_id",))


def q_top_routes_stream(spark, d):
    return jobs.top_routes_stream(_feed(spark, d))


def q_top_routes_stream_update(spark, d):
    return jobs.top_routes_stream(_feed(spark, d), output_mode="update")


def q_area_profitability_stream(spark, d):
    return jobs.area_profitability_stream(_feed(spark, d))


def q_area_profitability_stream_update(spark, d):
    return jobs.area_profitability_stream(_feed(spark, d), output_mode="update")


#: Replays end with a closing record.
REPLAY = Admission(closing=closing_line())


def q_idle_time_stream(spark, d):
    return jobs.idle_time_stream(_feed(spark, d, time_col="pickup_datetime"), admit=REPLAY)


def q_area_profitability_joined_stream(spark, d):
    return jobs.joined_profitability_stream(_feed(spark, d), admit=REPLAY)


def q_congestion_stream(spark, d):
    return jobs.congestion_stream(_feed(spark, d), admit=REPLAY)


def q_route_mean_reset_stream(spark, d):
    return jobs.route_mean_reset_stream(_feed(spark, d), admit=REPLAY)


LATE_SECONDS = 20 * 60


def q_late(job, time_col: str = "dropoff_datetime"):
    """A keyed-state job fed with trips up to 20 minutes late, out of order."""
    return lambda spark, d: job(_feed(spark, d, time_col=time_col, late_seconds=LATE_SECONDS), admit=REPLAY)


def q_windowed(job, output_mode: str = "complete"):
    return lambda spark, d: job(_feed(spark, d), output_mode=output_mode)


def routed_lon_lat(spark, d):
    return routed_trips(valid(spark, d), 500, "lon_lat_ceil")


def q_idle_time_uncapped(spark, d):
    return drivers.idle_time(drivers.previous_ride(grid_cells(valid(spark, d), 500), max_rows=MAX_ROWS), None)


def q_idle_time_lon_lat(spark, d):
    return drivers.idle_time(drivers.previous_ride(routed_lon_lat(spark, d), max_rows=MAX_ROWS))


def q_congestion_alerts_lon_lat(spark, d):
    return congestion.congestion_alerts(routed_lon_lat(spark, d), max_rows=MAX_ROWS)


def q_archive_readback(spark, d):
    return jobs.archive_roundtrip(_feed(spark, d, "json"))


def q_register_clean_table(spark, d):
    return jobs.clean_table_roundtrip(_feed(spark, d, "json"))


def q_clean_files_registered(spark, d):
    return jobs.clean_files_registered(_feed(spark, d, "json"))


def q_topic_payload(spark, d):
    sent = kafka_payload(topic_fanout(to_trip_json(load_trips(spark, d), keep_id=True), TOPICS))
    return sent.select("topic", F.sha2("value", 256).alias("payload_sha256"), F.octet_length("value").cast("long").alias("n_bytes"))


def q_closed(job, time_col: str = "dropoff_datetime"):
    """The top of every window, given when the window closes."""
    return lambda spark, d: job(_feed(spark, d, time_col=time_col), admit=REPLAY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_routes": lambda s, d: routes.top_routes(q_route_counts(s, d)),
    "trip_decode_csv": q_trip_decode_csv,
    "trip_decode_json": json_records,
    "trip_valid": valid,
    "trip_valid_routes": q_trip_valid_routes,
    "trip_clean": q_trip_clean,
    "trip_date_parts": q_trip_date_parts,
    "grid_cells_500": q_grid_cells(500),
    "grid_cells_250": q_grid_cells(250),
    "trip_routes": q_trip_routes,
    "route_counts": q_route_counts,
    "top_routes_per_window": lambda s, d: routes.top_routes_per_window(q_route_counts(s, d)),
    "area_profit_avg": q_area_profit_avg,
    "area_dropoffs": q_area_dropoffs,
    "area_profitability": q_area_profitability,
    "area_profitability_aligned": lambda s, d: areas.area_profitability_aligned(cells250(s, d)),
    "driver_tip_rate": q_driver_tip_rate,
    "most_pleasant_driver": lambda s, d: drivers.most_pleasant_driver(tip_rates(s, d)),
    "pleasant_driver_per_day": lambda s, d: drivers.pleasant_driver_per_day(tip_rates(s, d)),
    "price_breakdown": q_price_breakdown,
    "top_price_breakdown": lambda s, d: areas.top_price_breakdown(q_price_breakdown(s, d)),
    "price_breakdown_per_window": lambda s, d: areas.price_breakdown_per_window(q_price_breakdown(s, d)),
    "amount_per_mile": q_amount_per_mile,
    "top_amount_per_mile": lambda s, d: routes.top_amount_per_mile(q_amount_per_mile(s, d)),
    "previous_ride": q_previous_ride,
    "idle_time": q_idle_time,
    "previous_ride_sliced": q_previous_ride_sliced,
    "rising_runs_sliced": q_rising_runs_sliced,
    "congestion_alerts_sliced": q_congestion_alerts_sliced,
    "rising_runs": q_rising_runs,
    "congestion_alerts": q_congestion_alerts,
    "vendor_revenue": q_vendor_revenue,
    "vendor_revenue_report": q_vendor_revenue_report,
    "fleet_totals": q_fleet_totals,
    "table_preview": q_table_preview,
    "table_filter_eq": q_table_filter_eq,
    "table_preview_lineitem": q_table_preview_lineitem,
    "table_preview_supplier": q_table_preview_supplier,
    "table_filter_eq_head": q_table_filter_eq_head,
    "topic_fanout": q_topic_fanout,
    "route_mean_reset": q_route_mean_reset,
    "top_routes_stream": q_top_routes_stream,
    "top_routes_stream_update": q_top_routes_stream_update,
    "area_profitability_stream": q_area_profitability_stream,
    "area_profitability_joined_stream": q_area_profitability_joined_stream,
    "area_profitability_stream_update": q_area_profitability_stream_update,
    "idle_time_stream": q_idle_time_stream,
    "congestion_stream": q_congestion_stream,
    "route_mean_reset_stream": q_route_mean_reset_stream,
    "idle_time_uncapped": q_idle_time_uncapped,
    "idle_time_lon_lat": q_idle_time_lon_lat,
    "congestion_alerts_lon_lat": q_congestion_alerts_lon_lat,
    "most_pleasant_driver_stream": q_windowed(jobs.most_pleasant_driver_stream),
    "most_pleasant_driver_stream_update": q_windowed(jobs.most_pleasant_driver_stream, "update"),
    "top_price_breakdown_stream": q_windowed(jobs.top_price_breakdown_stream),
    "top_price_breakdown_stream_update": q_windowed(jobs.top_price_breakdown_stream, "update"),
    "top_amount_per_mile_stream": q_windowed(jobs.top_amount_per_mile_stream),
    "top_amount_per_mile_stream_update": q_windowed(jobs.top_amount_per_mile_stream, "update"),
    "idle_time_stream_late": q_late(jobs.idle_time_stream, "pickup_datetime"),
    "congestion_stream_late": q_late(jobs.congestion_stream),
    "route_mean_reset_stream_late": q_late(jobs.route_mean_reset_stream),
    "archive_readback": q_archive_readback,
    "register_clean_table": q_register_clean_table,
    "clean_files_registered": q_clean_files_registered,
    "topic_payload": q_topic_payload,
    "top_routes_closed_stream": q_closed(jobs.closed_top_routes_stream),
    "price_breakdown_closed_stream": q_closed(jobs.closed_price_breakdown_stream, "pickup_datetime"),
    "pleasant_driver_closed_stream": q_closed(jobs.closed_pleasant_driver_stream),
}

__all__ = ["QUERIES"]
