"""Congested routes: runs of rising ride durations, and alerts when the run
started with a ride longer than the route's recent mean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import time_of
from . import sequence as seq
from .restarts import restarted_means


def route_rising_runs(routed: DataFrame, time_col: str = "dropoff_datetime",
                      tiebreak: str | None = "trip_id",
                      bucket_seconds: int = seq.BUCKET_SECONDS, max_rows: int | None = None) -> DataFrame:
    """Per ride: ``run_length`` of strictly rising ``trip_time`` on its route
    (rides in dropoff order), plus duration and pickup point of the ride that
    started the run. ``max_rows``: rides of a route and bucket above which it
    is cut into slices (``None``: never)."""
    order = seq.key_time_order(time_col, tiebreak)
    widths = max_rows and seq.dense_widths(seq.moments(routed, ["route"], time_col), ["route"], bucket_seconds, max_rows)
    return seq.rising_runs(routed, ["route"], order, "trip_time",
                           ["pickup_longitude", "pickup_latitude"], bucket_seconds, widths=widths).drop(seq.BUCKET)


def congestion_alerts(routed: DataFrame, min_run: int = 2, mean_hours: int = 4,
                      time_col: str = "dropoff_datetime", tiebreak: str | None = "trip_id",
                      bucket_seconds: int = seq.BUCKET_SECONDS, max_rows: int | None = None) -> DataFrame:
    """Rides ending a run of at least ``min_run`` rising durations whose first
    ride lasted longer than the route's mean duration over the last
    ``mean_hours`` (rides with dropoff in [t - mean_hours, t]).

    The rows are shuffled once by (route, bucket) for the trailing mean and
    the runs; the carries of both are narrow aggregates. ``max_rows``: as for
    ``route_rising_runs``.
    """
    order = seq.key_time_order(time_col, tiebreak)
    widths = max_rows and seq.dense_widths(seq.moments(routed, ["route"], time_col, mean_hours * 3600), ["route"],
                                           bucket_seconds, max_rows)
    d = seq.trailing_range_avg(routed, ["route"], time_col, "trip_time", mean_hours * 3600,
                               "route_mean", bucket_seconds, widths)
    d = seq.rising_runs(d, ["route"], order, "trip_time",
                        ["pickup_longitude", "pickup_latitude"], bucket_seconds, source=routed, widths=widths)
    return (d.filter((F.col("run_length") >= min_run)
                     & (F.col("first_trip_time") > F.col("route_mean")))
            .select("route", *([tiebreak] if tiebreak else []), time_col, "run_length",
                    "first_pickup_longitude", "first_pickup_latitude", "first_trip_time",
                    "route_mean"))


def route_mean_reset(routed: DataFrame, reset_hours: int = 4, tiebreak: str = "trip_id") -> DataFrame:
    """Running mean of ``trip_time`` per route (rides in dropoff order) that
    restarts at the first ride ending more than ``reset_hours`` after the
    pickup of the ride that started the current mean: the original job's
    rule, where the prose asks for a trailing window (see
    ``congestion_alerts``).

    The restarts form a chain per route (each start fixes the next one), found
    by composing maps of time blocks (``restarts``); the mean is a running one
    since the latest start. Equal (dropoff, id) pairs keep an arbitrary order.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(routed.sparkSession)
    routed = routed.dropna(subset=["dropoff_datetime", "pickup_datetime"])
    span = reset_hours * 3600
    rides = routed.dropna(subset=["route"]).select(
        "route", seq.epoch_micros(routed, "dropoff_datetime").alias("t"), F.col(tiebreak).cast("long").alias("id"),
        (seq.epoch_micros(routed, "pickup_datetime") + F.lit(span * 1_000_000)).alias("reach"),
        F.col("trip_time").cast("double").alias("value"))
    kind = dict(routed.dtypes)["dropoff_datetime"]
    return restarted_means(rides, span).select(
        "route", F.col("id").alias(tiebreak), time_of(F.col("t"), kind).alias("dropoff_datetime"), F.col("mean").alias("route_mean_reset"))
