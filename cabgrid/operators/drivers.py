"""Driver questions: tip rate per day, previous ride, idle time per area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AVG_DIGITS, epoch_micros, window_columns
from .routes import top_k_per_window
from .sequence import BUCKET, BUCKET_SECONDS, dense_widths, moments, previous_in_order


def driver_tip_rate(trips: DataFrame, length: str = "1 day", time_col: str = "dropoff_datetime",
                    watermark: str | None = None) -> DataFrame:
    """Average of tip / total per (window on dropoff, driver), as computed;
    ``reported_rates`` rounds it for a report."""
    trips = trips.withWatermark(time_col, watermark) if watermark else trips
    rate = F.try_divide(F.col("tip_amount"), F.col("total_amount"))
    win = F.window(time_col, length)
    return (trips.groupBy(win.alias("w"), "hack_license").agg(F.avg(rate).alias("avg_tip_percentage"))
            .select(*window_columns(F.col("w")), "hack_license", "avg_tip_percentage"))


def reported_rates(rates: DataFrame) -> DataFrame:
    """Rates rounded for the report, after any ranking."""
    return rates.withColumn("avg_tip_percentage", F.round("avg_tip_percentage", AVG_DIGITS))


def most_pleasant_driver(rates: DataFrame, k: int = 1) -> DataFrame:
    """Highest average tip rate over the whole result (window, driver break
    ties); ranked as computed, then rounded."""
    return reported_rates(rates.orderBy(F.col("avg_tip_percentage").desc_nulls_last(), "window_start",
                                        "hack_license").limit(k))


def pleasant_driver_per_day(rates: DataFrame, k: int = 1) -> DataFrame:
    """Highest average tip rate inside every window; ranked as computed."""
    return reported_rates(top_k_per_window(rates, [F.col("avg_tip_percentage").desc_nulls_last(),
                                                   F.col("hack_license")], k))


def previous_ride(cells: DataFrame, key: str = "hack_license", time_col: str = "pickup_datetime",
                  tiebreak: str | None = "trip_id",
                  bucket_seconds: int = BUCKET_SECONDS, max_rows: int | None = None) -> DataFrame:
    """Every ride with the dropoff cell and dropoff time of the same driver's
    previous ride (by pickup time); null for the driver's first ride.
    ``max_rows``: rides of a key and bucket above which it is cut into slices
    (``None``: never)."""
    order = [time_col] + ([tiebreak] if tiebreak else [])
    widths = max_rows and dense_widths(moments(cells, [key], time_col), [key], bucket_seconds, max_rows)
    d = previous_in_order(cells, [key], order, ["cell_dropoff", "dropoff_datetime"],
                          bucket_seconds=bucket_seconds, widths=widths)
    return d.drop(BUCKET)


def idle_rides(prev: DataFrame, max_idle_seconds: int | None = 3600) -> DataFrame:
    """Rides that start in the cell where the driver's previous ride ended,
    after it ended, with the idle gap in seconds.

    ``max_idle_seconds``: a driver idle for longer than this is taken as not
    available and the gap is not counted (``None``: no cap).
    """
    gap_us = epoch_micros(prev, "pickup_datetime") - epoch_micros(prev, "prev_dropoff_datetime")
    d = prev.withColumn("_gap_us", gap_us).filter(
        (F.col("cell_pickup") == F.col("prev_cell_dropoff")) & (F.col("_gap_us") > 0))
    if max_idle_seconds is not None:
        d = d.filter(F.col("_gap_us") <= F.lit(max_idle_seconds * 1_000_000))
    return d.withColumn("idle_seconds", F.col("_gap_us") / F.lit(1_000_000.0))


def idle_sums(rides: DataFrame) -> DataFrame:
    """(cell, gap_us, rides): sum and count of the gaps ``_gap_us`` per cell."""
    return rides.groupBy("cell").agg(F.sum("_gap_us").alias("gap_us"), F.count(F.lit(1)).alias("rides"))


def idle_sums_merged(sums: DataFrame) -> DataFrame:
    return sums.groupBy("cell").agg(F.sum("gap_us").alias("gap_us"), F.sum("rides").alias("rides"))


def idle_means(sums: DataFrame) -> DataFrame:
    """Average idle seconds and ride count per ``cell`` (exact sum in
    microseconds, then one division); highest average first."""
    return sums.select("cell", (F.col("gap_us").cast("double") / F.col("rides") / F.lit(1_000_000.0))
                       .alias("avg_idle_seconds"), "rides").orderBy(F.desc("avg_idle_seconds"), "cell")


def idle_summary(rides: DataFrame) -> DataFrame:
    """``idle_means`` of rides with the gap ``_gap_us`` in microseconds."""
    return idle_means(idle_sums(rides))


def idle_time(prev: DataFrame, max_idle_seconds: int | None = 3600) -> DataFrame:
    """Average idle seconds per pickup cell, highest first."""
    return idle_summary(idle_rides(prev, max_idle_seconds).withColumnRenamed("cell_pickup", "cell"))
