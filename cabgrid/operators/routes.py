"""Route questions: most frequent routes, amount per mile.

All aggregates are ``groupBy`` on (window, route): Spark combines partially
before the shuffle, so a hot route costs one partial row per task, not a hot
partition. Top-k is ``orderBy().limit()`` (``TakeOrderedAndProject``: one
k-row heap per task) or ``row_number() <= k`` per window (``WindowGroupLimit``
trims before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import EXACT, window_columns


def route_panes(routed: DataFrame, pane: str = "10 minutes", time_col: str = "dropoff_datetime",
                watermark: str | None = None) -> DataFrame:
    """Trips per (pane, route): the slides that sliding windows consist of.
    A trip is one row here, not one for every window that holds it."""
    df = routed.withWatermark(time_col, watermark) if watermark else routed
    return (df.groupBy(F.window(time_col, pane).alias("w"), "route").agg(F.count(F.lit(1)).alias("count"))
            .select(*window_columns(F.col("w")), "route", "count"))


def windows_of_panes(panes: DataFrame, length_panes: int = 3) -> DataFrame:
    """Counts per sliding window of ``length_panes`` panes, from pane counts."""
    width = F.col("window_end") - F.col("window_start")
    starts = F.array(*[F.col("window_start") - width * i for i in range(length_panes)])
    return (panes.select(F.explode(starts).alias("window_start"), width.alias("width"), "route", "count")
            .withColumn("window_end", F.col("window_start") + F.col("width") * length_panes)
            .groupBy("window_start", "window_end", "route").agg(F.sum("count").alias("count")))


def route_counts(routed: DataFrame, pane: str = "10 minutes", length_panes: int = 3,
                 time_col: str = "dropoff_datetime", watermark: str | None = None) -> DataFrame:
    """Trips per (sliding window on dropoff, route): windows of 30 minutes every
    10. Trips are counted once, by panes; the pane counts are combined. Of a
    stream (one stateful aggregate): the windows themselves."""
    if not routed.isStreaming:
        return windows_of_panes(route_panes(routed, pane, time_col), length_panes)
    df = routed.withWatermark(time_col, watermark) if watermark else routed
    n, unit = pane.split()
    win = F.window(time_col, f"{int(n) * length_panes} {unit}", pane)
    return (df.groupBy(win.alias("w"), "route").agg(F.count(F.lit(1)).alias("count"))
            .select(*window_columns(F.col("w")), "route", "count"))


def closing_route_counts(routed: DataFrame, pane: str = "10 minutes", length_panes: int = 3,
                         time_col: str = "dropoff_datetime") -> DataFrame:
    """``route_counts`` of a stream with a watermark, for append mode: a pane's
    counts go on to a second aggregate when the pane closes, which gives each
    sliding window when it closes. Trips are counted once, by panes."""
    n, unit = pane.split()
    panes = routed.groupBy(F.window(time_col, pane).alias("pane"), "route").agg(F.count(F.lit(1)).alias("n"))
    win = F.window(F.window_time("pane"), f"{int(n) * length_panes} {unit}", pane)
    return (panes.groupBy(win.alias("w"), "route").agg(F.sum("n").alias("count"))
            .select(*window_columns(F.col("w")), "route", "count"))


def top_routes(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top k over the whole result: latest window first, then count; route
    breaks ties."""
    return counts.orderBy(F.col("window_start").desc(), F.col("window_end").desc(),
                          F.col("count").desc(), F.col("route")).limit(k)


def top_k_per_window(df: DataFrame, order, k: int, partition=("window_start", "window_end"),
                     rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_routes_per_window(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top k routes inside every window."""
    return top_k_per_window(counts, [F.col("count").desc(), F.col("route")], k)


def amount_per_mile(routed: DataFrame, length: str = "1 hour", time_col: str = "pickup_datetime",
                    watermark: str | None = None) -> DataFrame:
    """Σ total_amount / Σ trip_distance per (window on pickup, route)."""
    routed = routed.withWatermark(time_col, watermark) if watermark else routed
    win = F.window(time_col, length)
    agg = routed.groupBy(win.alias("w"), "route").agg(
        F.sum(F.col("total_amount").try_cast(EXACT)).alias("sum_total"),
        F.sum(F.col("trip_distance").try_cast(EXACT)).alias("sum_distance"))
    return agg.select(*window_columns(F.col("w")), "route",
                      F.try_divide(F.col("sum_total").cast("double"),
                                   F.col("sum_distance").cast("double")).alias("amount_per_mile"))


def top_amount_per_mile(apm: DataFrame, k: int = 10) -> DataFrame:
    return apm.orderBy(F.col("amount_per_mile").desc_nulls_last(), F.col("window_start"),
                       F.col("route")).limit(k)
