"""Area questions: profit per pickup cell, dropoffs per cell, profitability,
price breakdown.

Aggregates group by (cell, window) with partial aggregation before the
shuffle. Money is summed as wide decimals so totals are exact and do not
depend on partitioning; ratios divide the exact sums as doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import EXACT, window_columns
from .routes import top_k_per_window


def _money_sum(name: str):
    return F.sum(F.col(name).try_cast(EXACT))


def area_profit_avg(cells: DataFrame, length: str = "15 minutes",
                    time_col: str = "dropoff_datetime", watermark: str | None = None) -> DataFrame:
    """Average fare + tip per (pickup cell, window on dropoff)."""
    cells = cells.withWatermark(time_col, watermark) if watermark else cells
    profit = F.col("fare_amount").try_cast(EXACT) + F.col("tip_amount").try_cast(EXACT)
    win = F.window(time_col, length)
    agg = cells.groupBy("cell_pickup", win.alias("w")).agg(
        F.sum(profit).alias("_p"), F.count(profit).alias("_n"))
    return agg.select("cell_pickup", *window_columns(F.col("w")),
                      F.try_divide(F.col("_p").cast("double"), F.col("_n")).alias("avg_profit"))


def area_dropoffs(cells: DataFrame, length: str = "30 minutes",
                  time_col: str = "dropoff_datetime", watermark: str | None = None) -> DataFrame:
    """Number of dropoffs per (dropoff cell, window on dropoff)."""
    cells = cells.withWatermark(time_col, watermark) if watermark else cells
    win = F.window(time_col, length)
    return (cells.groupBy("cell_dropoff", win.alias("w")).agg(F.count(F.lit(1)).alias("count"))
            .select("cell_dropoff", *window_columns(F.col("w")), "count"))


def area_profitability(profit: DataFrame, dropoffs: DataFrame, k: int = 5) -> DataFrame:
    """Top k of (profit row x dropoff row of the same cell) by profit window
    ascending, then ``avg_profit / count`` descending.

    The pairing is on the cell only, so every profit window of a cell meets
    every dropoff window of that cell. Only the first k rows are reported,
    and those can be found without forming all pairs: for one profit row the
    best partners are the k dropoff windows of its cell with the fewest
    dropoffs (positive profit), the most (negative profit) or the earliest
    (zero or unknown profit). Each profit row is joined with at most 3k
    candidates, so the work is linear in the number of profit rows.
    Ties: cell, then dropoff window, ascending.
    """
    d = dropoffs.select(F.col("cell_dropoff").alias("cell"),
                        F.col("window_start").alias("taxis_window_start"),
                        F.col("window_end").alias("taxis_window_end"),
                        F.col("count").alias("dropoffs"))
    by_cell = Window.partitionBy("cell")
    cand = (d.withColumn("_r1", F.row_number().over(by_cell.orderBy("dropoffs", "taxis_window_start")))
            .withColumn("_r2", F.row_number().over(by_cell.orderBy(F.desc("dropoffs"), "taxis_window_start")))
            .withColumn("_r3", F.row_number().over(by_cell.orderBy("taxis_window_start")))
            .filter((F.col("_r1") <= k) | (F.col("_r2") <= k) | (F.col("_r3") <= k))
            .drop("_r1", "_r2", "_r3"))
    p = profit.select(F.col("cell_pickup").alias("cell"), "window_start", "window_end", "avg_profit")
    pairs = p.join(cand, "cell").select(
        "cell", "window_start", "window_end", "taxis_window_start", "taxis_window_end",
        (F.col("avg_profit") / F.col("dropoffs")).alias("profitability"))
    return pairs.orderBy("window_start", "window_end", F.col("profitability").desc_nulls_last(),
                         "cell", "taxis_window_start").limit(k)


def area_profitability_aligned(cells: DataFrame, length: str = "15 minutes") -> DataFrame:
    """Profitability with both sides on the same window: average profit of
    trips starting in the cell / dropoffs in the cell, per (cell, window).

    Both aggregates are keyed on (cell, window struct), so the join reuses
    their hash partitioning instead of shuffling again.
    """
    profit = F.col("fare_amount").try_cast(EXACT) + F.col("tip_amount").try_cast(EXACT)
    win = F.window("dropoff_datetime", length)
    p = cells.groupBy(F.col("cell_pickup").alias("cell"), win.alias("w")).agg(
        F.sum(profit).alias("_p"), F.count(profit).alias("_n"))
    d = cells.groupBy(F.col("cell_dropoff").alias("cell"), win.alias("w")).agg(
        F.count(F.lit(1)).alias("dropoffs"))
    avg_profit = F.try_divide(F.col("_p").cast("double"), F.col("_n"))
    return p.join(d, ["cell", "w"]).select(
        "cell", *window_columns(F.col("w")), avg_profit.alias("avg_profit"), "dropoffs",
        (avg_profit / F.col("dropoffs")).alias("profitability"))


def price_breakdown(cells: DataFrame, length: str = "2 hours", time_col: str = "pickup_datetime",
                    tolls_digits: int = 0, watermark: str | None = None) -> DataFrame:
    """Σ total and the share of each price component per (pickup cell, window).

    Shares are rounded to 3 digits, tolls to ``tolls_digits`` (0 as in the
    original report).
    """
    cells = cells.withWatermark(time_col, watermark) if watermark else cells
    win = F.window(time_col, length)
    agg = cells.groupBy("cell_pickup", win.alias("w")).agg(
        *[_money_sum(c).alias(f"_{c}") for c in
          ("total_amount", "fare_amount", "surcharge", "mta_tax", "tip_amount", "tolls_amount")])
    total = F.col("_total_amount").cast("double")

    def share(c: str, digits: int = 3):
        return F.round(F.try_divide(F.col(f"_{c}").cast("double"), total), digits)

    return agg.select(
        "cell_pickup", *window_columns(F.col("w")),
        F.round(total, 3).alias("sum_total_amount"),
        share("fare_amount").alias("fare"), share("surcharge").alias("surcharge"),
        share("mta_tax").alias("mta_tax"), share("tip_amount").alias("tip"),
        share("tolls_amount", tolls_digits).alias("tolls"))


def top_price_breakdown(pb: DataFrame, k: int = 5) -> DataFrame:
    return pb.orderBy(F.col("sum_total_amount").desc_nulls_last(), "window_start",
                      "cell_pickup").limit(k)


def price_breakdown_per_window(pb: DataFrame, k: int = 5) -> DataFrame:
    return top_k_per_window(pb, [F.col("sum_total_amount").desc_nulls_last(), F.col("cell_pickup")], k)
