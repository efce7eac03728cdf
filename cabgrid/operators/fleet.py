"""Fleet-wide reports over the cleaned / enriched trip tables, table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EXACT
from ..sources import tables


def vendor_revenue(clean: DataFrame) -> DataFrame:
    """round(Σ total_amount) per vendor."""
    return clean.groupBy("vendorid").agg(
        F.round(F.sum(F.col("total_amount").try_cast(EXACT)), 0).cast("double").alias("amount"))


def vendor_revenue_report(revenue: DataFrame) -> DataFrame:
    """One text line per vendor, in the layout of the e-mailed report:
    ``Vendor ID Number: <id>   :    Total Amount (USD): <amount>``."""
    amount = F.concat(F.col("amount").cast("long").cast("string"), F.lit(".0"))
    line = F.concat(F.lit("Vendor ID Number: "), F.coalesce(F.col("vendorid"), F.lit("None")),
                    F.lit("   :    Total Amount (USD): "), amount)
    return revenue.select("vendorid", line.alias("line"))


def fleet_totals(enriched: DataFrame) -> DataFrame:
    """Σ trip_distance and Σ passenger_count over the whole table."""
    return enriched.agg(
        F.sum(F.col("trip_distance").try_cast(EXACT)).cast("double").alias("total_trip_distance"),
        F.sum(F.trim(F.col("passenger_count")).try_cast("double")).alias("total_passengers"))


def table_preview(table: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows of a table in key order (a top-n, not a full sort)."""
    return tables.preview(table, order_by, n)


def table_filter_eq(table: DataFrame, column: str, value) -> DataFrame:
    """Rows where ``column == value`` (pushed to the scan as a filter)."""
    return tables.filter_eq(table, column, value)
