"""Validation and cleaning of trips (filters and projections only).

All predicates are on typed columns, so on a Parquet source they reach the
scan as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money, parse_timestamp
from ..functions.constants import (CLEAN_COLUMNS, CLEAN_PARTITIONS, ENRICHED_TYPES,
                                   JSON_DOUBLE_FIELDS, JSON_MONEY_FIELDS, JSON_RENAMES,
                                   LIMIT_LAT, LIMIT_LON, ORIGIN_LAT, ORIGIN_LON)
from .grid import grid_cells, trip_routes


def inside_box(prefix: str):
    lon = F.col(f"{prefix}_longitude")
    lat = F.col(f"{prefix}_latitude")
    return ((lon > F.lit(ORIGIN_LON)) & (lon < F.lit(LIMIT_LON))
            & (lat > F.lit(LIMIT_LAT)) & (lat < F.lit(ORIGIN_LAT)))


def valid_trip():
    """The condition of ``trip_valid``."""
    return (inside_box("pickup") & inside_box("dropoff") & (F.col("trip_time") > 0)
            & (F.col("trip_distance") > 0) & (F.col("total_amount") > 0))


def trip_valid(trips: DataFrame) -> DataFrame:
    """Trips whose four coordinates lie strictly inside the grid and whose
    ``trip_time``, ``trip_distance`` and ``total_amount`` are positive.
    Compared as doubles: a 0.44-mile trip is kept.

    An all-null row fails these comparisons, so no separate all-null drop is
    needed (one would reference every column and defeat column pruning)."""
    return trips.filter(valid_trip())


def trip_box_filter(trips: DataFrame) -> DataFrame:
    """Pipeline form: inside the grid, ``total_amount`` and ``trip_distance``
    positive (no ``trip_time``)."""
    return trips.filter(inside_box("pickup") & inside_box("dropoff")
                        & (F.col("total_amount") > 0) & (F.col("trip_distance") > 0))


def trip_typed_json(records: DataFrame) -> DataFrame:
    """Decoded JSON record -> renamed, typed trip (money, timestamps, doubles)."""
    df = records.withColumnsRenamed(JSON_RENAMES)
    df = df.withColumns({m: money(m) for m in JSON_MONEY_FIELDS})
    df = df.withColumns({t: parse_timestamp(t) for t in ("pickup_datetime", "dropoff_datetime")})
    df = df.withColumns({
        "TripStartDT": F.to_date("pickup_datetime"),
        "TripEndDT": F.to_date("dropoff_datetime"),
    })
    return df.withColumns({d: F.trim(F.col(d)).try_cast("double") for d in JSON_DOUBLE_FIELDS})


def trip_date_parts(trips: DataFrame, names: str = "table") -> DataFrame:
    """Calendar parts of the pickup.

    ``names="table"`` -> ``hourd/minuted/secondd`` (table layout),
    ``names="archive"`` -> ``hour/minute/second`` (archive layout).
    """
    if "TripStartDT" not in trips.columns:
        trips = trips.withColumns({"TripStartDT": F.to_date("pickup_datetime"),
                                   "TripEndDT": F.to_date("dropoff_datetime")})
    h, m, s = ("hourd", "minuted", "secondd") if names == "table" else ("hour", "minute", "second")
    return trips.withColumns({
        "TripStartDay": F.dayofmonth("TripStartDT"),
        "TripStartMonth": F.month("TripStartDT"),
        "TripStartYear": F.year("TripStartDT"),
        h: F.hour("pickup_datetime"),
        m: F.minute("pickup_datetime"),
        s: F.second("pickup_datetime"),
        "dayofweek": F.dayofweek("TripStartDT"),
        "week_day_full": F.date_format("TripStartDT", "EEEE"),
    })


def trip_clean(records: DataFrame) -> DataFrame:
    """Cleaned trip table from decoded JSON records.

    Outlier filter on typed values first (0 < passengers < 8, 0 <= tip < 30,
    1 <= fare < 150, 0 < distance < 100), then the table's columns. ``passenger_count`` stays text, as in the table layout.
    """
    df = trip_date_parts(trip_typed_json(records), names="table")
    pc = F.trim(F.col("passenger_count")).try_cast("double")
    df = df.filter((pc > 0) & (pc < 8)
                   & (F.col("tip_amount") >= 0) & (F.col("tip_amount") < 30)
                   & (F.col("fare_amount") >= 1) & (F.col("fare_amount") < 150)
                   & (F.col("trip_distance") > 0) & (F.col("trip_distance") < 100))
    cols = [F.col(n).cast(t).alias(n) for n, t in CLEAN_COLUMNS + CLEAN_PARTITIONS]
    return df.select(*cols)


def trip_enriched(records: DataFrame, size: int = 500, convention: str = "lat_lon") -> DataFrame:
    """The 33-column routed trip of the database sink: typed record, calendar
    parts, grid filter, cells and route."""
    df = trip_date_parts(trip_typed_json(records), names="table")
    df = trip_box_filter(df)
    return trip_routes(grid_cells(df, size, convention), convention)


ENRICHED_COLUMNS = [name for name, _ in ENRICHED_TYPES]
