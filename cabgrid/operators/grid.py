"""Placing trips on the city grid (narrow projections, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cell_label, route_separator


def grid_cells(trips: DataFrame, size: int = 500, convention: str = "lat_lon") -> DataFrame:
    """Add ``cell_pickup`` and ``cell_dropoff`` (``size`` = 500 or 250 metres)."""
    return trips.withColumns({
        "cell_pickup": cell_label(F.col("pickup_longitude").cast("double"),
                                  F.col("pickup_latitude").cast("double"), size, convention),
        "cell_dropoff": cell_label(F.col("dropoff_longitude").cast("double"),
                                   F.col("dropoff_latitude").cast("double"), size, convention),
    })


def trip_routes(cells: DataFrame, convention: str = "lat_lon") -> DataFrame:
    """Add ``route`` = pickup cell and dropoff cell joined by ``/`` (or ``:``)."""
    sep = route_separator(convention)
    return cells.withColumn("route", F.concat_ws(sep, "cell_pickup", "cell_dropoff"))


def routed_trips(trips: DataFrame, size: int = 500, convention: str = "lat_lon") -> DataFrame:
    return trip_routes(grid_cells(trips, size, convention), convention)
