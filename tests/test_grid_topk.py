"""Grid cells, routes and top-k ordering."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabgrid.functions.columns import cell_label
from cabgrid.functions.constants import LIMIT_LAT, LIMIT_LON, ORIGIN_LAT, ORIGIN_LON
from cabgrid.operators import routes
from cabgrid.operators.grid import grid_cells, trip_routes


def point(spark, lon, lat):
    return spark.createDataFrame([(lon, lat, lon, lat)], "pickup_longitude double, pickup_latitude double, "
                                 "dropoff_longitude double, dropoff_latitude double")


def test_cell_conventions(spark):
    df = point(spark, -73.99, 40.7)
    a = grid_cells(df).first().cell_pickup
    b = grid_cells(df, convention="lon_lat_ceil").first().cell_pickup
    assert a.split("-")[0] == "173"
    assert b.split("-")[1] == "174"
    assert a.split("-")[1] == b.split("-")[0]


def test_route_separators(spark):
    df = point(spark, -73.99, 40.7)
    r1 = trip_routes(grid_cells(df)).first().route
    r2 = trip_routes(grid_cells(df, convention="lon_lat_ceil"), "lon_lat_ceil").first().route
    assert "/" in r1 and ":" in r2


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.floats(ORIGIN_LON + 1e-9, LIMIT_LON - 1e-9),
                          st.floats(LIMIT_LAT + 1e-9, ORIGIN_LAT - 1e-9)), min_size=1, max_size=20))
def test_cell_index_in_grid(spark, pts):
    df = spark.createDataFrame(pts, "lon double, lat double")
    for size, top in ((500, 300), (250, 600)):
        cells = df.select(cell_label(F.col("lon"), F.col("lat"), size).alias("c")).collect()
        for r in cells:
            lat_i, lon_i = (int(x) for x in r.c.split("-"))
            assert 0 <= lat_i <= top and 1 <= lon_i <= top


def test_top_routes_ties_by_route(spark):
    rows = [("2013-01-01 00:00:00", "b"), ("2013-01-01 00:00:00", "a"), ("2013-01-01 00:00:00", "c"),
            ("2013-01-01 00:00:00", "c")]
    df = spark.createDataFrame(rows, "t string, route string").select(
        F.col("t").cast("timestamp").alias("dropoff_datetime"), "route")
    counts = routes.route_counts(df, "10 minutes", 3)
    top = routes.top_routes(counts, 3).collect()
    assert [(r.route, r["count"]) for r in top] == [("c", 2), ("a", 1), ("b", 1)]
    per = routes.top_routes_per_window(counts, 1).collect()
    assert {r.route for r in per} == {"c"} and len(per) == 3


def test_price_breakdown_shares_sum_to_one(spark):
    from conftest import SF_SMALL
    from cabgrid.operators import areas
    from cabgrid.plans.catalog import valid
    pb = areas.price_breakdown(grid_cells(valid(spark, SF_SMALL), 500), tolls_digits=3)
    rows = pb.collect()
    assert len(rows) > 10
    for r in rows:
        total = r.fare + r.surcharge + r.mta_tax + r.tip + r.tolls
        assert abs(total - 1.0) <= 0.0025  # five shares, each rounded to 3 digits
