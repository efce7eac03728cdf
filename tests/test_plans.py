"""Physical plans on a stored trip table: filters reach the Parquet scan,
projections prune columns, aggregates combine before the shuffle, top-k
stays a bounded heap."""

import re
import uuid

import pytest

from cabgrid.operators import routes
from cabgrid.operators.clean import trip_valid
from cabgrid.operators.grid import routed_trips
from cabgrid.session import shared_path
from cabgrid.sources.trips import load_trips
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    path = shared_path(spark, f"trips-{uuid.uuid4().hex}")
    load_trips(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def test_validation_filters_pushed_and_columns_pruned(stored):
    p = plan(trip_valid(stored).select("trip_id", "total_amount"))
    pushed = p.split("PushedFilters: ")[1].split("\n")[0]
    for f in ("GreaterThan(pickup_longitude,-74.916578)", "LessThan(dropoff_latitude,41.47718278)",
              "GreaterThan(trip_time,0.0)", "GreaterThan(trip_distance,0.0)", "GreaterThan(total_amount,0.0)"):
        assert f in pushed
    schema = p.split("ReadSchema: ")[1].split("\n")[0]
    for unused in ("medallion", "hack_license", "fare_amount", "tip_amount", "payment_type"):
        assert unused not in schema


def test_route_counts_partial_aggregation_and_topk(stored):
    counts = routes.route_counts(routed_trips(trip_valid(stored)))
    p = plan(routes.top_routes(counts))
    assert "TakeOrderedAndProject" in p
    assert p.count("HashAggregate") >= 2  # partial before the exchange, final after
    assert "BroadcastExchange" not in p  # nothing broadcast by hand
    assert ") Expand" not in p  # trips are counted by panes, not once per window


def test_per_window_topk_trimmed_before_shuffle(stored):
    counts = routes.route_counts(routed_trips(trip_valid(stored)))
    p = plan(routes.top_routes_per_window(counts))
    assert "WindowGroupLimit" in p


def full_exchanges(p, width):
    """Shuffles of rows with at least ``width`` columns."""
    return [x for x in p.split("\n\n") if ") Exchange" in x and int(x.split("Input [")[1].split("]")[0]) >= width]


def test_order_dependent_queries_shuffle_rows_once(spark, stored):
    """On a stored trip table, broadcast joins off: rows go through one
    shuffle, carries come from narrow scans."""
    from cabgrid.operators import congestion, drivers
    from cabgrid.operators.grid import grid_cells
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    trips = trip_valid(stored)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df, scans, windows in (
                (drivers.previous_ride(grid_cells(trips, 500)), 2, 2), (congestion.route_rising_runs(routed_trips(trips)), 2, 8),
                (congestion.congestion_alerts(routed_trips(trips)), 4, 10)):
            p = plan(df)
            assert len([x for x in p.split("\n\n") if ") Scan parquet" in x]) <= scans
            assert len(full_exchanges(p, 14)) <= 1
            assert len([x for x in p.split("\n\n") if ") Window\n" in x]) <= windows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_sliced_queries_shuffle_rows_once(spark, stored):
    """Cutting dense hours adds narrow scans and broadcasts of widths only."""
    from cabgrid.operators import congestion, drivers
    from cabgrid.operators.grid import grid_cells
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    trips = trip_valid(stored)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df in (drivers.previous_ride(grid_cells(trips, 500), max_rows=1000), congestion.congestion_alerts(routed_trips(trips), max_rows=1000)):
            p = plan(df)
            assert len(full_exchanges(p, 14)) <= 1
            sent = [int(x.split("Input [")[1].split("]")[0]) for x in p.split("\n\n") if ") BroadcastExchange" in x]
            assert sent and max(sent) <= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_widths_of_few_rows_are_not_broadcast_by_hand(spark, stored):
    """Slices of two rides: the widths grow with the rides, so no size bounds
    a broadcast of them."""
    from cabgrid.operators import congestion, drivers
    from cabgrid.operators.grid import grid_cells
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    trips = trip_valid(stored)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df in (drivers.previous_ride(grid_cells(trips, 500), max_rows=2), congestion.route_rising_runs(routed_trips(trips), max_rows=2),
                   congestion.congestion_alerts(routed_trips(trips), max_rows=2)):
            assert "BroadcastExchange" not in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def method_sizes(df):
    """Bytes of the largest generated method of each stage; the JVM compiles none above 8,000."""
    text = df.sparkSession.sparkContext._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_trip_derivation_is_compiled(spark):
    sizes = method_sizes(routed_trips(trip_valid(load_trips(spark, SF_SMALL))))
    assert sizes and max(sizes) < 8000


def test_building_a_query_starts_no_job(spark, monkeypatch):
    """No action before the caller's own (the pointer-doubling rounds of the
    reset mean, the streams and the training-data operators excepted)."""
    import __spark_entry__ as entry
    from test_oracle import BATCH_KEYS

    def action(self, *_, **__):
        raise AssertionError("an action while the query is built")

    for name in ("collect", "count", "first", "head", "take", "isEmpty", "toPandas", "toArrow", "checkpoint", "localCheckpoint", "foreach"):
        monkeypatch.setattr(type(spark.range(0)), name, action)
    for name in BATCH_KEYS:
        if name != "route_mean_reset":
            entry.QUERIES[name](spark, SF_SMALL)


def test_no_registered_query_pairs_rows(spark):
    """No cartesian product or nested-loop join in any batch query's plan."""
    import __spark_entry__ as entry
    from test_oracle import BATCH_KEYS
    for name in BATCH_KEYS:
        p = plan(entry.queries()[name](spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, f"{name}: {bad}"


def test_session_settings_are_left_alone(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.constraintPropagation.enabled", "spark.sql.sources.partitionOverwriteMode")}
    load_trips(spark, SF_SMALL).count()
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_cluster_needs_a_shared_folder(spark):
    from cabgrid.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Cluster())


def test_package_can_be_shipped(spark):
    from cabgrid.session import ship_package
    ship_package(spark)
