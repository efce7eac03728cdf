"""Every registered batch query against its DuckDB SQL twin.

An oracle match on zero rows proves nothing, so each key also has a
minimum row count (at sf0.01 for the sparse ones, at sf0.001 otherwise).
"""

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import compare
from conftest import SF_ORACLE, SF_SMALL, TABLES

STREAM_KEYS = {k for k in entry.QUERIES if "_stream" in k} | {"archive_readback", "register_clean_table", "clean_files_registered"}
# Keys whose interesting rows are sparse: checked at sf0.01 with a floor.
SPARSE = {"congestion_alerts": 100, "congestion_alerts_lon_lat": 100, "congestion_alerts_sliced": 100, "idle_time": 100, "idle_time_uncapped": 100,
          "idle_time_lon_lat": 100, "area_profitability": 5, "top_routes": 10,
          "most_pleasant_driver": 1, "table_filter_eq": 1, "fleet_totals": 1}
BATCH_KEYS = [k for k in entry.QUERIES if k not in STREAM_KEYS]


def oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def cons():
    return {SF_SMALL: oracle(SF_SMALL), SF_ORACLE: oracle(SF_ORACLE)}


def test_every_query_has_oracle_sql():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", BATCH_KEYS)
def test_batch_query_matches_oracle(spark, cons, name):
    sf = SF_ORACLE if name in SPARSE else SF_SMALL
    got = entry.queries()[name](spark, sf).toPandas()
    exp = cons[sf].execute(entry.oracle_sql()[name]).df()
    assert len(got) >= SPARSE.get(name, 1)
    assert compare(got, exp) == "OK"


STREAM_FLOOR = {"area_profitability_joined_stream": 5, "idle_time_stream_late": 100, "congestion_stream_late": 100, "route_mean_reset_stream_late": 9000,
                "most_pleasant_driver_stream_update": 1, "top_price_breakdown_stream": 5, "top_amount_per_mile_stream": 10}


@pytest.mark.parametrize("name", sorted(STREAM_FLOOR))
def test_stream_query_matches_oracle(spark, cons, name):
    got = entry.queries()[name](spark, SF_ORACLE).toPandas()
    assert len(got) >= STREAM_FLOOR[name]
    assert compare(got, cons[SF_ORACLE].execute(entry.oracle_sql()[name]).df()) == "OK"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "route", "count"]
    assert df.count() == 10
