"""Decoding, validation and cleaning on hand-made rows (FIXTURES §8)."""

import datetime as dt

from pyspark.sql import functions as F

from cabgrid.functions.columns import money, parse_timestamp
from cabgrid.functions.constants import LIMIT_LAT, ORIGIN_LON
from cabgrid.operators.clean import trip_valid
from cabgrid.sources.decode import trip_decode_csv

GOOD = ("m1,h1,2013-01-01 00:00:00,2013-01-01 00:10:00,600,0.44,"
        "-73.99,40.75,-73.98,40.76,CSH,5.0,0.5,0.5,1.0,0.0,7.0")


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_bad_lines_rejected_without_error(spark):
    short = "m1,h1,2013-01-01 00:00:00"
    text_in_number = GOOD.replace(",600,", ",abc,")
    df = trip_valid(trip_decode_csv(lines(spark, GOOD, short, "", text_in_number)))
    rows = df.collect()
    assert [r.medallion for r in rows] == ["m1"]
    assert rows[0].trip_distance == 0.44  # sub-mile trip kept (compared as double)


def test_null_line_dropped_by_decode(spark):
    df = spark.createDataFrame([(None,), (GOOD,)], "value string")
    assert trip_decode_csv(df).count() == 1


def test_box_limit_is_strict(spark):
    on_edge = GOOD.replace("-73.99,40.75", f"{ORIGIN_LON},40.75")
    on_lat_edge = GOOD.replace("-73.98,40.76", f"-73.98,{LIMIT_LAT}")
    assert trip_valid(trip_decode_csv(lines(spark, on_edge, on_lat_edge))).count() == 0


def test_decode_subset_with_types(spark):
    df = trip_decode_csv(lines(spark, GOOD), [("trip_time", "int"), ("total_amount", "float")])
    r = df.first()
    assert r.trip_time == 600 and abs(r.total_amount - 7.0) < 1e-6


def test_money_rules(spark):
    df = spark.createDataFrame([(None,), ("$12.50",), ("abc",), ("3",)], "m string")
    got = [r[0] for r in df.select(money("m")).collect()]
    assert got == [0.0, 12.5, None, 3.0]


def test_timestamp_forms(spark):
    df = spark.createDataFrame([("2015-01-01T00:34:42.000",), ("2013-01-01 00:02:00",), ("garbage",)],
                               "t string")
    got = [r[0] for r in df.select(parse_timestamp("t")).collect()]
    assert got == [dt.datetime(2015, 1, 1, 0, 34, 42), dt.datetime(2013, 1, 1, 0, 2), None]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    texts = ["1/5/2015 3:04:05 PM", "2015-01-01T00:34:42+02:00", "2015-01-01T00:34:42Z", "2013-03-10 02:30:00", "2015-07-01 00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    exp = [dt.datetime(2015, 1, 5, 15, 4, 5), dt.datetime(2014, 12, 31, 22, 34, 42), dt.datetime(2015, 1, 1, 0, 34, 42),
           dt.datetime(2013, 3, 10, 2, 30), dt.datetime(2015, 7, 1)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = df.select(parse_timestamp("t").alias("wall"), F.unix_micros(parse_timestamp("t", ntz=False)).alias("us")).collect()
            assert [r.wall for r in got] == exp
            assert [r.us for r in got] == [int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 10 ** 6 for t in exp]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_amount_per_mile_of_short_trips(spark):
    """Distances are summed as they are: 2 x 5 USD over 2 x 0.004 miles."""
    from cabgrid.operators import fleet, routes
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("r", t, 5.0, 0.004, "1"), ("r", t, 5.0, 0.004, "1")],
                               "route string, pickup_datetime timestamp_ntz, total_amount double, trip_distance double, passenger_count string")
    assert [r.amount_per_mile for r in routes.amount_per_mile(df).collect()] == [1250.0]
    assert fleet.fleet_totals(df).first().total_trip_distance == 0.008
    huge = df.withColumn("total_amount", F.lit(1e30))
    assert routes.amount_per_mile(huge).first().amount_per_mile is None  # out of any range: unknown, no error


def test_drivers_rank_before_rounding(spark):
    from cabgrid.operators import drivers
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 1.0, 4.0), ("b", t, 1.0000000001, 4.0)],
                               "hack_license string, dropoff_datetime timestamp_ntz, tip_amount double, total_amount double")
    best = drivers.most_pleasant_driver(drivers.driver_tip_rate(df)).first()
    assert best.hack_license == "b" and best.avg_tip_percentage == 0.25


def test_clean_filter_runs_before_drop(spark):
    from cabgrid.operators.clean import trip_clean
    from cabgrid.sources.decode import trip_decode_json
    rec = ('{"vendorid":"2","lpep_pickup_datetime":"2015-01-01 00:34:42","lpep_dropoff_datetime":'
           '"2015-01-01 00:50:00","passenger_count":"%s","trip_distance":"2.5","fare_amount":"$%s",'
           '"tip_amount":"1.0","total_amount":"14.0","pickup_longitude":"-73.9","pickup_latitude":"40.7",'
           '"dropoff_longitude":"-73.9","dropoff_latitude":"40.7"}')
    recs = spark.createDataFrame([(rec % ("1", "12.0"),), (rec % ("9", "12.0"),), (rec % ("1", "0.5"),)],
                                 "value string")
    out = trip_clean(trip_decode_json(recs)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.passenger_count == "1" and r.vendorid == "2" and r.TripStartMonth == 1
    assert r.week_day_full == "Thursday" and r.dayofweek == 5 and r.hourd == 0 and r.minuted == 34
    assert "fare_amount" not in out[0].asDict()
