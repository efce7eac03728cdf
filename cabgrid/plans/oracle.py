"""DuckDB SQL twins of the registered queries (the correctness oracle).

Every statement reads the ``events`` view (or a TPC-H-ish table) and repeats
the trip derivation, so the oracle shares no code path with Spark.
"""

from __future__ import annotations

from ..functions.constants import LIMIT_LAT, LIMIT_LON, ORIGIN_LAT, ORIGIN_LON, SHIFT_LAT_500, SHIFT_LON_500
from ..sources.fixture import number, trip_columns

LON0, LAT0, LON1, LAT1 = map(number, (ORIGIN_LON, ORIGIN_LAT, LIMIT_LON, LIMIT_LAT))
DLON, DLAT = number(SHIFT_LON_500), number(SHIFT_LAT_500)

TRIPS = "trips AS (SELECT " + ",\n ".join(f"{e} AS {n}" for e, n in trip_columns("VARCHAR")) + "\nFROM events)"

TRIP_COLS = ("trip_id, medallion, hack_license, pickup_datetime, dropoff_datetime, trip_time, "
             "trip_distance, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, "
             "payment_type, fare_amount, surcharge, mta_tax, tip_amount, tolls_amount, total_amount")


def box(prefix: str) -> str:
    return (f"{prefix}_longitude > {LON0} AND {prefix}_longitude < {LON1} AND "
            f"{prefix}_latitude > {LAT1} AND {prefix}_latitude < {LAT0}")


VALID_WHERE = (f"{box('pickup')} AND {box('dropoff')} AND trip_time > 0 "
               "AND trip_distance > 0 AND total_amount > 0")

VALID = f"valid AS (SELECT * FROM trips WHERE {VALID_WHERE})"


def cell(prefix: str, size: int = 500, convention: str = "lat_lon") -> str:
    div = 1 if size == 500 else 2
    dlon, dlat = f"({DLON}/{div})", f"({DLAT}/{div})"
    lon_idx = f"CAST(CEIL(({prefix}_longitude - ({LON0}))/{dlon}) AS BIGINT)"
    if convention == "lat_lon":
        lat_idx = f"(-CAST(CEIL(({prefix}_latitude - {LAT0})/{dlat}) AS BIGINT))"
        return f"(CAST({lat_idx} AS VARCHAR) || '-' || CAST({lon_idx} AS VARCHAR))"
    lat_idx = f"CAST(CEIL(({LAT0} - {prefix}_latitude)/{dlat}) AS BIGINT)"
    return f"(CAST({lon_idx} AS VARCHAR) || '-' || CAST({lat_idx} AS VARCHAR))"


def cells(src: str, name: str, size: int = 500, convention: str = "lat_lon") -> str:
    sep = "/" if convention == "lat_lon" else ":"
    cp, cd = cell("pickup", size, convention), cell("dropoff", size, convention)
    return (f"{name} AS (SELECT *, {cp} AS cell_pickup, {cd} AS cell_dropoff, "
            f"{cp} || '{sep}' || {cd} AS route FROM {src})")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ROUTED500 = cells("valid", "routed")
ROUTED250 = cells("valid", "routed250", 250)

MONEY = "DECIMAL(28,9)"
AVG_DIGITS = 9

ROUTE_COUNTS = ("route_counts AS (SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, "
                "route, COUNT(*) AS count FROM (SELECT route, time_bucket(INTERVAL 10 MINUTE, dropoff_datetime) "
                "- k * INTERVAL 10 MINUTE AS window_start FROM routed, range(3) t(k) WHERE dropoff_datetime IS NOT NULL) GROUP BY ALL)")


def fixed_sql(expr: str, d: int) -> str:
    s = 10 ** d
    u = f"CAST(ROUND(({expr}) * {s}e0) AS BIGINT)"
    return (f"(CASE WHEN {u} < 0 THEN '-' ELSE '' END || CAST(ABS({u}) // {s} AS VARCHAR) "
            f"|| '.' || LPAD(CAST(ABS({u}) % {s} AS VARCHAR), {d}, '0'))")


DOLLAR = "(CASE WHEN trip_id % 7 = 0 THEN '$' ELSE '' END)"



def _when(c: str) -> str:
    return (f"CASE WHEN trip_id % 41 = 0 THEN strftime({c}, '%-m/%-d/%Y %-I:%M:%S %p') "
            f"ELSE strftime({c}, '%Y-%m-%d %H:%M:%S') END")


def _time(c: str) -> str:
    return f"coalesce(TRY_CAST({c} AS TIMESTAMP), try_strptime({c}, '%m/%d/%Y %I:%M:%S %p'))"


JSON_FIELDS_SQL = {
    "vendorid": "CAST(1 + trip_id % 2 AS VARCHAR)",
    "lpep_pickup_datetime": _when("pickup_datetime"),
    "lpep_dropoff_datetime": _when("coalesce(dropoff_datetime, pickup_datetime)"),
    "store_and_fwd_flag": "'N'",
    "ratecodeid": "'1'",
    "pickup_longitude": fixed_sql("pickup_longitude", 6),
    "pickup_latitude": fixed_sql("pickup_latitude", 6),
    "dropoff_longitude": fixed_sql("dropoff_longitude", 6),
    "dropoff_latitude": fixed_sql("dropoff_latitude", 6),
    "passenger_count": "CAST(trip_id % 10 AS VARCHAR)",
    "trip_distance": fixed_sql("trip_distance", 4),
    "fare_amount": f"{DOLLAR} || {fixed_sql('fare_amount', 2)}",
    "extra": fixed_sql("surcharge", 2),
    "mta_tax": f"{DOLLAR} || {fixed_sql('mta_tax', 2)}",
    "tip_amount": f"CASE WHEN trip_id % 31 = 0 THEN NULL ELSE {DOLLAR} || {fixed_sql('tip_amount', 2)} END",
    "tolls_amount": f"CASE WHEN trip_id % 37 = 0 THEN 'n/a' ELSE {DOLLAR} || {fixed_sql('tolls_amount', 2)} END",
    "improvement_surcharge": "'0.30'",
    "total_amount": f"{DOLLAR} || {fixed_sql('total_amount', 2)}",
    "payment_type": "payment_type",
    "trip_type": "'1'",
}

JSONREC = ("jsonrec AS (SELECT trip_id, "
           + ", ".join(f"{v} AS {k}" for k, v in JSON_FIELDS_SQL.items()) + " FROM trips)")


def _json_text() -> str:
    parts = []
    for i, k in enumerate(JSON_FIELDS_SQL):
        sep = "," if i else ""
        piece = f"'{sep}\"{k}\":\"' || {k} || '\"'"
        parts.append(f"COALESCE({piece}, '')")
    return "'{' || " + " || ".join(parts) + " || '}'"


def _money(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 0e0 ELSE TRY_CAST(TRIM(REPLACE({c}, '$', '')) AS DOUBLE) END"


TYPED = f"""typed AS (SELECT trip_id, vendorid,
 {_time('lpep_pickup_datetime')} AS pickup_datetime,
 {_time('lpep_dropoff_datetime')} AS dropoff_datetime,
 store_and_fwd_flag, ratecodeid,
 TRY_CAST(TRIM(pickup_longitude) AS DOUBLE) AS pickup_longitude,
 TRY_CAST(TRIM(pickup_latitude) AS DOUBLE) AS pickup_latitude,
 TRY_CAST(TRIM(dropoff_longitude) AS DOUBLE) AS dropoff_longitude,
 TRY_CAST(TRIM(dropoff_latitude) AS DOUBLE) AS dropoff_latitude,
 passenger_count, TRY_CAST(TRIM(trip_distance) AS DOUBLE) AS trip_distance,
 {_money('fare_amount')} AS fare_amount, extra, {_money('mta_tax')} AS mta_tax,
 {_money('tip_amount')} AS tip_amount, {_money('tolls_amount')} AS tolls_amount,
 improvement_surcharge, {_money('total_amount')} AS total_amount,
 payment_type AS PaymentType, trip_type,
 CAST({_time('lpep_pickup_datetime')} AS DATE) AS TripStartDT,
 CAST({_time('lpep_dropoff_datetime')} AS DATE) AS TripEndDT
FROM jsonrec)"""


def dated(src: str, name: str, h: str = "hourd", m: str = "minuted", s: str = "secondd") -> str:
    return (f"{name} AS (SELECT *, CAST(day(TripStartDT) AS INTEGER) AS TripStartDay, "
            f"CAST(month(TripStartDT) AS INTEGER) AS TripStartMonth, "
            f"CAST(year(TripStartDT) AS INTEGER) AS TripStartYear, "
            f"CAST(hour(pickup_datetime) AS INTEGER) AS {h}, "
            f"CAST(minute(pickup_datetime) AS INTEGER) AS {m}, "
            f"CAST(second(pickup_datetime) AS INTEGER) AS {s}, "
            f"CAST(dayofweek(TripStartDT) + 1 AS INTEGER) AS dayofweek, "
            f"dayname(TripStartDT) AS week_day_full FROM {src})")


CLEAN = """clean AS (SELECT pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
 passenger_count, trip_distance, tip_amount, total_amount, TripStartDay, TripStartYear, hourd, minuted,
 secondd, dayofweek, week_day_full, vendorid, TripStartMonth FROM dated_t
 WHERE TRY_CAST(TRIM(passenger_count) AS DOUBLE) > 0 AND TRY_CAST(TRIM(passenger_count) AS DOUBLE) < 8
 AND tip_amount >= 0 AND tip_amount < 30 AND fare_amount >= 1 AND fare_amount < 150
 AND trip_distance > 0 AND trip_distance < 100)"""

ENRICHED_COLS = ("trip_id, vendorid, pickup_datetime, dropoff_datetime, store_and_fwd_flag, ratecodeid, "
                 "pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, passenger_count, "
                 "trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, "
                 "total_amount, PaymentType, trip_type, TripStartDT, TripEndDT, TripStartDay, TripStartMonth, "
                 "TripStartYear, hourd, minuted, secondd, dayofweek, week_day_full, cell_pickup, cell_dropoff, route")

ENRICHED = [TRIPS, JSONREC, TYPED, dated("typed", "dated_t"),
            f"boxed AS (SELECT * FROM dated_t WHERE {box('pickup')} AND {box('dropoff')} "
            "AND total_amount > 0 AND trip_distance > 0)",
            cells("boxed", "enriched")]

JSON_CTES = [TRIPS, JSONREC, TYPED, dated("typed", "dated_t"), CLEAN]

BASE = [TRIPS, VALID]


def win(ts: str, minutes: int) -> str:
    return (f"time_bucket(INTERVAL {minutes} MINUTE, {ts}) AS window_start, "
            f"time_bucket(INTERVAL {minutes} MINUTE, {ts}) + INTERVAL {minutes} MINUTE AS window_end")


def msum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS {MONEY})) AS DOUBLE)"


PROFIT_AVG = (f"profit AS (SELECT cell_pickup, {win('dropoff_datetime', 15)}, "
              f"CAST(SUM(CAST(fare_amount AS {MONEY}) + CAST(tip_amount AS {MONEY})) AS DOUBLE) "
              f"/ COUNT(CAST(fare_amount AS {MONEY}) + CAST(tip_amount AS {MONEY})) AS avg_profit "
              "FROM routed250 WHERE dropoff_datetime IS NOT NULL GROUP BY ALL)")
DROPOFFS = (f"taxis AS (SELECT cell_dropoff, {win('dropoff_datetime', 30)}, COUNT(*) AS count "
            "FROM routed250 WHERE dropoff_datetime IS NOT NULL GROUP BY ALL)")
TIP_RATE = (f"rates AS (SELECT {win('dropoff_datetime', 1440)}, hack_license, "
            "AVG(tip_amount / total_amount) AS raw_rate FROM valid WHERE dropoff_datetime IS NOT NULL GROUP BY ALL)")
RATE_COLS = f"window_start, window_end, hack_license, ROUND(raw_rate, {AVG_DIGITS}) AS avg_tip_percentage"
PRICE = (f"pb AS (SELECT cell_pickup, {win('pickup_datetime', 120)}, "
         f"ROUND({msum('total_amount')}, 3) AS sum_total_amount, "
         f"ROUND({msum('fare_amount')} / {msum('total_amount')}, 3) AS fare, "
         f"ROUND({msum('surcharge')} / {msum('total_amount')}, 3) AS surcharge, "
         f"ROUND({msum('mta_tax')} / {msum('total_amount')}, 3) AS mta_tax, "
         f"ROUND({msum('tip_amount')} / {msum('total_amount')}, 3) AS tip, "
         f"ROUND({msum('tolls_amount')} / {msum('total_amount')}, 0) AS tolls "
         "FROM routed GROUP BY ALL)")
APM = (f"apm AS (SELECT {win('pickup_datetime', 60)}, route, "
       f"{msum('total_amount')} / {msum('trip_distance')} AS amount_per_mile FROM routed GROUP BY ALL)")
PREV = ("prev AS (SELECT *, LAG(cell_dropoff) OVER w AS prev_cell_dropoff, "
        "LAG(dropoff_datetime) OVER w AS prev_dropoff_datetime FROM routed "
        "WINDOW w AS (PARTITION BY hack_license ORDER BY pickup_datetime, trip_id))")
RUNS = """lagged AS (SELECT *, LAG(trip_time) OVER (PARTITION BY route ORDER BY dropoff_datetime, trip_id) AS prev_t FROM routed WHERE dropoff_datetime IS NOT NULL),
flagged AS (SELECT *, SUM(CASE WHEN prev_t IS NULL OR trip_time <= prev_t THEN 1 ELSE 0 END)
  OVER (PARTITION BY route ORDER BY dropoff_datetime, trip_id ROWS UNBOUNDED PRECEDING) AS run_id FROM lagged),
runs AS (SELECT *, ROW_NUMBER() OVER r - 1 AS run_length, FIRST_VALUE(trip_time) OVER r AS first_trip_time,
  FIRST_VALUE(pickup_longitude) OVER r AS first_pickup_longitude, FIRST_VALUE(pickup_latitude) OVER r AS first_pickup_latitude,
  AVG(trip_time) OVER (PARTITION BY route ORDER BY dropoff_datetime RANGE BETWEEN INTERVAL 4 HOURS PRECEDING AND CURRENT ROW) AS route_mean
  FROM flagged WINDOW r AS (PARTITION BY route, run_id ORDER BY dropoff_datetime, trip_id))"""


def sql_map() -> dict[str, str]:
    routed = BASE + [ROUTED500]
    c250 = BASE + [ROUTED250]
    q = {}
    q["trip_valid"] = with_(*BASE) + "SELECT * FROM valid"
    q["trip_decode_csv"] = with_(TRIPS) + "SELECT * FROM trips"
    q["trip_decode_json"] = with_(TRIPS, JSONREC) + "SELECT * FROM jsonrec"
    q["trip_date_parts"] = (with_(TRIPS, JSONREC, TYPED, dated("typed", "d", "hour", "minute", "second"))
                            + "SELECT trip_id, pickup_datetime, TripStartDT, TripEndDT, TripStartDay, "
                              "TripStartMonth, TripStartYear, hour, minute, second, dayofweek, week_day_full FROM d")
    q["trip_clean"] = with_(*JSON_CTES) + "SELECT * FROM clean"
    q["trip_valid_routes"] = with_(*ENRICHED) + f"SELECT {ENRICHED_COLS} FROM enriched"
    q["grid_cells_500"] = with_(*routed) + "SELECT trip_id, cell_pickup, cell_dropoff FROM routed"
    q["grid_cells_250"] = with_(*c250) + "SELECT trip_id, cell_pickup, cell_dropoff FROM routed250"
    q["trip_routes"] = with_(*routed) + "SELECT trip_id, cell_pickup, cell_dropoff, route FROM routed"
    q["route_counts"] = with_(*routed, ROUTE_COUNTS) + "SELECT * FROM route_counts"
    q["top_routes"] = (with_(*routed, ROUTE_COUNTS) + "SELECT * FROM route_counts "
                       "ORDER BY window_start DESC, window_end DESC, count DESC, route LIMIT 10")
    q["top_routes_per_window"] = (with_(*routed, ROUTE_COUNTS) + "SELECT * FROM (SELECT *, CAST(ROW_NUMBER() "
                                  "OVER (PARTITION BY window_start, window_end ORDER BY count DESC, route) AS INTEGER) "
                                  "AS rank FROM route_counts) WHERE rank <= 10")
    q["area_profit_avg"] = with_(*c250, PROFIT_AVG) + "SELECT * FROM profit"
    q["area_dropoffs"] = with_(*c250, DROPOFFS) + "SELECT * FROM taxis"
    q["area_profitability"] = (
        with_(*c250, PROFIT_AVG, DROPOFFS)
        + "SELECT profit.cell_pickup AS cell, profit.window_start, profit.window_end, "
          "taxis.window_start AS taxis_window_start, taxis.window_end AS taxis_window_end, "
          "profit.avg_profit / taxis.count AS profitability FROM taxis JOIN profit ON "
          "taxis.cell_dropoff = profit.cell_pickup ORDER BY profit.window_start, profit.window_end, "
          "profitability DESC NULLS LAST, cell, taxis_window_start LIMIT 5")
    q["area_profitability_aligned"] = (
        with_(*c250, PROFIT_AVG.replace("profit AS", "p AS"),
              f"d AS (SELECT cell_dropoff, {win('dropoff_datetime', 15)}, COUNT(*) AS dropoffs "
              "FROM routed250 WHERE dropoff_datetime IS NOT NULL GROUP BY ALL)")
        + "SELECT p.cell_pickup AS cell, p.window_start, p.window_end, p.avg_profit, d.dropoffs, "
          "p.avg_profit / d.dropoffs AS profitability FROM p JOIN d ON p.cell_pickup = d.cell_dropoff "
          "AND p.window_start = d.window_start")
    q["driver_tip_rate"] = with_(*BASE, TIP_RATE) + f"SELECT {RATE_COLS} FROM rates"
    q["most_pleasant_driver"] = (with_(*BASE, TIP_RATE) + f"SELECT {RATE_COLS} FROM rates ORDER BY "
                                 "raw_rate DESC NULLS LAST, window_start, hack_license LIMIT 1")
    q["pleasant_driver_per_day"] = (with_(*BASE, TIP_RATE) + f"SELECT {RATE_COLS}, rank FROM (SELECT *, CAST(ROW_NUMBER() OVER "
                                    "(PARTITION BY window_start, window_end ORDER BY raw_rate DESC "
                                    "NULLS LAST, hack_license) AS INTEGER) AS rank FROM rates) WHERE rank <= 1")
    q["price_breakdown"] = with_(*routed, PRICE) + "SELECT * FROM pb"
    q["top_price_breakdown"] = (with_(*routed, PRICE) + "SELECT * FROM pb ORDER BY sum_total_amount DESC "
                                "NULLS LAST, window_start, cell_pickup LIMIT 5")
    q["price_breakdown_per_window"] = (with_(*routed, PRICE) + "SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER "
                                       "(PARTITION BY window_start, window_end ORDER BY sum_total_amount DESC "
                                       "NULLS LAST, cell_pickup) AS INTEGER) AS rank FROM pb) WHERE rank <= 5")
    q["amount_per_mile"] = with_(*routed, APM) + "SELECT * FROM apm"
    q["top_amount_per_mile"] = (with_(*routed, APM) + "SELECT * FROM apm ORDER BY amount_per_mile DESC "
                                "NULLS LAST, window_start, route LIMIT 10")
    q["previous_ride"] = (with_(*routed, PREV) + "SELECT trip_id, hack_license, pickup_datetime, "
                          "dropoff_datetime, cell_pickup, cell_dropoff, prev_cell_dropoff, "
                          "prev_dropoff_datetime FROM prev")
    q["idle_time"] = (with_(*routed, PREV, "g AS (SELECT cell_pickup AS cell, epoch_us(pickup_datetime) "
                            "- epoch_us(prev_dropoff_datetime) AS gap FROM prev WHERE cell_pickup = prev_cell_dropoff)")
                      + "SELECT cell, CAST(SUM(gap) AS DOUBLE) / COUNT(*) / 1e6 AS avg_idle_seconds, "
                        "COUNT(*) AS rides FROM g WHERE gap > 0 AND gap <= 3600000000 GROUP BY cell")
    lon_lat = BASE + [cells("valid", "routed", 500, "lon_lat")]
    gaps = ("g AS (SELECT cell_pickup AS cell, epoch_us(pickup_datetime) - epoch_us(prev_dropoff_datetime) AS gap "
            "FROM prev WHERE cell_pickup = prev_cell_dropoff)")
    idle = "SELECT cell, CAST(SUM(gap) AS DOUBLE) / COUNT(*) / 1e6 AS avg_idle_seconds, COUNT(*) AS rides FROM g WHERE gap > 0"
    q["idle_time_uncapped"] = with_(*routed, PREV, gaps) + idle + " GROUP BY cell"
    q["idle_time_lon_lat"] = with_(*lon_lat, PREV, gaps) + idle + " AND gap <= 3600000000 GROUP BY cell"
    q["congestion_alerts_lon_lat"] = (
        with_(*lon_lat, RUNS) + "SELECT route, trip_id, dropoff_datetime, run_length, first_pickup_longitude, "
        "first_pickup_latitude, first_trip_time, route_mean FROM runs WHERE run_length >= 2 AND first_trip_time > route_mean")
    q["rising_runs"] = (with_(*routed, RUNS) + "SELECT route, trip_id, dropoff_datetime, trip_time, "
                        "run_length, first_trip_time, first_pickup_longitude, first_pickup_latitude FROM runs")
    q["congestion_alerts"] = (with_(*routed, RUNS) + "SELECT route, trip_id, dropoff_datetime, run_length, "
                              "first_pickup_longitude, first_pickup_latitude, first_trip_time, route_mean "
                              "FROM runs WHERE run_length >= 2 AND first_trip_time > route_mean")
    rev = (f"rev AS (SELECT vendorid, CAST(ROUND(SUM(CAST(total_amount AS {MONEY})), 0) AS DOUBLE) "
           "AS amount FROM clean GROUP BY vendorid)")
    q["vendor_revenue"] = with_(*JSON_CTES, rev) + "SELECT * FROM rev"
    q["vendor_revenue_report"] = (with_(*JSON_CTES, rev) + "SELECT vendorid, 'Vendor ID Number: ' || "
                                  "COALESCE(vendorid, 'None') || '   :    Total Amount (USD): ' || "
                                  "CAST(CAST(amount AS BIGINT) AS VARCHAR) || '.0' AS line FROM rev")
    q["fleet_totals"] = (with_(*ENRICHED) + f"SELECT {msum('trip_distance')} AS total_trip_distance, "
                         "SUM(TRY_CAST(TRIM(passenger_count) AS DOUBLE)) AS total_passengers FROM enriched")
    q["table_preview"] = "SELECT * FROM part ORDER BY p_partkey LIMIT 5"
    q["table_filter_eq"] = "SELECT * FROM lineitem WHERE l_partkey = 3"
    q["table_preview_lineitem"] = "SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 5"
    q["table_preview_supplier"] = "SELECT * FROM supplier ORDER BY s_suppkey LIMIT 5"
    q["table_filter_eq_head"] = ("SELECT * FROM lineitem WHERE l_partkey = 3 "
                                 "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 2")
    span = 4 * 3600 * 1_000_000
    q["route_mean_reset"] = (
        "WITH RECURSIVE " + ",\n".join(routed) + ",\n"
        "o AS (SELECT route, trip_id, dropoff_datetime, trip_time, epoch_us(pickup_datetime) AS tp, "
        "epoch_us(dropoff_datetime) AS td, ROW_NUMBER() OVER (PARTITION BY route ORDER BY dropoff_datetime, "
        "trip_id) AS rn FROM routed WHERE dropoff_datetime IS NOT NULL),\n"
        "rec AS (SELECT route, rn, trip_id, dropoff_datetime, trip_time AS total, 1 AS n, tp AS start "
        "FROM o WHERE rn = 1 UNION ALL "
        f"SELECT o.route, o.rn, o.trip_id, o.dropoff_datetime, "
        f"CASE WHEN o.td - rec.start > {span} THEN o.trip_time ELSE rec.total + o.trip_time END, "
        f"CASE WHEN o.td - rec.start > {span} THEN 1 ELSE rec.n + 1 END, "
        f"CASE WHEN o.td - rec.start > {span} THEN o.tp ELSE rec.start END "
        "FROM rec JOIN o ON o.route = rec.route AND o.rn = rec.rn + 1)\n"
        "SELECT route, trip_id, dropoff_datetime, total / n AS route_mean_reset FROM rec")
    q["archive_readback"] = (
        with_(TRIPS, JSONREC, f"a AS (SELECT *, {_time('lpep_pickup_datetime')} AS pickup_datetime, "
              f"{_time('lpep_dropoff_datetime')} AS dropoff_datetime, "
              f"CAST({_time('lpep_pickup_datetime')} AS DATE) AS TripStartDT, "
              f"CAST({_time('lpep_dropoff_datetime')} AS DATE) AS TripEndDT FROM jsonrec)",
              dated("a", "d", "hour", "minute", "second"))
        + "SELECT * FROM d")
    twins = {"top_routes_stream": "top_routes", "top_routes_stream_update": "top_routes",
             "area_profitability_stream_update": "area_profitability", "area_profitability_stream": "area_profitability",
             "area_profitability_joined_stream": "area_profitability",
             "idle_time_stream": "idle_time", "congestion_stream": "congestion_alerts",
             "route_mean_reset_stream": "route_mean_reset", "idle_time_stream_late": "idle_time",
             "congestion_stream_late": "congestion_alerts", "route_mean_reset_stream_late": "route_mean_reset",
             "most_pleasant_driver_stream": "most_pleasant_driver", "most_pleasant_driver_stream_update": "most_pleasant_driver",
             "top_price_breakdown_stream": "top_price_breakdown", "top_price_breakdown_stream_update": "top_price_breakdown",
             "top_amount_per_mile_stream": "top_amount_per_mile", "top_amount_per_mile_stream_update": "top_amount_per_mile",
             "top_routes_closed_stream": "top_routes_per_window",
             "price_breakdown_closed_stream": "price_breakdown_per_window",
             "pleasant_driver_closed_stream": "pleasant_driver_per_day",
             "previous_ride_sliced": "previous_ride", "rising_runs_sliced": "rising_runs",
             "congestion_alerts_sliced": "congestion_alerts", "register_clean_table": "trip_clean", "clean_files_registered": "trip_clean"}
    for stream_key, batch_key in twins.items():
        q[stream_key] = q[batch_key]
    q["topic_fanout"] = (with_(TRIPS, JSONREC) + f"SELECT t.topic, trip_id, {_json_text()} AS value FROM jsonrec, "
                         "(VALUES ('topic2'), ('topic3'), ('topic4')) t(topic)")
    q["topic_payload"] = (with_(TRIPS, JSONREC) + f"SELECT t.topic, sha256({_json_text()}) AS payload_sha256, "
                          f"CAST(octet_length(encode({_json_text()})) AS BIGINT) AS n_bytes FROM jsonrec, "
                          "(VALUES ('topic2'), ('topic3'), ('topic4')) t(topic)")
    return q
