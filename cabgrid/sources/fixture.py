"""The trip fixture: SQL text that derives one trip per event.

The text runs unchanged in Spark SQL and DuckDB and gives identical rows:
integer arithmetic on ``event_id``, calendar fields of ``ts``, and DOUBLE
literals with exponents. FIXTURES.md says what the data hold.
"""

from __future__ import annotations

from ..functions.constants import ORIGIN_LAT, ORIGIN_LON, SHIFT_LAT_500, SHIFT_LON_500


def number(x: float) -> str:
    """A DOUBLE literal in both engines."""
    return f"{x!r}e0"


# Seconds of a ride: longer towards the end of each 4 hours, so that rising
# runs start above the trailing mean often enough.
SECONDS = "(60 + (event_id*event_id*31 + event_id*17) % 599 + 500*(hour(ts) % 4))"
PICKUP = f"(ts - {SECONDS} * INTERVAL '1' SECOND)"
# Five busy drivers have half of the rides.
DRIVER = "CASE WHEN (event_id*31337) % 100 < 50 THEN 900000 + (event_id*31337) % 5 ELSE user_id END"


def _hour(ts: str) -> str:
    return f"(day({ts})*24 + hour({ts}))"


def _index(hot: int, near: str, ts: str, share: str, few: int, some: int, a: int, b: int, low: int) -> str:
    """500 m cell index: the hot cell, one of four, or by driver and hour."""
    return (f"CASE WHEN {share} < {few} THEN {hot} WHEN {share} < {some} THEN {hot} + {near} % 2 "
            f"ELSE {low} + (({DRIVER})*{a} + {_hour(ts)}*{b}) % 50 END")


UP, DOWN = "(event_id*7919) % 1000", "(event_id*104729) % 1000"
PICKUP_X = _index(150, "event_id*6101", PICKUP, UP, 480, 530, 13, 7, 100)
PICKUP_Y = _index(160, "event_id*3571", PICKUP, UP, 480, 530, 29, 12, 110)
DROPOFF_X = _index(150, "event_id*4513", "ts", DOWN, 520, 570, 13, 7, 100)
DROPOFF_Y = _index(160, "event_id*2203", "ts", DOWN, 520, 570, 29, 12, 110)


def _lon(index: str) -> str:
    return f"{number(ORIGIN_LON)} + ({index} + 3e-1)*{number(SHIFT_LON_500)}"


def _lat(index: str) -> str:
    return f"{number(ORIGIN_LAT)} - ({index} + 3e-1)*{number(SHIFT_LAT_500)}"


#: One (expression, name) per column; a trip without a readable dropoff time
#: when event_id % 53 = 0, without a longitude or distance when % 23 or % 29 = 0.
TRIP_COLUMNS = [
    ("event_id", "trip_id"),
    ("CAST(event_id % 200 AS {text})", "medallion"),
    (f"CAST({DRIVER} AS {{text}})", "hack_license"),
    (PICKUP, "pickup_datetime"),
    ("CASE WHEN event_id % 53 = 0 THEN NULL ELSE ts END", "dropoff_datetime"),
    (f"CAST({SECONDS} AS DOUBLE)", "trip_time"),
    ("CASE WHEN event_id % 29 = 0 THEN 0e0 ELSE CAST((event_id*3137) % 150000 AS DOUBLE)/1e4 END", "trip_distance"),
    (f"CASE WHEN event_id % 23 = 0 THEN 0e0 ELSE {_lon(PICKUP_X)} END", "pickup_longitude"),
    (_lat(PICKUP_Y), "pickup_latitude"),
    (_lon(DROPOFF_X), "dropoff_longitude"),
    (_lat(DROPOFF_Y), "dropoff_latitude"),
    ("CASE WHEN event_id % 2 = 0 THEN 'CRD' ELSE 'CSH' END", "payment_type"),
    ("CAST(250 + (event_id*53) % 5000 AS DOUBLE)/1e2", "fare_amount"),
    ("CAST(50*(event_id % 3) AS DOUBLE)/1e2", "surcharge"),
    ("5e-1", "mta_tax"),
    ("CAST((event_id*17) % 900 AS DOUBLE)/1e2", "tip_amount"),
    ("CASE WHEN event_id % 13 = 0 THEN 5.33e0 ELSE 0e0 END", "tolls_amount"),
    ("CAST(250 + (event_id*53) % 5000 + 50*(event_id % 3) + 50 + (event_id*17) % 900"
     " + CASE WHEN event_id % 13 = 0 THEN 533 ELSE 0 END AS DOUBLE)/1e2", "total_amount"),
]


def trip_columns(text: str) -> list[tuple[str, str]]:
    """(expression, name) pairs; ``text`` is the engine's text type."""
    return [(e.replace("{text}", text), n) for e, n in TRIP_COLUMNS]


#: The parts that several columns share, in steps that each use those before.
STEPS = [
    [(SECONDS, "_seconds"), (f"({DRIVER})", "_driver"), (_hour("ts"), "_dropoff_hour")],
    [(PICKUP, "_pickup")],
    [(_hour(PICKUP), "_pickup_hour")],
    [(PICKUP_X, "_px"), (PICKUP_Y, "_py"), (DROPOFF_X, "_dx"), (DROPOFF_Y, "_dy")],
]


def trip_steps(text: str) -> tuple[list[list[tuple[str, str]]], list[tuple[str, str]]]:
    """(steps, columns): ``trip_columns`` with each shared part as a column of
    its own, so that an engine evaluates it once a row."""
    named: list[tuple[str, str]] = []

    def short(expression: str) -> str:
        for part, name in reversed(named):
            expression = expression.replace(part, name)
        return expression

    steps = []
    for step in STEPS:
        steps.append([(short(part), name) for part, name in step])
        named += [(short(part), name) for part, name in step if short(part) != part] + step
    return steps, [(short(e), n) for e, n in trip_columns(text)]
