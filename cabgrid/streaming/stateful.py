"""Keyed-state twins of the order-dependent queries for Structured Streaming.

Each puts a key's rides (driver or route) in event-time order, whatever order
they arrive in (``keyed_log``): a ride waits until the watermark has passed it,
then it is processed sorted by (time, trip id). So the output equals the batch
(window-function) forms as long as no ride is later than the watermark delay.
Later rides are dropped by Spark and counted in the query's progress
(``numRowsDroppedByWatermark``). A bounded replay ends with a closing record
dated past everything (``sources.closing_line``), which lets the last rides go.

State per key: for drivers the last ride (dropped once no later ride can be
counted against it), for routes the run counters and the trailing window's
total and count, or the current mean. ``expire_hours`` (off by default): a ride
that far after its route's last one starts anew, and states that old are
dropped. Rides without an event time are left out before the state.

Times cross the Python boundary as epoch microseconds (``long``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import utc_timestamp
from .keyed_log import Rows, in_event_time

US = 1_000_000
HOUR = 3600 * US
NEVER = 1 << 62


def _moment(df: DataFrame, name: str) -> Column:
    """A time column as a moment: wall clocks are UTC."""
    c = F.col(name)
    return utc_timestamp(c) if dict(df.dtypes)[name] == "timestamp_ntz" else c


def _rides(df: DataFrame, key: str, time_col: str) -> DataFrame:
    """Rides with a key and an event time (as a moment, ``event_time``)."""
    return df.withColumn("event_time", _moment(df, time_col)).dropna(subset=[key, "event_time"])


# --- idle time (previous ride of the same driver) ---------------------------

IDLE_OUT = {"hack_license": "string", "trip_id": "long", "cell": "string", "pickup_us": "long",
            "prev_dropoff_us": "long", "gap_us": "long"}
NO_TIME = -(1 << 62)


def _idle_step(cap: int | None):
    def step(driver, r: Rows, last, leaves, reached):
        drop, cell = r["dropoff_us"], r["cell_dropoff"]
        prev_cell = np.append([last[0] if last else None], cell[:-1]).astype(object)
        prev_drop = np.append([last[1] if last else NO_TIME], drop[:-1])
        gap = r["time_us"] - prev_drop
        keep = (r["cell_pickup"] == prev_cell) & (gap > 0) & (prev_drop != NO_TIME)
        if cap is not None:
            keep &= gap <= cap
        return (cell[-1], int(drop[-1])), {
            "hack_license": np.full(int(keep.sum()), driver, dtype=object), "trip_id": r["trip_id"][keep],
            "cell": r["cell_pickup"][keep], "pickup_us": r["time_us"][keep],
            "prev_dropoff_us": prev_drop[keep], "gap_us": gap[keep]}, None
    return step


def idle_rides_stream(cells: DataFrame, max_idle_seconds: int | None = 3600,
                      watermark: str | None = "2 hours") -> DataFrame:
    """Streaming rides that start where the driver's previous ride ended,
    with the idle gap ``gap_us`` (microseconds): the rows of the batch
    ``idle_rides``. A ride whose dropoff time is unknown leaves no gap."""
    cap = None if max_idle_seconds is None else max_idle_seconds * US
    d = _rides(cells, "hack_license", "pickup_datetime")
    d = d.withColumn("dropoff_us", F.coalesce(F.unix_micros(_moment(d, "dropoff_datetime")), F.lit(NO_TIME)))
    columns = {"time_us": "long", "trip_id": "long", "cell_pickup": "string", "cell_dropoff": "string", "dropoff_us": "long"}
    until = None if cap is None else lambda last: max(last[1], 0) + cap
    return in_event_time(d, "hack_license", "event_time", columns, {"cell": "string", "dropoff_us": "long"}, IDLE_OUT,
                         watermark, _idle_step(cap), until)


# --- congestion (rising runs + trailing mean per route) -----------------------

CONG_OUT = {"route": "string", "trip_id": "long", "dropoff_us": "long", "run_length": "long",
            "first_pickup_longitude": "double", "first_pickup_latitude": "double",
            "first_trip_time": "double", "route_mean": "double"}
CONG_STATE = {"last_us": "long", "prev_dur": "double", "run_length": "long", "first_dur": "double",
              "first_lon": "double", "first_lat": "double", "total": "long", "n": "long"}
START = (-NEVER, np.inf, -1, 0.0, 0.0, 0.0, 0, 0)


def _congestion_step(min_run: int, mean_hours: int, expire: int):
    rng = mean_hours * HOUR

    def step(route, r: Rows, last, leaves, reached):
        t, dur, lon, lat = r["time_us"], r["trip_time"], r["pickup_longitude"], r["pickup_latitude"]
        last_us, prev, run, f_dur, f_lon, f_lat, total, n = last or START
        gone_us, gone = leaves
        if not len(t):
            return (last_us, prev, run, f_dur, f_lon, f_lat, total - int(gone.sum()), n - len(gone)), None, None
        # Trailing mean over [t - range, t], ties included: what has come up to
        # t less what has left before t, in whole microseconds.
        amount = np.round(dur * US).astype(np.int64)
        came, left = np.append(0, np.cumsum(amount)), np.append(0, np.cumsum(gone))
        until, before, own = (np.searchsorted(t, t, "right"), np.searchsorted(gone_us, t), np.searchsorted(t + rng, t))
        mean = (total + came[until] - left[before] - came[own]) / US / (n + until - before - own)
        out_now = int(np.searchsorted(t + rng, reached, "right"))
        total, n = total + int(came[-1] - left[-1] - came[out_now]), n + len(t) - len(gone) - out_now
        # Rising runs: a break where the duration does not rise; the run length is
        # the distance to the latest break, or goes on from the carried run.
        idx = np.arange(len(dur))
        broke = (dur <= np.append(prev, dur[:-1])) | (t - np.append(last_us, t[:-1]) > expire)
        last_brk = np.maximum.accumulate(np.where(broke, idx, -1))
        carried, src = last_brk < 0, np.maximum(last_brk, 0)
        runs = np.where(carried, run + 1 + idx, idx - last_brk)
        fd, flo, fla = (np.where(carried, a, b[src]) for a, b in ((f_dur, dur), (f_lon, lon), (f_lat, lat)))
        hit = (runs >= min_run) & (fd > mean)
        state = (int(t[-1]), float(dur[-1]), int(runs[-1]), float(fd[-1]), float(flo[-1]), float(fla[-1]), total, n)
        return state, {
            "route": np.full(int(hit.sum()), route, dtype=object), "trip_id": r["trip_id"][hit],
            "dropoff_us": t[hit], "run_length": runs[hit], "first_pickup_longitude": flo[hit],
            "first_pickup_latitude": fla[hit], "first_trip_time": fd[hit], "route_mean": mean[hit],
        }, (t[out_now:] + rng, amount[out_now:])

    return step


def _expiry(expire_hours: float | None) -> int:
    return NEVER if expire_hours is None else int(expire_hours * HOUR)


def congestion_alerts_stream(routed: DataFrame, min_run: int = 2, mean_hours: int = 4,
                             watermark: str | None = "30 minutes", expire_hours: float | None = None) -> DataFrame:
    """Streaming congestion alerts: the rows of the batch ``congestion_alerts``
    (``dropoff_us`` in place of the time)."""
    columns = {"time_us": "long", "trip_id": "long", "trip_time": "double", "pickup_longitude": "double", "pickup_latitude": "double"}
    expire, rng = _expiry(expire_hours), mean_hours * HOUR
    until = None if expire_hours is None else lambda last: last[0] + max(expire, rng)
    return in_event_time(_rides(routed, "route", "dropoff_datetime"), "route", "event_time", columns, CONG_STATE, CONG_OUT,
                         watermark, _congestion_step(min_run, mean_hours, expire), until)


# --- running mean per route with the 4-hour reset (as coded) --------------------

RESET_OUT = {"route": "string", "trip_id": "long", "dropoff_us": "long", "route_mean_reset": "double"}
RESET_STATE = {"last_us": "long", "total": "double", "n": "long", "start_us": "long"}


def _reset_step(reset_hours: int, expire: int):
    span = reset_hours * HOUR

    def step(route, r: Rows, last, leaves, reached):
        drop, pick, dur = r["time_us"], r["pickup_us"], r["trip_time"]
        last_us, total, n, start = last or (drop[0], 0.0, 0, int(pick[0]))
        anew = np.flatnonzero(drop - np.append(last_us, drop[:-1]) > expire)  # long silences
        out = np.empty(len(dur))
        a = 0
        while a < len(dur):  # one pass per segment: up to the first ride past its span, or a silence
            if len(anew) and a == anew[0]:
                total, n, start, anew = 0.0, 0, int(pick[a]), anew[1:]
            end = anew[0] if len(anew) else len(drop)
            b = max(a + int(np.searchsorted(drop[a:end], start + span, "right")), a + (n == 0))
            out[a:b] = (total + np.cumsum(dur[a:b])) / (n + np.arange(1, b - a + 1))
            total, n = total + float(dur[a:b].sum()), n + b - a
            if b < end:  # the ride past the span starts the next mean, however long it took itself
                total, n, start = 0.0, 0, int(pick[b])
            a = b
        return (int(drop[-1]), total, n, start), {
            "route": np.full(len(dur), route, dtype=object), "trip_id": r["trip_id"], "dropoff_us": drop, "route_mean_reset": out}, None

    return step


def route_mean_reset_stream(routed: DataFrame, reset_hours: int = 4, watermark: str | None = "30 minutes",
                            expire_hours: float | None = None) -> DataFrame:
    """Running mean of ride duration per route that restarts at the first
    ride ending more than ``reset_hours`` after the pickup of the ride that
    started the current mean (the original job's rule)."""
    d = _rides(routed, "route", "dropoff_datetime")
    d = d.withColumn("pickup_us", F.unix_micros(_moment(d, "pickup_datetime"))).dropna(subset=["pickup_us"])
    columns = {"time_us": "long", "trip_id": "long", "trip_time": "double", "pickup_us": "long"}
    return in_event_time(d, "route", "event_time", columns, RESET_STATE, RESET_OUT, watermark,
                         _reset_step(reset_hours, _expiry(expire_hours)),
                         None if expire_hours is None else lambda last: last[0] + _expiry(expire_hours))
