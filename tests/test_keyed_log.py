"""The keyed log without Spark: order, cost per micro-batch, expiry."""

import random
from types import SimpleNamespace

import numpy as np
import pandas as pd

from cabgrid.streaming import keyed_log
from cabgrid.streaming.stateful import (CONG_OUT, CONG_STATE, HOUR, NEVER, RESET_OUT, RESET_STATE, US, _congestion_step,
                                        _reset_step)

MINUTE = 60 * US


class State(dict):
    """A map or value state that counts what is written."""

    written = read = 0

    def getValue(self, key):
        State.read += len(dict.get(self, key, (b"",))[0])
        return dict.get(self, key)

    def updateValue(self, key, value):
        State.written += len(value[0])
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def get(self):
        return dict.get(self, "now")

    def update(self, value):
        State.written += 8 * sum(len(v) if isinstance(v, list) else 1 for v in value)
        self["now"] = value


class Handle:
    def __init__(self):
        self.timers, self.states = set(), {}

    def getValueState(self, name, *schema):
        return self.states.setdefault(name, State())

    getMapState = getValueState

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


def run(log, batches, delay_us):
    """Output frames of a shard fed batch by batch, Spark's calls in its order;
    bytes written and read by each batch."""
    handle, out, cost, latest, watermark = Handle(), [], [], 0, 0
    log.init(handle)
    for rows in [*batches, None]:
        State.written = State.read = 0
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        if rows is not None:
            late = rows["time_us"] // 1000 <= watermark
            out += log.handleInputRows((0,), iter([rows[~late]]), clock)
        else:
            watermark = NEVER // 1000
        for ms in sorted(t for t in handle.timers if t <= watermark):
            handle.timers.discard(ms)
            out += log.handleExpiredTimer((0,), clock, SimpleNamespace(getExpiryTimeInMs=lambda: ms))
        cost.append(State.written + State.read)
        if rows is not None:
            latest = max(latest, int(rows["time_us"].max()))
            watermark = max(0, (latest - delay_us) // 1000)
    return pd.concat(out), cost, handle


def rides(n, seed, late_us, keys=("hot",), gap_us=MINUTE // 6):
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.integers(1, 2 * gap_us, n)) + 10 * HOUR
    df = pd.DataFrame({"key": rng.choice(keys, n), "time_us": t, "trip_id": rng.permutation(n), "trip_time": rng.integers(60, 4000, n) * 1.0,
                       "pickup_longitude": rng.normal(size=n), "pickup_latitude": rng.normal(size=n)})
    df["pickup_us"] = df["time_us"] - (df["trip_time"] * US).astype("int64")
    return df.iloc[np.argsort(t + rng.integers(0, late_us + 1, n), kind="stable")].reset_index(drop=True)


COLUMNS = {"time_us": "long", "trip_id": "long", "trip_time": "double", "pickup_longitude": "double", "pickup_latitude": "double"}


def congestion(min_run=2, expire=NEVER, until=None):
    return keyed_log.KeyedLog(COLUMNS, CONG_STATE, CONG_OUT, _congestion_step(min_run, 4, expire), until)


def expected_congestion(df, min_run, expire=NEVER):
    out = set()
    for key, g in df.groupby("key"):
        g = g.sort_values(["time_us", "trip_id"])
        t, dur = g["time_us"].to_numpy(), g["trip_time"].to_numpy()
        run, first = -1, None
        for i, ride in enumerate(g.itertuples()):
            if i == 0 or dur[i] <= dur[i - 1] or t[i] - t[i - 1] > expire:
                run, first = 0, dur[i]
            else:
                run += 1
            mean = dur[(t >= t[i] - 4 * HOUR) & (t <= t[i])].mean()
            if run >= min_run and first > mean:
                out.add((key, ride.trip_id, run, first, round(mean, 6)))
    return out


def alerts(out):
    return {(r.route, r.trip_id, r.run_length, r.first_trip_time, round(r.route_mean, 6)) for r in out.itertuples()}


def test_order_and_trailing_means(monkeypatch):
    for chunk, batch, seed in ((7, 50, 1), (4_096, 50, 2), (16, 500, 3), (64, 9, 4)):
        monkeypatch.setattr(keyed_log, "CHUNK", chunk)
        df = rides(1_500, seed, 20 * MINUTE, ("hot", "hot", "hot", "a", "b", "é"), MINUTE)
        batches = [df[i:i + batch] for i in range(0, len(df), batch)]
        out, _, handle = run(congestion(1), batches, 20 * MINUTE)
        want = expected_congestion(df, 1)
        assert len(want) > 50 and alerts(out) == want
        assert not handle.states["waiting"] and len(out) == len(want)


def test_expired_runs_start_anew():
    df = rides(400, 5, 0, ("a", "b"), 90 * MINUTE)
    keep = congestion(0, HOUR, until=lambda last: last[0] + 4 * HOUR)
    out, _, handle = run(keep, [df[i:i + 20] for i in range(0, 400, 20)], 20 * MINUTE)
    assert alerts(out) == expected_congestion(df, 0, HOUR)
    assert all(not keep._page(n) for n in range(keyed_log.PAGES))


def test_mean_reset_with_and_without_expiry():
    for expire in (NEVER, 2 * HOUR):
        df = rides(600, 6, 15 * MINUTE, ("a", "b"), 25 * MINUTE)
        log = keyed_log.KeyedLog({"time_us": "long", "trip_id": "long", "trip_time": "double", "pickup_us": "long"},
                                 RESET_STATE, RESET_OUT, _reset_step(4, expire), None)
        out, _, _ = run(log, [df[i:i + 37] for i in range(0, 600, 37)], 15 * MINUTE)
        want = set()
        for key, g in df.groupby("key"):
            total = n = 0
            start, before = None, None
            for r in g.sort_values(["time_us", "trip_id"]).itertuples():
                if start is None or r.time_us > start + 4 * HOUR or r.time_us - before > expire:
                    total, n, start = 0.0, 0, r.pickup_us
                total, n, before = total + r.trip_time, n + 1, r.time_us
                want.add((key, r.trip_id, round(total / n, 6)))
        assert {(r.route, r.trip_id, round(r.route_mean_reset, 6)) for r in out.itertuples()} == want


def test_a_hot_keys_batch_cost_does_not_grow_with_its_history():
    """One route takes every ride; 300 micro-batches over two days. What a
    batch writes and reads stays what it was after the first hours."""
    df = rides(60_000, 7, 5 * MINUTE, gap_us=3 * US)
    _, cost, handle = run(congestion(), [df[i:i + 200] for i in range(0, len(df), 200)], 10 * MINUTE)
    early, late = np.mean(cost[40:80]), np.mean(cost[240:299])
    assert late < 1.3 * early, (early, late)
    # Per ride: written on arrival, once more in a cut chunk, again when it will leave the window.
    assert late < 200 * 200 * 4


def test_log_takes_what_is_due():
    rng = random.Random(8)
    state, want = State(), []
    log = keyed_log.TimeLog(state, {"time_us": "long", "trip_id": "long"}, [], 0)
    until = 0
    for step in range(200):
        new = [until + rng.randint(1, 5_000) for _ in range(rng.randint(0, 60))]
        want += new
        if new:
            log.add({"time_us": np.array(new), "trip_id": np.arange(len(new))})
        until += rng.randint(0, 500)
        got = sorted(log.take(until)["time_us"].tolist())
        assert got == sorted(x for x in want if x <= until)
        want = [x for x in want if x > until]
        assert log.first == min(want, default=None)
