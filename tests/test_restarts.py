"""Chains of restarts by composed block maps against the sequential rule."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from cabgrid.operators import restarts

HOUR = 3_600_000_000


def sequential(rides, span):
    out = {}
    for route, g in rides.groupby("route"):
        start, total, n = None, 0.0, 0
        for r in g.sort_values(["t", "id"]).itertuples():
            if start is None or r.t > start:
                start, total, n = r.reach, 0.0, 0
            total, n = total + r.value, n + 1
            out[route, r.id] = total / n
    return out


def rides_of(n, seed, hours, longest, hot=0.6):
    """Rides of up to ``longest`` hours; one route holds most of them."""
    rng = np.random.default_rng(seed)
    route = np.where(rng.random(n) < hot, "hot", rng.choice(list("abcdefgh"), n))
    t = rng.integers(0, hours * 60, n) * (HOUR // 60) + 400_000 * HOUR  # whole minutes: ties
    long = rng.integers(1, int(longest * 60) + 1, n) * (HOUR // 60)
    return pd.DataFrame({"route": route, "t": t, "id": rng.permutation(n).astype("int64"), "reach": t - long + 4 * HOUR,
                         "value": (long // 1_000_000).astype(float)})


@pytest.mark.parametrize("first, arity, hours, longest", [
    (1, 2, 200, 1), (2, 3, 900, 6), (6, 16, 3_000, 3), (1, 2, 300, 30), (2, 2, 2, 1)])
def test_means_equal_the_sequential_rule(spark, monkeypatch, first, arity, hours, longest):
    monkeypatch.setattr(restarts, "FIRST", first)
    monkeypatch.setattr(restarts, "ARITY", arity)
    rides = rides_of(1_200, first * 100 + arity, hours, longest)
    got = restarts.restarted_means(spark.createDataFrame(rides).repartition(5), 4 * 3600).collect()
    want = sequential(rides, 4 * HOUR)
    assert len(got) == len(rides)
    assert {(r.route, r.id): round(r.mean, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}


def test_no_rides_and_one_ride(spark):
    schema = "route string, t long, id long, reach long, value double"
    assert restarts.restarted_means(spark.createDataFrame([], schema), 4 * 3600).count() == 0
    one = spark.createDataFrame([("a", 5 * HOUR, 1, 8 * HOUR, 60.0)], schema)
    assert [tuple(r) for r in restarts.restarted_means(one, 4 * 3600).collect()] == [("a", 5 * HOUR, 1, 60.0)]
    twice = spark.createDataFrame([("a", 5 * HOUR, 1, 8 * HOUR, 60.0)] * 2, schema)
    assert [r.mean for r in restarts.restarted_means(twice, 4 * 3600).collect()] == [60.0, 60.0]


def test_entries_of_a_dense_route_are_few(spark):
    """A map keeps the rides of a block's first span; a level above, of ARITY
    blocks: what goes through the levels is a fraction of the rides."""
    rides = rides_of(20_000, 9, 2_000, 1, hot=1.0)
    levels = restarts.Levels(4 * HOUR)
    lowest = restarts.composed(spark.createDataFrame(rides), levels, 0).checkpoint()
    levels.cover(int(rides.t.min()), int(rides.reach.max()))
    above = restarts.composed(lowest.select("route", "t", "id", "reach"), levels, 1)
    assert lowest.count() < len(rides) / 4 and above.count() < len(rides) / 40
    assert len(levels.widths) == 3


def test_whole_groups_are_never_cut():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 40, 500))
    table = pa.table({"route": pa.array(keys.astype(str)), "block": keys, "n": np.arange(500)})
    for size in (1, 3, 50, 500):
        batches = [b for i in range(0, 500, size) for b in table.slice(i, size).combine_chunks().to_batches()]
        cut = list(restarts.whole_groups(iter(batches), ["route", "block"]))
        assert [n for t in cut for n in t.column("n").to_pylist()] == list(range(500))
        seen = [set(t.column("block").to_pylist()) for t in cut]
        assert sum(map(len, seen)) == len(set(keys.tolist()))
