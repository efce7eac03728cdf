"""The live cell join: its state and emitted pairs against all pairs formed
plainly, and the running job against the batch report."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cabgrid.operators import areas
from cabgrid.plans import catalog
from cabgrid.session import shared_path
from cabgrid.streaming import cell_join, jobs
from cabgrid.streaming.cell_join import CellJoin
from conftest import SF_SMALL


class Cells(dict):
    """The map state of a shard."""

    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value


def plain_pairs(windows, taxis, k):
    """All pairs of a cell in report order, the first k."""
    pairs = [(w, t, p / n if p is not None else None) for w, p in windows.items() for t, n in taxis.items()]
    return sorted(pairs, key=lambda x: (x[0], x[2] is None, -(x[2] or 0.0), x[1]))[:k]


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("k", [1, 3, 5])
def test_state_holds_what_any_later_report_needs(seed, k):
    rng = np.random.default_rng(seed)
    join, held = CellJoin(k), {}
    join.cells = Cells()
    sides = {c: ({}, {}) for c in "abc"}
    for cell, (windows, taxis) in sides.items():
        for i in rng.permutation(40)[:int(rng.integers(0, 40))].tolist():
            windows[i * 900] = [None, 0.0, 4.5, -3.25, 12.0][int(rng.integers(0, 5))]
        for i in rng.permutation(40)[:int(rng.integers(0, 40))].tolist():
            taxis[i * 1800] = int(rng.integers(1, 6))
    rows = [(c, True, w, np.nan if p is None else p) for c, (ws, _) in sides.items() for w, p in ws.items()]
    rows += [(c, False, t, n) for c, (_, ts) in sides.items() for t, n in ts.items()]
    frame = pd.DataFrame(rows, columns=["cell", "is_profit", "start_us", "amount"]).sample(frac=1, random_state=seed)
    for a in range(0, len(frame), 7):  # batches of seven, each in two frames
        batch = frame.iloc[a:a + 7]
        for out in join.handleInputRows((0,), iter([batch.iloc[:4], batch.iloc[4:]]), None):
            assert not out.duplicated(["cell", "rank"]).any()
            held |= {(r.cell, r.rank): r for r in out.itertuples()}
    for cell, (windows, taxis) in sides.items():
        got = [(r.window_us, r.taxis_us, None if np.isnan(r.profitability) else r.profitability)
               for r in (held[cell, i] for i in range(1, k + 1) if (cell, i) in held)]
        assert got == plain_pairs(windows, taxis, k)
    for windows, profits, taxis, counts in join.cells.values():
        assert len(windows) == len(profits) <= k and len(taxis) == len(counts) <= 3 * k


def test_unchanged_pairs_are_not_written_again():
    join = CellJoin(2)
    join.cells = Cells()

    def give(*rows):
        frame = pd.DataFrame(rows, columns=["cell", "is_profit", "start_us", "amount"])
        return next(join.handleInputRows((0,), iter([frame]), None))
    assert len(give(("a", True, 0, 6.0))) == 0  # no dropoffs yet, no pair
    assert give(("a", False, 0, 2))["profitability"].tolist() == [3.0]
    assert give(("a", False, 1, 1))["rank"].tolist() == [1, 2]
    assert len(give(("a", True, 900, 60.0), ("a", False, 2, 9))) == 0  # behind both pairs


def test_running_job_equals_the_batch_report(spark):
    """More pairs than one window gives; a second start finds nothing new."""
    k = 300
    cells = catalog.cells250(spark, SF_SMALL)
    expected = areas.area_profitability(areas.area_profit_avg(cells), areas.area_dropoffs(cells), k)
    out, ckpt = shared_path(spark, "joined-out"), shared_path(spark, "joined-ckpt")
    feed = catalog._feed(spark, SF_SMALL, files=8, per_batch=2)
    for _ in range(2):
        report = jobs.joined_profitability_stream(feed, k=k, output=out, checkpoint=ckpt, admit=catalog.REPLAY)
        assert report.count() == expected.count() > 30
        assert report.exceptAll(expected).isEmpty() and expected.exceptAll(report).isEmpty()


def test_one_query_one_scan_and_bounded_rows(spark):
    """Both sides come from one aggregate; nulls and empty input give no rows."""
    trips = spark.createDataFrame(
        [("x", "y", "2024-01-01 00:05:00", 1.0, 2.0), (None, "x", "2024-01-01 00:20:00", 1.0, 2.0), ("x", None, "2024-01-01 00:16:00", None, None),
         ("y", "x", None, 1.0, 1.0), ("x", "x", "2024-01-01 00:25:00", 5.0, None)],
        "cell_pickup string, cell_dropoff string, dropoff_datetime string, fare_amount double, tip_amount double"
    ).withColumn("dropoff_datetime", F.col("dropoff_datetime").cast("timestamp"))
    start = 1_704_067_200_000_000
    got = {tuple(r) for r in cell_join.closed_sides(trips).collect()}
    assert got == {("x", True, start, 3.0), ("x", True, start + 900_000_000, None), ("y", False, start, 1.0), ("x", False, start, 2.0)}
    assert cell_join.closed_sides(trips.limit(0)).count() == 0
