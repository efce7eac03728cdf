"""The live join of two windowed aggregates of a cell, held in keyed state.

Both sides come as closed windows: one streaming aggregate (partial counts
before its shuffle, so a hot cell is a few rows a task) counts profits by
pickup cell and dropoffs by dropoff cell, and gives each (cell, window) once,
when the watermark has passed it. One stateful operator behind it keeps, for a
cell, what any later report can need:

* the k earliest profit windows: pairs are reported by profit window first, so
  a cell's first k pairs lie in them, and a window that k earlier ones have
  pushed out never comes back;
* of the dropoff windows the k with fewest, the k with most and the k earliest
  dropoffs (the best partners of a profit above, below and of zero or unknown):
  counts are final, so these too are never needed again once pushed out.

So a cell's state is at most 4k windows whatever its history, and a micro-batch
reads and writes the cells whose windows it closes. Of those whose first k
pairs changed it emits these pairs by rank; pairs are only ever added, so a
rank's latest row replaces the one before and none is taken back.

Rows without a cell or an event time take no part; a cell with one side only
has no pairs. Cells are dealt to SHARDS, as the keyed logs' keys are; ``k`` and
SHARDS are fixed for the life of a checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions.columns import EXACT
from .keyed_log import SHARDS

PROFIT_MINUTES, DROPOFF_MINUTES = 15, 30
MINUTE_US = 60_000_000
OUT = "cell string, rank int, window_us long, taxis_us long, profitability double"


def closed_sides(trips: DataFrame, time_col: str = "dropoff_datetime") -> DataFrame:
    """cell, is_profit, start_us, amount (average profit of 15 minutes, or the
    number of dropoffs of 30) of each window the watermark closes. A profit
    window is given when the 30 minutes it lies in are over."""
    profit = F.col("fare_amount").try_cast(EXACT) + F.col("tip_amount").try_cast(EXACT)
    part = F.floor(F.pmod(F.unix_micros(time_col), F.lit(DROPOFF_MINUTES * MINUTE_US)) / F.lit(PROFIT_MINUTES * MINUTE_US)).cast("int")
    sides = F.explode(F.array(
        F.struct(F.col("cell_pickup").alias("cell"), F.lit(True).alias("is_profit"), part.alias("part"), profit.alias("profit")),
        F.struct(F.col("cell_dropoff").alias("cell"), F.lit(False).alias("is_profit"), F.lit(0).alias("part"), F.lit(None).cast(profit_type(trips, profit)).alias("profit"))))
    rows = trips.select(time_col, sides.alias("e")).select(time_col, "e.*").filter("cell is not null")
    held = rows.groupBy(F.window(time_col, f"{DROPOFF_MINUTES} minutes").alias("w"), "cell", "is_profit", "part").agg(
        F.sum("profit").alias("_p"), F.count("profit").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    mean = F.try_divide(F.col("_p").cast("double"), F.col("_n"))
    return held.select("cell", "is_profit", (F.unix_micros("w.start") + F.col("part") * F.lit(PROFIT_MINUTES * MINUTE_US)).alias("start_us"),
                       F.when(F.col("is_profit"), mean).otherwise(F.col("_rows").cast("double")).alias("amount"))


def profit_type(trips: DataFrame, profit) -> str:
    return trips.select(profit.alias("p")).schema["p"].dataType.simpleString()


def kept_dropoffs(starts: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Which of a cell's dropoff windows may still be among a profit's best k."""
    return np.unique(np.concatenate([np.lexsort((starts, counts))[:k], np.lexsort((starts, -counts))[:k], np.argsort(starts)[:k]]))


def first_pairs(windows: np.ndarray, profits: np.ndarray, taxis: np.ndarray, counts: np.ndarray, k: int) -> list[tuple]:
    """A cell's first k pairs (window, dropoff window, profitability), by
    profit window, then the highest profitability (unknown last)."""
    left, right = (i.ravel() for i in np.meshgrid(np.arange(len(windows)), np.arange(len(taxis)), indexing="ij"))
    value = profits[left] / counts[right]
    order = np.lexsort((taxis[right], -np.nan_to_num(value), np.isnan(value), windows[left]))[:k]
    return [(int(windows[left[i]]), int(taxis[right[i]]), float(value[i])) for i in order]


class CellJoin(StatefulProcessor):
    """Both sides of the cells of a shard; see the module."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cells = handle.getMapState("cells", "cell string", (
            "windows array<long>, profits array<double>, taxis array<long>, counts array<double>"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        # A frame of a long batch may split a cell's rows: each is merged into the state.
        for frame in rows:
            for cell, new in frame.groupby("cell", sort=False):
                found += self._merged(cell, new["is_profit"].to_numpy(bool), new["start_us"].to_numpy(np.int64),
                                      new["amount"].to_numpy(np.float64))
        latest = {row[:2]: row for row in found}
        yield pd.DataFrame(list(latest.values()), columns=["cell", "rank", "window_us", "taxis_us", "profitability"]).astype(
            {"rank": np.int32, "window_us": np.int64, "taxis_us": np.int64, "profitability": np.float64})

    def _merged(self, cell: str, is_profit: np.ndarray, starts: np.ndarray, amounts: np.ndarray) -> list[tuple]:
        """Adds closed windows to a cell; its changed pairs by rank."""
        old = [np.array(c, t) for c, t in zip(self.cells.getValue((cell,)) or ([], [], [], []), "qdqd")]
        before = first_pairs(*old, self.k)
        windows, profits = np.append(old[0], starts[is_profit]), np.append(old[1], amounts[is_profit])
        taxis, counts = np.append(old[2], starts[~is_profit]), np.append(old[3], amounts[~is_profit])
        first, best = np.argsort(windows)[:self.k], kept_dropoffs(taxis, counts, self.k)
        now = windows[first], profits[first], taxis[best], counts[best]
        self.cells.updateValue((cell,), tuple(c.tolist() for c in now))
        after = first_pairs(*now, self.k)
        return [(cell, rank, *pair) for rank, pair in enumerate(after, 1)
                if rank > len(before) or repr(before[rank - 1]) != repr(pair)]

    def close(self) -> None:
        pass


def first_pairs_of_cells(trips: DataFrame, k: int, time_col: str = "dropoff_datetime", shards: int = SHARDS) -> DataFrame:
    """cell, rank, window_us, taxis_us, profitability: the first k pairs of
    each cell, given again by rank whenever closed windows change them.
    ``trips``: a stream with a watermark on ``time_col``."""
    shard = F.pmod(F.xxhash64("cell"), F.lit(shards)).cast("int")
    sides = closed_sides(trips, time_col)
    joined = sides.select(shard.alias("shard"), *sides.columns).groupBy("shard").transformWithStateInPandas(CellJoin(k), OUT, "append", "none")
    return joined.withColumn("profitability", F.when(~F.isnan("profitability"), F.col("profitability")))
