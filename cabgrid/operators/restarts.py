"""Chains of restarts: each start of a mean fixes the next one, the first ride
that ends more than a span after the start's pickup.

A chain is followed without putting a route in one task and without moving
every ride through rounds of pointer jumps. Time is cut into blocks, FIRST spans
wide at the lowest level and ARITY times as wide at each further one. A block is
a map from where a chain may enter to where it leaves: chains enter a block
within its first span, so a block of w spans keeps a 1/w share of a dense
route's rides as entries (never less than one), each with its exit: the time its
chain has reached when it leaves. Going up, the maps of ARITY blocks are
composed into one; the rides themselves take part once, at the lowest level.
Going down, the one chain that begins at a route's first ride is traced through
the maps: each level gives the entries of the blocks below that are really met.
A last pass of the rides forms the means.

So the rides are shuffled twice, the entries of a level (checkpointed) are fewer
than the rides below it, and the levels number the logarithm of the time range.
A block of a route (FIRST spans of rides; above, as many entries) is one group
in a task, held as arrays of some 40 bytes a ride.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST, ARITY = 6, 16
NO_RIDE = -1


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches cut so that no group of equal ``keys`` is split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.flatnonzero(group_starts(pa.Table.from_batches([batch]), keys))
        a = int(starts[-1])
        whole = held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys)
        if a or whole:
            yield pa.Table.from_batches([*held, *([batch.slice(0, a)] if a else [])])
            held = []
        held.append(batch.slice(a))
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    first = np.zeros(table.num_rows, bool)
    first[:1] = True
    for k in keys:
        c = table.column(k)
        first[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy()
    return first


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def next_in_group(first: np.ndarray, offset: np.ndarray, reach: np.ndarray, width: int) -> np.ndarray:
    """Per row (sorted by group, then ``offset`` in [0, width)) the first later
    row of its group with an offset beyond ``reach``; NO_RIDE if there is none."""
    group = np.cumsum(first) - 1
    n, stride = len(first), width + 1
    at = np.arange(n)
    out = np.empty(n, np.int64)
    step = max(1, (1 << 62) // stride)  # groups whose places fit 64 bits
    cuts = np.append(np.flatnonzero(first)[::step], n)
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = group[a:b] - group[a]
        place = own * stride + offset[a:b]
        out[a:b] = a + np.searchsorted(place, own * stride + np.minimum(reach[a:b], width), "right")
    out = np.maximum(out, at + 1)
    ends = np.append(np.flatnonzero(first)[1:], n)[group]
    return np.where(out < ends, out, NO_RIDE)


def last_in_chain(after: np.ndarray) -> np.ndarray:
    """Per row the last row of its chain, by doubling the steps."""
    at = np.where(after == NO_RIDE, np.arange(len(after)), after)
    while True:
        further = at[at]
        if (further == at).all():
            return at
        at = further


def met(after: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Rows on the chains that begin at ``entries``."""
    on = np.zeros(len(after), bool)
    while len(entries):
        on[entries] = True
        entries = after[entries]
        entries = entries[entries != NO_RIDE]
    return on


class Levels:
    """Block numbers; ``widths`` are those of the levels. The lowest blocks are
    counted from 1970, the others from the earliest block (``cover``)."""

    def __init__(self, span: int):
        self.base, self.span, self.widths = 0, span, [FIRST * span]

    def cover(self, earliest: int, latest: int) -> None:
        self.base = earliest // self.widths[0] * self.widths[0]
        while self.widths[-1] <= latest - self.base:
            self.widths.append(self.widths[-1] * ARITY)

    def start(self, level: int) -> int:
        return self.base if level else 0

    def block(self, level: int) -> Column:
        return F.floor((F.col("t") - self.start(level)) / F.lit(self.widths[level])).cast("long")


def _dealt(rows: DataFrame, levels: Levels, level: int) -> DataFrame:
    return (rows.withColumn("block", levels.block(level)).repartition("route", "block")
            .sortWithinPartitions("route", "block", "t", "id"))


def _chains(table: pa.Table, levels: Levels, level: int):
    """(first rows of groups, offsets in the block, next rows of the chains)."""
    first, width = group_starts(table, ["route", "block"]), levels.widths[level]
    start = levels.start(level) + numbers(table, "block") * width
    offset = numbers(table, "t") - start
    return first, offset, next_in_group(first, offset, numbers(table, "reach") - start, width)


ENTRY = "route string, t long, id long, reach long"
#: Of the lowest blocks also the sums of values from the chain's last start to
#: the block's end, and of the whole block.
SUMS = ["tail", "tail_n", "whole", "whole_n"]


def composed(rows: DataFrame, levels: Levels, level: int) -> DataFrame:
    """(route, t, id, reach; at the lowest level value) of rides or entries ->
    the entries of this level's blocks, ``reach``: where a chain that enters
    there leaves the block."""
    span = levels.span

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["route", "block"]):
            first, offset, after = _chains(table, levels, level)
            last = last_in_chain(after)
            beyond = offset > span
            entry = ~beyond | first | ~np.append(True, beyond[:-1])
            out = table.select(["route", "t", "id"])
            columns = {"reach": np.maximum(numbers(table, "reach"), numbers(table, "t"))[last]}
            if not level:
                sums, begin = np.append(0.0, np.cumsum(numbers(table, "value"))), np.flatnonzero(first)
                group, end = np.cumsum(first) - 1, np.append(begin[1:], len(first))
                begin, end = begin[group], end[group]
                columns |= {"tail": sums[end] - sums[last], "tail_n": end - last, "whole": sums[end] - sums[begin], "whole_n": end - begin}
            for name, column in columns.items():
                out = out.append_column(name, pa.array(column))
            yield from out.filter(pa.array(entry)).combine_chunks().to_batches()

    sums = "" if level else ", tail double, tail_n long, whole double, whole_n long"
    return _dealt(rows, levels, level).mapInArrow(run, ENTRY + sums)


def _headed(rows: DataFrame, heads: DataFrame, levels: Levels, level: int) -> DataFrame:
    """Rows of this level's blocks, before them what is known of the block
    (``heads``: route, block; t and id of the entry if a chain meets it)."""
    both = rows.withColumns({"head": F.lit(False), "block": levels.block(level)}).unionByName(
        heads.withColumn("head", F.lit(True)), allowMissingColumns=True)
    return both.repartition("route", "block").sortWithinPartitions("route", "block", F.desc("head"), "t", "id")


def _met_rows(table: pa.Table, levels: Levels, level: int) -> tuple[pa.Table, pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """(heads, rows, each row's head, first rows of groups, rows on the chains)."""
    group = np.cumsum(group_starts(table, ["route", "block"]))
    is_head = numbers(table, "head").astype(bool)
    heads, rows = table.filter(pa.array(is_head)), table.filter(pa.array(~is_head))
    own, asked = group[~is_head], group[is_head]
    first, _, after = _chains(rows, levels, level)
    t, ids = numbers(rows, "t"), numbers(rows, "id")
    lows, highs = np.searchsorted(own, asked), np.searchsorted(own, asked, "right")
    found = []
    for a, b, at_t, at_id in zip(lows.tolist(), highs.tolist(), heads.column("t").to_pylist(), heads.column("id").to_pylist()):
        if at_t is not None:
            a += int(np.searchsorted(t[a:b], at_t))
            while ids[a] != at_id:
                a += 1
            found.append(a)
    return heads, rows, np.searchsorted(asked, own), first, met(after, np.array(found, np.int64))


def traced(entries_below: DataFrame, entries: DataFrame, levels: Levels, level: int) -> DataFrame:
    """Of the entries of the level below those that the chains meet, given the
    entries of this level's blocks."""
    names = entries_below.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["route", "block"]):
            _, rows, _, _, on = _met_rows(table, levels, level)
            yield from rows.select(names).filter(pa.array(on)).combine_chunks().to_batches()

    heads = entries.groupBy("route", levels.block(level).alias("block")).agg(F.min(F.struct("t", "id")).alias("e"))
    return _headed(entries_below, heads.select("route", "block", "e.t", "e.id"), levels, level).mapInArrow(run, entries_below.schema)


def handed_on(lowest: DataFrame, entries: DataFrame, levels: Levels) -> DataFrame:
    """Per lowest block: its entry if a chain meets it, and the sum and count
    since the latest start that earlier blocks hand on to it."""
    block = levels.block(0).alias("block")
    blocks = lowest.groupBy("route", block).agg(F.first("whole").alias("whole"), F.first("whole_n").alias("whole_n"))
    starts = entries.groupBy("route", block).agg(F.min(F.struct("t", "id", "tail", "tail_n")).alias("e"))
    by_block = Window.partitionBy("route").orderBy("block")
    both = blocks.join(starts, ["route", "block"], "left").withColumn("run", F.count("e").over(by_block))
    run = Window.partitionBy("route", "run").orderBy("block")
    both = both.withColumns({"sum": F.sum(F.coalesce("e.tail", "whole")).over(run), "n": F.sum(F.coalesce("e.tail_n", "whole_n")).over(run)})
    return both.select("route", "block", "e.t", "e.id", F.coalesce(F.lag("sum").over(by_block), F.lit(0.0)).alias("sum"),
                       F.coalesce(F.lag("n").over(by_block), F.lit(0)).alias("n"))


def running_means(rides: DataFrame, heads: DataFrame, levels: Levels) -> DataFrame:
    """(route, t, id, mean): the mean of ``value`` since the latest start, in
    one pass of the rides: running sums inside a block, and before its first
    start what earlier blocks hand on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["route", "block"]):
            heads, rows, head, first, on = _met_rows(table, levels, 0)
            sums, at = np.append(0.0, np.cumsum(numbers(rows, "value"))), np.arange(len(first))
            since = np.maximum.accumulate(np.where(first | on, at, 0))
            begun = np.cumsum(on)
            started = begun > np.maximum.accumulate(np.where(first, begun - on, 0))
            total = sums[1:] - sums[since] + np.where(started, 0.0, numbers(heads, "sum")[head])
            n = at - since + 1 + np.where(started, 0, numbers(heads, "n")[head])
            out = rows.select(["route", "t", "id"]).append_column("mean", pa.array(total / n))
            yield from out.combine_chunks().to_batches()

    return _headed(rides, heads, levels, 0).mapInArrow(run, "route string, t long, id long, mean double")


def restarted_means(rides: DataFrame, span_seconds: int) -> DataFrame:
    """``rides``: route, t (end, microseconds), id (orders equal ends), reach
    (pickup + span), value. (route, id, t, mean): the mean since the latest
    start at or before each ride."""
    levels = Levels(span_seconds * 1_000_000)
    maps = [composed(rides, levels, 0).checkpoint()]
    earliest, latest = maps[0].agg(F.min("t"), F.max("reach")).first()
    levels.cover(earliest or 0, latest or 0)
    for level in range(1, len(levels.widths)):
        maps.append(composed(maps[-1].select("route", "t", "id", "reach"), levels, level).checkpoint())
    # One block a route at the top: its chain begins at the route's first ride.
    top = maps[-1]
    entries = top.groupBy("route").agg(F.min(F.struct("t", "id", *[c for c in SUMS if c in top.columns])).alias("e")).select("route", "e.*")
    for level in reversed(range(1, len(levels.widths))):
        entries = traced(maps[level - 1], entries, levels, level)
    return running_means(rides, handed_on(maps[0], entries, levels), levels)
