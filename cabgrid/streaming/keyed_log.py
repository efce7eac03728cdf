"""Keyed state that is appended to, not rewritten: rides put in event-time
order by ``transformWithStateInPandas``.

Keys (drivers, routes) are dealt to SHARDS; a shard is one state key, so that
a micro-batch costs a few state calls per shard and not some per ride. A
shard's state:

* a log of waiting rides: chunks of up to CHUNK rides in time order, each one
  map entry (Arrow bytes); a micro-batch adds its rides as new chunks and reads
  none;
* when an event-time timer tells that the watermark has passed the first of
  them, the chunks that begin before the watermark are taken out, what is later
  in them goes back as one run of chunks. A ride is thus written once when it
  arrives and again only while the watermark is inside its chunk;
* a second log of rides that will leave a trailing window (their time is when
  they leave), so windows are kept as running totals and not as lists of rides;
* the last state of every key, in PAGES map entries, of which a release rewrites
  those of the keys that it meets: some 60 bytes a key, whatever its history.

So the cost of a micro-batch follows its rides and what it releases; neither a
key's history nor the rides that wait enter it (the index of the chunks, three
numbers for each, does). Rides of one key stay in one shard: their order is
what is computed. SHARDS is fixed for the life of a checkpoint.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

SHARDS, PAGES, CHUNK = 64, 4, 4_096
NUMPY = {"long": np.int64, "double": np.float64, "string": object}
ARROW = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
Rows = dict[str, np.ndarray]
#: (key, its rides in order, its last state or None, what leaves its window:
#: times and amounts, the time reached) -> (state, output columns or None,
#: what will leave later: times and amounts, or None).
Step = Callable[[str, Rows, tuple | None, tuple[np.ndarray, np.ndarray], int], tuple[tuple, Rows | None, tuple | None]]


def pack(rows: Rows, types: dict[str, str]) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(rows[n], ARROW[t]) for n, t in types.items()], list(types))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes, types: dict[str, str]) -> Rows:
    table = pa.ipc.open_stream(data).read_all()
    return {n: table.column(n).to_numpy().astype(NUMPY[t]) for n, t in types.items()}


def chosen(rows: Rows, at) -> Rows:
    return {n: v[at] for n, v in rows.items()}


class TimeLog:
    """Rows in chunks of a map state; ``index``: [id, first, last time] each."""

    def __init__(self, chunks, types: dict[str, str], index: list[list[int]], next_id: int):
        self.chunks, self.types, self.index, self.next_id = chunks, types, index, next_id

    def add(self, rows: Rows) -> None:
        rows = chosen(rows, np.argsort(rows["time_us"], kind="stable"))
        times = rows["time_us"]
        for a in range(0, len(times), CHUNK):
            part = chosen(rows, slice(a, a + CHUNK))
            self.chunks.updateValue((self.next_id,), (pack(part, self.types),))
            self.index.append([self.next_id, int(part["time_us"][0]), int(part["time_us"][-1])])
            self.next_id += 1

    def take(self, until: int) -> Rows:
        """The rows up to a time, taken out."""
        due = [e for e in self.index if e[1] <= until]
        parts = [unpack(self.chunks.getValue((e[0],))[0], self.types) for e in due]
        for e in due:
            self.chunks.removeKey((e[0],))
        self.index = [e for e in self.index if e[1] > until]
        rows = {n: np.concatenate([np.empty(0, NUMPY[t]), *(p[n] for p in parts)]) for n, t in self.types.items()}
        late = rows["time_us"] > until
        if late.any():
            self.add(chosen(rows, late))
        return chosen(rows, ~late)

    @property
    def first(self) -> int | None:
        return min((e[1] for e in self.index), default=None)


class KeyedLog(StatefulProcessor):
    """The rides of a shard, given to ``step`` key by key in event-time order."""

    LEAVING = {"key": "string", "time_us": "long", "amount": "long"}

    def __init__(self, columns: dict[str, str], kept: dict[str, str], out: dict[str, str], step: Step,
                 until: Callable[[tuple], int] | None):
        self.columns, self.kept, self.out, self.step, self.until = {"key": "string", **columns}, kept, out, step, until

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", (
            "waiting array<long>, leaving array<long>, waiting_next long, leaving_next long, reached long, timer long"))
        self.waiting_chunks = handle.getMapState("waiting", "id long", "data binary")
        self.leaving_chunks = handle.getMapState("leaving", "id long", "data binary")
        self.pages = handle.getMapState("pages", "page int", "data binary")

    def _open(self) -> None:
        waiting, leaving, w, lv, self.reached, self.timer = self.index.get() or ([], [], 0, 0, -(1 << 62), 0)
        triples = lambda flat: [list(flat[i:i + 3]) for i in range(0, len(flat), 3)]
        self.waiting = TimeLog(self.waiting_chunks, self.columns, triples(waiting), w)
        self.leaving = TimeLog(self.leaving_chunks, self.LEAVING, triples(leaving), lv)

    def _close(self) -> None:
        """Stores the index; the timer is set behind the first waiting ride."""
        first = self.waiting.first
        due = 0 if first is None else first // 1000 + 1
        if self.timer and self.timer != due:
            self.handle.deleteTimer(self.timer)
        if due and self.timer != due:
            self.handle.registerTimer(due)
        flat = [[x for e in log.index for x in e] for log in (self.waiting, self.leaving)]
        self.index.update((*flat, self.waiting.next_id, self.leaving.next_id, self.reached, due))

    def _frame(self, found: list[Rows]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({n: pd.Series(np.concatenate([np.empty(0, NUMPY[t]), *(f[n] for f in found)]), dtype=NUMPY[t])
                            for n, t in self.out.items()})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        self._open()
        frames = list(rows)
        new = {n: np.concatenate([f[n].to_numpy(NUMPY[t]) for f in frames]) for n, t in self.columns.items()}
        self.waiting.add(chosen(new, new["time_us"] > self.reached))
        self._close()
        return self._frame([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._open()
        self.timer = 0 if self.timer == expiredTimerInfo.getExpiryTimeInMs() else self.timer
        self.reached = timerValues.getCurrentWatermarkInMs() * 1000
        found = self._released(self.waiting.take(self.reached), self.leaving.take(self.reached))
        self._close()
        return self._frame(found)

    def _released(self, rows: Rows, leaves: Rows) -> list[Rows]:
        if not len(rows["key"]) and not len(leaves["key"]):
            return []
        keys, code = np.unique(np.concatenate([rows["key"], leaves["key"]]).astype(str), return_inverse=True)
        own, gone = code[:len(rows["key"])], code[len(rows["key"]):]
        order = np.lexsort((rows["trip_id"], rows["time_us"], own))
        rows, own = chosen(rows, order), own[order]
        order = np.lexsort((leaves["time_us"], gone))
        leaves, gone = chosen(leaves, order), gone[order]
        cuts, leave_cuts = (np.searchsorted(c, np.arange(len(keys) + 1)) for c in (own, gone))
        pages: dict[int, dict[str, tuple]] = {}
        found, later = [], []
        for i, key in enumerate(keys.tolist()):
            number = zlib.crc32(key.encode()) % PAGES
            if number not in pages:
                pages[number] = self._page(number)
            mine = slice(leave_cuts[i], leave_cuts[i + 1])
            state, out, leave = self.step(key, chosen(rows, slice(cuts[i], cuts[i + 1])), pages[number].get(key),
                                          (leaves["time_us"][mine], leaves["amount"][mine]), self.reached)
            pages[number][key] = state
            if out is not None:
                found.append(out)
            if leave is not None and len(leave[0]):
                later.append({"key": np.full(len(leave[0]), key, object), "time_us": leave[0], "amount": leave[1]})
        if later:
            self.leaving.add({n: np.concatenate([x[n] for x in later]) for n in self.LEAVING})
        for number, page in pages.items():
            self._put_page(number, page)
        return found

    def _page(self, number: int) -> dict[str, tuple]:
        data = self.pages.getValue((number,))
        if data is None:
            return {}
        rows = unpack(data[0], {"key": "string", **self.kept})
        return dict(zip(rows["key"].tolist(), zip(*(rows[n].tolist() for n in self.kept))))

    def _put_page(self, number: int, page: dict[str, tuple]) -> None:
        """Keys whose state can change nothing any more are left out."""
        if self.until:
            page = {k: s for k, s in page.items() if self.until(s) > self.reached}
        columns = list(zip(*page.values())) or [()] * len(self.kept)
        rows = {"key": list(page), **dict(zip(self.kept, columns))}
        self.pages.updateValue((number,), (pack(rows, {"key": "string", **self.kept}),))

    def close(self) -> None:
        pass


def in_event_time(df: DataFrame, key: str, time: str, columns: dict[str, str], kept: dict[str, str], out: dict[str, str],
                  watermark: str | None, step: Step, until: Callable[[tuple], int] | None = None,
                  shards: int = SHARDS) -> DataFrame:
    """``step`` applied to each key's rides in event-time order.

    ``time``: the event time (a timestamp column); ``columns``: name -> type of
    what ``step`` reads beside the key (``time_us`` and ``trip_id`` among
    them); ``kept``, ``out``: those of a key's state and of the output;
    ``watermark``: its delay (None: ``df`` has one); ``until(state)``: the
    microsecond from which the state is of no effect (None: never).
    """
    df = df.withWatermark(time, watermark) if watermark else df
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")
    rows = (df.withColumn("time_us", F.unix_micros(time))
            .select(shard.alias("shard"), time, F.col(key).alias("key"), *columns))
    schema = ", ".join(f"{n} {t}" for n, t in out.items())
    return rows.groupBy("shard").transformWithStateInPandas(
        KeyedLog(columns, kept, out, step, until), schema, "append", "eventTime")
