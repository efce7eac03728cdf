"""The streaming jobs: each wires a stream source through the same operators
as the batch queries into a sink. ``start_*`` starts a job (give ``output``
and ``checkpoint`` to restart it later, or to run it from a scheduler with the
default ``availableNow`` trigger); its report may be read while it runs.
``*_stream`` runs it to its end and returns the report.

``lines`` / ``records`` are streaming DataFrames with the record text in
``value`` and, where the feed has one, a ``trip_id`` used to break ties in
event-time order (on Kafka the offset plays that role).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import utc_wall
from ..functions.constants import CLEAN_COLUMNS, CLEAN_PARTITIONS, TRIP_JSON_FIELDS
from ..operators import areas, drivers, routes
from ..operators.clean import trip_clean
from ..operators.grid import grid_cells, routed_trips
from ..session import shared_path
from ..sources.decode import trip_decode_json
from . import stateful
from .admission import Admission, admitted, rejected, rejects
from .cell_join import DROPOFF_MINUTES, MINUTE_US, PROFIT_MINUTES, first_pairs_of_cells
from .runner import (KEYED_STATE, Merge, await_bounded, batch_sink, read_batches, read_snapshot, run_stream,
                     snapshot_sink)
from .sinks import register_clean_table, register_new_partitions, write_archive, write_clean_files, write_clean_table


def _folder(spark, name: str) -> str:
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: utc_wall(F.col(c)) for c in cols})


def _from_us(c: str):
    return utc_wall(F.timestamp_micros(F.expr(c)))


WINDOW = ["window_start", "window_end"]


@dataclass(frozen=True)
class Job:
    """Started queries and the report over what their sinks hold, which may be
    asked for at any time: while they run, after a stop, after a restart."""

    queries: list[StreamingQuery]
    report: Callable[[], DataFrame]

    def rejected(self) -> dict[str, int]:
        """Records turned away by the recent micro-batches, by reason."""
        return rejected(self.queries[:1])

    def finish(self, timeout_s: float | None = None) -> DataFrame:
        for q in self.queries:
            await_bounded(q, timeout_s)
        return self.report()


ADMIT = Admission()


def _windowed(rows: DataFrame, name: str, key: list[str], top: Callable[[DataFrame], DataFrame], output_mode: str,
              output: str | None, checkpoint: str | None, trigger: dict | None) -> Job:
    """A windowed aggregate kept up to date, and its top report.

    ``complete``: each micro-batch writes the sorted top as the newest version
    (all windows stay in state, as in the original jobs). ``update``: for long
    runs; the watermark evicts closed windows, each micro-batch writes the
    rows it changed, the report takes each (window, key)'s latest row.
    ``output`` and ``checkpoint`` make the job restartable: with the same two,
    a new start goes on where the last one stopped.
    """
    spark = rows.sparkSession
    out, schema = output or _folder(spark, name), rows.schema
    if output_mode == "complete":
        ranked = top(spark.createDataFrame([], schema)).schema
        sink, report = snapshot_sink(out, top), lambda: read_snapshot(spark, out, ranked)
    else:
        sink, report = batch_sink(out, schema, [*WINDOW, *key]), lambda: top(read_batches(spark, out, schema, [*WINDOW, *key]))

    q = run_stream(rows, checkpoint or _folder(spark, f"ckpt-{name}"), output_mode, sink, trigger=trigger)
    return Job([q], lambda: _ntz(report(), *WINDOW))


def start_top_routes(lines: DataFrame, k: int = 10, watermark: str = "30 minutes", output_mode: str = "complete",
                     output: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """Top k routes over 30-minute windows sliding by 10 minutes; the state
    holds counts of 10-minute panes, which the report combines."""
    panes = routes.route_panes(routed_trips(admitted(lines, admit)), watermark=watermark)
    return _windowed(panes, "top-routes", ["route"], lambda p: routes.top_routes(routes.windows_of_panes(p), k), output_mode,
                     output, checkpoint, trigger)


def start_most_pleasant_driver(lines: DataFrame, k: int = 1, watermark: str = "30 minutes", output_mode: str = "complete",
                               output: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """Drivers with the highest average tip rate of a day."""
    rates = drivers.driver_tip_rate(admitted(lines, admit), watermark=watermark)
    return _windowed(rates, "pleasant-driver", ["hack_license"], lambda r: drivers.most_pleasant_driver(r, k), output_mode,
                     output, checkpoint, trigger)


def start_top_price_breakdown(lines: DataFrame, k: int = 5, watermark: str = "30 minutes", output_mode: str = "complete",
                              output: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """Cells with the highest totals of two hours and what they consist of."""
    prices = areas.price_breakdown(grid_cells(admitted(lines, admit), 500), watermark=watermark)
    return _windowed(prices, "price-breakdown", ["cell_pickup"], lambda p: areas.top_price_breakdown(p, k), output_mode,
                     output, checkpoint, trigger)


def start_top_amount_per_mile(lines: DataFrame, k: int = 10, watermark: str = "30 minutes", output_mode: str = "complete",
                              output: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """Routes with the highest amount per mile of an hour."""
    rates = routes.amount_per_mile(routed_trips(admitted(lines, admit)), watermark=watermark)
    return _windowed(rates, "amount-per-mile", ["route"], lambda a: routes.top_amount_per_mile(a, k), output_mode,
                     output, checkpoint, trigger)


def _closed(rows: DataFrame, name: str, top: Callable[[DataFrame], DataFrame], output: str | None, checkpoint: str | None,
            trigger: dict | None) -> Job:
    """The top of every window, written once: when the watermark closes it.

    In append mode all rows of a window come in one micro-batch (they expire
    together), so ranking a batch ranks whole windows; nothing but the open
    windows' aggregates is held, and nothing that is written changes later."""
    spark = rows.sparkSession
    schema = top(spark.createDataFrame([], rows.schema)).schema
    out = output or _folder(spark, name)
    q = run_stream(rows, checkpoint or _folder(spark, f"ckpt-{name}"), "append", batch_sink(out, schema, transform=top),
                   trigger=trigger, settings=KEYED_STATE)
    return Job([q], lambda: _ntz(read_batches(spark, out, schema), *WINDOW))


def start_closed_top_routes(lines: DataFrame, k: int = 10, watermark: str = "30 minutes", output: str | None = None,
                            checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """Top k routes of every sliding window, when it closes."""
    routed = routed_trips(admitted(lines, admit, "dropoff_datetime", watermark))
    return _closed(routes.closing_route_counts(routed), "closed-routes", lambda c: routes.top_routes_per_window(c, k),
                   output, checkpoint, trigger)


def start_closed_price_breakdown(lines: DataFrame, k: int = 5, watermark: str = "30 minutes", output: str | None = None,
                                 checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """Cells with the highest totals of every two hours, when they are over."""
    cells = grid_cells(admitted(lines, admit, "pickup_datetime", watermark), 500)
    return _closed(areas.price_breakdown(cells), "closed-prices", lambda p: areas.price_breakdown_per_window(p, k),
                   output, checkpoint, trigger)


def start_closed_pleasant_driver(lines: DataFrame, k: int = 1, watermark: str = "30 minutes", output: str | None = None,
                                 checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """Drivers with the highest average tip rate of every day, when it is over."""
    rates = drivers.driver_tip_rate(admitted(lines, admit, "dropoff_datetime", watermark))
    return _closed(rates, "closed-pleasant", lambda r: drivers.pleasant_driver_per_day(r, k), output, checkpoint, trigger)


def start_area_profitability(lines: DataFrame, k: int = 5, output_mode: str = "complete", watermark: str = "30 minutes",
                             output: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """Two concurrent streams (average profit per pickup cell and 15 minutes;
    dropoffs per cell and 30 minutes); the profitability report reads what
    both hold at that moment."""
    spark = lines.sparkSession
    cells = grid_cells(admitted(lines, admit), 250)
    out, ckpt = output or _folder(spark, "profitability"), checkpoint or _folder(spark, "ckpt-profitability")
    parts = {"profit": (areas.area_profit_avg(cells, watermark=watermark), "cell_pickup"),
             "dropoffs": (areas.area_dropoffs(cells, watermark=watermark), "cell_dropoff")}
    queries = []
    for name, (rows, cell) in parts.items():
        sink = (snapshot_sink(f"{out}/{name}") if output_mode == "complete"
                else batch_sink(f"{out}/{name}", rows.schema, [cell, *WINDOW]))
        queries.append(run_stream(rows, f"{ckpt}/{name}", output_mode, sink, trigger=trigger))

    def held(name: str) -> DataFrame:
        rows, cell = parts[name]
        got = (read_snapshot(spark, f"{out}/{name}", rows.schema) if output_mode == "complete"
               else read_batches(spark, f"{out}/{name}", rows.schema, [cell, *WINDOW]))
        return _ntz(got, *WINDOW)

    return Job(queries, lambda: areas.area_profitability(held("profit"), held("dropoffs"), k))


def start_joined_profitability(lines: DataFrame, k: int = 5, watermark: str = "30 minutes", output: str | None = None,
                               checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT) -> Job:
    """The profitability report over closed windows, the two sides joined per
    cell in one query's state (``cell_join``): a micro-batch writes the pairs
    it changed, and state and report hold at most k pairs a cell."""
    spark = lines.sparkSession
    pairs = first_pairs_of_cells(grid_cells(admitted(lines, admit, "dropoff_datetime", watermark), 250), k)
    out, key = output or _folder(spark, "joined-profitability"), ["cell", "rank"]
    q = run_stream(pairs, checkpoint or _folder(spark, "ckpt-joined-profitability"), "append", batch_sink(out, pairs.schema, key),
                   trigger=trigger, settings=KEYED_STATE)

    def report() -> DataFrame:
        ends = [_from_us(f"{c} + {m * MINUTE_US}") for c, m in (("window_us", PROFIT_MINUTES), ("taxis_us", DROPOFF_MINUTES))]
        return (read_batches(spark, out, pairs.schema, key)
                .orderBy("window_us", F.col("profitability").desc_nulls_last(), "cell", "taxis_us").limit(k)
                .select("cell", _from_us("window_us").alias("window_start"), ends[0].alias("window_end"),
                        _from_us("taxis_us").alias("taxis_window_start"), ends[1].alias("taxis_window_end"), "profitability"))

    return Job([q], report)


def _stateful(rows: DataFrame, name: str, report: Callable[[DataFrame], DataFrame], output: str | None,
              checkpoint: str | None, trigger: dict | None,
              on_batch: Callable[[DataFrame, int], None] | None = None,
              keep: Callable[[DataFrame], DataFrame] | None = None, merge: Merge | None = None) -> Job:
    """Rows of a keyed-state query, appended per micro-batch, and their report;
    ``on_batch`` gets the report after every micro-batch. ``keep`` and
    ``merge``: of a batch only partial aggregates are kept, so that a report
    does not read all rows ever written."""
    spark = rows.sparkSession
    schema = keep(spark.createDataFrame([], rows.schema)).schema if keep else rows.schema
    out = output or _folder(spark, name)
    put = batch_sink(out, schema, transform=keep, merge=merge)

    def held() -> DataFrame:
        return report(read_batches(spark, out, schema, merge=merge))

    def sink(batch: DataFrame, batch_id: int) -> None:
        put(batch, batch_id)
        if on_batch is not None:
            on_batch(held(), batch_id)

    q = run_stream(rows, checkpoint or _folder(spark, f"ckpt-{name}"), "append", sink, trigger=trigger,
                   settings=KEYED_STATE)
    return Job([q], held)


def start_idle_time(lines: DataFrame, max_idle_seconds: int | None = 3600, watermark: str = "2 hours",
                    output: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT,
                    on_batch: Callable[[DataFrame, int], None] | None = None) -> Job:
    """Average idle time per cell, highest first, over the idle rides that the
    keyed state has given so far."""
    cells = grid_cells(admitted(lines, admit, "pickup_datetime", watermark), 500)
    return _stateful(stateful.idle_rides_stream(cells, max_idle_seconds, None), "idle", drivers.idle_means,
                     output, checkpoint, trigger, on_batch,
                     keep=lambda rides: drivers.idle_sums(rides.withColumnRenamed("gap_us", "_gap_us")), merge=drivers.idle_sums_merged)


def start_congestion(lines: DataFrame, min_run: int = 2, mean_hours: int = 4, watermark: str = "30 minutes",
                     output: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT,
                     expire_hours: float | None = None) -> Job:
    """Congestion alerts from keyed state per route."""
    routed = routed_trips(admitted(lines, admit, "dropoff_datetime", watermark))
    return _stateful(
        stateful.congestion_alerts_stream(routed, min_run, mean_hours, None, expire_hours), "congestion",
        lambda got: got.select("route", "trip_id", _from_us("dropoff_us").alias("dropoff_datetime"), "run_length",
                               "first_pickup_longitude", "first_pickup_latitude", "first_trip_time", "route_mean"),
        output, checkpoint, trigger)


def start_route_mean_reset(lines: DataFrame, reset_hours: int = 4, watermark: str = "30 minutes",
                           output: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, admit: Admission = ADMIT,
                           expire_hours: float | None = None) -> Job:
    """Running duration mean per route with the original 4-hour reset."""
    routed = routed_trips(admitted(lines, admit, "dropoff_datetime", watermark))
    return _stateful(
        stateful.route_mean_reset_stream(routed, reset_hours, None, expire_hours), "mean-reset",
        lambda got: got.select("route", "trip_id", _from_us("dropoff_us").alias("dropoff_datetime"), "route_mean_reset"),
        output, checkpoint, trigger)


def start_rejects(lines: DataFrame, event_time: str | None = "dropoff_datetime", admit: Admission = ADMIT, output: str | None = None,
                  checkpoint: str | None = None, trigger: dict | None = None) -> Job:
    """The side output of a job with the same ``admit`` and ``event_time``:
    the records that it turns away, with the reason."""
    spark = lines.sparkSession
    rows, out = rejects(lines, admit, event_time), output or _folder(spark, "rejects")
    q = run_stream(rows, checkpoint or _folder(spark, "ckpt-rejects"), "append", batch_sink(out, rows.schema), trigger=trigger)
    return Job([q], lambda: read_batches(spark, out, rows.schema))


def _bounded(start: Callable[..., Job]) -> Callable[..., DataFrame]:
    """The job run to its end (``availableNow`` unless a trigger is given) or
    for ``timeout_s`` seconds, then its report."""
    @wraps(start)
    def run(lines: DataFrame, *args, timeout_s: float | None = None, **options) -> DataFrame:
        return start(lines, *args, **options).finish(timeout_s)
    return run


top_routes_stream = _bounded(start_top_routes)
most_pleasant_driver_stream = _bounded(start_most_pleasant_driver)
top_price_breakdown_stream = _bounded(start_top_price_breakdown)
top_amount_per_mile_stream = _bounded(start_top_amount_per_mile)
area_profitability_stream = _bounded(start_area_profitability)
joined_profitability_stream = _bounded(start_joined_profitability)
closed_top_routes_stream = _bounded(start_closed_top_routes)
closed_price_breakdown_stream = _bounded(start_closed_price_breakdown)
closed_pleasant_driver_stream = _bounded(start_closed_pleasant_driver)
idle_time_stream = _bounded(start_idle_time)
congestion_stream = _bounded(start_congestion)
route_mean_reset_stream = _bounded(start_route_mean_reset)


# --- pipeline sinks ------------------------------------------------------------

ARCHIVE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in TRIP_JSON_FIELDS]
    + [T.StructField(n, t) for n, t in [
        ("trip_id", T.LongType()),
        ("pickup_datetime", T.TimestampNTZType()), ("dropoff_datetime", T.TimestampNTZType()),
        ("TripStartDT", T.DateType()), ("TripEndDT", T.DateType()),
        ("minute", T.IntegerType()), ("second", T.IntegerType()),
        ("dayofweek", T.IntegerType()), ("week_day_full", T.StringType()),
        ("TripStartYear", T.IntegerType()), ("TripStartMonth", T.IntegerType()),
        ("TripStartDay", T.IntegerType()), ("hour", T.IntegerType())]])


def archive_records(records: DataFrame) -> DataFrame:
    """The archive layout: the 20 text fields as received, parsed pickup and
    dropoff times, and calendar parts of the pickup."""
    from ..functions.columns import parse_timestamp
    from ..operators.clean import trip_date_parts
    keep = [c for c in ("trip_id",) if c in records.columns]
    df = trip_decode_json(records, keep=keep)
    df = df.withColumns({"pickup_datetime": parse_timestamp("lpep_pickup_datetime"),
                         "dropoff_datetime": parse_timestamp("lpep_dropoff_datetime")})
    return trip_date_parts(df, names="archive")


def archive_roundtrip(records: DataFrame, partitions: list[str] | None = None, timeout_s: float | None = None,
                      output: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Stream the records into the partitioned JSON archive, then read the
    archive back with partition discovery (typed by an explicit schema)."""
    spark = records.sparkSession
    path = output or _folder(spark, "archive")
    q = write_archive(archive_records(records), path, checkpoint or _folder(spark, "ckpt-archive"), partitions)
    await_bounded(q, timeout_s)
    return spark.read.schema(ARCHIVE_SCHEMA).json(path)


def clean_table_roundtrip(records: DataFrame, table: str | None = None, timeout_s: float | None = None,
                          output: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Stream cleaned trips into a partitioned catalog table (created over a
    folder in the shared checkpoint folder), then scan the table."""
    spark = records.sparkSession
    name = table or f"clean_{uuid.uuid4().hex[:12]}"
    full = register_clean_table(spark, name, location=output or _folder(spark, "clean-table"), repair=False, by_batch=True)
    q = write_clean_table(trip_clean(trip_decode_json(records)), full, checkpoint or _folder(spark, "ckpt-clean"))
    await_bounded(q, timeout_s)
    cols = [n for n, _ in CLEAN_COLUMNS + CLEAN_PARTITIONS]
    return spark.table(full).select(*cols)


def clean_files_registered(records: DataFrame, table: str | None = None, timeout_s: float | None = None,
                           output: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Stream cleaned trips into Parquet files, register the partitions that
    came since the last call, and scan the table."""
    spark = records.sparkSession
    path = output or _folder(spark, "clean-files")
    full = register_clean_table(spark, table or f"files_{uuid.uuid4().hex[:12]}", location=path, repair=False)
    q = write_clean_files(trip_clean(trip_decode_json(records)), path, checkpoint or _folder(spark, "ckpt-clean-files"))
    await_bounded(q, timeout_s)
    register_new_partitions(spark, full, path)
    return spark.table(full).select(*[n for n, _ in CLEAN_COLUMNS + CLEAN_PARTITIONS])
