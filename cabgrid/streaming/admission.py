"""Which records of a feed may move event time.

A watermark follows the latest event time it sees and never goes back, so one
record with a wrong date would make every later record late. Records are
therefore judged before the watermark: those that cannot be a trip, have no
event time, or are dated further ahead of the clock than ``max_future`` (or
after ``not_after``) are turned away. The rejects are counted by reason in the
query's progress (``rejected``), and ``rejects`` gives the records themselves
with the reason, for a sink of their own.

A replay may name its closing record (``closing``: that exact text): it passes
the watermark and is dropped behind it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import valid_trip
from ..sources.decode import trip_decode_csv

METRICS = "admission"
REASONS = ("invalid", "no_time", "future")
TIMES = ("pickup_datetime", "dropoff_datetime")


@dataclass(frozen=True)
class Admission:
    """``max_future``: how far a time may lie ahead of the processing time
    (None: any); ``not_after``: a fixed latest time, for replays of old data;
    ``closing``: the text of a replay's closing record."""

    max_future: str | None = "1 day"
    not_after: str | None = None
    closing: str | None = None

    def _future(self) -> Column:
        late = F.lit(False)
        for c in TIMES:
            if self.max_future is not None:
                late = late | (F.col(c) > F.current_timestamp() + F.expr(f"INTERVAL '{self.max_future}'"))
            if self.not_after is not None:
                late = late | (F.col(c) > F.lit(self.not_after).cast("timestamp"))
        return F.coalesce(late, F.lit(False))

    def judged(self, lines: DataFrame, event_time: str | None) -> DataFrame:
        """Decoded trips (times as moments) with ``_reason``: null for those
        admitted, 'closing' for the closing record, else one of REASONS."""
        lines = lines.withColumn("_closing", F.col("value").eqNullSafe(F.lit(self.closing)) if self.closing else F.lit(False))
        keep = [c for c in ("trip_id",) if c in lines.columns]
        trips = trip_decode_csv(lines, ntz=False, keep=[*keep, "value", "_closing"])
        reason = F.when(F.col("_closing"), "closing").when(self._future(), "future").when(
            ~F.coalesce(valid_trip(), F.lit(False)), "invalid")
        if event_time is not None:
            reason = reason.when(F.col(event_time).isNull(), "no_time")
        return trips.withColumn("_reason", reason)


def admitted(lines: DataFrame, rule: Admission, event_time: str | None = None, watermark: str | None = None) -> DataFrame:
    """Valid trips, the watermark (if given) behind the judgement. The last
    filter reads the event time, so it is not moved below the watermark."""
    judged = rule.judged(lines, event_time).drop("value")
    if lines.isStreaming:
        judged = judged.observe(METRICS, *[F.count(F.when(F.col("_reason") == r, 1)).alias(r) for r in REASONS])
    closing = F.col("_closing")
    if event_time is None:
        return judged.filter(F.col("_reason").isNull()).drop("_reason", "_closing")
    passed = judged.filter(F.col("_reason").isNull() | (F.col("_reason") == "closing")).drop("_reason")
    if watermark is not None:
        passed = passed.withWatermark(event_time, watermark)
    return passed.filter(closing != F.col(event_time).isNotNull()).drop("_closing")


def rejects(lines: DataFrame, rule: Admission, event_time: str | None = None) -> DataFrame:
    """The records turned away, as they came, with ``reason``."""
    judged = rule.judged(lines, event_time).filter(F.col("_reason").isin(*REASONS))
    return judged.select(*[c for c in ("trip_id",) if c in lines.columns], "value", F.col("_reason").alias("reason"))


def rejected(queries: Iterable[StreamingQuery]) -> dict[str, int]:
    """How many records the queries' recent micro-batches turned away, by reason."""
    total = Counter(dict.fromkeys(REASONS, 0))
    for q in queries:
        for progress in q.recentProgress:
            row = (progress.observedMetrics or {}).get(METRICS)
            if row is not None:
                total.update({r: row[r] for r in REASONS})
    return dict(total)
