"""Order-dependent building blocks that stay parallel when one key is hot.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; if
one taxi or route holds a third of the data, that task holds a third of the
data. Here every window is partitioned by (key, time bucket), and what crosses
a bucket boundary is a carry: one row per key and bucket, from a narrow
aggregate of the columns it needs, joined to the one pass over the rows.

* previous row: the last row of each bucket, ``lag`` over buckets;
* run counters: each bucket's row count, last value and last break, scanned
  over buckets to the run that enters each bucket;
* trailing range means: exact prefix sums; the prefix at ``t - range`` comes
  from narrow look-up entries placed in the bucket that asks for them.

Buckets are BUCKET_SECONDS wide unless the caller says otherwise. With
``widths`` (``dense_widths``) a (key, bucket) of more than ``max_rows`` rows is
cut into narrower slices of its own width, so a window partition stops growing
with a key's density; the carries chain slices just as they chain buckets. The
narrowest slice is a second: rows of a key in the same second (ties, as trip
records hold whole seconds) are one partition.

Rows without a key or a time have no place in a sequence and are left out. All
results equal the unbucketed window definitions exactly, whatever the buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import EXACT, epoch_micros

BUCKET = "_bkt"
# One hour: a key's rows of an hour are one window partition, and a key has
# 8,766 carry rows a year. A parameter of every operator.
BUCKET_SECONDS = 3_600
WIDE = "_wide"
# Rows of a key in a bucket from which it is cut into slices.
MAX_ROWS = 1_000_000
# Widths of slices of fewer rows are too many to broadcast.
BROADCAST_ROWS = 1_000


def start_of(micros: Column, width: Column | int) -> Column:
    """The second at which the slice of ``width`` seconds around a moment starts."""
    width = F.lit(width) if isinstance(width, int) else width
    return ((micros - F.pmod(micros, width * F.lit(1_000_000).cast("long"))) / F.lit(1_000_000)).cast("long")


def in_buckets(df: DataFrame, key: list[str], micros: Column, bucket_seconds: int, widths: DataFrame | None = None) -> DataFrame:
    """``df`` with its bucket, named by the second it starts at."""
    if widths is None:
        return df.withColumn(BUCKET, start_of(micros, bucket_seconds))
    near = df.withColumn(WIDE, start_of(micros, bucket_seconds)).join(widths, [*key, WIDE], "left")
    return near.select(*df.columns, start_of(micros, F.coalesce("_width", F.lit(bucket_seconds))).alias(BUCKET))


def placed(df: DataFrame, key: list[str], time_col: str, bucket_seconds: int, widths: DataFrame | None = None) -> DataFrame:
    """Rows that have a place in a sequence, with their bucket."""
    if BUCKET in df.columns:
        return df.dropna(subset=[*key, time_col])
    return in_buckets(df.dropna(subset=[*key, time_col]), key, epoch_micros(df, time_col), bucket_seconds, widths)


def moments(df: DataFrame, key: list[str], time_col: str, *later: int) -> DataFrame:
    """The key and ``_t`` (microseconds) of each row, and of the moments
    ``later`` seconds after it."""
    t = epoch_micros(df, time_col)
    at = F.explode(F.array(*[t + F.lit(s * 1_000_000) for s in (0, *later)])) if later else t
    return df.dropna(subset=[*key, time_col]).select(*key, at.alias("_t"))


def slice_widths(bucket_seconds: int) -> list[int]:
    """Widths a bucket may be cut to: divisors, each at most half the one before."""
    widths: list[int] = []
    for w in range(bucket_seconds // 2, 0, -1):
        if bucket_seconds % w == 0 and 2 * w <= (widths or [bucket_seconds])[-1]:
            widths.append(w)
    return widths or [1]


def dense_widths(at: DataFrame, key: list[str], bucket_seconds: int = BUCKET_SECONDS, max_rows: int = MAX_ROWS) -> DataFrame:
    """(key, ``_wide``, ``_width``) of each (key, bucket) with more than
    ``max_rows`` of the moments ``at``: the widest slices of which none holds
    more (a second, if even that does).

    One narrow scan with partial counts. Only where it finds dense buckets is
    a second scan made, for their counts by second (at most ``bucket_seconds``
    rows a bucket). Both tables have at most (moments / ``max_rows``) rows, the
    size bound of their broadcasts: 5e11 rows, about 100 TB of trips, give at
    most 5e5 rows of some 50 bytes at MAX_ROWS.

    With ``max_rows`` below BROADCAST_ROWS that bound grows with the input, so
    nothing is broadcast by hand: one scan counts every bucket by second, and
    rows meet their widths in a shuffled join (adaptive execution broadcasts
    what turns out small, and splits an hour that is skewed).
    """
    wide = at.withColumn(WIDE, start_of(F.col("_t"), bucket_seconds))
    second = F.floor(F.col("_t") / 1_000_000).alias("_second")
    few = max_rows < BROADCAST_ROWS
    if few:
        counted = wide.groupBy(*key, WIDE, second).agg(F.count(F.lit(1)).alias("_n"))
        in_all = F.sum("_n").over(Window.partitionBy(*key, WIDE))
        seconds = counted.withColumn("_all", in_all).filter(F.col("_all") > max_rows)
    else:
        dense = wide.groupBy(*key, WIDE).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows).select(*key, WIDE)
        seconds = wide.join(F.broadcast(dense), [*key, WIDE]).groupBy(*key, WIDE, second).agg(F.count(F.lit(1)).alias("_n"))
    tries = F.explode(F.array(*[F.lit(w) for w in slice_widths(bucket_seconds)]))
    sizes = (seconds.select(*key, WIDE, "_second", "_n", tries.alias("_width"))
             .groupBy(*key, WIDE, "_width", F.floor((F.col("_second") - F.col(WIDE)) / F.col("_width")).alias("_slice"))
             .agg(F.sum("_n").alias("_n")).groupBy(*key, WIDE, "_width").agg(F.max("_n").alias("_most")))
    widths = sizes.groupBy(*key, WIDE).agg(
        F.coalesce(F.max(F.when(F.col("_most") <= max_rows, F.col("_width"))), F.lit(1)).alias("_width"))
    # One shuffle of the widths, which all joins with them read.
    return widths.repartition(*key, WIDE) if few else F.broadcast(widths)


def previous_in_order(df: DataFrame, key: list[str], order: list[str], cols: list[str],
                      prefix: str = "prev_", bucket_seconds: int = BUCKET_SECONDS,
                      widths: DataFrame | None = None) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same key
    (rows ordered by ``order``; ``order[0]`` is the timestamp bucketed).

    One window pass over (key, bucket); a bucket's first row takes the last
    row of the bucket before, from a partial aggregate.
    """
    d = placed(df, key, order[0], bucket_seconds, widths)
    ends = d.groupBy(*key, BUCKET).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    carry = ends.select(*key, BUCKET, F.lag("_last").over(Window.partitionBy(*key).orderBy(BUCKET)).alias("_carry"))
    w = Window.partitionBy(*key, BUCKET).orderBy(*order)
    d = d.join(carry, [*key, BUCKET]).withColumns(
        {"_rn": F.row_number().over(w), **{prefix + c: F.lag(c).over(w) for c in cols}})
    return d.withColumns({prefix + c: F.when(F.col("_rn") == 1, F.col("_carry")[c]).otherwise(F.col(prefix + c))
                          for c in cols}).drop("_rn", "_carry")


def run_carries(df: DataFrame, key: list[str], order: list[str], value: str, carry: list[str],
                bucket_seconds: int = BUCKET_SECONDS, widths: DataFrame | None = None) -> DataFrame:
    """Per (key, bucket): ``_before`` rows in earlier buckets, ``_enter`` the
    last value before it, ``_run`` the start of the run that enters it
    (``at``: its row number, ``value``, and the ``carry`` columns)."""
    d = placed(df, key, order[0], bucket_seconds, widths).select(*key, BUCKET, *dict.fromkeys([*order, value, *carry]))
    w = Window.partitionBy(*key, BUCKET).orderBy(*order)
    d = d.withColumns({"_pos": F.row_number().over(w) - 1, "_prev": F.lag(value).over(w)})
    start = F.struct(F.col("_pos").alias("at"), F.col(value).alias("value"), *carry)
    broke = (F.col("_pos") > 0) & (F.col("_prev").isNull() | (F.col(value) <= F.col("_prev")))
    ends = d.groupBy(*key, BUCKET).agg(
        F.count("*").alias("_n"), F.max_by(value, "_pos").alias("_last"), F.min_by(start, "_pos").alias("_first"),
        F.max_by(F.when(broke, start), F.when(broke, F.col("_pos"))).alias("_break"))
    kw = Window.partitionBy(*key).orderBy(BUCKET)
    earlier = kw.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_enter": F.lag("_last").over(kw)})
    first = F.col("_first.value")
    latest = F.coalesce("_break", F.when(F.col("_enter").isNull() | (first <= F.col("_enter")), F.col("_first")))
    moved = F.when(latest.isNotNull(), F.struct((latest["at"] + F.col("_before")).alias("at"), latest["value"].alias("value"),
                                                *[latest[c].alias(c) for c in carry]))
    return (ends.withColumn("_latest", moved)
            .select(*key, BUCKET, "_before", "_enter", F.last("_latest", ignorenulls=True).over(earlier).alias("_run")))


def rising_runs(df: DataFrame, key: list[str], order: list[str], value: str,
                carry: list[str], bucket_seconds: int = BUCKET_SECONDS, source: DataFrame | None = None,
                widths: DataFrame | None = None) -> DataFrame:
    """Length of the current run of strictly rising ``value`` per key.

    ``run_length`` is 0 on the first row of a key and whenever ``value`` does
    not exceed the previous row's, else previous + 1. ``first_<value>`` and
    ``first_<c>`` for ``c`` in ``carry`` come from the row that started the run.

    One pass over the rows (one shuffle, one window order) beside the carries;
    ``source``: the rows to take the carries from, where ``df`` is derived
    from them.
    """
    carries = run_carries(df if source is None else source, key, order, value, carry, bucket_seconds, widths)
    d = placed(df, key, order[0], bucket_seconds, widths).join(carries, [*key, BUCKET])
    w = Window.partitionBy(*key, BUCKET).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({"_pos": F.row_number().over(w) - 1, "_prev": F.lag(value).over(w)})
    prev = F.when(F.col("_pos") == 0, F.col("_enter")).otherwise(F.col("_prev"))
    at = F.col("_before") + F.col("_pos")
    start = F.struct(at.alias("at"), F.col(value).alias("value"), *carry)
    d = d.withColumn("_start", F.coalesce(
        F.last(F.when(prev.isNull() | (F.col(value) <= prev), start), ignorenulls=True).over(upto), "_run"))
    return d.withColumns({"run_length": (at - F.col("_start.at")).cast("long"), "first_" + value: F.col("_start.value"),
                          **{"first_" + c: F.col("_start")[c] for c in carry}}).drop(
        "_before", "_enter", "_run", "_pos", "_prev", "_start")


def trailing_range_avg(df: DataFrame, key: list[str], time_col: str, value: str,
                       range_seconds: int, out: str, bucket_seconds: int = BUCKET_SECONDS,
                       widths: DataFrame | None = None) -> DataFrame:
    """``out`` = average of ``value`` over rows of the same key whose
    ``time_col`` lies in [t - range, t] (ties included).

    What came until ``t`` less what had gone before it, both exact decimals: a
    row's value comes at its time and goes ``range`` after it, as a narrow
    entry (key, time, value) in the bucket of that later moment. Totals of the
    earlier buckets (a carry per key and bucket) and growing frames inside the
    bucket. Linear in the rows; ``bucket_seconds`` must divide the range.
    ``widths`` are those of the moments at which values come and go.
    """
    if range_seconds % bucket_seconds:
        raise ValueError(f"a range of {range_seconds} s is not a multiple of the {bucket_seconds} s buckets")
    rng = F.lit(range_seconds * 1_000_000)
    rows_in = df.dropna(subset=[*key, time_col])
    t, v = epoch_micros(df, time_col), F.col(value).try_cast(EXACT)
    d = placed(df, key, time_col, bucket_seconds, widths).withColumns({"_t": t, "_v": v})
    nothing = F.lit(None).cast(EXACT)
    moves = F.explode(F.array(F.struct(t.alias("_t"), v.alias("_v"), nothing.alias("_gone")),
                              F.struct((t + rng).alias("_t"), nothing.alias("_v"), v.alias("_gone"))))
    moved = in_buckets(rows_in.select(*key, moves.alias("_m")).select(*key, "_m.*"), key, F.col("_t"), bucket_seconds, widths)
    sums = moved.groupBy(*key, BUCKET).agg((F.coalesce(F.sum("_v"), F.lit(0)) - F.coalesce(F.sum("_gone"), F.lit(0))).alias("_s"),
                                           (F.count("_v") - F.count("_gone")).alias("_c"))
    earlier = Window.partitionBy(*key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*key, BUCKET, F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_bs"),
                       F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_bc"))
    entries = in_buckets(rows_in.select(*key, (t + rng).alias("_t"), v.alias("_gone")), key, F.col("_t"), bucket_seconds, widths)
    both = d.unionByName(entries.withColumn("_entry", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy(*key, BUCKET).orderBy("_t", F.col("_entry").asc_nulls_first())
    gone = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    came = Window.partitionBy(*key, BUCKET).orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumns({"_gs": F.coalesce(F.sum("_gone").over(gone), F.lit(0)), "_gc": F.count("_gone").over(gone)})
    both = both.withColumns({"_us": F.coalesce(F.sum("_v").over(came), F.lit(0)), "_uc": F.count("_v").over(came)})
    rows = both.filter(F.col("_entry").isNull()).join(base, [*key, BUCKET])
    mean = F.try_divide((F.col("_bs") + F.col("_us") - F.col("_gs")).cast("double"), F.col("_bc") + F.col("_uc") - F.col("_gc"))
    return rows.withColumn(out, mean).drop("_t", "_v", "_entry", "_gone", "_gs", "_gc", "_us", "_uc", "_bs", "_bc")


def key_time_order(time_col: str, tiebreak: str | None) -> list[str]:
    return [time_col] + ([tiebreak] if tiebreak else [])
