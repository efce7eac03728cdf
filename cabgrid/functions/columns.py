"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import (CELL_SIZES, ORIGIN_LAT, ORIGIN_LON, SHIFT_LAT_500,
                        SHIFT_LON_500)

# Money and distances are summed as exact decimals, wide enough for any trip
# (28 digits, 9 of them after the point), so totals do not depend on the order
# in which partitions are combined.
EXACT = "decimal(28,9)"
# Averages of non-money ratios are reported to this many decimals, which
# makes them independent of summation order.
AVG_DIGITS = 9

# Extra text layouts accepted by ``parse_timestamp`` after the ISO forms.
TIMESTAMP_FORMATS = ["M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm",
                     "yyyy/MM/dd HH:mm:ss"]
OFFSET = r"(?:Z|[+-]\d{2}:?\d{2})$"


def money(c: Column | str) -> Column:
    """Text money to double: ``$`` removed, null -> 0.0, malformed -> null."""
    c = F.col(c) if isinstance(c, str) else c
    cleaned = F.trim(F.regexp_replace(c.cast("string"), r"\$", ""))
    return F.when(c.isNull(), F.lit(0.0)).otherwise(cleaned.try_cast("double"))


def parse_timestamp(c: Column | str, ntz: bool = True) -> Column:
    """Free-form text to timestamp; unparseable text -> null.

    ISO forms (``2015-01-01T00:34:42.000``, ``2013-01-01 00:02:00``) go through
    a plain cast, a few other common layouts (with AM/PM too) are tried after
    it. A text without an offset is wall-clock time, read as UTC; one with an
    offset (``...T00:34:42+02:00``, ``...Z``) is that moment in UTC. Neither
    depends on the session's time zone.
    """
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    wall = F.coalesce(c.try_cast("timestamp_ntz"),
                      *[_wall_clock(c, fmt) for fmt in TIMESTAMP_FORMATS])
    moment = c.try_cast("timestamp")
    utc = F.when(c.rlike(r"\d" + OFFSET) & c.rlike(r"\d:\d") & moment.isNotNull(),
                 utc_wall(moment))
    found = F.coalesce(utc, wall)
    return found if ntz else utc_timestamp(found)


def _wall_clock(c: Column, fmt: str) -> Column:
    """A pattern's wall-clock time, whatever the session's time zone."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def utc_wall(c: Column) -> Column:
    """What UTC clocks show at a moment (``timestamp_ntz``)."""
    seconds = F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def utc_timestamp(c: Column) -> Column:
    """The moment at which UTC clocks show the wall-clock time ``c``."""
    return F.timestamp_micros(wall_micros(c))


def wall_micros(c: Column) -> Column:
    """Microseconds from 1970-01-01 00:00 to a ``timestamp_ntz``, by its own
    calendar fields: no session time zone takes part."""
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    return (F.unix_date(c.cast("date")).cast("long") * F.lit(86_400_000_000) + seconds.cast("long") * F.lit(1_000_000)
            + (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long"))


def time_of(micros: Column, kind: str) -> Column:
    """The time of ``epoch_micros`` as the Spark type ``kind``."""
    moment = F.timestamp_micros(micros)
    return utc_wall(moment) if kind == "timestamp_ntz" else moment


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970-01-01 for a timestamp column, ntz or not.

    Used to order range frames; for ``timestamp_ntz`` the result does not
    depend on the session time zone.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return wall_micros(F.col(name))
    return F.unix_micros(F.col(name))



def cell_label(lon: Column, lat: Column, size: int = 500,
               convention: str = "lat_lon") -> Column:
    """Grid cell of a point as text.

    ``lat_lon`` (default): ``"<-ceil((lat-origin)/step)>-<ceil((lon-origin)/step)>"``
    ``lon_lat_ceil``:      ``"<ceil((lon-origin)/step)>-<ceil((origin-lat)/step)>"``
    """
    div = CELL_SIZES[size]
    lon_step = F.lit(SHIFT_LON_500 / div)
    lat_step = F.lit(SHIFT_LAT_500 / div)
    lon_idx = F.ceil((lon - F.lit(ORIGIN_LON)) / lon_step)
    if convention == "lat_lon":
        lat_idx = -F.ceil((lat - F.lit(ORIGIN_LAT)) / lat_step)
        return F.concat_ws("-", lat_idx, lon_idx)
    if convention == "lon_lat_ceil":
        lat_idx = F.ceil((F.lit(ORIGIN_LAT) - lat) / lat_step)
        return F.concat_ws("-", lon_idx, lat_idx)
    raise ValueError(f"unknown cell convention {convention!r}")


def route_separator(convention: str = "lat_lon") -> str:
    return "/" if convention == "lat_lon" else ":"


def window_columns(win: Column) -> list[Column]:
    """Flatten a ``window`` struct into ``window_start`` / ``window_end``."""
    return [win.start.alias("window_start"), win.end.alias("window_end")]
