"""Decoding of the two wire forms into typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import utc_timestamp
from ..functions.constants import TRIP_JSON_FIELDS, TRIP_LINE_FIELDS

# Natural type of each trip-line field.
TRIP_LINE_TYPES = {
    "medallion": "string", "hack_license": "string",
    "pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz",
    "trip_time": "double", "trip_distance": "double",
    "pickup_longitude": "double", "pickup_latitude": "double",
    "dropoff_longitude": "double", "dropoff_latitude": "double",
    "payment_type": "string", "fare_amount": "double", "surcharge": "double",
    "mta_tax": "double", "tip_amount": "double", "tolls_amount": "double",
    "total_amount": "double",
}

TRIP_JSON_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True)
                                 for n in TRIP_JSON_FIELDS])


def trip_decode_csv(lines: DataFrame, columns=None, value_col: str = "value",
                    ntz: bool = True, keep=()) -> DataFrame:
    """Split ``value`` on ``,`` and type the requested fields by position.

    ``columns``: list of names or ``(name, type)`` pairs; default all 17 with
    their natural types. Lines with fewer fields or text in a number give null
    (``try_cast`` / ``get``), never an exception. Rows with every decoded field
    null are dropped. ``keep`` names input columns carried through. With
    ``ntz=False`` times become moments, wall clocks read as UTC.
    """
    if columns is None:
        columns = list(TRIP_LINE_FIELDS)
    parts = F.split(F.col(value_col).cast("string"), ",")
    out = [F.col(k) for k in keep]
    names = []
    first_is_text = False
    for c in columns:
        name, typ = (c, TRIP_LINE_TYPES[c]) if isinstance(c, str) else c
        idx = TRIP_LINE_FIELDS.index(name)
        item = F.get(parts, idx)
        if typ != "string":
            item = F.trim(item).try_cast(typ)
            if typ.startswith("timestamp") and not ntz:
                item = utc_timestamp(item)
        elif idx == 0:
            first_is_text = True
        out.append(item.alias(name))
        names.append(name)
    if first_is_text:
        # Field 0 as text is null only when the line is: the all-null test is
        # one null check, not 17 decodes pushed below the projection.
        return lines.filter(F.col(value_col).isNotNull()).select(*out)
    return lines.select(*out).na.drop(how="all", subset=names)


def trip_decode_json(records: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """The 20 text fields of a JSON trip record as columns.

    ``json_tuple`` parses each record once for all fields, and being a
    generator it keeps later filters on the decoded fields above the parse
    (a ``from_json`` struct would be re-parsed for every pushed predicate).
    """
    fields = F.json_tuple(F.col(value_col).cast("string"), *TRIP_JSON_FIELDS).alias(*TRIP_JSON_FIELDS)
    return records.select(*[F.col(k) for k in keep], fields)
