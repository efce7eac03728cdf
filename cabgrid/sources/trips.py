"""Trip inputs: the typed trip table derived from the ``events`` table, and the
two wire forms (17-field CSV line, 20-field JSON record) built from it.

The derivation is column arithmetic on ``events`` (no shuffle), so its cost
grows linearly with the table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import TRIP_JSON_FIELDS, TRIP_LINE_FIELDS
from .fixture import trip_steps

MALFORMED = "garbage"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_events(events: DataFrame) -> DataFrame:
    """Typed trips (``trip_id`` + the 17 trip-line fields) from ``events``.

    The columns come out of a generator, so the optimizer sees plain columns
    and not their derivations (constraint propagation over those grows very
    fast with the depth of a plan). Parts that several columns share are
    columns before it: with each repeated, the generated method grows beyond
    what the JVM compiles (8,000 bytes) and runs interpreted."""
    steps, columns = trip_steps("STRING")
    rows = events.select("event_id", "ts", "user_id")
    for step in steps:
        rows = rows.selectExpr("*", *[f"{e} AS {n}" for e, n in step])
    fields = ", ".join(f"{e} AS {n}" for e, n in columns)
    return rows.selectExpr(f"inline(array(struct({fields})))")


def load_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(load_table(spark, sf_dir, "events"))


# --- wire forms -------------------------------------------------------------

def to_trip_lines(trips: DataFrame, keep_id: bool = False, keep=()) -> DataFrame:
    """17-field comma-separated trip line in column ``value`` (``keep``:
    extra columns carried along); an unknown value is malformed text."""
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit(MALFORMED)) for c in TRIP_LINE_FIELDS])
    cols = [line.alias("value")] + [F.col(k) for k in keep]
    if keep_id:
        cols = [F.col("trip_id")] + cols
    return trips.select(*cols)


def fixed_text(c: Column, decimals: int) -> Column:
    """Decimal text of a double with a fixed number of decimals, built from
    an integer so that every engine writes the same characters."""
    units = F.round(c * F.lit(float(10 ** decimals))).cast("long")
    return (units.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-decimals))).cast(f"decimal({19 + decimals},{decimals})").cast("string")


def to_trip_json(trips: DataFrame, keep_id: bool = False, keep=()) -> DataFrame:
    """20-field JSON trip record (all text) in column ``value``.

    Deterministic dirt, keyed on ``trip_id``: ``$`` before money when
    ``id % 7 = 0`` (not on ``extra``/``improvement_surcharge``), null tip when
    ``id % 31 = 0``, ``tolls_amount = 'n/a'`` when ``id % 37 = 0``, times with
    AM/PM when ``id % 41 = 0``, the pickup time for an unknown dropoff time.
    """
    tid = F.col("trip_id")
    # Columns of their own: derived once a row, not once a field.
    trips = trips.withColumns({"_dollar": F.when(tid % 7 == 0, F.lit("$")).otherwise(F.lit("")), "_am_pm": tid % 41 == 0})
    dollar, am_pm = F.col("_dollar"), F.col("_am_pm")

    def cash(name: str) -> Column:
        return F.concat(dollar, fixed_text(F.col(name), 2))

    def when(time: Column) -> Column:
        return F.when(am_pm, F.date_format(time, "M/d/yyyy h:mm:ss a")).otherwise(
            F.date_format(time, "yyyy-MM-dd HH:mm:ss"))

    fields = {
        "vendorid": (F.lit(1) + tid % 2).cast("string"),
        "lpep_pickup_datetime": when(F.col("pickup_datetime")),
        "lpep_dropoff_datetime": when(F.coalesce("dropoff_datetime", "pickup_datetime")),
        "store_and_fwd_flag": F.lit("N"),
        "ratecodeid": F.lit("1"),
        "pickup_longitude": fixed_text(F.col("pickup_longitude"), 6),
        "pickup_latitude": fixed_text(F.col("pickup_latitude"), 6),
        "dropoff_longitude": fixed_text(F.col("dropoff_longitude"), 6),
        "dropoff_latitude": fixed_text(F.col("dropoff_latitude"), 6),
        "passenger_count": (tid % 10).cast("string"),
        "trip_distance": fixed_text(F.col("trip_distance"), 4),
        "fare_amount": cash("fare_amount"),
        "extra": fixed_text(F.col("surcharge"), 2),
        "mta_tax": cash("mta_tax"),
        "tip_amount": F.when(tid % 31 == 0, F.lit(None).cast("string")).otherwise(cash("tip_amount")),
        "tolls_amount": F.when(tid % 37 == 0, F.lit("n/a")).otherwise(cash("tolls_amount")),
        "improvement_surcharge": F.lit("0.30"),
        "total_amount": cash("total_amount"),
        "payment_type": F.col("payment_type"),
        "trip_type": F.lit("1"),
    }
    assert list(fields) == TRIP_JSON_FIELDS
    rec = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    cols = [rec.alias("value")] + [F.col(k) for k in keep]
    if keep_id:
        cols = [tid] + cols
    return trips.select(*cols)
