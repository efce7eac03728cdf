"""Fixed values of the trip data model.

These numbers must equal the original jobs' values for results to match, so
they are stated here once, in natural order, and used everywhere else.
"""

# --- fixed values: city grid --------------------------------------------
# Upper-left corner of the grid (longitude, latitude).
ORIGIN_LON = -74.916578
ORIGIN_LAT = 41.47718278
# Lower-right limit of the grid (longitude, latitude).
LIMIT_LON = -73.120778
LIMIT_LAT = 40.12971598
# Degrees of longitude / latitude for a 500 m step; 250 m is half of each.
SHIFT_LON_500 = 0.005986
SHIFT_LAT_500 = 0.004491556
# --- end of fixed values -------------------------------------------------

CELL_SIZES = {500: 1, 250: 2}  # metres -> divisor of the 500 m step

# --- fixed values: 17-field trip line, in wire order ----------------------
TRIP_LINE_FIELDS = [
    "medallion", "hack_license", "pickup_datetime", "dropoff_datetime",
    "trip_time", "trip_distance", "pickup_longitude", "pickup_latitude",
    "dropoff_longitude", "dropoff_latitude", "payment_type", "fare_amount",
    "surcharge", "mta_tax", "tip_amount", "tolls_amount", "total_amount",
]

# --- fixed values: 20-field trip JSON record ------------------------------
TRIP_JSON_FIELDS = [
    "vendorid", "lpep_pickup_datetime", "lpep_dropoff_datetime",
    "store_and_fwd_flag", "ratecodeid", "pickup_longitude", "pickup_latitude",
    "dropoff_longitude", "dropoff_latitude", "passenger_count",
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "payment_type",
    "trip_type",
]

# Renames applied when a JSON record is cleaned.
JSON_RENAMES = {
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "payment_type": "PaymentType",
}

# Money columns normalised from text ("$12.50" -> 12.5, null -> 0.0).
JSON_MONEY_FIELDS = ["tip_amount", "fare_amount", "tolls_amount", "mta_tax", "total_amount"]

# Text columns cast to double when a JSON record is cleaned.
JSON_DOUBLE_FIELDS = [
    "trip_distance", "pickup_longitude", "pickup_latitude",
    "dropoff_longitude", "dropoff_latitude",
]

# Cleaned-table layout: data columns then partition columns.
CLEAN_COLUMNS = [
    ("pickup_longitude", "double"), ("pickup_latitude", "double"),
    ("dropoff_longitude", "double"), ("dropoff_latitude", "double"),
    ("passenger_count", "string"), ("trip_distance", "double"),
    ("tip_amount", "double"), ("total_amount", "double"),
    ("TripStartDay", "int"), ("TripStartYear", "int"), ("hourd", "int"),
    ("minuted", "int"), ("secondd", "int"), ("dayofweek", "int"),
    ("week_day_full", "string"),
]
CLEAN_PARTITIONS = [("vendorid", "string"), ("TripStartMonth", "int")]

# Default partition layout of the JSON archive (coarser than per-second).
ARCHIVE_PARTITIONS = ["TripStartYear", "TripStartMonth", "TripStartDay", "hour"]

# The 33 columns of the routed-trip table of the database sink,
# with their SQL types, in table order.
ENRICHED_TYPES = [
    ("vendorid", "VARCHAR(8)"), ("pickup_datetime", "TIMESTAMP"), ("dropoff_datetime", "TIMESTAMP"),
    ("store_and_fwd_flag", "VARCHAR(8)"), ("ratecodeid", "VARCHAR(8)"),
    ("pickup_longitude", "DOUBLE PRECISION"), ("pickup_latitude", "DOUBLE PRECISION"),
    ("dropoff_longitude", "DOUBLE PRECISION"), ("dropoff_latitude", "DOUBLE PRECISION"),
    ("passenger_count", "VARCHAR(8)"), ("trip_distance", "DOUBLE PRECISION"),
    ("fare_amount", "DOUBLE PRECISION"), ("extra", "VARCHAR(16)"), ("mta_tax", "DOUBLE PRECISION"),
    ("tip_amount", "DOUBLE PRECISION"), ("tolls_amount", "DOUBLE PRECISION"),
    ("improvement_surcharge", "VARCHAR(16)"), ("total_amount", "DOUBLE PRECISION"),
    ("PaymentType", "VARCHAR(16)"), ("trip_type", "VARCHAR(8)"),
    ("TripStartDT", "DATE"), ("TripEndDT", "DATE"),
    ("TripStartDay", "INTEGER"), ("TripStartMonth", "INTEGER"), ("TripStartYear", "INTEGER"),
    ("hourd", "INTEGER"), ("minuted", "INTEGER"), ("secondd", "INTEGER"), ("dayofweek", "INTEGER"),
    ("week_day_full", "VARCHAR(16)"), ("cell_pickup", "VARCHAR(16)"), ("cell_dropoff", "VARCHAR(16)"),
    ("route", "VARCHAR(40)"),
]
