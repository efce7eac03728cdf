"""Stream sources of trip records and a helper that stages a static table as
time-ordered files for a file stream.

On a cluster the records come from Kafka (``format="kafka"``, broker and
topic in ``options``); the Kafka connector is a deployment dependency and is
not needed for the file-stream paths used in tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import TRIP_LINE_FIELDS
from ..session import shared_path

KAFKA_ROWS = 1_000_000
VALUE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])


def read_trip_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                     options: dict | None = None, schema: T.StructType | None = None,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Streaming DataFrame with the record text in ``value`` and a unique
    ``trip_id`` (the tiebreak of event-time order in the stateful jobs).

    ``fmt="kafka"``: ``options`` carries ``kafka.bootstrap.servers`` and
    ``subscribe``; key and value are cast to text and ``trip_id`` is
    ``(partition << 40) + offset`` (unique, and in arrival order within a
    partition). ``fmt="text"``: one record per line. Any other file format
    (``parquet``, ``json``) is read with ``schema`` (default: a single text
    column ``value``); ``keep`` names extra columns carried through. A file
    source without a ``trip_id`` column gets ``xxhash64(value)``.

    ``options`` also bounds a micro-batch: ``maxFilesPerTrigger`` for files,
    ``maxOffsetsPerTrigger`` for Kafka (KAFKA_ROWS unless given). The keyed
    jobs hold one key's rows of a micro-batch in one call.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"maxOffsetsPerTrigger": str(KAFKA_ROWS), **(options or {})}
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "kafka":
        df = reader.load()
        tid = F.shiftleft(F.col("partition").cast("long"), 40) + F.col("offset")
        return df.select(F.col("key").cast("string").alias("key"),
                         F.col("value").cast("string").alias("value"), tid.alias("trip_id"), *keep)
    if fmt == "text":
        df = reader.load(path)
    else:
        df = reader.schema(schema or VALUE_SCHEMA).load(path)
    cols = [F.col("value").cast("string").alias("value")] + [F.col(k) for k in keep]
    if "trip_id" not in keep:
        cols.append(F.xxhash64("value").alias("trip_id"))
    return df.select(*cols)


def read_json_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                     options: dict | None = None, schema: T.StructType | None = None,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Same source for JSON trip records (the record text in ``value``)."""
    return read_trip_stream(spark, fmt, path, options, schema, keep)


def closing_line(when: str = "2100-01-01 00:00:00") -> str:
    """A trip line dated past everything, which no filter keeps: as the last
    record of a bounded replay it moves the watermark over the rides that
    still wait in keyed state."""
    return ",".join({"pickup_datetime": when, "dropoff_datetime": when}.get(f, "0") for f in TRIP_LINE_FIELDS)


def stage_time_slices(df: DataFrame, time_col: str, files: int = 32, root: str | None = None,
                      fmt: str = "parquet", form: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write ``df`` as files that each hold one contiguous range of
    ``time_col``, dated in time order, into a fresh folder under the shared
    checkpoint folder.

    The file stream takes files oldest first, so with ``maxFilesPerTrigger =
    k`` every micro-batch reads the next k time ranges, k tasks in parallel,
    and data arrives in time order, like a live feed replayed. One write job
    (``repartitionByRange`` on the time: equal times share a file) into
    ``files`` files. Each file is then stamped with its position (a metadata
    call per file). ``form`` makes the rows to write of the sorted ones: what it
    derives is derived once, neither for the sample of the ranges nor shuffled.
    A replay tool for tests and registered checks:
    a production feed comes from Kafka. Returns the glob to read.
    """
    spark = df.sparkSession
    folder = root or shared_path(spark, f"stage-{uuid.uuid4().hex}")
    rows = df.repartitionByRange(files, F.col(time_col)).sortWithinPartitions(time_col)
    ((form(rows) if form else rows)
     .write.mode("errorifexists").format(fmt).save(folder))
    _stamp_in_order(spark, folder, fmt)
    return f"{folder}/part-*.{fmt}"


def _stamp_in_order(spark: SparkSession, folder: str, fmt: str) -> None:
    """Set each part file's modification time to base + its partition number
    (range partitions are numbered in key order)."""
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    statuses = fs.globStatus(Path(f"{folder}/part-*.{fmt}")) or []
    base = 1_000_000_000_000  # ms; any fixed past time works
    for st in statuses:
        p = st.getPath()
        part = int(p.getName().split("-")[1])
        fs.setTimes(p, base + 1000 * part, -1)
