"""Sinks and catalog helpers: partitioned Parquet stream sink, a partitioned
table over batch-written files (partitions found by repair), Kafka payload,
catalog listing."""

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabgrid.functions.constants import CLEAN_COLUMNS, CLEAN_PARTITIONS
from cabgrid.operators.clean import trip_clean
from cabgrid.operators import routes
from cabgrid.operators.grid import routed_trips
from cabgrid.plans.catalog import FEED_SCHEMA, json_records, valid
from cabgrid.streaming import jobs
from cabgrid.streaming.admission import Admission, admitted
from cabgrid.session import shared_path
from cabgrid.sources.decode import trip_decode_json
from cabgrid.sources.tables import describe_table, list_databases, list_tables
from cabgrid.sources.trips import load_trips, to_trip_json, to_trip_lines
from cabgrid.streaming.runner import await_bounded, run_stream
from cabgrid.streaming.sinks import (kafka_payload, register_clean_table, topic_fanout,
                                     write_clean_files, write_clean_table)
from cabgrid.streaming.sources import read_json_stream, read_trip_stream, stage_time_slices
from conftest import SF_ORACLE, SF_SMALL

TYPES = {"double": T.DoubleType(), "string": T.StringType(), "int": T.IntegerType()}
CLEAN_SCHEMA = T.StructType([T.StructField(n, TYPES[t]) for n, t in CLEAN_COLUMNS + CLEAN_PARTITIONS])
COLS = [n for n, _ in CLEAN_COLUMNS + CLEAN_PARTITIONS]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_partitioned_parquet_stream_sink(spark):
    trips = load_trips(spark, SF_SMALL)
    glob = stage_time_slices(to_trip_json(trips, keep_id=True, keep=("dropoff_datetime",)),
                             "dropoff_datetime", 3)
    recs = read_json_stream(spark, "parquet", glob, {"maxFilesPerTrigger": "1"}, FEED_SCHEMA)
    path = shared_path(spark, f"clean-files-{uuid.uuid4().hex}")
    q = write_clean_files(trip_clean(trip_decode_json(recs)), path,
                          shared_path(spark, f"ckpt-{uuid.uuid4().hex}"))
    await_bounded(q, 300)
    assert any(d.startswith("vendorid=") for d in os.listdir(path))
    got = spark.read.schema(CLEAN_SCHEMA).parquet(path)
    exp = trip_clean(json_records(spark, SF_SMALL))
    assert got.count() > 100
    assert rows(got) == rows(exp)


def test_table_over_batch_files_found_by_repair(spark):
    exp = trip_clean(json_records(spark, SF_SMALL))
    path = shared_path(spark, f"clean-batch-{uuid.uuid4().hex}")
    exp.write.partitionBy(*[n for n, _ in CLEAN_PARTITIONS]).parquet(path)
    name = f"clean_{uuid.uuid4().hex[:10]}"
    table = register_clean_table(spark, name, location=path, database="taxi_test")
    got = spark.table(table)
    assert dict(got.dtypes)["vendorid"] == "string"
    assert rows(got) == rows(exp)
    assert "taxi_test" in [r[0] for r in list_databases(spark).collect()]
    assert name in [r.tableName for r in list_tables(spark, "taxi_test").collect()]
    described = [r.col_name for r in describe_table(spark, table).collect()]
    assert "passenger_count" in described and "TripStartMonth" in described


def test_kafka_payload_three_topics(spark):
    recs = to_trip_json(load_trips(spark, SF_SMALL), keep_id=True)
    fan = topic_fanout(recs, ["topic2", "topic3", "topic4"])
    pay = kafka_payload(fan)
    assert dict(pay.dtypes) == {"topic": "string", "value": "binary"}
    n = recs.count()
    assert pay.count() == 3 * n
    back = pay.select("topic", F.decode("value", "UTF-8").alias("v")).groupBy("topic").agg(
        F.count_distinct("v").alias("k")).collect()
    assert {r.topic: r.k for r in back} == {"topic2": n, "topic3": n, "topic4": n}


def test_memory_and_foreach_batch_sinks(spark):
    trips = load_trips(spark, SF_SMALL)
    glob = stage_time_slices(to_trip_lines(trips, keep_id=True, keep=("dropoff_datetime",)),
                             "dropoff_datetime", 2)
    lines = read_trip_stream(spark, "parquet", glob, {"maxFilesPerTrigger": "1"}, FEED_SCHEMA,
                             keep=("trip_id",))
    counts = routes.route_counts(routed_trips(admitted(lines, Admission())), watermark="30 minutes")
    name = f"route_counts_{uuid.uuid4().hex[:8]}"
    q = run_stream(counts, shared_path(spark, f"ckpt-{uuid.uuid4().hex}"), "complete", fmt="memory",
                   query_name=name)
    await_bounded(q, 300)
    assert spark.table(name).count() == routes.route_counts(routed_trips(valid(spark, SF_SMALL))).count()
    seen = []
    q2 = run_stream(counts, shared_path(spark, f"ckpt-{uuid.uuid4().hex}"), "complete",
                    foreach_batch=lambda b, i: seen.append((i, b.count())))
    await_bounded(q2, 300)
    assert len(seen) >= 2 and seen[-1][1] == spark.table(name).count()


def test_read_latest_takes_the_last_batch_per_key(spark):
    from cabgrid.streaming.runner import batch_sink, read_batches
    path = shared_path(spark, f"latest-{uuid.uuid4().hex}")
    schema = T.StructType.fromDDL("k string, v double")
    assert read_batches(spark, path, schema, ["k"]).count() == 0
    put = batch_sink(path, schema, ["k"], fan=2)
    put(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double"), 0)
    put(spark.createDataFrame([("a", 5.0)], "k string, v double"), 1)
    put(spark.createDataFrame([("a", 3.0), ("c", 7.0)], "k string, v double"), 2)
    put(spark.createDataFrame([("a", 3.0), ("c", 7.0)], "k string, v double"), 2)  # a replay
    got = {r.k: r.v for r in read_batches(spark, path, schema, ["k"]).collect()}
    assert got == {"a": 3.0, "b": 2.0, "c": 7.0}
    for i in range(3, 12):
        put(spark.createDataFrame([("d", float(i))], "k string, v double"), i)
    assert {r.k: r.v for r in read_batches(spark, path, schema, ["k"]).collect()} == {"a": 3.0, "b": 2.0, "c": 7.0, "d": 11.0}
    assert len(os.listdir(path)) <= 8  # merged and cleared, not one folder per batch


def test_snapshots_keep_two_versions(spark):
    from cabgrid.streaming.runner import read_snapshot, snapshot_sink
    path = shared_path(spark, f"snap-{uuid.uuid4().hex}")
    assert read_snapshot(spark, path, "k string").count() == 0
    for i in range(5):
        snapshot_sink(path)(spark.createDataFrame([(str(i),)], "k string"), i)
    assert [r.k for r in read_snapshot(spark, path, "k string").collect()] == ["4"] and len(os.listdir(path)) == 2


def test_replayed_batch_adds_no_rows_to_the_table(spark):
    from cabgrid.streaming.sinks import write_clean_table
    path = shared_path(spark, f"lines-{uuid.uuid4().hex}")
    to_trip_json(load_trips(spark, SF_SMALL)).write.text(path)
    recs = read_trip_stream(spark, "text", path)
    table = register_clean_table(spark, f"replay_{uuid.uuid4().hex[:8]}", shared_path(spark, f"t-{uuid.uuid4().hex}"), repair=False, by_batch=True)
    for _ in range(2):  # a fresh checkpoint: batch 0 comes again
        await_bounded(write_clean_table(trip_clean(trip_decode_json(recs)), table, shared_path(spark, f"c-{uuid.uuid4().hex}")), 300)
    exp = trip_clean(json_records(spark, SF_SMALL))
    assert exp.count() > 100 and rows(spark.table(table)) == rows(exp)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_table_is_replaced_or_refused(spark):
    import pytest
    name, a, b = f"moved_{uuid.uuid4().hex[:8]}", *(shared_path(spark, f"t-{uuid.uuid4().hex}") for _ in range(2))
    register_clean_table(spark, name, a, repair=False)
    register_clean_table(spark, name, a, repair=False)
    with pytest.raises(ValueError):
        register_clean_table(spark, name, b, repair=False)
    with pytest.raises(ValueError):
        register_clean_table(spark, name, a, repair=False, by_batch=True)
    register_clean_table(spark, name, b, repair=False, replace=True)


def test_sink_table_has_33_typed_columns():
    from cabgrid.operators.clean import ENRICHED_COLUMNS
    from cabgrid.streaming.sinks import enriched_column_types
    typed = enriched_column_types().split(", ")
    assert len(typed) == 33 and [t.split(" ")[0] for t in typed] == ENRICHED_COLUMNS
    assert "pickup_datetime TIMESTAMP" in typed and "TripStartDT DATE" in typed and "trip_distance DOUBLE PRECISION" in typed


def test_levelled_runs_hold_every_batch_once_and_bound_what_is_written(spark, monkeypatch):
    """40 batches, merged by threes over two levels: sums are right after every
    batch, and no batch writes more than the last nine had."""
    from cabgrid.streaming import runner
    monkeypatch.setattr(runner, "LEVELS", 2)
    path, schema = shared_path(spark, f"levels-{uuid.uuid4().hex}"), "k string, v long"
    sums = lambda df: df.groupBy("k").agg(F.sum("v").alias("v"))
    put = runner.batch_sink(path, schema, fan=3, levels=2, merge=sums)
    for i in range(40):
        put(spark.createDataFrame([("a", 1), (f"k{i}", i)], schema), i)
        if i % 6 == 5 or i > 36:
            put(spark.createDataFrame([("a", 1), (f"k{i}", i)], schema), i)  # replayed
            got = {r.k: r.v for r in runner.read_batches(spark, path, schema, merge=sums).collect()}
            assert got == {"a": i + 1, **{f"k{j}": j for j in range(i + 1)}}
    sizes = [spark.read.parquet(f).count() for f in runner._folders(spark, path, "run2").values()]
    assert sizes == [10] * 4 and len(runner._folders(spark, path, "run0")) <= 7 and len(runner._folders(spark, path, "run1")) <= 7


def test_one_vendor_is_written_by_many_tasks(spark):
    """All rows of one vendor and month: files of about the advisory size."""
    path, name = shared_path(spark, f"vendor-{uuid.uuid4().hex}"), f"vendor_{uuid.uuid4().hex[:8]}"
    recs = to_trip_json(load_trips(spark, SF_ORACLE), keep_id=True)
    recs.repartition(8).select(F.regexp_replace("value", '"vendorid":"."', '"vendorid":"1"').alias("value")).write.parquet(f"{path}/in")
    lines = read_trip_stream(spark, "parquet", f"{path}/in")
    table = register_clean_table(spark, name, location=f"{path}/table", repair=False, by_batch=True)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
        write_clean_table(trip_clean(trip_decode_json(lines)), table, f"{path}/ckpt").awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = spark.table(table).select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(files) >= 5 and max(r["count"] for r in files) < 0.5 * sum(r["count"] for r in files)
    spark.sql(f"DROP TABLE {table}")


def test_a_busy_hour_is_archived_by_many_tasks(spark):
    from cabgrid.streaming.sinks import write_archive
    path = shared_path(spark, f"hour-{uuid.uuid4().hex}")
    rows = load_trips(spark, SF_SMALL).selectExpr("cast(trip_id as string) AS value", "'2024' AS TripStartYear")
    rows.write.parquet(f"{path}/in")
    lines = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # small parts would be joined again
    try:
        spark.conf.set(key, "false")
        write_archive(lines, f"{path}/out", f"{path}/ckpt", ["TripStartYear"], spread=32).awaitTermination()
    finally:
        spark.conf.unset(key)
    back = spark.read.json(f"{path}/out")
    per_file = [r["count"] for r in back.select(F.input_file_name().alias("f")).groupBy("f").count().collect()]
    assert back.count() == rows.count() and len(per_file) >= 3 and max(per_file) < 0.6 * sum(per_file)


def test_only_new_partitions_are_registered(spark):
    """Batch after batch: what each call adds is what came in, also past the
    commit log's compaction; odd and missing partition values are found."""
    from cabgrid.functions.constants import CLEAN_COLUMNS, CLEAN_PARTITIONS
    from cabgrid.streaming.sinks import register_new_partitions, write_clean_files
    path = shared_path(spark, f"new-{uuid.uuid4().hex}")
    columns = CLEAN_COLUMNS + CLEAN_PARTITIONS
    schema = ", ".join(f"`{n}` {t}" for n, t in columns)
    table = register_clean_table(spark, f"new_{uuid.uuid4().hex[:8]}", f"{path}/table", repair=False)
    assert register_new_partitions(spark, table, f"{path}/table") == 0

    def arrive(*parts):
        rows = [tuple([None] * len(CLEAN_COLUMNS) + list(p)) for p in parts]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        lines = spark.readStream.schema(schema).parquet(f"{path}/in")
        write_clean_files(lines, f"{path}/table", f"{path}/ckpt", spread=1).awaitTermination()

    arrive(("1", 1), ("2", 1))
    assert register_new_partitions(spark, table, f"{path}/table") == 2
    assert register_new_partitions(spark, table, f"{path}/table") == 0
    arrive(("1", 1), ("it's a/b+c %41=\u00e9", 2), (None, 3))
    assert register_new_partitions(spark, table, f"{path}/table") == 2
    for month in range(2, 13):
        arrive(("1", month))
    assert any(f.endswith(".compact") for f in os.listdir(f"{path}/table/_spark_metadata"))
    assert register_new_partitions(spark, table, f"{path}/table") == 11
    got = sorted((r.vendorid or "", r.TripStartMonth) for r in spark.table(table).collect())
    assert got == sorted([("1", 1), ("2", 1), ("1", 1), ("it's a/b+c %41=\u00e9", 2), ("", 3)] + [("1", m) for m in range(2, 13)])
    spark.sql(f"DROP TABLE {table}")


def test_staged_form_is_derived_of_the_sorted_rows(spark):
    """What ``form`` derives is neither sampled for the ranges nor shuffled:
    each row is derived once, and files hold contiguous ranges of the time."""
    calls = spark.sparkContext.accumulator(0)

    def seen(i):
        calls.add(1)
        return i

    udf = F.udf(seen, "long")
    rows = spark.range(1000).select(F.col("id").alias("trip_id"), F.pmod(F.hash("id"), F.lit(500)).alias("at"))
    glob = stage_time_slices(rows, "at", 4, form=lambda r: r.select("trip_id", "at", udf("trip_id").alias("value")))
    got = spark.read.parquet(glob)
    assert calls.value == 1000
    assert got.filter("value = trip_id").count() == 1000
    ends = sorted((r.a, r.b) for r in got.groupBy(F.input_file_name()).agg(F.min("at").alias("a"), F.max("at").alias("b")).collect())
    assert len(ends) == 4 and all(x[1] < y[0] for x, y in zip(ends, ends[1:]))
