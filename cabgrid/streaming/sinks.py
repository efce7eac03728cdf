"""Sinks: topic fan-out, partitioned JSON archive, cleaned Parquet table,
JDBC table. Every writer works on a streaming DataFrame (``writeStream``)
and, where noted, on a static one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.constants import ARCHIVE_PARTITIONS, CLEAN_COLUMNS, CLEAN_PARTITIONS, ENRICHED_TYPES


def topic_fanout(records: DataFrame, topics: list[str], value_col: str = "value") -> DataFrame:
    """One output row per (record, topic): columns ``topic`` and ``value``
    (UTF-8 JSON text), ready for a Kafka sink that routes on ``topic``."""
    return records.withColumn("topic", F.explode(F.array(*[F.lit(t) for t in topics]))).withColumn(
        value_col, F.col(value_col).cast("string"))


def kafka_payload(fanned: DataFrame) -> DataFrame:
    """Binary key/value/topic columns as the Kafka sink expects."""
    return fanned.select(F.col("topic"), F.encode(F.col("value"), "UTF-8").alias("value"))


def _spread(df: DataFrame, partitions: list[str], spread: int) -> DataFrame:
    """Rows dealt by partition and one of ``spread`` parts of it (by a hash of
    the row): up to so many tasks write a partition, so a busy hour or vendor
    is not one task's. A plain streaming sink cannot size them by the data."""
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    return df.repartition(*partitions, part)


def write_archive(df: DataFrame, path: str, checkpoint: str, partitions: list[str] | None = None,
                  trigger: dict | None = None, spread: int = 4) -> StreamingQuery:
    """Append the dated trips as JSON files partitioned by calendar parts
    (year/month/day/hour by default; the full list is an argument), a
    micro-batch by up to ``spread`` files and tasks a partition."""
    by = partitions or ARCHIVE_PARTITIONS
    w = (_spread(df, by, spread).writeStream.format("json").outputMode("append").partitionBy(*by)
         .option("path", path).option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def write_clean_files(df: DataFrame, path: str, checkpoint: str,
                      trigger: dict | None = None, spread: int = 32) -> StreamingQuery:
    """Append cleaned trips as Parquet partitioned by vendor and month, a
    micro-batch by up to ``spread`` files and tasks a partition."""
    by = [n for n, _ in CLEAN_PARTITIONS]
    w = (_spread(df, by, spread).writeStream.format("parquet").outputMode("append").partitionBy(*by)
         .option("path", path).option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


BATCH_PARTITION = ("batch_id", "bigint")


def register_clean_table(spark: SparkSession, table: str, location: str | None = None,
                         database: str | None = None, repair: bool = True, replace: bool = False,
                         by_batch: bool = False) -> str:
    """Create the partitioned Parquet table of cleaned trips, if it is missing
    or ``replace`` drops it first (of an external table the definition only).
    A table that is there with other columns or another location is an error.
    ``by_batch`` adds the partition ``batch_id`` that ``write_clean_table``
    needs to write a replayed batch once.

    With ``location`` the table is external over that folder; with
    ``repair`` the partitions of files already there are discovered with
    ``MSCK REPAIR TABLE`` (nothing is moved). Pass ``repair=False`` for a new,
    empty folder that ``write_clean_table`` will fill.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        table = f"`{database}`.`{table}`"
    partitions = CLEAN_PARTITIONS + [BATCH_PARTITION] * by_batch
    cols = ", ".join(f"`{n}` {t}" for n, t in CLEAN_COLUMNS + partitions)
    parts = ", ".join(f"`{n}`" for n, _ in partitions)
    loc = f" LOCATION '{location}'" if location else ""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
              f"PARTITIONED BY ({parts}){loc}")
    there = [(c.name, c.dataType) for c in spark.catalog.listColumns(table)]
    if there != CLEAN_COLUMNS + partitions:
        raise ValueError(f"{table} is there with other columns: {there}")
    at = next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Location")
    if location and at.split(":", 1)[-1].rstrip("/").lstrip("/") != location.split(":", 1)[-1].rstrip("/").lstrip("/"):
        raise ValueError(f"{table} is there at {at}, not {location}")
    if location and repair:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return table


REGISTERED = "registered_batch"


def register_new_partitions(spark: SparkSession, table: str, location: str) -> int:
    """Register the partitions that a file stream into ``location`` (such as
    ``write_clean_files``) has committed since the last call; how many were new.

    The sink's commit log names each batch's files. Only the log entries after
    the batch noted in the table's properties are read and only partitions that
    the catalog lacks are added, so a call costs what came in, not a walk over
    the whole tree. A call that dies halfway is repeated by the next one.
    Register the table (``repair=False``) before the stream's first batch: over a
    folder with a commit log Spark takes the partition columns for file columns.
    """
    done = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(REGISTERED)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location, "_spark_metadata")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    # <batch>, or <batch>.compact: all files up to that batch.
    ended = {n: int(n.split(".")[0]) for n in names if re.fullmatch(r"\d+(\.compact)?", n)}
    since = -1 if done is None else int(done)
    new = [n for n, batch in ended.items() if batch > since]
    whole = max((ended[n] for n in new if n.endswith(".compact")), default=-1)
    new = [n for n in new if ended[n] > whole or n == f"{whole}.compact"]
    if not new:
        return 0
    keys = [n for n, _ in CLEAN_PARTITIONS]
    pattern = "/" + "/".join(f"{k}=([^/]*)" for k in keys) + "/[^/]*$"
    path = F.get_json_object("value", "$.path")
    # Spark's file readers skip folders that begin with an underscore.
    lines = spark.sparkContext.textFile(",".join(fs.makeQualified(root).toString() + f"/{n}" for n in new))
    log = spark.createDataFrame(lines.map(lambda line: (line,)), "value string")
    folders = log.filter(path.rlike(pattern)).select(
        *[_unescaped(F.regexp_extract(path, pattern, i + 1)).alias(k) for i, k in enumerate(keys)]).distinct()
    name = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.col(k)) for k in keys]).alias("name")
    found = folders.select(name, *[_unescaped(F.col(k)).alias(k) for k in keys]).collect()
    there = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    added = [r for r in found if r["name"] not in there]
    for a in range(0, len(added), 100):
        spec = " ".join("PARTITION (" + ", ".join(f"`{k}` = {_literal(r[k])}" for k in keys) + ")" for r in added[a:a + 100])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{REGISTERED}' = '{max(ended.values())}')")
    spark.catalog.refreshTable(table)
    return len(added)


def _unescaped(c: Column) -> Column:
    """Percent escapes resolved once (the log's paths are URIs of folder names,
    which escape the partition value)."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def _literal(value: str) -> str:
    """A partition value as SQL; the folder of nulls stands for null."""
    if value == "__HIVE_DEFAULT_PARTITION__":
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_clean_table(df: DataFrame, table: str, checkpoint: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """Append cleaned trips into a catalog table registered ``by_batch``: each
    micro-batch overwrites its own ``batch_id`` partitions, so a replayed one
    leaves its rows once. The rows are rebalanced by the partition columns
    (adaptive execution): few files per partition, and a partition beyond the
    advisory size is written by many tasks."""
    order = [n for n, _ in CLEAN_COLUMNS + CLEAN_PARTITIONS]
    parts = [n for n, _ in CLEAN_PARTITIONS]

    def put(batch: DataFrame, batch_id: int) -> None:
        # The micro-batch's own session: the caller's settings stay as they are.
        conf = batch.sparkSession.conf
        conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        conf.set("spark.sql.adaptive.enabled", "true")
        (batch.select(*order).hint("rebalance", *[F.col(p) for p in parts]).withColumn(BATCH_PARTITION[0], F.lit(batch_id).cast("long"))
         .write.mode("overwrite").insertInto(table))

    w = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def enriched_column_types() -> str:
    """The 33 typed columns of the routed-trip sink table, in table order, as
    Spark's JDBC writer takes them."""
    return ", ".join(f"{n} {t}" for n, t in ENRICHED_TYPES)


def jdbc_batch_writer(url: str, table: str, properties: dict | None = None,
                      column_types: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function appending a micro-batch through the JDBC
    writer (one connection per task, batched inserts, typed columns:
    ``enriched_column_types()`` for routed trips).

    A replayed batch is written again; give the table a unique trip key (or
    deduplicate downstream) for exactly-once results.
    """
    props = dict(properties or {})

    def put(batch: DataFrame, _batch_id: int) -> None:
        w = batch.write.format("jdbc").option("url", url).option("dbtable", table)
        if column_types:
            w = w.option("createTableColumnTypes", column_types)
        for k, v in props.items():
            w = w.option(k, v)
        w.mode("append").save()

    return put


def write_jdbc(df: DataFrame, url: str, table: str, checkpoint: str, properties: dict | None = None,
               column_types: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    w = (df.writeStream.foreachBatch(jdbc_batch_writer(url, table, properties, column_types))
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()
