"""Starting and bounding streaming queries, and the folders that hold their
results. Nothing is collected on the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: State in RocksDB; a batch commits its changes, not a copy of its files.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
BatchFn = Callable[[DataFrame, int], None]


def run_stream(df: DataFrame, checkpoint: str, output_mode: str = "append",
               foreach_batch: BatchFn | None = None, fmt: str | None = None,
               path: str | None = None, partition_by: list[str] | None = None,
               options: dict | None = None, trigger: dict | None = None,
               query_name: str | None = None, settings: dict[str, str] | None = None) -> StreamingQuery:
    """Start a streaming query with a checkpoint (restartable).

    ``settings``: session settings for this query (KEYED_STATE for keyed logs);
    a query takes them as it starts, then the session gets its own back.

    ``trigger`` defaults to ``availableNow`` (process what is there, then
    stop: an incremental run any scheduler can start); pass
    ``{"processingTime": "10 seconds"}`` for a continuous job.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt or "parquet")
        if path:
            w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"availableNow": True}))
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in settings or {}}
    try:
        for k, v in (settings or {}).items():
            conf.set(k, v)
        return w.start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def await_bounded(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for the query to finish, at most ``timeout_s`` seconds, then stop
    it; re-raise its failure if it failed."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")


# --- result folders ------------------------------------------------------------
#
# A micro-batch writes one sub-folder named by its batch id (a replay writes
# it again, so every batch counts once) and readers take only folders whose
# write has ended. ``snapshot_sink``: each ``version=<id>`` holds the whole
# result. ``batch_sink``: each ``run0=<id>`` holds what the batch changed; FAN
# runs of a level are merged into one of the next, ``run<level>=<last id>``, up
# to LEVELS. So a row is written LEVELS + 1 times at most, no merge takes in more
# than FAN ** LEVELS batches, and what a merge has taken in is deleted when the
# next one of its level is done: a reader's folders outlive it.

FAN, LEVELS = 10, 3
Merge = Callable[[DataFrame], DataFrame]


def _folders(spark: SparkSession, path: str, kind: str) -> dict[int, str]:
    """Ended sub-folders ``<kind>=<id>`` of ``path``, by id; none if it is not there."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name, _, number = status.getPath().getName().partition("=")
        if name == kind and fs.exists(_child(spark, status.getPath(), "_SUCCESS")):
            found[int(number)] = f"{path}/{name}={number}"
    return found


def _file_system(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _child(spark: SparkSession, folder, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name)


def _delete(spark: SparkSession, folders) -> None:
    for f in folders:
        fs, root = _file_system(spark, f)
        fs.delete(root, True)


def snapshot_sink(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchFn:
    """foreachBatch function for complete mode: the (transformed) result of
    the batch is the newest version; the one before stays for its readers."""
    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        (transform(batch) if transform else batch).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        versions = _folders(spark, path, "version")
        _delete(spark, [versions[v] for v in sorted(versions)[:-2]])
    return put


def read_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest whole version; empty if no batch has run yet."""
    versions = _folders(spark, path, "version")
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(versions[max(versions)])


def batch_sink(path: str, schema, key: list[str] | None = None, fan: int = FAN, levels: int = LEVELS,
               transform: Callable[[DataFrame], DataFrame] | None = None, merge: Merge | None = None) -> BatchFn:
    """foreachBatch function for append mode, and with ``key`` for update mode
    (readers take a key's row of its latest batch). ``transform``: what is kept
    of a batch (rows of ``schema``); ``merge``: combines kept rows (sums of
    partial aggregates), when runs are merged and when they are read."""
    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        (transform(batch) if transform else batch).write.mode("overwrite").parquet(f"{path}/run0={batch_id}")
        for level in range(1, levels + 1):
            span = fan ** level
            if (batch_id + 1) % span:
                break
            below = _folders(spark, path, f"run{level - 1}")
            taken = {i: f for i, f in below.items() if batch_id - span < i <= batch_id}
            if taken:
                _merged(spark, taken, schema, key, merge).write.mode("overwrite").parquet(f"{path}/run{level}={batch_id}")
            _delete(spark, [f for i, f in below.items() if i <= batch_id - span])
    return put


def _runs(spark: SparkSession, path: str) -> dict[int, str]:
    """The runs that hold all batches, each once, by last batch id: those of
    the highest level, then of each lower one what came after."""
    names = {f"run{level}" for level in range(LEVELS + 1)}
    runs, upto = {}, -1
    for name in sorted(names, reverse=True):
        found = {i: f for i, f in _folders(spark, path, name).items() if i > upto}
        upto = max(found, default=upto)
        runs |= found
    return runs


def _merged(spark: SparkSession, runs: dict[int, str], schema, key: list[str] | None, merge: Merge | None) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(*runs.values())
    if merge is not None:
        return merge(df)
    if key is None:
        return df
    at = F.regexp_extract("_metadata.file_path", r"/run\d+=(\d+)/", 1).cast("long")
    rest = [c for c in df.columns if c not in key]
    latest = df.withColumn("_at", at).groupBy(*key).agg(F.max_by(F.struct(*rest), "_at").alias("_v"))
    return latest.select(*[F.col(c) if c in key else F.col("_v")[c].alias(c) for c in df.columns])


def read_batches(spark: SparkSession, path: str, schema, key: list[str] | None = None, merge: Merge | None = None) -> DataFrame:
    """What ``batch_sink`` holds: all rows (``merge``d), or per ``key`` the row
    of the latest batch that changed it; empty if no batch has run yet."""
    return _merged(spark, _runs(spark, path), schema, key, merge)
