"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "cabgrid") -> SparkSession:
    """A local session configured the way the tests and the bench run.

    On a cluster, build the session with the cluster's own settings and pass it
    to the operators instead; nothing in the library depends on this helper.
    """
    parts = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A scratch folder of this machine stands in only on a ``local`` master
    (tests); on a cluster a missing setting is an error, as executors could
    not read each other's folders.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set: on {master} it must name a folder all executors share")
        current = tempfile.mkdtemp(prefix="cabgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (Python workers import the functions
    they run from it). Not needed where it is installed on every node."""
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="cabgrid-pkg-"), "cabgrid"), "zip",
                                  os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(archive)


def shared_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (for stream checkpoints and
    materialised intermediates); never a machine-local path on a cluster."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
