"""Small shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder (any path Spark's readers accept)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut there.

    Survives lost executors; used for narrow intermediates that several later
    steps read.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: for
    wider intermediates, which this keeps compressed."""
    import uuid

    from ..session import shared_path
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The intermediate tables of one operator call: Parquet in the shared
    folder, so they survive lost executors.

    ``with Scratch(spark, name) as scratch``: inside, Spark removes a step's
    shuffle files when the step has ended (nothing reads them again, as every
    step reads tables), ``drop`` removes tables whose last reader is done, and
    leaving removes all but ``result``. The session's setting comes back.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str):
        import uuid

        from ..session import shared_path
        self.spark, self.root = spark, shared_path(spark, f"{name}-{uuid.uuid4().hex}")
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        self.count = 0

    def __enter__(self) -> Scratch:
        self.before = self.spark.conf.get(self.CLEANUP, None)
        self.spark.conf.set(self.CLEANUP, "true")
        return self

    def __exit__(self, *_) -> None:
        if self.before is None:
            self.spark.conf.unset(self.CLEANUP)
        else:
            self.spark.conf.set(self.CLEANUP, self.before)
        self.drop(*[df for df, _ in self.paths.values()])

    def result(self, df: DataFrame) -> DataFrame:
        """``df`` written to a table that stays."""
        self.count += 1
        path = f"{self.root}-{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written to a table that goes with the scratch folder."""
        out = self.result(df)
        self.paths[id(out)] = out, f"{self.root}-{self.count}"
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove the tables of ``frames`` (those ``keep`` gave)."""
        context = self.spark.sparkContext
        for df in frames:
            path = context._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df))[1])
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def few_by_hash(df: DataFrame, seed: str, key: str, count: int, over: int = 4) -> DataFrame:
    """About ``over * count`` rows of ``df`` (all, if it has no more), by a
    hash of ``key``: what a bounded sample is then taken from, so that no task
    sends more than its share to the driver."""
    from pyspark.sql import functions as F
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 11) / float(1 << 53)
    return df.filter(h < over * count / max(1, df.count()))


def with_row(df: DataFrame, *columns) -> DataFrame:
    """The whole input row as one struct ``row`` beside ``columns``.

    Operators work beside the struct, so input columns of any name (their own
    result names included) can neither clash nor get lost.
    """
    from pyspark.sql import functions as F
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *columns)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_, name__, ... that ``df`` has not."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sql_crc32(text: str) -> str:
    """DuckDB SQL: the CRC-32 (polynomial 0xEDB88320) of an ASCII text."""
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda ch: unicode(ch)::BIGINT)),
      lambda c, b: xor(c >> 8, list_reduce(list_concat([xor(c, b) & 255], range(8)),
        lambda d, k: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END))), 4294967295)"""
