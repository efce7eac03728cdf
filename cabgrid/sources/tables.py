"""Catalog and table helpers: listing, describing, previewing, filtering.

They return DataFrames (Spark runs them); nothing is fetched to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_databases(spark: SparkSession) -> DataFrame:
    """The catalog's databases (``SHOW DATABASES``)."""
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of a database (``SHOW TABLES``)."""
    return spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """Column names and types of a table (``DESCRIBE TABLE``)."""
    return spark.sql(f"DESCRIBE TABLE {table}")


def read_table(spark: SparkSession, name: str | None = None, path: str | None = None,
               fmt: str = "parquet", jdbc: dict | None = None) -> DataFrame:
    """A table from the catalog (``name``), from files (``path``) or through
    JDBC (``jdbc`` = reader options: url, dbtable, user, ...); the schema comes
    from the source, as reflection did in the original exercise."""
    if jdbc is not None:
        reader = spark.read.format("jdbc")
        for k, v in jdbc.items():
            reader = reader.option(k, v)
        return reader.load()
    if path is not None:
        return spark.read.format(fmt).load(path)
    return spark.table(name)


def preview(table: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (a top-n, not a full sort)."""
    return table.orderBy(*order_by).limit(n)


def filter_eq(table: DataFrame, column: str, value) -> DataFrame:
    """Rows where ``column == value`` (reaches a Parquet scan as a pushed filter)."""
    return table.filter(F.col(column) == F.lit(value))
