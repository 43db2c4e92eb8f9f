"""Batch writers: partitioned lake tables, one-file reports, catalogue tables, materialized layers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.sources.versions import current_version, publish_version


def write_single_csv(df: DataFrame, path: str) -> None:
    """One headered CSV part. The shuffle to one partition comes after the aggregate, so only the finished,
    report-sized result passes through one task; the work before it stays parallel."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv_by(df: DataFrame, key: str, path: str) -> None:
    """Headered CSV parts in order of the key, by as many tasks as the rows need."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("header", True).csv(path)


def write_lake(df: DataFrame, base: str, by: list[str], whole: bool = False, keep: int = 2) -> DataFrame:
    """A new version of a table, partitioned by date (and region), made current at once; returns it as written.

    Partitions that df holds are replaced, others are kept; with whole (or no partitions) the table is df alone. The
    rebalance hint gathers each partition value in few files, and lets Spark split a value that holds much of the data over
    several tasks.
    """
    held = None if whole or not by else read_lake(df.sparkSession, base, df.schema)
    if held is not None:
        on = [F.col(f"h.{c}").eqNullSafe(F.col(f"n.{c}")) for c in by]
        df = df.unionByName(held.alias("h").join(df.select(*by).distinct().alias("n"), on, "left_anti"))
    publish_version({"rows": df.hint("rebalance", *by) if by else df}, base, {"rows": by}, keep)
    return read_lake(df.sparkSession, base, df.schema)


def read_lake(spark: SparkSession, base: str, schema=None) -> DataFrame | None:
    """The current version of a table that write_lake has written, or None."""
    folder = current_version(spark, base)
    if folder is None:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/rows")


def register_tables(spark: SparkSession, database: str, tables: dict[str, DataFrame], location: str) -> list[str]:
    """Create the database and one Parquet table per dataset below location; returns the table names.

    Every load writes a folder of its own and then points the table to it, so a query sees the old rows or the new ones,
    and a load that fails leaves the table as it was.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, df in tables.items():
        table, folder = f"{database}.{name}", f"{location}/{name}/v-{uuid.uuid4().hex}"
        df.write.parquet(folder)
        if spark.catalog.tableExists(table) and spark.table(table).schema.simpleString() == df.schema.simpleString():
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.catalog.createTable(table, folder, "parquet", df.schema)
    return [f"{database}.{name}" for name in tables]


def materialize(views: dict[str, DataFrame], tables: dict[str, DataFrame], location: str) -> dict[str, DataFrame]:
    """Views for staging and intermediate layers, Parquet for marts; returns every relation by name.

    Dictionaries are in dependency order, which Python functions already give: a model is the DataFrame of
    the models it was built from.
    """
    out = {}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
        out[name] = df
    for name, df in tables.items():
        path = f"{location}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = df.sparkSession.read.parquet(path)
    return out
