"""Batch readers: headered CSV under a column contract, and lookup of the best available dataset."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from freightlens.sources.schemas import require_columns

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists on its own file system (HDFS, object store or local)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, dataset: str = "dataset") -> DataFrame:
    """Headered CSV with fixed types. The header is checked against the contract before any row is read;
    columns are matched by name, and unreadable cells become NULL."""
    text = spark.read.option("header", True).csv(path)
    require_columns(text, schema.names, dataset)
    return text.select(*[text[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None, dataset: str = "dataset") -> DataFrame:
    """Parquet by default, CSV under its contract when the path says so."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema, dataset) if schema is not None else spark.read.option("header", True).csv(path)
    return spark.read.parquet(path)


def first_available(
    spark: SparkSession, candidates: list[str], schema: T.StructType | None = None, required: bool = False
) -> DataFrame | None:
    """The first candidate that exists (processed before raw). Without any: None with a warning, or an error."""
    for path in candidates:
        if path_exists(spark, path):
            return read_any(spark, path, schema)
    if required:
        raise FileNotFoundError("none of these datasets exists: " + ", ".join(candidates))
    log.warning("skipped, none of these datasets exists: %s", ", ".join(candidates))
    return None


def read_all(spark: SparkSession, folder: str, names: list[str], suffix: str = ".parquet") -> dict[str, DataFrame]:
    """Every dataset of the list that exists in the folder; absent ones are logged and left out."""
    found = {}
    for name in names:
        df = first_available(spark, [f"{folder.rstrip('/')}/{name}{suffix}"])
        if df is not None:
            found[name] = df
    if not found:
        raise FileNotFoundError(f"no dataset of {names} in {folder}")
    return found
