"""The ten raw datasets in one folder, as Parquet or headered CSV."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.sources.readers import path_exists, read_any
from freightlens.sources.schemas import RAW

log = logging.getLogger(__name__)


class FolderTables:
    """One method per raw table: name, name.parquet or name.csv below the folder, checked against its contract.
    A dataset that is absent is an empty table, so that jobs on the others still run."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        schema = RAW[name]
        for path in (f"{self.folder}/{name}", f"{self.folder}/{name}.parquet", f"{self.folder}/{name}.csv"):
            if path_exists(self.spark, path):
                df = read_any(self.spark, path, schema, name)
                return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
        log.warning("dataset %s is absent in %s", name, self.folder)
        return self.spark.createDataFrame([], schema)

    def __getattr__(self, name: str):
        if name in RAW:
            return lambda: self.table(name)
        raise AttributeError(name)

    def delivery_windows(self) -> DataFrame:
        """First and last event of each order."""
        return self.table("delivery_updates").groupBy("order_id").agg(
            F.min("event_timestamp").alias("start_time"), F.max("event_timestamp").alias("end_time")
        )
