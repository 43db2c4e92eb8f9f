"""Streaming sinks: files with a checkpoint, and a table of the latest row per key."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freightlens.sources.versions import current_version, publish_version


def start(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False, every: str = "10 seconds"
) -> StreamingQuery:
    """Append to files. once: process what is there and stop (a scheduled run); otherwise a micro-batch every interval."""
    w = stream.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()


STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

#: For bounded runs of an inner join. A task keeps both sides in one store instead of four, writes without looking rows up to
#: count them, and commits changes instead of whole stores. A batch without data would only drop old state, since an inner
#: join gives no rows for it; the next batch with data drops the same state.
INNER_JOIN = {
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def disk_state(spark: SparkSession, more: dict[str, str] | None = None):
    """Queries started in this block keep their state in RocksDB, which processors with timers need. more: further settings."""
    wanted = STATE | (more or {})
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_once(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", settings: dict[str, str] | None = None) -> None:
    with disk_state(stream.sparkSession, settings):
        start(stream, path, checkpoint, fmt, once=True).awaitTermination()


def write_split(events: DataFrame, split, valid_path: str, reject_path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Valid rows and rejected messages to two tables. Each micro-batch overwrites its own batch_id partition,
    so a batch replayed after a failure leaves no duplicates."""

    def each(batch: DataFrame, batch_id: int) -> None:
        for part, path in zip(split(batch), (valid_path, reject_path)):
            tagged = part.withColumn("batch_id", F.lit(batch_id))
            tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    w = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")).start()


def write_latest(updates: DataFrame, base: str, checkpoint: str, key: str, order: list[str], every: int = 8, once: bool = True) -> StreamingQuery:
    """Keep the latest row per key (by `order`, ties by the later columns) without state in the stream.

    Each micro-batch is reduced to its latest row per key and written to its own change folder. After `every` batches the
    changes are folded into the snapshot, which becomes current as a whole. The latest of rows is the same in any order and
    with repeats, so a batch that is replayed changes nothing.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest(batch, key, order).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(f"{base}/changes")
        if (batch_id + 1) % every == 0:
            compact(spark, base, key, order, batch.schema)

    w = updates.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")).start()


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per key the row that is greatest in `order`, then in its other columns."""
    rest = [c for c in df.columns if c != key and c not in order]
    return df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_l")).select(*[key if c == key else F.col(f"_l.{c}").alias(c) for c in df.columns])


def _snapshot(spark: SparkSession, base: str, schema) -> tuple[DataFrame | None, int]:
    """The current snapshot and the last batch that it holds."""
    folder = current_version(spark, f"{base}/snapshot")
    if folder is None:
        return None, -1
    return spark.read.schema(schema).parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/upto").first()["batch_id"]


def compact(spark: SparkSession, base: str, key: str, order: list[str], schema) -> None:
    """Fold the changes since the last snapshot into a new one."""
    held, upto = _snapshot(spark, base, schema)
    changes = spark.read.parquet(f"{base}/changes").where(F.col("batch_id") > upto)
    last = changes.agg(F.max("batch_id")).first()[0]
    if last is None:
        return
    rows = changes.select(*schema.names)
    rows = latest(rows if held is None else rows.union(held.select(*schema.names)), key, order)
    publish_version({"rows": rows, "upto": spark.createDataFrame([(last,)], "batch_id long").coalesce(1)}, f"{base}/snapshot", keep=2)


def read_latest(spark: SparkSession, base: str, key: str, order: list[str], schema) -> DataFrame:
    """One row per key: the snapshot, and the few batches after it."""
    held, upto = _snapshot(spark, base, schema)
    changes = spark.read.schema(f"{schema.toDDL()}, batch_id int").parquet(f"{base}/changes").where(F.col("batch_id") > upto).select(*schema.names)
    return latest(changes if held is None else changes.union(held.select(*schema.names)), key, order)
