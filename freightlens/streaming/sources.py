"""Event topics: Kafka for production, a folder of event files for replay and tests.

Both give the same columns (key, value, timestamp), so everything after the reader is shared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_COLUMNS = "key string, value string, timestamp timestamp"


def kafka_topic(spark: SparkSession, brokers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Stream of one Kafka topic (needs the Spark Kafka connector on the class path).

    A first run reads the topic from its start, and lost offsets stop the stream instead of passing unnoticed.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "true")
        .load()
    )
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def folder_topic(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of event files that publish() wrote."""
    r = spark.readStream.schema(EVENT_COLUMNS)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(path)


def as_events(df: DataFrame, key: str, ingest_time: Column | None = None) -> DataFrame:
    """Rows as messages: key = entity id, value = JSON of the row, NULL fields written as null."""
    body = F.to_json(
        F.struct(*df.columns),
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
    when = F.current_timestamp() if ingest_time is None else ingest_time.cast("timestamp")
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"), when.alias("timestamp"))


def publish(events: DataFrame, path: str) -> str:
    """Append messages to a folder topic."""
    events.write.mode("append").parquet(path)
    return path


def publish_in_order(
    events: DataFrame, path: str, closing: DataFrame | None, slices: int = 4, files: int = 4, messages: int = 500_000
) -> int:
    """Append messages to a folder topic in order of ingest time, and a closing message after all others.

    The messages are written once, dealt into time ranges of equal length, and each range is appended to the topic after the
    range before it, all as the same number of files: `files`, or more where a range has over `messages` messages a file,
    so that no task writes or reads more with larger topics. Returns that number. A reader that takes so many files per batch
    sees one range at a time, so no message comes later than messages of a later range; a range with fewer messages than
    files is published together with the next one. The closing message lies past every window that is still open:
    it moves the watermark over them, while its own window never closes and gives no row. Where nothing waits for a
    watermark there is none.
    """
    spark = events.sparkSession
    ends = events.agg(F.struct(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).alias("e")).scalar()
    first = F.unix_micros("_e.a")
    part = F.floor((F.unix_micros("timestamp") - first) * F.lit(slices) / (F.unix_micros("_e.b") - first + 1)).cast("int")
    events.withColumn("_e", ends).withColumn("part", part).drop("_e").write.partitionBy("part").parquet(f"{path}-dealt")
    dealt = spark.read.schema(f"{EVENT_COLUMNS}, part int").parquet(f"{path}-dealt")
    sizes = {r["part"]: r["n"] for r in dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()}
    files = max(files, -(-max(sizes.values(), default=0) // messages))
    parts, n = [], 0
    for k, size in sizes.items():
        parts, n = [*parts, k], n + size
        if n < files and k != max(sizes):
            continue
        here = dealt.where(F.col("part").isin(parts)).drop("part")
        # One task deals a small range, so that none of its files is empty.
        publish((here.coalesce(1) if n <= messages else here).repartition(files), path)
        parts, n = [], 0
    if not sizes:
        publish(dealt.drop("part"), path)
    if closing is not None:
        publish(closing, path)
    return files


def publish_kafka(events: DataFrame, brokers: str, topic: str) -> None:
    """Send messages from all executors at once; one batch write replaces a send per row."""
    events.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()
