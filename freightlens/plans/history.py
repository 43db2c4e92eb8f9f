"""Type-2 history kept in files: a load appends closed versions and rewrites only the buckets of ids that changed."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.plans.star import versions
from freightlens.registry import query
from freightlens.session import run_dir
from freightlens.sources.versions import current_version

#: Files that make up a version: open versions of one bucket of ids, or (bucket null) the closed ones that a load has added.
MANIFEST = "version long, folder string, buckets int, bucket int"


def _manifest(spark: SparkSession, base: str) -> list:
    """The newest version's entries: at most one per bucket and one per load."""
    if current_version(spark, base) is None:
        return []
    entries = spark.read.schema(MANIFEST).parquet(f"{base}/pointer")
    return entries.where(F.col("version") == entries.agg(F.max("version")).scalar()).collect()


def _path(base: str, entry) -> str:
    return f"{base}/{entry['folder']}/" + ("closed" if entry["bucket"] is None else f"open/bucket={entry['bucket']}")


def read_history(spark: SparkSession, base: str) -> DataFrame | None:
    """All versions as of the newest load, or None."""
    paths = [_path(base, e) for e in _manifest(spark, base)]
    return spark.read.parquet(*paths) if paths else None


def load_history(log: DataFrame, natural: str, day: str, attrs: list[str], base: str, buckets: int = 64) -> DataFrame:
    """Fold newly observed attributes into the history below base; returns the history.

    Only open versions are read, and only ids of the log are compared. Closed versions are appended and never read or written
    again; open ones are rewritten in the buckets (by a hash of the id; their number is fixed by the first load) that hold a changed id. The
    manifest appears last and whole, so a reader sees the history before the load or after it, and a load that fails changes nothing.
    Loads come in order of days, one at a time: a row older than its id's open version is refused; on the day of that
    version the larger attributes hold, so the last day may be loaded again. Rows without id or day are left out.
    """
    spark = log.sparkSession
    held = _manifest(spark, base)
    buckets = held[0]["buckets"] if held else buckets
    bucket: Column = F.pmod(F.xxhash64(natural), F.lit(buckets)).cast("int")
    seen = log.where(F.col(natural).isNotNull() & F.col(day).isNotNull()).select(natural, day, *attrs)
    was_open = {e["bucket"]: e for e in held if e["bucket"] is not None}
    folder, version = f"v-{uuid.uuid4().hex}", max((e["version"] for e in held), default=0) + 1
    if was_open:
        current = spark.read.parquet(*[_path(base, e) for e in was_open.values()])
        named = current.join(seen.groupBy(natural).agg(F.min(day).alias("_since")), natural)
        # An error in the job that writes, so the log is not read once more for the test alone.
        known = F.when(F.col("_since") < F.col("valid_from"), F.raise_error(F.lit("older than the open version: ")).cast("date")).otherwise(F.col("valid_from"))
        seen = seen.unionByName(named.select(natural, known.alias(day), *attrs))
        fresh = versions(seen, natural, day, attrs)
        same = current.where("is_current").select("version_key", F.struct(*attrs).alias("_had"))
        kept = fresh.join(same, "version_key", "left")
        fresh = kept.where(~(F.col("is_current") & F.col("_had").isNotNull() & F.struct(*attrs).eqNullSafe(F.col("_had")))).drop("_had")
    else:
        fresh = versions(seen, natural, day, attrs)
    fresh.withColumn("bucket", bucket).write.parquet(f"{base}/{folder}/changed")
    fresh = spark.read.parquet(f"{base}/{folder}/changed")
    fresh.where("not is_current").drop("bucket").write.parquet(f"{base}/{folder}/closed")
    opened = fresh.where("is_current")
    changed = [r["bucket"] for r in opened.select("bucket").distinct().collect()]
    stale = [_path(base, was_open[b]) for b in changed if b in was_open]
    if stale:
        rest = spark.read.parquet(*stale).join(opened.select(natural), natural, "left_anti")
        opened = opened.unionByName(rest.withColumn("bucket", bucket))
    if changed:
        opened.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{base}/{folder}/open")
    entries = [(version, e["folder"], buckets, e["bucket"]) for e in held if e["bucket"] not in changed]
    entries += [(version, folder, buckets, b) for b in [None, *changed]]
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{base}/pointer")
    return read_history(spark, base)


@query("dim_scd2_merged")
def merged(lake):
    """The history of drivers' regions, built by three loads of a third of the days each."""
    log, base = lake.stg_orders.select("driver_id", "order_date", "region"), run_dir(lake.spark, "history")
    first, last = log.agg(F.min("order_date"), F.max("order_date")).first()
    if first is None:
        return versions(log, "driver_id", "order_date", ["region"])
    step = (last - first) / 3
    out = None
    for i in range(3):
        after = F.lit(True) if i == 0 else F.col("order_date") > F.lit(first + step * i)
        until = F.lit(True) if i == 2 else F.col("order_date") <= F.lit(first + step * (i + 1))
        out = load_history(log.where(after & until), "driver_id", "order_date", ["region"], base)
    return out
