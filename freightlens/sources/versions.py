"""Versions of a group of tables: written to a folder of their own, then made current by one small file."""

from __future__ import annotations

import functools
import hashlib
import pathlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "version long, folder string"


def current_version(spark: SparkSession, base: str) -> str | None:
    """The folder of the newest version below base, or None."""
    try:
        newest = spark.read.schema(POINTER).parquet(f"{base}/pointer").orderBy(F.desc("version"), "folder").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return newest and f"{base}/{newest['folder']}"


def publish_version(tables: dict[str, DataFrame], base: str, partition_by: dict[str, list[str]] | None = None, keep: int | None = None) -> str:
    """Write all tables as the next version and make it current; returns its folder.

    Nothing that exists is touched before the pointer file appears, and that file appears whole or not at all: a reader that
    looks up the version sees all old tables or all new ones, and a load that fails midway changes nothing. keep: delete
    the folders of versions before the last `keep` ones (readers of those should have ended).
    """
    spark = next(iter(tables.values())).sparkSession
    folder = f"v-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{base}/{folder}/{name}")
    seen = spark.read.schema(POINTER).parquet(f"{base}/pointer").collect() if current_version(spark, base) else []
    version = max((r["version"] for r in seen), default=0) + 1
    spark.createDataFrame([(version, folder)], POINTER).coalesce(1).write.mode("append").parquet(f"{base}/pointer")
    if keep:
        for r in sorted(seen, key=lambda r: -r["version"])[max(0, keep - 1) :]:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{r['folder']}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return f"{base}/{folder}"


@functools.cache
def code_version() -> str:
    """A name for the state of the library's sources, so that what other code has derived is not read."""
    top = pathlib.Path(__file__).resolve().parents[1]
    texts = (p.read_bytes() for p in sorted(top.glob("*/*.py")) if p.parent.name != "llm")
    return hashlib.sha256(b"".join(texts)).hexdigest()[:16]


def files_version(spark: SparkSession, paths: list[str]) -> str:
    """A name for the state of files: their number, paths, lengths and times of change, and the library's sources."""
    files = spark.read.format("binaryFile").load(paths)
    one = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("x")).first()
    return f"{one['n']}-{(one['x'] or 0) & (1 << 64) - 1:016x}-{code_version()}"


def input_version(df: DataFrame) -> str:
    """The state of all files that df reads."""
    return files_version(df.sparkSession, df.inputFiles())


def derived_once(name: str, df: DataFrame, base: str) -> DataFrame:
    """df as written below base, which names the version of its input; written by whoever needs it first."""
    folder = current_version(df.sparkSession, f"{base}/{name}") or publish_version({"rows": df}, f"{base}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")
