"""Helpers shared by the operators: shared folder, shipped code, fixed-size filters, components, hashes."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import freightlens

_SHIPPED: dict[str, bool] = {}
#: Bytes of an Arrow batch, which the executor's JVM and its Python worker hold side by side.
BATCH_BYTES = "8m"
#: The same for operators whose functions gain nothing from larger batches: less memory on both sides.
SMALL_BATCH_BYTES = "2m"


def ship(spark: SparkSession, batch_bytes: str = BATCH_BYTES) -> None:
    """Give the package to the executors' Python workers (once per application), and texts to them a few megabytes at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(freightlens.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="freightlens-code-"), "freightlens_llm.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.write(os.path.join(top, "__init__.py"), "freightlens/__init__.py")
        for name in sorted(os.listdir(os.path.join(top, "llm"))):
            if name.endswith(".py"):
                z.write(os.path.join(top, "llm", name), f"freightlens/llm/{name}")
    spark.sparkContext.addPyFile(path)
    _SHIPPED[app] = True


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder below the warehouse only where it is unset."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (d or spark.conf.get("spark.sql.warehouse.dir") + "/llm-work").rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it survives lost executors and cuts lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that stage() has written, once nothing reads it any more."""
    spark = table.sparkSession
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let the driver collect garbage now, so that Spark's cleaner removes shuffle files of steps that are done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def rows_per_batch(spark: SparkSession, n: int):
    """Within this block, Arrow batches hold at most n rows: for rows of many bytes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


FILTER_BITS = 26
#: Where a hash's two slots begin; the leading bits are left out, since keys may be the smallest of many hashes.
SLOTS = (32, 10)


def bit_filter(df: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A membership filter of 2**bits bits over a column of 64-bit hashes, two bits each, as an array of uint64.

    Executors set the bits; the driver gets at most 2**(bits - 6) words (16 MB at 26 bits), whatever
    the size of the input. False positives only: every use checks its hits again by an exact join.
    """
    h = F.col(column)
    slot = F.explode(F.array(*[F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << bits) - 1)) for at in SLOTS]))
    words = (
        df.select(slot.alias("s"))
        .select(F.shiftright("s", 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("s").bitwiseAND(F.lit(63)).cast("int")).alias("b"))
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.view(np.uint64)


def in_filter(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which of the uint64 hashes may be members."""
    bits = len(words).bit_length() - 1 + 6
    out = None
    for slot in ((hashes >> np.uint64(at)) & np.uint64((1 << bits) - 1) for at in SLOTS):
        hit = (words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
        out = hit if out is None else out & hit
    return out


def count_keys(packed: DataFrame, least: int) -> DataFrame:
    """(h, n) of the keys counted `least` times or more in blobs (bucket, keys, counts) as pack_keys makes them.

    A bucket holds an even share of all keys, since it is dealt by a scramble of the key; a frequent key is one entry per blob.
    """

    def merge(table):
        k, n = (np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table[c]]) for c, t in (("keys", np.uint64), ("counts", np.uint32)))
        order = np.argsort(k)
        k, n = k[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        n = np.add.reduceat(n, first)
        return pa.table({"h": k[first[n >= least]].view(np.int64), "n": n[n >= least]})

    return packed.groupBy("bucket").applyInArrow(merge, "h long, n long")


PACKED = "bucket int, keys binary, counts binary"


def key_buckets(spark: SparkSession) -> int:
    """Bits of the bucket number: about two buckets per shuffle partition."""
    return min(16, max(6, (2 * width(spark) - 1).bit_length()))


def pack_keys(keys: list[np.ndarray], counts: list[np.ndarray] | None, bits: int) -> pa.RecordBatch:
    """Blobs of distinct keys with their counts, one per bucket; keys may crowd in a part of their range, buckets don't."""
    k = np.concatenate(keys) if keys else np.array([], np.uint64)
    order = np.argsort(k)
    k = k[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.array([], int)
    if counts is None:
        n = np.diff(np.append(first, len(k)))
    else:
        n = np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else first
    k, n = k[first], np.minimum(n, 1 << 31).astype(np.uint32)
    bucket = (mix(k) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    k, n, bucket = k[order], n[order], bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist() if len(k) else []
    rows = [(int(bucket[i]), k[i:j].tobytes(), n[i:j].tobytes()) for i, j in zip(cuts, cuts[1:])]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["bucket", "keys", "counts"])


M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


#: Edges that one task of components() joins into a forest.
FOREST_EDGES = 200_000


def _forest(batches):
    """A task's edges as stars around the smallest vertex of each of their components, by union-find."""
    up = {}

    def top(x):
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    names, types = None, None
    for b in batches:
        names, types = b.schema.names, b.schema.types
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    vertices = [x for x, y in up.items() if x != y]
    if vertices:
        yield pa.RecordBatch.from_arrays([pa.array(vertices, types[0]), pa.array([top(x) for x in vertices], types[1])], names)


def components(edges: DataFrame, name: str = "components", share: int = FOREST_EDGES) -> DataFrame:
    """(v, root) for every vertex of an edge table (a, b): root is the smallest vertex of its component.

    Each task first reduces `share` edges to a forest of stars. Where that takes several tasks, their
    forests are joined by alternating large-star and small-star steps on the edge table. Every step is
    an aggregation by vertex with partial aggregation and a join, which Spark splits where a vertex has
    very many edges; each result is written to the shared folder. The number of steps grows with the
    logarithm of the longest path. It ends when no edge changes, by count and an exclusive or of hashes.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    tasks = max(1, -(-e.count() // share))
    e = stage(e.repartition(tasks).mapInArrow(_forest, e.schema), name)
    state = None
    while tasks > 1:
        now = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
        if now == state or not now["n"]:
            break
        state = now
        both = e.union(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(low, "v").where("u > v and u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v")
        small = small.select("v", F.col("m").alias("u")).union(small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")))
        e = stage(small.where("v <> u").distinct(), name)
    roots = e.select(F.col("u").alias("v")).distinct()
    return e.groupBy("v").agg(F.min("u").alias("root")).union(roots.select("v", F.col("v").alias("root")))
