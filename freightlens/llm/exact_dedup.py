"""Exact duplicates: counting quotient filters per partition, merged by sorted remainders, then byte verification.

Every partition turns the 64-bit fingerprints of its texts into a counting quotient filter: the high
half of a fingerprint is its quotient, the low half its remainder; each occupied quotient holds a run
of sorted remainders with counts. Filters are cut into blocks of neighbouring quotients; the blocks
of all partitions meet and merge without loss. A fingerprint seen more than once sends its rows to
verification, which groups by the text itself, so equal fingerprints of different texts part again.

Defined results: a null text counts as empty; a null doc_id is smaller than any other; of repeated
rows with the same doc_id and text one stays; an empty table gives an empty result; further columns
are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import SMALL_BATCH_BYTES, bit_filter, in_filter, ship, width

HALF = np.uint64(32)


class CountingQuotientFilter:
    """Sorted runs: quotients, the remainders of each, and how often each fingerprint was added."""

    def __init__(self, quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.quotients, self.remainders, self.counts = quotients, remainders, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray) -> CountingQuotientFilter:
        f, n = np.unique(fingerprints.astype(np.uint64, copy=False), return_counts=True)
        return cls((f >> HALF).astype(np.uint32), (f & np.uint64(0xFFFFFFFF)).astype(np.uint32), n.astype(np.int64))

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """One filter with the summed counts."""
        q = np.concatenate([x.quotients for x in filters])
        r = np.concatenate([x.remainders for x in filters])
        n = np.concatenate([x.counts for x in filters])
        order = np.lexsort((r, q))
        q, r, n = q[order], r[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (r[1:] != r[:-1])])) if len(q) else np.array([], int)
        return cls(q[first], r[first], np.add.reduceat(n, first) if len(first) else n)

    def blocks(self, bits: int):
        """(block, filter): the quotients of a block share their top bits."""
        if not len(self.quotients):
            return
        block = self.quotients >> np.uint32(32 - bits)
        cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(block[a]), CountingQuotientFilter(self.quotients[a:b], self.remainders[a:b], self.counts[a:b])

    def pack(self) -> bytes:
        return self.quotients.tobytes() + self.remainders.tobytes() + self.counts.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> CountingQuotientFilter:
        n = len(data) // 16
        return cls(np.frombuffer(data, np.uint32, n), np.frombuffer(data, np.uint32, n, 4 * n), np.frombuffer(data, np.int64, n, 8 * n))

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        at = self.counts > 1
        return (self.quotients[at].astype(np.uint64) << HALF) | self.remainders[at], self.counts[at]


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """(fp, n) of the fingerprints that a column fp holds more than once."""
    ship(fingerprints.sparkSession, SMALL_BATCH_BYTES)
    bits = min(20, max(6, (2 * width(fingerprints.sparkSession) - 1).bit_length()))

    def build(batches):
        parts = [CountingQuotientFilter.of(b.column(0).to_numpy(zero_copy_only=False)) for b in batches]
        if parts:
            found = list(CountingQuotientFilter.merge(parts).blocks(bits))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([x.pack() for _, x in found], pa.binary())], ["block", "data"])

    def merge(_, table):
        f, n = CountingQuotientFilter.merge([CountingQuotientFilter.unpack(x.as_buffer()) for x in table["data"]]).repeated()
        return pa.table({"fp": pa.array(f.view(np.int64)), "n": pa.array(n)})

    return fingerprints.select("fp").mapInArrow(build, "block int, data binary").groupBy("block").applyInArrow(merge, "fp long, n long")


def _routed(docs: DataFrame, text: str):
    """The rows with their fingerprint, and the test which of them need verification."""
    spark = docs.sparkSession
    marked = docs.withColumn("_fp", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    held = spark.sparkContext.broadcast(bit_filter(repeated_fingerprints(marked.select(F.col("_fp").alias("fp"))), "fp"))

    @F.pandas_udf("boolean")
    def may_repeat(fp: pd.Series) -> pd.Series:
        return pd.Series(in_filter(fp.to_numpy().view(np.uint64), held.value))

    return marked, may_repeat(F.col("_fp"))


def _verified(routed: DataFrame, text: str, key: str) -> DataFrame:
    """(_fp, _sha, keep_id, group_size) of the texts that really occur more than once."""
    return (
        routed.select("_fp", F.coalesce(F.col(text), F.lit("")).alias("_text"), F.col(key).alias("_key"))
        .groupBy("_fp", "_text").agg(F.max("_key").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select("_fp", F.sha2("_text", 256).alias("_sha"), "keep_id", "group_size")
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: its key, keep_id, group_size, kept, text_sha256."""
    marked, flag = _routed(docs, text)
    groups = _verified(marked.where(flag), text, key)
    narrow = marked.select(F.col(key), "_fp", F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_sha"))
    joined = narrow.join(groups, ["_fp", "_sha"], "left")
    alone = F.col("group_size").isNull()
    same = Window.partitionBy(key, "_sha").orderBy(F.lit(1))
    return joined.select(
        key,
        F.when(alone, F.col(key)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col(key).eqNullSafe(F.col("keep_id")) & (F.row_number().over(same) == 1))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def without_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Only rows that need verification are shuffled."""
    marked, flag = _routed(docs, text)
    marked = marked.withColumn("_flag", flag)
    routed = marked.where("_flag").withColumn("_sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    groups = _verified(marked.where("_flag"), text, key)
    joined = routed.join(groups, ["_fp", "_sha"], "left")
    lone = joined.where("group_size is null").select(*docs.columns)
    same = Window.partitionBy("_fp", "_sha").orderBy(F.lit(1))
    first = joined.where(F.col("group_size").isNotNull() & F.col(key).eqNullSafe(F.col("keep_id"))).withColumn("_n", F.row_number().over(same))
    return marked.where(~F.col("_flag")).select(*docs.columns).unionByName(lone).unionByName(first.where("_n = 1").select(*docs.columns))
