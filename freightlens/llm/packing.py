"""Best-fit packing by minimum bin slack.

A document's ids are its encoding and one end id; longer ones are cut so that all pieces but the first
are full. Which pieces share a sequence depends on the lengths alone, so the histogram of lengths (one
row per possible length) is all that the packing plan needs. Per sequence the plan takes the longest
length left and finds, by subset sums in a bitset, the fullest combination of the lengths left; the
combination is removed as often as the lengths allow, so the plan has at most a few combinations per
length. Pieces then get their number among the pieces of their length (a window over hash buckets and
a running sum of bucket sizes), which tells their place in the plan.

Defined results: a null text counts as empty and is one piece that holds the end id; repeated documents
are packed as often as they occur; an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import ship, stage
from freightlens.llm.pretokens import vocabulary, worker_cache

CAPACITY, END_ID = 2048, 0


def encoded(batches, path: str | None, end_id: int):
    """(text column's row, little-endian ids with the end id) for every batch."""
    cache = worker_cache(path or vocabulary(), "ids", 1_000_000)
    end = np.array([end_id], "<u4").tobytes()

    def pack(ids):
        return struct.pack(f"<{len(ids)}I", *ids)

    for b in batches:
        out = []
        for x in b.column(0).to_pylist():
            if not x:
                out.append(end)
            elif cache.plain(x):
                out.append(cache.joined(cache.cut(x), pack) + end)
            else:
                out.append(np.array(cache.ids([x])[0], "<u4").tobytes() + end)
        yield b, out


def pieces(docs: DataFrame, key: str, text: str, path: str | None, capacity: int, end_id: int) -> DataFrame:
    """(row, key, piece, start, length, ids_crc32) for every piece."""
    kind = dict(docs.dtypes)[key]

    def cut(batches):
        start = TaskContext.get().partitionId() << 33
        for b, ids in encoded(batches, path, end_id):
            at, number, begin, length, crc = [], [], [], [], []
            for i, data in enumerate(ids):
                n = len(data) // 4
                first = n % capacity or capacity
                for j, a in enumerate([0, *range(first, n, capacity)]):
                    size = first if j == 0 else capacity
                    at.append(i), number.append(j), begin.append(a), length.append(size)
                    crc.append(zlib.crc32(data[4 * a : 4 * (a + size)]))
            at = pa.array(at, pa.int64())
            rows = pa.array(start + np.arange(b.num_rows))
            yield pa.RecordBatch.from_arrays(
                [rows.take(at), b.column(1).take(at), pa.array(number, pa.int32()), pa.array(begin, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["row", key, "piece", "start", "length", "ids_crc32"],
            )
            start += b.num_rows

    return docs.select(text, key).mapInArrow(cut, f"row long, `{key}` {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(left: dict[int, int], space: int) -> dict[int, int]:
    """The combination of the lengths left that fills most of `space`, as length -> how many.

    Bit i of the set says that a sum of i can be reached. Each length joins in powers of two of its
    count, so that log(count) shifts do; the sets before each shift lead back from the best sum.
    """
    reach, full, steps = 1, (1 << (space + 1)) - 1, []
    for length in sorted(left, reverse=True):
        most, times = min(left[length], space // length), 1
        while most > 0:
            times = min(times, most)
            after = reach | ((reach << (length * times)) & full)
            if after != reach:
                steps.append((length, times, reach))
                reach = after
            most -= times
            times *= 2
        if reach >> space & 1:
            break
    best, taken = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> best & 1:
            taken[length] = taken.get(length, 0) + times
            best -= length * times
    return taken


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(combination, sequences packed so): every length is used up."""
    left, out = dict(histogram), []
    while left:
        longest = max(left)
        rest = {k: v - (k == longest) for k, v in left.items()}
        taken = fullest({k: v for k, v in rest.items() if 0 < k <= capacity - longest and v}, capacity - longest)
        taken[longest] = taken.get(longest, 0) + 1
        times = min(left[k] // n for k, n in taken.items())
        for k, n in taken.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((taken, times))
    return out


def _places(combinations: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first number, first sequence, how many per sequence, offset of the first)."""
    used: dict[int, int] = {}
    rows: dict[int, list] = {}
    sequence = 0
    for taken, times in combinations:
        offset = 0
        for length, n in sorted(taken.items(), reverse=True):
            rows.setdefault(length, []).append((used.get(length, 0), sequence, n, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    ship(spark)
    cut = stage(pieces(docs, key, text, path, capacity, end_id), "packing-pieces")
    buckets = max(1, -(-cut.count() // 2_000))
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)))
    sizes = cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    held = spark.sparkContext.broadcast(_places(plan(histogram, capacity)))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row", "piece"))
    numbered = cut.withColumn("own", own).join(before.select("length", "bucket", "before"), ["length", "bucket"])
    numbered = numbered.select(key, "piece", "start", "length", "ids_crc32", (F.coalesce("before", F.lit(0)) + F.col("own") - 1).alias("number"))
    names = [*numbered.columns[:-1], "sequence_id", "offset"]

    def place(batches):
        for b in batches:
            length, number = (b.column(i).to_numpy() for i in (3, 5))
            sequence, offset = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for k in np.unique(length).tolist():
                at, rows = np.flatnonzero(length == k), held.value[k]
                r = rows[np.searchsorted(rows[:, 0], number[at], "right") - 1]
                own = number[at] - r[:, 0]
                sequence[at] = r[:, 1] + own // r[:, 2]
                offset[at] = r[:, 3] + own % r[:, 2] * k
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names)

    schema = numbered.drop("number").withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return numbered.mapInArrow(place, schema)
