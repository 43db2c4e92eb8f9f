"""Token counts by a two-tier lookup on the map side.

Texts are cut at single spaces and newlines, where pre-tokens end, so that only chunks which are not yet
known are split into pre-tokens. Tier one is a broadcast hash table with the token lengths of frequent
chunks; its size is fixed by `table_size`. Which chunks are frequent comes from all documents: each task
summarises its chunks by a Misra-Gries sketch of fixed size, and sketches, not chunks, are merged in a
tree. Tier two is a cache in each Python worker: the pre-tokens of a chunk that is in neither tier are
encoded once by the tokenizer and remembered. Texts that hold special strings or unusual characters go
to the tokenizer whole. No chunk is shuffled, and the counts do not depend on what the tiers hold.

Defined results: a null text counts as empty with 0 tokens; repeated documents give repeated rows; an
empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import ship
from freightlens.llm.pretokens import vocabulary, worker_cache

TABLE_SIZE, FAN_IN = 16_384, 64
SKETCH = "part long, pieces array<string>, counts array<long>"


def shrink(counts: Counter, size: int) -> Counter:
    """Misra-Gries: take the (size + 1)th largest count off all, and keep what is left."""
    if len(counts) <= size:
        return counts
    off = sorted(counts.values(), reverse=True)[size]
    return Counter({k: v - off for k, v in counts.items() if v > off})


def _sketch_batch(part: int, counts: Counter):
    return pa.RecordBatch.from_arrays(
        [pa.array([part]), pa.array([list(counts)], pa.list_(pa.string())), pa.array([list(counts.values())], pa.list_(pa.int64()))], ["part", "pieces", "counts"]
    )


def frequent_chunks(docs: DataFrame, text: str, path: str | None, size: int) -> list[str]:
    """At most `size` chunks: those the documents use most, to within 1 / size of all."""

    def summarise(batches):
        cache, counts = worker_cache(path or vocabulary(), "length"), Counter()
        for b in batches:
            for x in b.column(0).to_pylist():
                if x and cache.plain(x):
                    counts.update(cache.cut(x))
                    if len(counts) > 16 * size:
                        counts = shrink(counts, size)
        yield _sketch_batch(TaskContext.get().partitionId(), shrink(counts, size))

    def merge(batches):
        counts = Counter()
        for b in batches:
            for pieces, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                counts.update(dict(zip(pieces, n)))
                counts = shrink(counts, size)
        yield _sketch_batch(TaskContext.get().partitionId(), counts)

    sketches = docs.select(text).mapInArrow(summarise, SKETCH)
    parts = docs.select(text).rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // FAN_IN)
        sketches = sketches.repartition(parts).mapInArrow(merge, SKETCH)
    found = sketches.collect()  # one sketch of at most `size` entries
    return [p for r in found for p in r["pieces"]]


def token_counts(docs: DataFrame, text: str = "text", path: str | None = None, table_size: int = TABLE_SIZE) -> DataFrame:
    """The documents without their text, with n_bytes and n_tokens, which replace columns of these names. `path`: the tokenizer file, at the same place on all machines."""
    spark = docs.sparkSession
    ship(spark)
    frequent = frequent_chunks(docs, text, path, table_size)
    cache = worker_cache(path or vocabulary(), "length")
    held = spark.sparkContext.broadcast({c: cache.total([c], {}) for c in frequent})
    rest = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    schema = docs.select(*rest).withColumn("n_bytes", F.lit(0).cast("long")).withColumn("n_tokens", F.lit(0).cast("long")).schema

    def count(batches):
        cache, table = worker_cache(path or vocabulary(), "length"), held.value
        for b in batches:
            tokens = []
            sizes = pc.fill_null(pc.binary_length(b.column(0)).cast(pa.int64()), 0)
            for x in b.column(0).to_pylist():
                if not x:
                    tokens.append(0)
                elif cache.plain(x):
                    tokens.append(cache.total(cache.cut(x), table))
                else:
                    tokens.append(len(cache.ids([x])[0]))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], sizes, pa.array(tokens, pa.int64())], [*rest, "n_bytes", "n_tokens"])

    return docs.select(text, *rest).mapInArrow(count, schema)
