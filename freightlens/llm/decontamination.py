"""Benchmark decontamination: a prefix-filtered set join of shingles, verified over item-sized windows.

An item's windows are its runs of `window` words (the whole item where it is shorter). The set of a
window are its shingles of `shingle` words. A text that holds the whole window holds its rarest
shingle, so with shingles ordered by how often the documents use them, one prefix token per window is
enough. Neighbouring windows share prefix tokens. The tokens are joined with the documents' shingles
under bounds on length and position; each match carries its words to both sides and is verified word
by word: the run of equal words around it must be as long as the window.

Documents are read twice: to count shingles of items, and to find prefix tokens. Both passes ask a
filter of fixed size first, so that only likely matches are shuffled. Matches grow with the
occurrences of item text; a frequent token is split by the join, and nothing is capped.

Defined results: a null or empty text has no words, no hits and is clean; an item without words has
no window; a null item_id counts as the empty string; items with the same id count as one; repeated
documents give repeated rows; an empty table gives an empty result or clean documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import bit_filter, in_filter, ship, stage
from freightlens.llm.words import alnum_words, runs, word_hashes

WINDOW, SHINGLE = 13, 3


def _row_ids(n: int, start: int) -> np.ndarray:
    return (TaskContext.get().partitionId() << 33) + start + np.arange(n)


def _items(items: DataFrame, key: str, text: str, window: int, shingle: int) -> DataFrame:
    """(item, item_id, words, size, k, hashes) per item that has words: size of its windows, k of its shingles."""

    def parse(batches):
        start = 0
        for b in batches:
            out = []
            for number, item_id, raw in zip(_row_ids(b.num_rows, start).tolist(), b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = alnum_words(raw)
                if w:
                    k = min(shingle, len(w))
                    out.append((number, item_id or "", [x.decode() for x in w], min(window, len(w)), k, runs(word_hashes(w), k).view(np.int64).tolist()))
            start += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.list_(pa.int64())))], ["item", "item_id", "words", "size", "k", "hashes"])

    return items.select(F.col(key).cast("string"), F.col(text).cast("binary")).mapInArrow(parse, "item long, item_id string, words array<string>, size int, k int, hashes array<long>")


def _usage(docs: DataFrame, text: str, held, lengths: list[int]) -> DataFrame:
    """(h, n): how often the documents use shingles that pass the filter."""

    def count(batches):
        for b in batches:
            found = []
            for raw in b.column(0).to_pylist():
                h = word_hashes(alnum_words(raw))
                for k in lengths:
                    x = runs(h, k)
                    found.append(x[in_filter(x, held.value)])
            h, n = np.unique(np.concatenate(found) if found else np.array([], np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])

    return docs.select(F.col(text).cast("binary")).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _prefixes(items: DataFrame, usage: DataFrame) -> DataFrame:
    """(h, item_id, size, k, before, after, around, at): the prefix tokens of each item.

    before and after: words that the window needs on either side of the token, by position; around:
    the item's words near it, of which the token starts at number `at`.
    """
    used = (
        items.select("item", F.posexplode("hashes").alias("pos", "h")).join(usage, "h", "left")
        .groupBy("item").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("n", F.lit(0)).alias("n")))).alias("used"))
    )

    def choose(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                n, size, k, words = [x["n"] for x in r["used"]], r["size"], r["k"], r["words"]
                need: dict[int, tuple[int, int]] = {}
                for a in range(len(words) - size + 1):
                    p = min(range(a, a + size - k + 1), key=lambda i: (n[i], r["hashes"][i], i))
                    before, after = need.get(p, (size, size))
                    need[p] = min(before, p - a), min(after, a + size - p)
                for p, (before, after) in need.items():
                    lo, hi = max(0, p - size + k), min(len(words), p + size)
                    out.append((r["hashes"][p], r["item_id"], size, k, before, after, words[lo:hi], p - lo))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32()))], ["h", "item_id", "size", "k", "before", "after", "around", "at"])

    return items.join(used, "item").select("item_id", "words", "size", "k", "hashes", "used").mapInArrow(choose, "h long, item_id string, size int, k int, before int, after int, around array<string>, at int")


def _found(docs: DataFrame, key: str, text: str, held, lengths: list[int], window: int) -> DataFrame:
    """(row, key, n_words, found): each document with its shingles that may be prefix tokens."""
    kind = pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int32()), ("near", pa.list_(pa.string())), ("off", pa.int32())]))
    key_type = dict(docs.dtypes)[key]

    def look(batches):
        start = 0
        for b in batches:
            sizes, found = [], []
            for raw in b.column(1).to_pylist():
                w = alnum_words(raw)
                h, own = word_hashes(w), []
                for k in lengths:
                    x = runs(h, k)
                    for p in np.flatnonzero(in_filter(x, held.value)).tolist():
                        lo = max(0, p - window + 1)
                        own.append({"h": int(x[p].view(np.int64)), "p": p, "near": [y.decode() for y in w[lo : p + window]], "off": p - lo})
                sizes.append(len(w))
                found.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(_row_ids(b.num_rows, start)), b.column(0), pa.array(sizes, pa.int64()), pa.array(found, kind)], ["row", key, "n_words", "found"])
            start += b.num_rows

    return docs.select(F.col(key), F.col(text).cast("binary")).mapInArrow(look, f"row long, `{key}` {key_type}, n_words long, found array<struct<h:long,p:int,near:array<string>,off:int>>")


def _verify(batches):
    """The run of equal words around each match, where it is as long as the item's window."""
    for b in batches:
        rows, ids, starts, ends = [], [], [], []
        for row, p, near, off, item_id, size, k, around, at in zip(*(c.to_pylist() for c in b.columns)):
            if near[off : off + k] != around[at : at + k]:
                continue
            left = 0
            while left < min(off, at) and near[off - left - 1] == around[at - left - 1]:
                left += 1
            right, most = k, min(len(near) - off, len(around) - at)
            while right < most and near[off + right] == around[at + right]:
                right += 1
            if left + right >= size:
                rows.append(row), ids.append(item_id), starts.append(p - left), ends.append(p + right)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["row", "item_id", "s", "e"])


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """A row per document: key, n_words, n_hit, items (ids of the items with occurring windows, sorted)."""
    spark = docs.sparkSession
    ship(spark)
    parsed = stage(_items(items, item_key, item_text, window, shingle), "decontamination-items")
    lengths = sorted(r["k"] for r in parsed.select("k").distinct().collect())  # at most `shingle` values
    all_shingles = spark.sparkContext.broadcast(bit_filter(parsed.select(F.explode("hashes").alias("h")), "h"))
    prefixes = stage(_prefixes(parsed, _usage(docs, text, all_shingles, lengths)), "decontamination-prefixes")
    tokens = spark.sparkContext.broadcast(bit_filter(prefixes, "h"))
    found = stage(_found(docs, key, text, tokens, lengths, window), "decontamination-found")
    pairs = (
        found.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
        .join(prefixes, "h")
        .where((F.col("n_words") >= F.col("size")) & (F.col("p") >= F.col("before")) & (F.col("n_words") - F.col("p") >= F.col("after")))
        .select("row", "p", "near", "off", "item_id", "size", "k", "around", "at")
    )
    hits = pairs.mapInArrow(_verify, "row long, item_id string, s long, e long")
    union = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"), F.greatest(a["end"], x["e"]).alias("end")),
    )
    by_row = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
    by_row = by_row.select("row", union["n"].alias("n_hit"), "items")
    return found.select("row", key, "n_words").join(by_row, "row", "left").select(
        key, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


#: A document is contaminated when hit words are at least one in so many of its words.
ONE_IN = 20


def is_contaminated():
    return (F.col("n_hit") > 0) & (F.lit(ONE_IN) * F.col("n_hit") >= F.col("n_words"))


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    body = docs.withColumn("_fp", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    tagged = body.select(F.struct(F.col(key).alias("id"), "_fp").alias("_key"), F.col(text).alias("_text"))
    bad = contamination(tagged, items, "_key", "_text").where(is_contaminated()).select(F.col("_key.id").alias("_id"), F.col("_key._fp").alias("_bad")).distinct()
    return body.join(bad, body[key].eqNullSafe(bad["_id"]) & (body["_fp"] == bad["_bad"]), "left_anti").select(*docs.columns)
