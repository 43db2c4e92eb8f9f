"""Removal of long repeated strings by distributed prefix doubling over sampled positions.

A byte goes when a string of `length` bytes that covers it also starts elsewhere. Plain prefix doubling
ranks every position by its first bytes, then by pairs of ranks at growing offsets, and drops positions
whose rank is unique. Here the ranks of short strings are fingerprints, and only sampled positions take
part: of the substrings of one level's length within a string of `length` bytes the one with the
smallest fingerprint, which equal strings share. Levels grow (half the length, then nine tenths); Spark
sorts and counts the ranks of each level, and strings whose sampled substring is unique drop out. What
is left is ranked by the pair (rank of the first half, rank at offset length / 2), in three steps: a
content-defined sample decides the inside of repeated runs, since two repeated strings that start at
most `length` apart cover all between them; then the last strings at each end of a run are asked about
one by one against all others; then all that is still open. The result is that of ranking every
position, up to equal 64-bit fingerprints of different strings.

Ranks travel as packed arrays per hash bucket, so a frequent string is one entry per batch.

Defined results: a null text counts as empty; texts shorter than `length` stay whole; repeated rows are
copies of each other and lose all strings of `length` bytes; an empty table gives an empty result;
further columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import PACKED, bit_filter, count_keys, in_filter, key_buckets, mix, pack_keys, ship, stage

LENGTH, SAMPLE = 200, 32
RANK_BITS = 27  # of the filters of repeated ranks
UNIT, POS = 1 << 20, 22  # bytes ranked at once; bits for a position among them

_rng = np.random.Generator(np.random.PCG64(20))
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i below a size of at least n."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        inverse = pow(BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            up, down = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (BASE, inverse))
        _POWERS[size] = up, down
    return _POWERS[size]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * _powers(len(data))[0][: len(data)], out=out[1:])
    return out


def fingerprints(sums: np.ndarray, length: int) -> np.ndarray:
    """The fingerprint of the string of `length` bytes at each position, from prefix sums."""
    n = len(sums) - length
    if n <= 0:
        return np.array([], np.uint64)
    return mix((sums[length:] - sums[:n]) * _powers(len(sums))[1][:n] + np.uint64(length))


def pairs_of_halves(sums: np.ndarray, length: int) -> np.ndarray:
    """The rank of each position by the pair (rank of its first half, rank at offset length / 2)."""
    half = fingerprints(sums, length // 2)
    n = len(sums) - length
    return mix(half[:n] * np.uint64(3) ^ (half[length - length // 2 :][:n] + np.uint64(BASE))) if n > 0 else half[:0]


def smallest(ranks: np.ndarray, window: int) -> np.ndarray:
    """For each position the position of the smallest rank among it and the next window - 1, the first of equals."""
    low = np.uint64((1 << POS) - 1)
    x = (ranks & ~low) | np.arange(len(ranks), dtype=np.uint64)
    size = 1
    while size * 2 <= window:
        x = np.minimum(x[:-size], x[size:]) if len(x) > size else x[:0]
        size *= 2
    if size < window:
        x = np.minimum(x[: -(window - size)], x[window - size :]) if len(x) > window - size else x[:0]
    return (x & low).astype(np.int64)


def units(batch, text: int, length: int):
    """(numbers of rows, begins, ends, bytes, bases): texts side by side, about UNIT bytes at a time.

    A longer text is cut into parts that overlap by length - 1 bytes, so that each string lies in one.
    """
    rows, parts, bases, size = [], [], [], 0
    for i, x in enumerate(batch.column(text).to_pylist()):
        if not x or len(x) < length:
            continue
        for a in range(0, len(x) - length + 1, UNIT):
            part = x[a : a + UNIT + length - 1]
            rows.append(i), parts.append(part), bases.append(a)
            size += len(part)
            if size >= UNIT:
                yield rows, parts, bases
                rows, parts, bases, size = [], [], [], 0
    if parts:
        yield rows, parts, bases


def _starts(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each part begins, and which positions start a string within one part."""
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes) - sizes
    valid = np.ones(sizes.sum() + 1, bool)
    for e in begins + sizes:
        valid[max(0, e - length + 1) : e] = False
    return begins, valid[:-1]


def _sampled(parts: list[bytes], length: int):
    """(begins, positions of whole strings, sampled position of each, ranks of halves)."""
    begins, valid = _starts(parts, length)
    ranks = fingerprints(prefix_sums(np.frombuffer(b"".join(parts), np.uint8)), length // 2)
    at = smallest(ranks, length - length // 2 + 1)
    whole = np.flatnonzero(valid[: len(at)])
    return begins, whole, at[whole], ranks


def _ranks(docs: DataFrame, length: int) -> DataFrame:
    """(h, n): the repeated ranks of sampled positions at the first level."""
    bits = key_buckets(docs.sparkSession)

    def rank(batches):
        for b in batches:
            found = []
            for _, parts, _ in units(b, 1, length):
                _, _, at, ranks = _sampled(parts, length)
                found.append(ranks[at[np.flatnonzero(np.diff(at, prepend=-1))]])
            yield pack_keys(found, None, bits)

    return count_keys(docs.mapInArrow(rank, PACKED), 2)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open ranges of consecutive true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _segments(docs: DataFrame, length: int, held) -> DataFrame:
    """(v, a, data): stretches in which the sampled half of every string may be repeated."""

    def cut(batches):
        for b in batches:
            v, out = b.column(0).to_pylist(), []
            for rows, parts, bases in units(b, 1, length):
                begins, whole, at, ranks = _sampled(parts, length)
                flags = np.zeros(sum(map(len, parts)), bool)
                flags[whole[in_filter(ranks[at], held.value)]] = True
                first, last = _runs(flags)
                owner = np.searchsorted(begins, first, "right") - 1
                for i, s, e in zip(owner.tolist(), first.tolist(), last.tolist()):
                    s, e = s - int(begins[i]), e - int(begins[i])
                    out.append((v[rows[i]], bases[i] + s, parts[i][s : e - 1 + length]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.binary()))], ["v", "a", "data"])

    return docs.mapInArrow(cut, "v binary, a long, data binary")


class Stretch:
    """The strings of one segment: their ranks, and which may be repeated by the second level."""

    def __init__(self, data: bytes, length: int, held=None):
        sums = prefix_sums(np.frombuffer(data, np.uint8))
        self.length, level = length, length * 9 // 10
        long = fingerprints(sums, level)
        at = smallest(long, length - level + 1)
        if held is None:
            self.sampled = long[at[np.flatnonzero(np.diff(at, prepend=-1))]]
        else:
            self.ranks = pairs_of_halves(sums, length)
            self.open = in_filter(long[at], held)
            self.in_sample = self.open & (self.ranks % np.uint64(SAMPLE) == 0)

    def between(self, yes: np.ndarray) -> np.ndarray:
        """Strings that two repeated ones at most `length` apart enclose; they cover no further bytes."""
        out = np.zeros(len(self.ranks), bool)
        at = np.flatnonzero(yes)
        for i in np.flatnonzero(np.diff(at) <= self.length):
            out[at[i] : at[i + 1]] = True
        return out

    def first_asked(self, repeated: list[int]) -> np.ndarray:
        """Strings near the ends of open runs, those between distant repeated ones, and short runs without any."""
        yes = flags(len(self.ranks), repeated)
        slack = self.length - self.length * 9 // 10
        near = np.zeros(len(yes), bool)
        found = np.flatnonzero(yes)
        for s, e in zip(*(x.tolist() for x in _runs(self.open))):
            near[s : min(e, s + slack + 1)] = True
            near[max(s, e - slack - 1) : e] = True
            i, j = np.searchsorted(found, [s, e])
            if i == j and e - s <= 3 * slack:
                near[s:e] = True
            elif i < j:
                near[found[i] : found[j - 1]] = True
        return self.open & near & ~self.in_sample & ~self.between(yes)

    def last_asked(self, repeated: list[int], more: list[int]) -> np.ndarray:
        """All that is not known and not enclosed after the first answers."""
        yes = flags(len(self.ranks), repeated) | flags(len(self.ranks), more)
        return self.open & ~self.in_sample & ~self.first_asked(repeated) & ~self.between(yes)


def flags(n: int, places: list[int] | None) -> np.ndarray:
    out = np.zeros(n, bool)
    if places:
        out[np.array(places, np.int64)] = True
    return out


def _long_ranks(segments: DataFrame, length: int) -> DataFrame:
    """(h, n): the repeated ranks of sampled positions at the second level."""
    bits = key_buckets(segments.sparkSession)

    def rank(batches):
        for b in batches:
            keys, counts = [], []
            for copies, data in zip(*(c.to_pylist() for c in b.columns)):
                keys.append(Stretch(data, length).sampled)
                counts.append(np.full(len(keys[-1]), copies))
            yield pack_keys(keys, counts, bits)

    return count_keys(segments.select("copies", "data").mapInArrow(rank, PACKED), 2)


def _rows(ids: list[int], places: list[np.ndarray], ranks: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    segment = np.repeat(np.array(ids, np.int64), [len(p) for p in places])
    flat = lambda x, t: np.concatenate(x).astype(t, copy=False) if x else np.array([], t)
    return pa.RecordBatch.from_arrays([pa.array(segment), pa.array(flat(places, np.int32)), pa.array(flat(ranks, np.uint64).view(np.int64))], names)


def _sample(segments: DataFrame, length: int, held) -> DataFrame:
    """(segment, p, h): the sampled open strings."""

    def pick(batches):
        for b in batches:
            ids, places, ranks = [], [], []
            for segment, data in zip(*(c.to_pylist() for c in b.columns)):
                x = Stretch(data, length, held.value)
                ids.append(segment), places.append(np.flatnonzero(x.in_sample)), ranks.append(x.ranks[places[-1]])
            yield _rows(ids, places, ranks, ["segment", "p", "h"])

    return segments.select("segment", "data").mapInArrow(pick, "segment long, p int, h long")


def _asked(segments: DataFrame, length: int, held) -> DataFrame:
    """(segment, p, h): the strings to ask about after what is known of each segment (repeated, more)."""

    def ask(batches):
        for b in batches:
            ids, places, ranks = [], [], []
            for segment, copies, data, repeated, more in zip(*(c.to_pylist() for c in b.columns)):
                if copies > 1:
                    continue  # all of it is repeated
                x = Stretch(data, length, held.value)
                want = x.first_asked(repeated) if more is None else x.last_asked(repeated, more)
                ids.append(segment), places.append(np.flatnonzero(want)), ranks.append(x.ranks[places[-1]])
            yield _rows(ids, places, ranks, ["segment", "p", "h"])

    return segments.select("segment", "copies", "data", "repeated", "more").mapInArrow(ask, "segment long, p int, h long")


def _answered(asked: DataFrame, segments: DataFrame, length: int, held) -> DataFrame:
    """(segment, places): the strings asked about that are repeated, among all open strings of all segments."""
    spark = segments.sparkSession
    bits = key_buckets(spark)
    wanted = spark.sparkContext.broadcast(bit_filter(asked, "h"))

    def look(batches):
        for b in batches:
            keys, counts = [], []
            for copies, data in zip(*(c.to_pylist() for c in b.columns)):
                x = Stretch(data, length, held.value)
                h = x.ranks[x.open]
                keys.append(h[in_filter(h, wanted.value)])
                counts.append(np.full(len(keys[-1]), copies))
            yield pack_keys(keys, counts, bits)

    yes = count_keys(segments.select("copies", "data").mapInArrow(look, PACKED), 2)
    return asked.join(yes.select("h"), "h").groupBy("segment").agg(F.collect_list("p").alias("places"))


def _covered(segments: DataFrame, length: int) -> DataFrame:
    """(v, s, e) of the bytes that repeated strings cover."""

    def cover(batches):
        for b in batches:
            vs, ss, es = [], [], []
            for v, a, copies, size, *lists in zip(*(c.to_pylist() for c in b.columns)):
                if copies > 1:
                    vs.append(v), ss.append(a), es.append(a + size)
                    continue
                at = sorted({p for x in lists if x for p in x})
                for i, p in enumerate(at):
                    if i and p - at[i - 1] <= length:
                        es[-1] = a + p + length
                    else:
                        vs.append(v), ss.append(a + p), es.append(a + p + length)
            yield pa.RecordBatch.from_arrays([pa.array(vs, pa.binary()), pa.array(ss, pa.int64()), pa.array(es, pa.int64())], ["v", "s", "e"])

    return segments.select("v", "a", "copies", F.octet_length("data").cast("long"), "repeated", "more", "rest").mapInArrow(cover, "v binary, s long, e long")


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(v, spans): sorted (s, e) of the bytes to remove, by the MD5 v of a text; texts without any are absent."""
    spark = docs.sparkSession
    ship(spark)
    body = docs.select(F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("v"), F.col(text).cast("binary").alias("t"))
    halves = spark.sparkContext.broadcast(bit_filter(_ranks(body, length), "h", RANK_BITS))
    segments = _segments(body, length, halves).groupBy("v", "a", "data").agg(F.count(F.lit(1)).alias("copies"))
    segments = stage(segments.withColumn("segment", F.monotonically_increasing_id()), "repeats-segments")
    held = spark.sparkContext.broadcast(bit_filter(_long_ranks(segments, length), "h", RANK_BITS))
    sample = stage(_sample(segments, length, held), "repeats-sample")
    copies = segments.where("copies > 1").select("segment", "copies")
    twice = (
        sample.join(copies, "segment", "left").groupBy("h").agg(F.sum(F.coalesce("copies", F.lit(1))).alias("n")).where("n > 1").select("h")
    )
    repeated = stage(sample.join(twice, "h").groupBy("segment").agg(F.collect_list("p").alias("repeated")), "repeats-repeated")
    none = F.lit(None).cast("array<int>")
    known = segments.join(repeated, "segment", "left")
    first = stage(_asked(known.withColumn("more", none), length, held), "repeats-asked")
    more = stage(_answered(first, segments, length, held).withColumnRenamed("places", "more"), "repeats-more")
    known = known.join(more, "segment", "left").withColumn("more", F.coalesce("more", F.array().cast("array<int>")))
    last = stage(_asked(known, length, held), "repeats-asked-last")
    rest = stage(_answered(last, segments, length, held).withColumnRenamed("places", "rest"), "repeats-rest")
    covered = _covered(known.join(rest, "segment", "left"), length)
    return stage(covered.groupBy("v").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans")), "repeats-spans")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """A row per document: key, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    spark = docs.sparkSession
    spans = repeated_spans(docs, text, length)
    held = spark.sparkContext.broadcast(bit_filter(spans.select(F.xxhash64("v").alias("h")), "h"))

    @F.pandas_udf("boolean")
    def may_have_spans(h: pd.Series) -> pd.Series:
        return pd.Series(in_filter(h.to_numpy().view(np.uint64), held.value))

    body = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")).withColumn("v", F.unhex(F.md5("t")))
    body = body.withColumn("flag", may_have_spans(F.xxhash64("v")))
    whole = body.where("not flag").select(key, F.octet_length("t").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("t").alias("kept"))

    names = whole.columns

    def cut(batches):
        for b in batches:
            size, removed, count, left = [], [], [], []
            for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                at, keep, n = 0, [], 0
                for x in spans or []:
                    if x["s"] > at or not n:
                        keep.append(t[at : x["s"]])
                        n += 1
                    at = max(at, x["e"])
                keep.append(t[at:])
                left.append(b"".join(keep)), size.append(len(t)), removed.append(len(t) - len(left[-1])), count.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (size, removed, count)), pa.array(left, pa.binary())], names)

    cuts = body.where("flag").join(spans, "v", "left").select(key, "t", "spans").mapInArrow(cut, whole.schema)
    return whole.unionByName(cuts)
