"""Near duplicates by weighted Jaccard similarity: BagMinHash signatures, bands, and exact verification.

A text is the multiset of its shingles of five words (a shorter text is one shingle). BagMinHash: every
shingle owns Poisson processes over unit steps of weight, grouped into the dyadic ranges [0,1), [1,2),
[2,4), [4,8) ... A range's first point is drawn at the rate of its width; then the range splits into
halves, of which one inherits the point and the other draws its own later one, down to single units. A
text of weight w sees the points below w only. Points fall on one of the signature's components, the
earliest point of a component is its value, and a process stops once it is later than every component,
so that a long text costs little more than one draw per shingle. Two signatures agree in a component
with the probability of the multisets' weighted Jaccard similarity.

Texts that agree in a band of components meet in a bucket. Pairs within a bucket are never listed: first
a text is compared with one hub, the text of its buckets that shares most of them. Texts whose buckets
then hold one class are done. The others are joined on their shingles, ordered from rare to frequent: a
pair that reaches the threshold first meets in a shingle so early in both texts that what follows it is
enough for the threshold, so a text offers only its rarest fifth, each shingle with the greatest length
of a text it can still be alike to. Copies that differ from each other in their own ways offer shingles
that no other text holds, however many they are. The order comes from a table of fixed size, which
decides how many candidates there are but not which pairs are found. All candidates are verified on the
shingles themselves.

Defined results: null and empty texts have no shingles and are duplicates of each other only, as equal
texts are; the class id is the smallest key of the class, null keys last; of repeated rows one stays; an empty
table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import GOLD, SMALL_BATCH_BYTES, bit_filter, components, in_filter, mix, rows_per_batch, ship, stage
from freightlens.llm.words import alnum_words, runs, word_hashes

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
#: Bits of a slot in the table of shingle counts that orders shingles (16 MB).
ORDER_BITS = 22


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    h = word_hashes(alnum_words(text))
    return runs(h, min(words, len(h))) if len(h) else h


def _draw(state: np.ndarray) -> np.ndarray:
    """Exponential variates of rate one from uint64 values."""
    return -np.log(((state >> np.uint64(11)) + np.uint64(1)) * 2.0**-53)


class _Signatures:
    def __init__(self, n: int, m: int):
        self.m, self.time, self.value = m, np.full(n * m, np.inf), np.zeros(n * m, np.uint64)

    def add(self, owner: np.ndarray, time: np.ndarray, point: np.ndarray) -> None:
        at = owner * self.m + (mix(point ^ GOLD) % np.uint64(self.m)).astype(np.int64)
        np.minimum.at(self.time, at, time)
        won = time == self.time[at]
        self.value[at[won]] = point[won]

    def latest(self) -> np.ndarray:
        return self.time.reshape(-1, self.m).max(1)


def bag_minhash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n x m) of n multisets, given as rows (owner, element, whole weight of at least one)."""
    out = _Signatures(n, m)
    parts = []  # (owner, state, low end, width, weight) of each dyadic range that the weight reaches
    low, width = 0, 1
    while True:
        at = weight > low
        if not at.any():
            break
        state = mix(element[at] + np.uint64(int(GOLD) * (low + 1) & (1 << 64) - 1))
        parts.append((owner[at], state, np.full(at.sum(), low), np.full(at.sum(), width), weight[at]))
        low, width = low + width, low + width if low else 1
    if not parts:
        return out.value.reshape(n, m)
    owner, state, low, width, weight = (np.concatenate(x) for x in zip(*parts))
    point = mix(state + np.uint64(1))
    time, fresh = _draw(point) / width, np.ones(len(owner), bool)
    rounds = 0
    while len(owner):
        emit = fresh & (low + width <= weight)
        out.add(owner[emit], time[emit], point[emit])
        go = time < out.latest()[owner]
        owner, state, low, width, weight, point, time, emitted = (x[go] for x in (owner, state, low, width, weight, point, time, emit | ~fresh))
        leaf = width == 1
        lo_owner, lo_state, lo_time, lo_low, lo_weight = owner[leaf], state[leaf], time[leaf], low[leaf], weight[leaf]
        # Units draw their next points; later rounds draw several at once.
        rounds += 1
        for _ in range(1 if rounds < 4 else 8):
            lo_state = mix(lo_state + GOLD)
            lo_point = mix(lo_state + np.uint64(1))
            lo_time = lo_time + _draw(lo_point)
            if rounds >= 4:
                out.add(lo_owner, lo_time, lo_point)
        # Wider ranges split: one half inherits the point, the other draws a later one.
        s = ~leaf
        half = width[s] // 2
        right = (mix(point[s] + np.uint64(7)) & np.uint64(1)).astype(np.int64)
        kids = []
        for heir in (True, False):
            side = right if heir else 1 - right
            kid_low = low[s] + side * half
            kid_state = mix(state[s] ^ (GOLD * (side.astype(np.uint64) + np.uint64(2))))
            kid_point = point[s] if heir else mix(kid_state + np.uint64(1))
            kid_time = time[s] if heir else time[s] + _draw(kid_point) / half
            kid_fresh = ~emitted[s] if heir else np.ones(len(half), bool)
            seen = kid_low < weight[s]
            kids.append(tuple(x[seen] for x in (owner[s], kid_state, kid_low, half, weight[s], kid_point, kid_time, kid_fresh)))
        unit = (lo_owner, lo_state, lo_low, np.ones(len(lo_owner), np.int64), lo_weight, lo_point if len(lo_owner) else lo_state, lo_time, np.full(len(lo_owner), rounds < 4))
        owner, state, low, width, weight, point, time, fresh = (np.concatenate(x) for x in zip(unit, *kids))
    return out.value.reshape(n, m)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(signatures), bands), np.uint64)
    for i in range(bands):
        x = np.full(len(signatures), i + 1, np.uint64)
        for j in range(rows):
            x = mix(x * GOLD + signatures[:, i * rows + j])
        out[:, i] = x
    return out


def sign_texts(texts: list[bytes | None], words: int, bands: int, rows: int):
    """(weights, band keys) of each text."""
    bags = [np.unique(shingles(t, words), return_counts=True) for t in texts]
    sizes = np.array([len(e) for e, _ in bags], np.int64)
    signatures = bag_minhash(
        np.repeat(np.arange(len(bags)), sizes), np.concatenate([e for e, _ in bags]) if bags else np.array([], np.uint64),
        np.concatenate([w for _, w in bags]).astype(np.int64) if bags else np.array([], np.int64), len(bags), bands * rows,
    )
    keys = band_keys(signatures, bands, rows).view(np.int64)
    return [(int(w.sum()), keys[i].tolist() if len(w) else []) for i, (_, w) in enumerate(bags)]


def occurrences(text: bytes | None, words: int) -> np.ndarray:
    """Sorted hashes of (shingle, how many of it came before): set intersection is multiset intersection."""
    s = np.sort(shingles(text, words))
    if not len(s):
        return s
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    rank = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    return np.sort(mix(s + GOLD * rank.astype(np.uint64)))


def _vertex(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _signed(docs: DataFrame, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """(v, n, bands) per distinct text."""

    def sign(batches):
        for b in batches:
            v, texts = b.column(0), b.column(1)
            at = 0
            while at < b.num_rows:  # texts of about a megabyte at a time
                end, size = at, 0
                while end < b.num_rows and (end == at or size < 1 << 20):
                    size += len(texts[end].as_buffer() or b"") if texts[end].is_valid else 0
                    end += 1
                got = sign_texts(texts[at:end].to_pylist(), words, bands, rows)
                yield pa.RecordBatch.from_arrays([v[at:end], pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.list_(pa.int64()))], ["v", "n", "bands"])
                at = end

    signed = docs.select(_vertex(text).alias("v"), F.col(text).cast("binary").alias("t")).mapInArrow(sign, "v binary, n long, bands array<long>")
    return signed.groupBy("v").agg(*(F.first(c).alias(c) for c in ("n", "bands")))


def _bags(docs: DataFrame, text: str, vertices: DataFrame, words: int) -> DataFrame:
    """(v, bag) of the texts among the vertices (and of few others): their shingles, numbered where they repeat."""
    held = docs.sparkSession.sparkContext.broadcast(bit_filter(vertices.select(F.xxhash64("v").alias("h")).distinct(), "h"))

    def hashed(batches):
        for b in batches:
            b = b.filter(pa.array(in_filter(b.column(0).to_numpy().view(np.uint64), held.value)))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([occurrences(x, words).tobytes() for x in b.column(2).to_pylist()], pa.binary())], ["v", "bag"])

    body = docs.select(F.xxhash64(_vertex(text)).alias("h"), _vertex(text).alias("v"), F.col(text).cast("binary").alias("t"))
    return body.mapInArrow(hashed, "v binary, bag binary").groupBy("v").agg(F.first("bag").alias("bag"))


def _verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches the threshold."""

    @F.pandas_udf("boolean")
    def verified(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            return both >= similarity * (len(x) + len(y) - both) - 1e-9

        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=bool)

    likely = stage(pairs, "near-likely")
    full = likely.join(bags.withColumnsRenamed({"v": "a", "bag": "ba"}), "a").join(bags.withColumnsRenamed({"v": "b", "bag": "bb"}), "b")
    with rows_per_batch(pairs.sparkSession, 500):  # a row holds two bags
        return stage(full.where(verified("ba", "bb")).select("a", "b"), "near-verified")


def _candidates(texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of texts (v, label, bag) with different labels, among them all whose similarity reaches the threshold."""
    spark, mask = texts.sparkSession, np.uint64((1 << ORDER_BITS) - 1)

    def slots(batches):
        for b in batches:
            x = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(0)] or [np.array([], np.uint64)])
            slot, n = np.unique(x & mask, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(n)], ["slot", "n"])

    counted = texts.select("bag").mapInArrow(slots, "slot int, n long").groupBy("slot").agg(F.least(F.sum("n"), F.lit((1 << 31) - 1)).cast("int").alias("n")).toArrow()
    counts = np.zeros(1 << ORDER_BITS, np.int32)
    counts[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    held = spark.sparkContext.broadcast(counts)

    def prefixes(batches):
        for b in batches:
            rows = []
            for i, bag in enumerate(b.column(2)):
                x = np.frombuffer(bag.as_buffer(), np.uint64)
                n, c = len(x), held.value[x & mask]
                # What a text shares with another lies behind the first shingle they share, which limits the other's length.
                most = np.floor((n - np.arange(n)) * (1 + 1 / similarity) - n + 1e-6).astype(np.int64)
                first = np.lexsort((x, c))[: np.count_nonzero(most >= similarity * n - 1e-6)]
                at = np.flatnonzero(c[first] > 1)
                rows.append((x[first[at]], np.full(len(at), i), np.full(len(at), n), most[at]))
            x, i, n, most = (np.concatenate(c) for c in zip(*rows)) if rows else (np.array([], np.int64),) * 4
            i = pa.array(i)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), b.column(0).take(i), b.column(1).take(i), pa.array(n), pa.array(most)], ["x", "v", "label", "n", "most"])

    offered = stage(texts.select("v", F.xxhash64("label").alias("label"), "bag").mapInArrow(prefixes, "x long, v binary, label long, n long, most long"), "near-offered")
    held_by = offered.groupBy("x").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("least")).where("low <> high").select("x", "least")
    offered = stage(offered.join(held_by, "x").where("most >= least").drop("least"), "near-offered")
    a, b = offered.alias("a"), offered.alias("b")
    met = a.join(b, (F.col("a.x") == F.col("b.x")) & (F.col("a.v") < F.col("b.v")) & (F.col("a.label") != F.col("b.label")) & (F.col("a.n") <= F.col("b.most")) & (F.col("b.n") <= F.col("a.most")))
    return met.select(F.col("a.v").alias("a"), F.col("b.v").alias("b")).distinct()


def near_links(docs: DataFrame, text: str = "text", words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(v, root) of the distinct texts that are linked to others; v is the MD5 of the text."""
    spark = docs.sparkSession
    ship(spark, SMALL_BATCH_BYTES)
    vertices = stage(_signed(docs, text, words, bands, rows), "near-signed")
    every = vertices.select("v", "n", F.explode("bands").alias("bucket"))
    shared = every.select("bucket", F.xxhash64("v").alias("h")).groupBy("bucket").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.count(F.lit(1)).alias("k")).where("low <> high").select("bucket", "k")
    members = every.join(shared, "bucket")
    members = stage(members.join(members.groupBy("v").agg(F.sum("k").alias("mass")), "v").select("bucket", "v", "n", "mass"), "near-members")
    bags = stage(_bags(docs, text, members, words), "near-bags")
    alike = (F.col("n") >= similarity * F.col("pn") - 1e-9) & (F.col("pn") >= similarity * F.col("n") - 1e-9)

    # The text with the most company is the hub of its buckets; a text first meets the greatest hub only.
    hubs = members.groupBy("bucket").agg(F.max_by(F.struct(F.col("v").alias("p"), F.col("n").alias("pn"), F.col("mass").alias("pm")), F.struct("mass", "v")).alias("x")).select("bucket", "x.*")
    best = members.join(hubs, "bucket").where((F.col("v") != F.col("p")) & alike).groupBy("v").agg(F.max_by("p", F.struct("pm", "p")).alias("p"))
    best = best.select(F.least("v", "p").alias("a"), F.greatest("v", "p").alias("b")).distinct()
    labels = stage(components(_verified(best, bags, similarity), "near-components"), "near-labels")

    labelled = members.join(labels, "v", "left").select("bucket", "v", F.coalesce("root", "v").alias("label"))
    mixed = labelled.select("bucket", F.xxhash64("label").alias("h")).groupBy("bucket").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("bucket")
    mixed = stage(labelled.join(mixed, "bucket").select("v", "label").distinct(), "near-mixed")
    found = _verified(_candidates(mixed.join(bags, "v"), similarity), bags, similarity)
    return stage(components(found.union(labels.where("v <> root").toDF("a", "b")), "near-components"), "near-labels")


def _classes(docs: DataFrame, key: str, text: str, **settings) -> tuple[DataFrame, DataFrame]:
    """The rows with their class, and (class, class_id, class_size)."""
    links = near_links(docs, text, **settings)
    rows = docs.withColumn("_v", _vertex(text))
    classes = (
        rows.select(F.col("_v"), F.col(key).alias("_key")).groupBy("_v").agg(F.min("_key").alias("low"), F.count(F.lit(1)).alias("n"))
        .join(links.withColumnRenamed("v", "_v"), "_v", "left").withColumn("_class", F.coalesce("root", "_v"))
    )
    sums = classes.groupBy("_class").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"))
    return rows, classes.select("_v", "_class").join(sums, "_class")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """A row per document: its key, class_id (smallest key of its class), class_size, kept."""
    rows, classes = _classes(docs, key, text, **settings)
    classes = stage(classes, "near-classes")
    one = Window.partitionBy(key, "_class").orderBy(F.lit(1))
    return rows.select(key, "_v").join(classes, "_v").select(
        key, "class_id", "class_size", (F.col(key).eqNullSafe(F.col("class_id")) & (F.row_number().over(one) == 1)).alias("kept")
    )


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One document of each class, with all columns. Only rows that may have copies are shuffled."""
    spark = docs.sparkSession
    rows, classes = _classes(docs, key, text, **settings)
    several = stage(classes.where("class_size > 1"), "near-classes")
    held = spark.sparkContext.broadcast(bit_filter(several.select(F.xxhash64("_v").alias("h")), "h"))

    @F.pandas_udf("boolean")
    def may_have_copies(h: pd.Series) -> pd.Series:
        return pd.Series(in_filter(h.to_numpy().view(np.uint64), held.value))

    flagged = rows.withColumn("_flag", may_have_copies(F.xxhash64("_v")))
    joined = flagged.where("_flag").join(several, "_v", "left")
    first = joined.where(F.col("class_size").isNotNull() & F.col(key).eqNullSafe(F.col("class_id"))).withColumn("_n", F.row_number().over(Window.partitionBy("_class").orderBy(F.lit(1))))
    parts = (flagged.where(~F.col("_flag")), joined.where("class_size is null"), first.where("_n = 1"))
    return parts[0].select(*docs.columns).unionByName(parts[1].select(*docs.columns)).unionByName(parts[2].select(*docs.columns))
