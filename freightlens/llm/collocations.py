"""Phrases that occur often, and how strongly their parts attract each other, by multikey quicksort of suffix pointers.

A suffix is up to five words of a piece. A first pass counts single words and pairs by 64-bit hashes; suffixes are cut where
a pair is infrequent, so what cannot lead to a frequent phrase is abandoned before anything is moved. A second pass routes
suffixes by their leading words to buckets; the bucket sorts pointers to them by a three-way quicksort, one word at a time:
the sizes of the equal partitions are the phrases' counts, and infrequent partitions are abandoned at once. Hashes only
choose what is routed and where to; words are compared as words.

Hot leading words: a suffix is routed by two words, and by one more as long as what it is routed by is itself very frequent.
The counts of such very frequent beginnings come from several buckets and are added up at the end. Equal suffixes are
merged before they are moved.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import GOLD, PACKED, bit_filter, count_keys, in_filter, mix, pack_keys, ship, stage

#: The separators of pieces. A-Z are lowered; a separator becomes a token of its own.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(b + 32 if 65 <= b <= 90 else 46 if b in SEPARATORS else b for b in range(256))
DEPTH = 5
#: Tokens that a worker handles at once, and bytes of a text that are split at once.
RUN, SLICE = 1 << 21, 1 << 22
#: Bytes of text whose suffixes share a bucket.
BUCKET_BYTES = 1 << 22
#: A longer beginning is looked at as very frequent only where one run alone has it so often.
LOCAL_HEAVY = 64
#: Tasks that a language's phrases are spread over.
SHARES = 256


class Run:
    """Tokens of some texts of one language: local ids in a row (0 ends a piece), and the words with their hashes."""

    def __init__(self, lang: str):
        self.lang, self.size, self.parts = lang, 0, []
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[b"."]

    def add(self, text: str) -> None:
        raw, at = text.encode().translate(FOLD), 0
        while at < len(raw):
            end = at + SLICE
            if end < len(raw):
                cut = max(raw.rfind(b" ", at, end), raw.rfind(b".", at, end))
                end = cut if cut > at else min((x for x in (raw.find(b" ", end), raw.find(b".", end)) if x >= 0), default=len(raw))
            tokens = raw[at:end].replace(b".", b" . ").split()
            self.parts.append(np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens)))
            self.size += len(tokens)
            at = end
        self.parts.append(np.zeros(1, np.int32))

    def hashes(self) -> np.ndarray:
        seed = xxhash.xxh3_64_intdigest(self.lang.encode())
        return mix(np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.ids), np.uint64, len(self.ids)))

    def slices(self):
        """(ids, number of positions that count): windows over the run that overlap by a phrase's length."""
        x = np.concatenate([*self.parts, np.zeros(DEPTH, np.int32)])
        n = len(x) - DEPTH
        for at in range(0, n, RUN):
            m = min(RUN, n - at)
            yield x[at : at + m + DEPTH], m


def runs_of(batches):
    open_runs: dict[str, Run] = {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            r = open_runs.get(lang)
            if r is None:
                r = open_runs[lang] = Run(lang)
            r.add(text)
            if r.size >= RUN or sum(x.size for x in open_runs.values()) >= 2 * RUN:
                yield open_runs.pop(lang)
    while open_runs:
        yield open_runs.popitem()[1]


def started(ids: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The hash of a beginning of one word."""
    return mix(h[ids] + np.uint64(1))


def extended(code: np.ndarray, ids: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The hash of a beginning with one more word."""
    return mix((code ^ (code >> np.uint64(29))) * GOLD + h[ids])


def _sums(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _count(bits: int):
    def count(batches):
        for run in runs_of(batches):
            h = run.hashes()
            for x, m in run.slices():
                inside = x[:m] > 0
                code = started(x[:m], h)
                at = np.flatnonzero(inside)
                found = [_sums(code[at])]
                for k in range(2, DEPTH):
                    code = extended(code, x[k - 1 : m + k - 1], h)
                    at = at[x[at + k - 1] > 0]
                    keys, n = _sums(code[at])
                    if k > 2:
                        keys, n = keys[n >= LOCAL_HEAVY], n[n >= LOCAL_HEAVY]
                    found.append((keys, n))
                    heavy = keys[n >= LOCAL_HEAVY]
                    at = at[_member(code[at], heavy)]
                yield pack_keys([f[0] for f in found], [f[1] for f in found], bits)

    return count


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


ROUTED = "bucket int, lang string, words binary, ids binary, counts binary, routes binary"


def _route(bits: int, frequent, hot):
    def blob(bucket: int, run: Run, words: list[bytes], suffixes: np.ndarray, counts: np.ndarray, routes: np.ndarray):
        used, back = np.unique(suffixes, return_inverse=True)
        if not len(used) or used[0]:
            used, back = np.concatenate([[0], used]), back + 1
        return bucket, run.lang, b".".join(words[i] for i in used.tolist()[1:]), back.reshape(suffixes.shape).astype(np.int32).tobytes(), counts.astype(np.int64).tobytes(), routes.astype(np.uint8).tobytes()

    def merged(suffixes: np.ndarray):
        order = np.lexsort(suffixes.T[::-1])
        s = suffixes[order]
        first = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]).any(axis=1)]))
        return s[first], np.diff(np.append(first, len(s)))

    def route(batches):
        often, very = frequent.value, hot.value
        for run in runs_of(batches):
            h, words = run.hashes(), list(run.ids)
            for x, m in run.slices():
                n = int(np.count_nonzero(x[:m]))
                single = np.bincount(x[:m], minlength=len(words))
                keep = np.flatnonzero(in_filter(started(np.arange(len(words)), h), often) & (single > 0))
                keep = keep[keep > 0]
                rows = [(np.stack([keep, *[np.zeros_like(keep)] * (DEPTH - 1)], axis=1), single[keep], np.ones(len(keep), np.uint8), started(keep, h))]
                # how far each suffix reaches over frequent pairs, up to the end of the window
                linked = in_filter(extended(started(x[:-1], h), x[1:], h), often) & (x[:-1] > 0) & (x[1:] > 0)
                at = np.flatnonzero(linked[:m])
                suffix = np.zeros((len(at), DEPTH), np.int32)
                suffix[:, 0], suffix[:, 1] = x[at], x[at + 1]
                going = np.ones(len(at), bool)
                for k in range(2, DEPTH):
                    going &= linked[at + k - 1]
                    suffix[going, k] = x[at[going] + k]
                if len(at):
                    suffix, counts = merged(suffix)
                    length = (suffix > 0).sum(axis=1)
                    key = extended(started(suffix[:, 0], h), suffix[:, 1], h)
                    reach = np.full(len(suffix), 2, np.uint8)
                    growing = in_filter(key, very)
                    for k in range(2, DEPTH + 1):
                        reach[growing] = k + 1
                        growing = growing & (length > k)
                        if k == DEPTH or not growing.any():
                            break
                        key = np.where(growing, extended(key, suffix[:, k], h), key)
                        growing &= in_filter(key, very)
                    rows.append((suffix, counts, reach, key))
                out = [(0, run.lang, b"", b"", np.array([n], np.int64).tobytes(), b"")] if n else []
                for suffixes, counts, routes, key in rows:
                    bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]])).tolist() if len(order) else []
                    for i, j in zip(cuts, cuts[1:]):
                        p = order[i:j]
                        out.append(blob(int(bucket[p[0]]), run, words, suffixes[p], counts[p], routes[p]))
                if out:
                    kinds = (pa.int32(), pa.string(), *[pa.binary()] * 4)
                    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], [c.split()[0] for c in ROUTED.split(", ")])

    return route


def quicksort_counts(words: np.ndarray, weights: np.ndarray, routes: np.ndarray, least: int):
    """(place of a suffix, number of words, count) of each beginning of two words or more that occurs `least` times.

    words: a row of word numbers per suffix, 0 after its end. A beginning shorter than its suffixes' route is counted in
    several buckets, so it is given whatever its count here, and its partition is never abandoned.
    """
    todo = [(np.arange(len(words)), 0)] if len(words) else []
    while todo:
        pointers, depth = todo.pop()
        column = words[pointers, depth]
        pivot = column[len(column) // 2]
        for part, equal in ((column < pivot, False), (column > pivot, False), (column == pivot, True)):
            p = pointers[part]
            if not len(p) or equal and not pivot:
                continue
            n = int(weights[p].sum())
            partial = bool((routes[p] > depth + 1).any())
            if n < least and not partial:
                continue
            if not equal:
                todo.append((p, depth))
                continue
            if depth:
                yield int(p[0]), depth + 1, n
            if depth + 1 < words.shape[1]:
                todo.append((p, depth + 1))


def _bucket(least: int):
    def counted(table: pa.Table) -> pa.Table:
        out: list[tuple[str, str, int, int]] = []
        by: dict[str, list] = defaultdict(list)
        for row in table.to_pylist():
            if row["routes"]:
                by[row["lang"]].append(row)
            else:
                out.append((row["lang"], "", 0, int(np.frombuffer(row["counts"], np.int64)[0])))
        for lang, rows in by.items():
            ids: defaultdict[bytes, int] = defaultdict()
            ids.default_factory = ids.__len__
            ids[b"."]
            words, weights, routes = [], [], []
            for row in rows:
                own = np.array([0, *(ids[w] for w in row["words"].split(b"."))], np.int32)
                words.append(own[np.frombuffer(row["ids"], np.int32)].reshape(-1, DEPTH))
                weights.append(np.frombuffer(row["counts"], np.int64))
                routes.append(np.frombuffer(row["routes"], np.uint8))
            words, weights, routes = np.concatenate(words), np.concatenate(weights), np.concatenate(routes)
            names = list(ids)
            alone = routes == 1
            sums = np.bincount(words[alone, 0], weights[alone], len(names)).astype(np.int64) if alone.any() else np.array([], np.int64)
            out += [(lang, names[i].decode(), 1, int(sums[i])) for i in np.flatnonzero(sums >= least)]
            words, weights, routes = words[~alone], weights[~alone], routes[~alone]
            for at, k, n in quicksort_counts(words, weights, routes, least):
                out.append((lang, b" ".join(names[i] for i in words[at, :k].tolist()).decode(), k, n))
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        return pa.Table.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], ["lang", "phrase", "words", "n"])

    return counted


def phrase_counts(docs: DataFrame, least: int, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, phrase, words, n): how often each phrase of one to five words occurs, where that is `least` times or more.

    The empty phrase with 0 words is there for every language with words: the number of all its words. A null language is
    `und`, a null text is empty. A phrase lies inside a piece between two of . , ; : ! ? and line breaks. Further columns
    are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(6, int(-(-size // BUCKET_BYTES)).bit_length())
    often = stage(count_keys(texts.mapInArrow(_count(bits), PACKED), least), "collocations-often")
    frequent = spark.sparkContext.broadcast(bit_filter(often, "h"))
    hot = spark.sparkContext.broadcast(bit_filter(often.where(F.col("n") >= max(least, (size >> bits) // 32)), "h"))
    routed = texts.mapInArrow(_route(bits, frequent, hot), ROUTED)
    found = routed.groupBy("bucket").applyInArrow(_bucket(least), "lang string, phrase string, words int, n long")
    counts = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("words") == 0))
    counts = stage(counts, "collocations-counts")
    for b in (frequent, hot):
        b.unpersist()
    return counts


def collocations(docs: DataFrame, least: int = 100, most: int = 2000, cover: int = 100, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `most` strongest phrases of two to five words.

    a is the phrase's count, n the number of the language's words; of the cuts into two parts with counts l and r, the one of
    lowest score floor(1000 * a * n / (l * r)) counts, then the one of the shortest first part. A phrase is dropped where a
    longer candidate that holds it has `cover` hundredths of its count. Ties in score go to the higher a, then to the phrase
    in UTF-8 byte order. Arithmetic is on decimals of 38 digits. Further columns are not read; an empty table gives no rows.
    """
    counts = phrase_counts(docs, least, lang, text)
    totals = counts.where("words = 0").select("lang", F.col("n").alias("total"))
    known = counts.where("words > 0").select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " "))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    # a language may hold most phrases: its total is given to many tasks
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    cuts = cuts.withColumn("share", share).join(totals.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long")))), ["lang", "share"])
    wide = "cast({} as decimal(19,0))"
    score = F.expr(f"(cast(1000 as decimal(4,0)) * {wide.format('a')} * {wide.format('total')}) div ({wide.format('l')} * {wide.format('r')})")
    cuts = cuts.select("lang", "phrase", "words", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"), F.col("total").alias("n"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.first("a").alias("a"), F.first("n").alias("n"), F.min("cut").alias("cut"))

    starts = F.sequence(F.lit(1), F.col("words") - 1)
    inner = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.when(i + size <= F.col("words") + 1, F.array_join(F.slice(words, i, size), " ")))))
    inside = candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")).where("phrase is not null")
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * cover))

    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    return kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most).select(
        "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
