"""Language-model scores by a probabilistic suffix tree over words.

States of the tree are contexts of one to `depth` words. A context is a candidate when it occurs at
least `min_count` times, whatever the size of the input, so the tree grows with the corpus. Its next-symbol distribution keeps the words seen twice or more after it,
discounted, and gives the rest of the mass to the distribution of its longest retained suffix; the
root is the add-one distribution of single words. A context stays when its distribution diverges from
its suffix's: the log-likelihood of its own occurrences, each scored as if it had not been counted,
must gain `least_gain` nats in all and `least_rate` per occurrence. A text is scored by the longest
retained suffix at each token.

A phrase of words has one key, whether it is a context or a context and the word after it, so the whole
tree is one table of (key, count, rest): the count of a phrase is both the number of times its last word
follows the others and its size as a context, and rest is the share it gives to its suffix (1 for a
phrase that is no retained context). The keys of the contexts before a token are those of the phrases that
end at the token before.

Counts come from all training texts: words and phrases as packed arrays per partition and hash bucket,
which a bucket's task merges by sorting. Nothing is grouped by context, so a frequent word is spread over
all buckets. A filter of fixed size leaves out most contexts that are no candidates, and a join the rest.
For scoring, texts are cut into blocks of rows. Phrases that a table of the most frequent ones (of fixed
size) and filters of fixed size can't settle are asked for once a block, as packed keys dealt by hash
bucket; a bucket's task looks them up in its share of the tree, and the answers go back to the block,
which is then scored. No step makes a row per token.

Words are told apart by 64-bit hashes. Defined results: a null text counts as empty and has the end
token only; a null id counts as held in (crc32 of no text is taken as 0); repeated rows are counted
and scored as often as they occur; an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import GOLD, PACKED, bit_filter, count_keys, discard, in_filter, key_buckets, mix, pack_keys, release, ship, stage

DEPTH, MIN_COUNT = 2, 8
DISCOUNT, LEAST_GAIN, LEAST_RATE = 0.75, 5.0, 0.01
FREQUENT = 1 << 19
#: Bytes of text of a block of rows that is scored as one, and phrases that one bucket of questions holds.
BLOCK_BYTES, BUCKET_KEYS = 1 << 21, 1 << 20
END = 0x5851F42D4C957F2D  # the hash of the end token, which is no word's

#: Lower-cases A-Z; bytes.split() then cuts at blanks, tabs to carriage returns.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the words and the end."""
    words = text.translate(LOWER).split() if text else []
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def extend(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The key of a phrase, from those of the phrase without its last word and without its first; a phrase of one word has the word's hash."""
    return mix(context * GOLD + suffix)


def each_once(keys: np.ndarray) -> np.ndarray:
    """The keys in order, each once."""
    k = np.sort(keys)
    return k[np.concatenate([[True], k[1:] != k[:-1]])] if len(k) else k


def token_runs(texts: list[bytes | None], size: int = 200_000):
    """(tokens of some texts side by side, where each text begins) for about `size` tokens at a time."""
    run, begins, n = [], [], 0
    for x in texts:
        t = tokens(x)
        run.append(t), begins.append(n)
        n += len(t)
        if n >= size:
            yield np.concatenate(run), np.array(begins)
            run, begins, n = [], [], 0
    if run:
        yield np.concatenate(run), np.array(begins)


def phrases(t: np.ndarray, depth: int) -> list[np.ndarray]:
    """For lengths 1 to `depth` + 1: the key of the phrase that ends at each token, also where it reaches beyond its text; see inside()."""
    out = [t]
    for _ in range(depth):
        x = np.zeros(len(t), np.uint64)
        x[1:] = extend(out[-1][:-1], out[-1][1:])
        out.append(x)
    return out


def inside(t: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How many tokens of its text lie before each token."""
    return np.arange(len(t)) - np.repeat(begins, np.diff(np.append(begins, len(t))))


def before(keys: np.ndarray) -> np.ndarray:
    """What stands at the token before."""
    out = np.zeros_like(keys)
    out[1:] = keys[:-1]
    return out


def _words(training: DataFrame) -> DataFrame:
    """(h, c) of all training tokens."""
    bits = key_buckets(training.sparkSession)

    def count(batches):
        for b in batches:
            keys, counts = [], []
            for t, _ in token_runs(b.column(0).to_pylist(), 400_000):
                k, n = np.unique(t, return_counts=True)
                keys.append(k), counts.append(n)
            yield pack_keys(keys, counts, bits)

    return count_keys(training.mapInArrow(count, PACKED), 1).withColumnRenamed("n", "c")


def _freed(spark, made):
    """`made`, once Spark may remove the shuffle files of what it took."""
    release(spark)
    return made


def _position(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands in a sorted table, -1 where it doesn't."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _packed(bucket: np.ndarray, block: int | None, *columns: np.ndarray) -> list[tuple]:
    """Rows (bucket, [block,] blobs of the columns), one per bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [x[order] for x in columns]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist() if len(bucket) else []
    lead = () if block is None else (block,)
    return [(int(bucket[i]), *lead, *[x[i:j].tobytes() for x in columns]) for i, j in zip(cuts, cuts[1:])]


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32() if n == "bucket" else pa.int64() if n == "block" else pa.binary() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _joined(table: pa.Table, **kinds) -> list[np.ndarray]:
    """Blobs of a bucket, joined to one array per column."""
    return [np.concatenate([np.frombuffer(x.as_buffer(), k) for x in table[c]] or [np.array([], k)]) for c, k in kinds.items()]


def _pairs(training: DataFrame, held, again, depth: int) -> DataFrame:
    """(ctx, k, s, c): phrases k seen at least twice, whose first `depth` words ctx pass the filter `held`; s is the phrase without its first word.

    `again` is a filter of the suffixes seen twice, or None: no phrase is seen twice whose suffix is not.
    """
    bits = key_buckets(training.sparkSession)
    names = ["bucket", "ctx", "s", "n"]

    def pack(ctx, s):
        k = extend(ctx, s)
        order = np.argsort(k)
        k, ctx, s = k[order], ctx[order], s[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.array([], int)
        n = np.diff(np.append(first, len(k))).astype(np.uint32)
        return _batch(_packed((mix(k[first]) >> np.uint64(64 - bits)).astype(np.int64), None, ctx[first], s[first], n), names)

    def collect(batches):
        parts, size = [], 0
        for b in batches:
            for t, begins in token_runs(b.column(0).to_pylist()):
                s = phrases(t, depth - 1)[-1]
                ctx = before(s)
                yes = np.flatnonzero(inside(t, begins) >= depth)
                yes = yes[in_filter(ctx[yes], held.value)]
                if again.value is not None:
                    yes = yes[in_filter(s[yes], again.value)]
                parts.append((ctx[yes], s[yes]))
                size += len(yes)
                if size > 1_500_000:
                    yield pack(*map(np.concatenate, zip(*parts)))
                    parts, size = [], 0
        if size:
            yield pack(*map(np.concatenate, zip(*parts)))

    def merge(table):
        ctx, s, n = _joined(table, ctx=np.uint64, s=np.uint64, n=np.uint32)
        k = extend(ctx, s)
        order = np.argsort(k)
        k, n = k[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        c = np.add.reduceat(n, first)
        first, c = first[c > 1], c[c > 1]
        return pa.table({"ctx": ctx[order[first]].view(np.int64), "k": k[first].view(np.int64), "s": s[order[first]].view(np.int64), "c": c})

    packed = training.mapInArrow(collect, "bucket int, ctx binary, s binary, n binary")
    return packed.groupBy("bucket").applyInArrow(merge, "ctx long, k long, s long, c long")


def _most(table: DataFrame, size: int) -> list[np.ndarray]:
    """Columns (k, c, ...) of the rows with the largest counts c, at most `size`, by key k; the threshold comes from a histogram."""
    total, least = 0, None
    for r in table.groupBy(F.least("c", F.lit(4096)).alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect():
        total += r["n"]
        if total > size:
            break
        least = r["c"]
    got = (table.limit(0) if least is None else table.where(F.col("c") >= least)).toArrow()
    out = [got[c].to_numpy() for c in table.columns]
    out[0] = out[0].view(np.uint64)
    order = np.argsort(out[0])
    return [x[order] for x in out]


def _level(pairs: DataFrame, sizes: DataFrame, below: DataFrame, d: int) -> tuple[DataFrame, DataFrame]:
    """(retained contexts (k, c, rest), phrases (k, c, own, p)).

    sizes: (ctx, n) of the candidates; below: the probability (s, par) of a phrase's last word at its longest retained
    suffix. p is the same one level up, own tells phrases whose context is retained. A phrase seen twice has a
    suffix that was seen twice, so every phrase has its row below.
    """
    taken = pairs.groupBy("ctx").agg(F.sum(F.col("c") - DISCOUNT).alias("taken"), F.sum("c").alias("seen"))
    # The join with sizes also drops contexts that only pass the filter.
    rest = taken.join(sizes, "ctx").select("ctx", "n", "seen", (1 - F.col("taken") / F.col("n")).alias("rest"))
    rows = _freed(pairs.sparkSession, stage(pairs.join(rest, "ctx").join(below, "s").drop("s"), f"lm-rows-{d}"))
    without = F.when(F.col("c") >= 3, (F.col("c") - 1 - DISCOUNT) / F.greatest(F.col("n") - 1, F.lit(1))).otherwise(0.0)
    gain = F.col("c") * F.log((without + F.col("rest") * F.col("par")) / F.col("par"))
    # n, seen and rest are the same in all rows of a context.
    gains = rows.groupBy("ctx").agg(F.sum(gain).alias("gain"), *[F.max(c).alias(c) for c in ("n", "seen", "rest")])
    gains = gains.withColumn("gain", F.col("gain") + (F.col("n") - F.col("seen")) * F.log("rest"))
    kept = stage(gains.where((F.col("gain") > LEAST_GAIN) & (F.col("gain") > LEAST_RATE * F.col("n"))).select(F.col("ctx").alias("k"), F.col("n").alias("c"), "rest"), f"lm-kept-{d}")
    marked = rows.join(kept.select(F.col("k").alias("ctx"), F.lit(True).alias("own")), "ctx", "left").withColumn("own", F.coalesce("own", F.lit(False)))
    p = F.when(F.col("own"), (F.col("c") - DISCOUNT) / F.col("n") + F.col("rest") * F.col("par")).otherwise(F.col("par"))
    known = stage(marked.select("k", "c", "own", p.alias("p")), f"lm-known-{d}")
    discard(rows)
    return kept, known


def suffix_tree(training: DataFrame, depth: int = DEPTH, min_count: int = MIN_COUNT):
    """(words (h, c), total, distinct, levels); a level is (contexts, n, rest) arrays of the most frequent retained contexts,
    the table (k, c, rest) of all of them, and the table (k, c) of the phrases that are counted after one."""
    ship(training.sparkSession)
    spark = training.sparkSession
    words = stage(_words(training), "lm-words")
    release(spark)
    sums = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"]
    below = words.select(F.col("h").alias("s"), ((F.col("c") + 1) / F.lit(float(total + distinct + 1))).alias("par"), "c").where("c > 1").drop("c")
    # The end is no context; nothing follows it, so longer phrases that end with it drop out by themselves.
    sizes = words.where((F.col("c") >= min_count) & (F.col("h") != int(np.uint64(END).view(np.int64)))).select(F.col("h").alias("ctx"), F.col("c").alias("n"))
    levels = []
    for d in range(1, depth + 1):
        if sizes.isEmpty():
            break
        # Most words are seen twice, most longer phrases are not.
        filters = [spark.sparkContext.broadcast(_freed(spark, x)) for x in (bit_filter(sizes, "ctx"), bit_filter(below, "s") if d > 1 else None)]
        pairs = _freed(spark, stage(_pairs(training, *filters, d), f"lm-pairs-{d}"))
        kept, known = _level(pairs, sizes, below, d)
        discard(pairs)
        release(spark)
        levels.append((*_most(kept, FREQUENT), kept, known.where("own").select("k", "c")))
        below = known.select(F.col("k").alias("s"), F.col("p").alias("par"))
        sizes = known.where(F.col("c") >= min_count).select(F.col("k").alias("ctx"), F.col("c").alias("n"))
    return words, total, distinct, levels


def _blocks(docs: DataFrame) -> DataFrame:
    """(block, key, text): rows side by side up to BLOCK_BYTES of text, or one longer text, make a block; written, so that blocks stay as they are."""
    kind = dict(docs.dtypes)["key"]

    def deal(batches):
        block, size = TaskContext.get().partitionId() << 33, 0
        for b in batches:
            numbers = []
            for n in pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist():
                if size and size + n > BLOCK_BYTES:
                    block, size = block + 1, 0
                size += n + 16
                numbers.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), b.column(0), b.column(1)], ["block", "key", "text"])

    return stage(docs.mapInArrow(deal, f"block long, key {kind}, text binary"), "lm-blocks")


def lm_scores(docs: DataFrame, training: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """A row per document: key, n_tokens, n_known, base_score, score and train_tokens, with a tree of `depth` grown on `training` (one column of texts)."""
    spark = docs.sparkSession
    words, total, distinct, levels = suffix_tree(training.select(F.col(training.columns[0]).cast("binary")), depth)
    depth, norm = len(levels), float(total + distinct + 1)
    parts = [words.select(F.col("h").alias("k"), "c", F.lit(1.0).alias("rest"))]
    for level in levels:
        parts += [level[4].select("k", "c", F.lit(1.0).alias("rest")), level[3]]
    tree = reduce(DataFrame.union, parts)

    def tidy(k, c, rest):
        """Each key once: a phrase and a context of the same words have the same count, and the context's rest holds."""
        order = np.lexsort((rest, k))
        k, c, rest = k[order], c[order], rest[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.array([], int)
        return k[first], c[first], rest[first]

    most = spark.sparkContext.broadcast(tidy(*_most(tree, FREQUENT)))
    held = spark.sparkContext.broadcast(_freed(spark, bit_filter(tree, "k")))
    states = spark.sparkContext.broadcast(_freed(spark, bit_filter(tree.where("rest < 1").select("k"), "k")))
    bits = max(key_buckets(spark), int(max(total, 1) * (depth + 1) // BUCKET_KEYS).bit_length())

    def bucket(k: np.ndarray) -> np.ndarray:
        return (mix(k) >> np.uint64(64 - bits)).astype(np.int64)

    def phrases_of(texts):
        """Of some texts: begins, keys of phrases by length, and which matter: those whose context may be retained, or that may be a retained one."""
        for t, begins in token_runs(texts):
            keys, place = phrases(t, depth), inside(t, begins)
            maybe = [in_filter(k, states.value) for k in keys[:-1]] + [np.zeros(len(t), bool)]
            yield begins, keys, [np.ones(len(t), bool)] + [(place >= d) & (before(maybe[d - 1]) | maybe[d]) for d in range(1, depth + 1)]

    def ask(batches):
        at, wanted, size = None, [], 0
        names = ["bucket", "block", "keys"]

        def flush():
            k = each_once(np.concatenate(wanted)) if wanted else np.array([], np.uint64)
            k = k[_position(most.value[0], k) < 0]
            return _batch(_packed(bucket(k), at, k), names)

        for b in batches:
            blocks = b.column(0).to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]])).tolist() if len(blocks) else []
            for i, j in zip(cuts, cuts[1:]):
                if at is not None and (blocks[i] != at or size > 4 * BUCKET_KEYS):
                    yield flush()
                    wanted, size = [], 0
                at = int(blocks[i])
                for _, keys, matter in phrases_of(b.column(2).slice(i, j - i).to_pylist()):
                    k = each_once(np.concatenate([x[m] for x, m in zip(keys, matter)]))
                    wanted.append(k[in_filter(k, held.value)])
                    size += len(wanted[-1])
        if at is not None:
            yield flush()

    def pack(batches):
        parts, size = [], 0
        for b in batches:
            parts.append(b)
            size += b.num_rows
            if size >= BUCKET_KEYS:
                yield blobs(parts)
                parts, size = [], 0
        if size:
            yield blobs(parts)

    def blobs(parts):
        k, c, rest = (np.concatenate([b.column(i).to_numpy() for b in parts]) for i in range(3))
        k = k.view(np.uint64)
        return _batch(_packed(bucket(k), None, k, c, rest), ["bucket", "keys", "c", "rest"])

    answer_kind = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("c", pa.binary()), ("rest", pa.binary())])

    def answer(asked, have):
        k, c, rest = tidy(*_joined(have, keys=np.uint64, c=np.int64, rest=np.float64))
        rows = []
        for block, x in zip(asked["block"].to_pylist(), asked["keys"]):
            at = _position(k, np.frombuffer(x.as_buffer(), np.uint64))
            at = at[at >= 0]
            if len(at):
                rows.append((block, k[at].tobytes(), c[at].tobytes(), rest[at].tobytes()))
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(answer_kind)], schema=answer_kind)

    kind = dict(docs.dtypes)[key]

    def score(block, answers):
        own = _joined(answers, keys=np.uint64, c=np.int64, rest=np.float64)
        order = np.argsort(own[0])
        tables = [most.value, [x[order] for x in own]]

        def look(keys):
            """(count, rest) of each key."""
            u, place = np.unique(keys, return_inverse=True)
            c, rest = np.zeros(len(u), np.int64), np.ones(len(u))
            for names, counts, shares in tables:
                at = _position(names, u)
                yes = np.flatnonzero(at >= 0)
                c[yes], rest[yes] = counts[at[yes]], shares[at[yes]]
            return c[place], rest[place]

        sizes, seen, base, full = [], [], [], []
        for begins, keys, matter in phrases_of(block["text"].to_pylist()):
            n = len(keys[0])
            c, rest = np.zeros((depth + 1, n), np.int64), np.ones((depth + 1, n))
            matter = np.array(matter)
            c[matter], rest[matter] = look(np.array(keys)[matter])
            p = p0 = (c[0] + 1) / norm
            first = np.zeros(n, bool)
            first[begins] = True
            for d in range(1, depth + 1):
                # A phrase that reaches beyond its text was not looked up, so no context before a text's first token is retained.
                share = np.where(first, 1.0, before(rest[d - 1]))
                p = np.where(share < 1, np.where(c[d] > 1, (c[d] - DISCOUNT) / np.maximum(before(c[d - 1]), 1), 0) + share * p, p)
            sizes += np.diff(np.append(begins, n)).tolist()
            seen += np.add.reduceat(c[0] > 0, begins, dtype=np.int64).tolist()
            base += np.add.reduceat(np.log10(p0), begins).tolist()
            full += np.add.reduceat(np.log10(p), begins).tolist()
        return pa.table({"key": block["key"], "n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(seen, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(full, pa.float64())})

    blocks = _blocks(docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")))
    asked = blocks.mapInArrow(ask, "bucket int, block long, keys binary").groupBy("bucket")
    have = tree.mapInArrow(pack, "bucket int, keys binary, c binary, rest binary").groupBy("bucket")
    answers = asked.cogroup(have).applyInArrow(answer, "block long, keys binary, c binary, rest binary")
    out = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, f"key {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("key").alias(key), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
