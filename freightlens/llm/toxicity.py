"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posteriors.

Voters fire on a text or abstain: a fixed lexicon, and words and beginnings of words that labelled
training rows show to be precise. The label model is a mixture of two classes in which every voter,
the annotators' label among them, fires with its own rate in each class; rates are found by
expectation maximisation. Voters whose residuals correlate (a word and its own beginning) share their
evidence: the log-odds of each are divided by the sum of its correlations. A logistic regression on the
votes is then fitted to the posteriors; it scores texts without looking at labels or other columns.

Voters are searched in all labelled training rows. Fitting reads a bounded sample of them (`fit_rows`,
those with the smallest hash of their id) and at most `voters` voters; scoring is one pass over all documents without a shuffle.

Defined results: a null or empty text scores as a text on which no voter fires; rows without a label or
an id are not used for fitting; of repeated labels of an id the largest counts; without any labelled
row the fixed lexicon decides; an empty table gives an empty result; further columns are left alone, but a column `score` is
replaced by the result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import SMALL_BATCH_BYTES, bit_filter, in_filter, ship, stage
from freightlens.llm.words import alnum_words

FIT_ROWS, VOTERS, THRESHOLD = 20_000, 512, 0.3
BEGINNINGS = (4, 5, 6, 7, 8)

# Words that insult in most contexts.
LEXICON = [
    "bastard", "clown", "coward", "cretin", "disgusting", "dumb", "dumbass", "filth", "fool", "freak", "garbage", "idiot", "idiotic",
    "imbecile", "jerk", "loser", "lunatic", "moron", "moronic", "pathetic", "pig", "psycho", "retard", "scum", "shit", "stupid", "trash",
    "ugly", "vermin", "worthless",
]


def signs(words: set[bytes]) -> set[bytes]:
    """The words themselves and their beginnings, by bytes."""
    out = {b"=" + w for w in words}
    for k in BEGINNINGS:
        out.update(b"*" + w[:k] for w in words if len(w) > k)
    return out


@dataclass
class Classifier:
    voters: list[bytes]
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.words = {v[1:]: i for i, v in enumerate(self.voters) if v[:1] == b"="}
        self.starts = {v[1:]: i for i, v in enumerate(self.voters) if v[:1] == b"*"}
        self.heads = {v[: BEGINNINGS[0]] for v in self.starts}

    def votes(self, text: bytes | None) -> set[int]:
        """Numbers of the voters that fire."""
        words = set(alnum_words(text))
        out = {self.words[w] for w in words & self.words.keys()}
        k = BEGINNINGS[0]
        for w in words:
            if w[:k] in self.heads:
                out.update(self.starts[w[:n]] for n in BEGINNINGS if len(w) > n and w[:n] in self.starts)
        return out

    def score(self, text: bytes | None) -> float:
        return float(1 / (1 + np.exp(-(self.bias + sum(self.weights[i] for i in self.votes(text))))))


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 25, related_from: float = 0.3) -> np.ndarray:
    """The posterior of the class for each row of votes (0 or 1).

    Three more voters join: silence (no voter fires), and the annotators for and against. A voter that
    abstains gives no evidence. Correlations of residuals below `related_from` count as noise.
    """
    every = np.column_stack([votes, votes.sum(1) == 0, labels == 1, labels != 1]).astype(np.float32)
    posterior = np.where(labels == 1, 0.95, 0.02)
    for _ in range(rounds):
        prior = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        a = (posterior @ every + 0.1) / (posterior.sum() + 1)
        b = ((1 - posterior) @ every + 0.1) / ((1 - posterior).sum() + 1)
        cross = np.zeros((len(a), len(a)))
        for at in range(0, len(every), 2000):  # a block at a time, to hold few copies of the votes
            p = posterior[at : at + 2000, None]
            residual = every[at : at + 2000] - p * a - (1 - p) * b
            cross += residual.T @ residual
        spread = np.sqrt(np.diag(cross)) + 1e-9
        related = np.abs(cross / np.outer(spread, spread))
        related[-3:] = related[:, -3:] = 0  # these three are tied to the others by definition
        share = 1 / np.maximum(1, np.where(related >= related_from, related, 0).sum(1))
        odds = np.log(prior / (1 - prior)) + every @ (np.log(a / b) * share)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


def regression(votes: np.ndarray, target: np.ndarray, penalty: float = 0.05, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft targets, by Newton steps."""
    x = np.column_stack([votes, np.ones(len(votes))]).astype(np.float32)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve, pull = np.diag(ridge), -ridge * w
        for at in range(0, len(x), 2000):
            block, q = x[at : at + 2000].astype(float), p[at : at + 2000]
            curve = curve + (block * (q * (1 - q) + 1e-6)[:, None]).T @ block
            pull = pull + block.T @ (target[at : at + 2000] - q)
        step = np.linalg.solve(curve, pull)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-5:
            break
    return w[:-1], float(w[-1])


def _labelled(labels: DataFrame, key: str) -> DataFrame:
    """(_id, _toxic) of the labelled ids whose crc32 is not 2 modulo 4."""
    return (
        labels.where(F.col("toxic").isNotNull() & (F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) != 2))
        .groupBy(F.col(key).alias("_id")).agg(F.max("toxic").alias("_toxic"))
    )


def _training(docs: DataFrame, labels: DataFrame, key: str, text: str, fit_rows: int) -> DataFrame:
    """(text, toxic) of at most fit_rows labelled ids."""
    # The sample has at most fit_rows rows of an id and a flag.
    sample = F.broadcast(_labelled(labels, key).orderBy(F.xxhash64("_id"), "_id").limit(fit_rows))
    return docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("text")).join(sample, F.col("_key") == F.col("_id")).select("text", F.col("_toxic").alias("toxic"))


def _hashed(docs: DataFrame, key: str, text: str | None) -> DataFrame:
    """(h, _key[, text]) of the documents that have an id; h is the id's hash."""
    columns = [F.xxhash64(F.col(key).cast("string")).alias("h"), F.col(key).alias("_key")] + ([F.col(text).cast("binary").alias("text")] if text else [])
    return docs.where(F.col(key).isNotNull()).select(*columns)


def _id_filter(ids: DataFrame):
    """A broadcast filter of fixed size over ids, by their hash."""
    return ids.sparkSession.sparkContext.broadcast(bit_filter(ids.select(F.xxhash64(F.col("_id").cast("string")).alias("h")), "h"))


def _passing(batch: pa.RecordBatch, held) -> pa.RecordBatch:
    return batch.filter(pa.array(in_filter(batch.column(0).to_numpy().view(np.uint64), held.value)))


def _known(docs: DataFrame, key: str, text: str | None, held) -> DataFrame:
    """(_key[, text]) of the documents that pass a filter of ids: all of these ids, and a few others."""

    def keep(batches):
        for b in batches:
            yield _passing(b, held)

    rows = _hashed(docs, key, text)
    return rows.mapInArrow(keep, rows.schema).drop("h")


def _count(texts: DataFrame, among=None, held=None, most: int = 300_000) -> DataFrame:
    """(sign, n): rows of `texts` (h, text) that hold each sign, in parts; `among`: a broadcast filter of the signs that matter, `held`: one that h passes."""

    def count(batches):
        n: Counter = Counter()

        def part():
            names = list(n)
            if among is not None and names:
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
                names = [x for x, yes in zip(names, in_filter(hashes, among.value).tolist()) if yes]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([n[x] for x in names], pa.int64())], ["sign", "n"])

        for b in batches:
            for raw in (b if held is None else _passing(b, held)).column(1).to_pylist():
                n.update(signs(set(alnum_words(raw))))
                if len(n) > most:
                    yield part()
                    n.clear()
        yield part()

    return texts.select("h", "text").mapInArrow(count, "sign binary, n long")


def _sign_counts(docs: DataFrame, key: str, text: str, ids: DataFrame, among=None) -> DataFrame:
    """(sign, n), to be summed: the documents of `ids` that hold each sign.

    A filter of fixed size finds them where they are counted, so that a task needs one Python worker. What it lets through in
    excess is found by a join of ids and taken off, so texts of other rows are never moved.
    """
    held = _id_filter(ids)
    counts = _count(_hashed(docs, key, text), among, held)
    others = stage(_known(docs, key, None, held).join(ids, F.col("_key") == F.col("_id"), "left_anti").select(F.col("_key").alias("_id")).distinct(), "toxicity-others")
    if others.isEmpty():
        return counts
    excess = stage(_known(docs, key, text, _id_filter(others)).join(others, F.col("_key") == F.col("_id"), "left_semi").select(F.lit(0).cast("long").alias("h"), "text"), "toxicity-excess")
    return counts.union(_count(excess, among).select("sign", -F.col("n")))


def _candidates(docs: DataFrame, labels: DataFrame, key: str, text: str, voters: int) -> list[bytes]:
    """Signs whose share of toxic rows is high even at the lower end of its confidence interval, over all labelled rows.

    Such a sign stands in at least five toxic rows (its interval reaches below one half otherwise), so signs of toxic rows
    are counted first, and only those with enough in the other rows.
    """
    spark = docs.sparkSession
    labelled = stage(_labelled(labels, key), "toxicity-labels")
    bad = labelled.where("_toxic <> 0")
    seen = stage(_sign_counts(docs, key, text, bad).groupBy("sign").agg(F.sum("n").alias("toxic")).where("toxic >= 5"), "toxicity-signs")

    @F.pandas_udf("long")
    def hashed(x: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((xxhash.xxh3_64_intdigest(v) for v in x), np.uint64, len(x)).view(np.int64))

    among = spark.sparkContext.broadcast(bit_filter(seen.select(hashed("sign").alias("h")), "h"))
    counts = _sign_counts(docs, key, text, labelled, among)
    n, z = F.col("n").cast("double"), 2.0
    share = F.col("toxic") / n
    low = (share + z * z / 2 / n - z * F.sqrt(share * (1 - share) / n + z * z / 4 / n / n)) / (1 + z * z / n)
    best = (
        counts.groupBy("sign").agg(F.sum("n").alias("n")).join(seen, "sign")
        .withColumn("low", low).where("low > 0.5").orderBy((F.col("low") * F.log1p(n)).desc(), "sign").limit(voters)
    )
    return [bytes(r["sign"]) for r in best.collect()]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS, voters: int = VOTERS) -> Classifier:
    ship(docs.sparkSession, SMALL_BATCH_BYTES)
    training = _training(docs, labels, key, text, fit_rows)
    fixed = [b"=" + w.encode() for w in LEXICON]
    names = fixed + [v for v in _candidates(docs, labels, key, text, voters - len(fixed)) if v not in fixed]
    model = Classifier(names, np.zeros(len(names)), 0.0)

    def vote(batches):
        for b in batches:
            fired = [sorted(model.votes(x)) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(fired, pa.list_(pa.int32())), b.column(1).cast(pa.int32())], ["fired", "toxic"])

    seen = training.mapInArrow(vote, "fired array<int>, toxic int").collect()  # at most fit_rows rows
    votes, given = np.zeros((len(seen), len(names)), np.float32), np.array([r["toxic"] for r in seen])
    for i, r in enumerate(seen):
        votes[i, r["fired"]] = 1
    if not len(seen) or given.min() == given.max():
        return Classifier(names, np.where([v in fixed for v in names], 4.0, 0.0), -3.0)
    order = np.lexsort((*votes.T[:: max(1, len(names) // 8)], given))  # sums do not depend on the order of rows
    weights, bias = regression(votes[order], label_model(votes[order], given[order]))
    return Classifier(names, weights, bias)


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents without their text, with a score between 0 and 1."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key, text, **settings))
    rest = [c for c in docs.columns if c not in (text, "score")]

    def score(batches):
        model = held.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array([model.score(x) for x in b.column(0).to_pylist()], pa.float64())], [*rest, "score"])

    return docs.select(F.col(text).cast("binary"), *rest).mapInArrow(score, docs.select(*rest).withColumn("score", F.lit(0.0)).schema)


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, **settings) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key, text, **settings))

    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.score(x) < threshold for x in texts])

    return docs.where(accepted(F.col(text).cast("binary")))
