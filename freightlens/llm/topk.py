"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become sparse rows of (term, integer weight), packed into blocks of a fixed number of rows and entries. Every block
of queries meets every block of candidates once, in a product of shares of both tables: a task reads its two shares from the
shared folder, so no block is copied for a join, neither through a shuffle nor through the driver. Where they meet, the
candidate block is turned into postings; each query scatters its weighted postings into a dense array of scores, and a
partition selection keeps its k best of the block. A task merges its blocks, and shares are merged by a ranked window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import ship, stage

#: Rows and entries of a block, whichever comes first.
CANDIDATE_ROWS, QUERY_ROWS, ENTRIES = 8192, 512, 1 << 20
#: Query blocks of a share, so that postings serve many queries, and most shares of queries.
SHARE_BLOCKS, QUERY_SHARES = 8, 256
#: Most shares of the candidates, as each gives k rows a query; where there are few queries, as many as make so many tasks.
CANDIDATE_SHARES, TASKS = 8, 64
#: Weights beyond these saturate; sums beyond the long range do too.
LIMIT = 1 << 62

BLOCKS = "ids binary, starts binary, terms binary, weights binary"


def _pack(limit: int):
    def pack(batches):
        ids, sizes, terms, weights, entries = [], [], [], [], 0

        def block():
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            n = np.array(sizes, np.int64)
            at = np.concatenate([[0], np.cumsum(n)])
            pick = np.concatenate([np.arange(at[i], at[i + 1]) for i in order]) if entries else np.array([], np.int64)
            t, w = (np.concatenate(x)[pick] if x else np.array([], np.int64) for x in (terms, weights))
            starts = np.concatenate([[0], np.cumsum(n[order])])
            columns = (np.array(ids, np.int64)[order], starts, t.astype(np.int32), w.astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["ids", "starts", "terms", "weights"])

        for b in batches:
            t, w = b.column("terms"), b.column("weights")
            edge = np.asarray(t.offsets).astype(np.int64)
            flat_t, flat_w = np.asarray(t.values), np.asarray(w.values)
            edge_w = np.asarray(w.offsets).astype(np.int64)
            for i, key in enumerate(b.column("id").to_pylist()):
                ids.append(key)
                sizes.append(int(edge[i + 1] - edge[i]))
                terms.append(flat_t[edge[i] : edge[i + 1]])
                weights.append(flat_w[edge_w[i] : edge_w[i + 1]])
                entries += sizes[-1]
                if len(ids) >= limit or entries >= ENTRIES:
                    yield block()
                    ids, sizes, terms, weights, entries = [], [], [], [], 0
        if ids:
            yield block()

    return pack


class Postings:
    """A candidate block by term: the places of the rows that hold it and their weights; a term that most rows hold is a full column."""

    def __init__(self, ids: bytes, starts: bytes, terms: bytes, weights: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        sizes = np.diff(np.frombuffer(starts, np.int64))
        term, weight = np.frombuffer(terms, np.int32), np.frombuffer(weights, np.int64)
        rows = np.repeat(np.arange(len(self.ids)), sizes)
        order = np.argsort(term, kind="stable")
        term, rows, weight = term[order], rows[order], weight[order]
        self.largest = int(max(weight.max(), -weight.min())) if len(weight) else 0
        self.longest = int(sizes.max()) if len(sizes) else 0
        cuts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1], [True]])) if len(term) else []
        narrow = np.int32 if self.largest < 1 << 31 else np.int64
        self.lists = {}
        for i, j in zip(cuts, cuts[1:]):
            w = weight[i:j].astype(narrow)
            if (j - i) * 4 > len(self.ids):
                column = np.zeros(len(self.ids), narrow)
                column[rows[i:j]] = w
                self.lists[int(term[i])] = (None, column)
            else:
                self.lists[int(term[i])] = (rows[i:j], w)

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The exact inner product of a query with every row of the block."""
        most = self.largest * int(np.abs(weights).max(initial=0)) * max(1, min(len(terms), self.longest))
        kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
        total = np.zeros(len(self.ids), kind)
        for term, weight in zip(terms.tolist(), weights.tolist()):
            if term in self.lists:
                rows, w = self.lists[term]
                part = w.astype(kind, copy=False) * (weight if kind is object else kind(weight))
                if rows is None:
                    total += part
                else:
                    total[rows] += part
        return np.clip(total, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id (ids ascend), without the rows of the query's own id."""
    place = np.flatnonzero(ids != own)
    if len(place) <= k:
        return place
    s = scores[place]
    least = np.partition(s, len(s) - k)[len(s) - k]
    above = place[s > least]
    return np.concatenate([above, place[s == least][: k - len(above)]])


def merged(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with their ids, highest first, ties to the smaller id."""
    order = np.lexsort((ids, ~scores))[:k]
    return ids[order], scores[order]


def _score(k: int):
    def score(batches):
        known, postings, kept, none = None, None, {}, np.array([], np.int64)
        for b in batches:
            for row in b.to_pylist():
                if row["block"] != known:
                    known, postings = row["block"], Postings(row["ids"], row["starts"], row["terms"], row["weights"])
                q_ids, q_at = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_starts"], np.int64)
                q_terms, q_weights = np.frombuffer(row["q_terms"], np.int32), np.frombuffer(row["q_weights"], np.int64)
                found = kept.setdefault(row["q_block"], [(own, none, none) for own in q_ids.tolist()])
                for i, (own, ids, best_scores) in enumerate(found):
                    scores = postings.scores(q_terms[q_at[i] : q_at[i + 1]], q_weights[q_at[i] : q_at[i + 1]])
                    place = np.flatnonzero(scores >= best_scores[-1]) if len(ids) == k else np.arange(len(scores))
                    if len(place):
                        keep = place[best(scores[place], postings.ids[place], own, k)]
                        found[i] = (own, *merged(np.concatenate([ids, postings.ids[keep]]), np.concatenate([best_scores, scores[keep]]), k))
        for found in kept.values():
            columns = ([np.full(len(ids), own, np.int64) for own, ids, _ in found], [f[1] for f in found], [f[2] for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["query_id", "id", "score"])

    return score


def _sparse(rows: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, terms, weights): the places and values of the vector's components that are not 0 after floor(scale * x)."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("long"))
    t = rows.where(F.col(key).isNotNull() & x.isNotNull() & ~bad).select(F.col(key).cast("long").alias("id"), whole.alias("w"))
    pairs = F.filter(F.transform("w", lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda p: p["v"] != 0)
    return t.select("id", pairs.alias("p")).select("id", F.col("p.i").alias("terms"), F.col("p.v").alias("weights"))


def _blocks(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    n = vectors.count()
    packed = vectors.repartition(max(1, -(-n // rows))).mapInArrow(_pack(rows), BLOCKS)
    return stage(packed.withColumn("block", F.monotonically_increasing_id()), name)


def exact_top_k(rows: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(query_id, rank, id, score): the k rows of highest inner product for every query row, ties to the smaller id.

    Components are floor(scale * x) of x as double. Candidates are all rows but those of the query's own id. Rows without an
    id, and vectors that are null or hold a null or non-finite component, take no part. A missing component is 0, so vectors
    of different lengths are compared over the shorter. A row that is repeated is a candidate each time; as a
    query it counts once (of different vectors with one id, the greatest). A query with fewer candidates than k gets all of them; an empty table gives no rows. Further columns are not read.
    """
    spark = rows.sparkSession
    ship(spark)
    candidates = _blocks(_sparse(rows, key, vector, scale), CANDIDATE_ROWS, "topk-candidates")
    queries = _sparse(rows.where(is_query), key, vector, scale).groupBy("id").agg(F.max(F.struct("terms", "weights")).alias("v")).select("id", "v.*")
    queries = _blocks(queries, QUERY_ROWS, "topk-queries")
    asked_in = min(QUERY_SHARES, max(1, -(-queries.count() // SHARE_BLOCKS)))
    asked = queries.select(*(F.col(c).alias(f"q_{c}") for c in queries.columns)).coalesce(asked_in)
    # without the hint Spark would broadcast a table whose compressed files are small
    pairs = candidates.coalesce(max(CANDIDATE_SHARES, TASKS // asked_in)).hint("shuffle_replicate_nl").crossJoin(asked)
    found = pairs.mapInArrow(_score(k), "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
