"""The Merkle manifest, exact top-k and collocations against brute force, and on odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from freightlens.llm import collocations as C
from freightlens.llm import queries, topk
from freightlens.llm.merkle import folded, merkle_manifest, proof_digest
from freightlens.llm.topk import Postings, _pack, _score, best, exact_top_k

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree_of(leaves):
    """The root and, per leaf, the siblings (before, after) level by level."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for k, p in enumerate(at):
            run, own = runs[p // 3], p % 3
            paths[k].append(("".join(run[:own]), "".join(run[own + 1 :])))
        level, at = [sha("".join(r)) for r in runs], [p // 3 for p in at]
    return level[0], paths


def manifest_of(rows):
    """{(doc_id, leaf): (subroot, root, path)} for rows (doc_id, source, lang, n_chars, text)."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: tree_of([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    root, tops = tree_of([built[s][0] for s in names])
    out = {}
    for s, top in zip(names, tops):
        for x, path in zip(sorted(groups[s], key=lambda x: x[:3]), built[s][1]):
            out.setdefault((x[3][0], x[2]), []).append((built[s][0], root, path + top))
    return out


def check_manifest(got, rows):
    want = manifest_of(rows)
    seen = collections.defaultdict(list)
    for r in got:
        seen[(r.doc_id, r.leaf)].append((r.subroot, r.root, [(p.before, p.after) for p in r.path]))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}


def test_manifest_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, source, lang, n_chars, text from '{SF}/documents.parquet'").fetchall()
    check_manifest(merkle_manifest(spark.read.parquet(f"{SF}/documents.parquet")).collect(), rows)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4, 1], [80, 81, 82, 243], [244, 1, 0, 730, 3]])
def test_manifest_of_tree_shapes(spark, sizes):
    rows = [(i, f"s{g:03}", "en", i, f"text {g} {i}") for g, n in enumerate(sizes) for i in range(n)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    check_manifest(merkle_manifest(df).collect(), rows)


def test_manifest_edges(spark):
    """Null ids, null and empty sources, repeated rows, a very long text, clashing and further columns, empty tables."""
    rows = [
        (1, "b", "en", 1, "x\ny"), (1, "b", "en", 1, "x\ny"), (None, "b", None, None, None), (None, None, "en", 0, ""), (2, None, "en", 1, "a"),
        (3, "", "de", 2, "b"), (4, "é", "de", 2, "long\n" * 400_000), (5, "z", "de", 2, "b"), (6, "ÿ", "", -2, "日本"),
    ]
    df = spark.createDataFrame([(*r, "x", 1, 2, "k", 0) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, rank int, n int, tree string, digest int")
    got = merkle_manifest(df).collect()
    check_manifest(got, rows)
    assert merkle_manifest(df.limit(0)).count() == 0


def test_manifest_query_finds_tampering(spark):
    got = queries.QUERIES["op11_merkle"](spark, SF).collect()
    want = {k[0]: (k[1], *v[0]) for k, v in manifest_of(duckdb.sql(f"select doc_id, source, lang, n_chars, text from '{SF}/documents.parquet'").fetchall()).items()}
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    assert len(got) == len(want)
    for r in got:
        leaf, subroot, root, path = want[r.doc_id]
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (texts[r.doc_id] or "")
        assert (r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) == (leaf, subroot, root, sha("".join(b + a for b, a in path)), not changed)
        assert (r.folded_root == root) == r.verified


def test_fold_and_proof(spark):
    row = spark.range(1).select(F.expr("array(named_struct('before', 'a', 'after', ''), named_struct('before', '', 'after', 'bc'))").alias("path"))
    got = row.select(folded(F.col("path"), F.lit("x")).alias("f"), proof_digest(F.col("path")).alias("p")).first()
    assert got.f == sha(sha("ax") + "bc") and got.p == sha("abc")


def brute_top_k(rows, k, scale=64.0):
    """rows: (id, vector); queries are ids divisible by 20."""
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(scale * float(np.float32(x))) for x in v]

    vectors = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = []
    for q, w in vectors:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in vectors if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    got = queries.QUERIES["op12_top_k"](spark, SF).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_top_k(rows, 20)
    assert {f.name: f.dataType.simpleString() for f in queries.QUERIES["op12_top_k"](spark, SF).schema} == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_top_k_edges(spark):
    """Ties, repeated rows, null ids and vectors, components that are null or not finite, other lengths, clashing columns, empty tables."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float((i * 7 + d) % 5 - 2) / 8 for d in range(6)]) for i in range(90)]
    rows += [(100, None), (120, []), (140, [nan, 1.0]), (160, [inf]), (180, [None, 1.0]), (None, [1.0, 2.0]), (200, [1.0]), (220, [0.001, -0.001, 0.0]), (33, rows[33][1])]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, rank int, terms string, block int")
    got = exact_top_k(df, F.col("vec_id") % 20 == 0, 7).collect()
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in got) == brute_top_k(rows, 7)
    few = exact_top_k(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 20 == 0, 7)
    assert [r["rank"] for r in few.orderBy("rank").collect()] == [1, 2]
    assert exact_top_k(df.limit(0), F.col("vec_id") % 20 == 0, 7).count() == 0


def test_top_k_over_many_blocks(spark, monkeypatch):
    """Blocks meet without a broadcast or a copy of the queries for every candidate block; ties and repeated rows over blocks."""
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rows = [(i, [float((i * 7 + d) % 5 - 2) / 8 for d in range(6)]) for i in range(300)]
    rows += [rows[33]] * 9 + [rows[151]] * 4
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = exact_top_k(df, F.col("vec_id") % 20 == 0, 7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and not re.search("Broadcast|Generate", plan)
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in found.collect()) == brute_top_k(rows, 7)


def test_score_keeps_k_rows_a_query():
    """A task merges what it finds in its blocks, in whatever order they meet."""
    rng = np.random.default_rng(8)
    vectors = [(i, [float(x) / 64 for x in rng.integers(-3, 4, 5)]) for i in range(90)] + [(7, [1 / 64] * 5)]
    kind = pa.schema([("id", pa.int64()), ("terms", pa.list_(pa.int32())), ("weights", pa.list_(pa.int64()))])

    def blocks(rows, size):
        packed = [{"id": i, "terms": list(range(5)), "weights": [round(x * 64) for x in v]} for i, v in rows]
        return [x for b in _pack(size)([pa.RecordBatch.from_pylist(packed, kind)]) for x in b.to_pylist()]

    candidates, asked = blocks(vectors, 16), blocks([r for r in vectors if r[0] % 20 == 0], 2)
    pairs = [c | {"block": i} | {f"q_{name}": v for name, v in q.items()} | {"q_block": j} for i, c in enumerate(candidates) for j, q in enumerate(asked)]
    for order in (pairs, pairs[::-1], [pairs[i] for i in rng.permutation(len(pairs))]):
        got = [r for b in _score(4)(pa.RecordBatch.from_pylist([x]) for x in order) for r in b.to_pylist()]
        assert sorted((r["query_id"], r["id"], r["score"]) for r in got) == sorted((q, i, s) for q, _, i, s in brute_top_k(vectors, 4))


def test_postings_accumulate_exactly():
    """Sparse and dense postings, and sums beyond 32 and 64 bits, against Python integers."""
    rng = np.random.default_rng(3)
    import pyarrow as pa

    for size, most in ((50, 9), (50, 1 << 40), (50, 1 << 61)):
        rows = [sorted(rng.choice(40, rng.integers(0, 30), replace=False).tolist()) for _ in range(size)]
        rows = [{"id": 1000 - i, "terms": t, "weights": [int(x) for x in rng.integers(-most, most, len(t))]} for i, t in enumerate(rows)]
        batch = pa.RecordBatch.from_pylist(rows, pa.schema([("id", pa.int64()), ("terms", pa.list_(pa.int32())), ("weights", pa.list_(pa.int64()))]))
        (block,) = _pack(8192)([batch])
        p = Postings(*(block.column(c)[0].as_py() for c in ("ids", "starts", "terms", "weights")))
        assert p.ids.tolist() == sorted(r["id"] for r in rows)
        by = {r["id"]: dict(zip(r["terms"], r["weights"])) for r in rows}
        for r in rows[:20]:
            got = p.scores(np.array(r["terms"], np.int32), np.array(r["weights"], np.int64))
            want = [sum(w * by[i].get(t, 0) for t, w in zip(r["terms"], r["weights"])) for i in p.ids.tolist()]
            assert got.tolist() == [max(-(1 << 63), min((1 << 63) - 1, x)) for x in want]


def test_best_takes_ties_by_id():
    ids = np.arange(10)
    scores = np.array([5, 1, 5, 7, 5, 5, 0, 7, 5, 1])
    assert sorted(best(scores, ids, 0, 4).tolist()) == [2, 3, 4, 7]
    assert sorted(best(scores, ids, 3, 2).tolist()) == [0, 7]
    assert best(scores, ids, -1, 50).tolist() == ids.tolist()


def brute_counts(rows):
    """{(lang, words): count} and {lang: words} of rows (lang, text)."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 6):
                    if i + k <= len(w):
                        f[lang, tuple(w[i : i + k])] += 1
    return f, n


def brute_collocations(rows, least, most):
    f, n = brute_counts(rows)
    candidates = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    covered = set()
    for (lang, w), a in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * a >= 100 * f[lang, w[i:j]]:
                    covered.add((lang, w[i:j]))
    by = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in covered:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            by[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, x, y, n[lang], -s) for lang, ps in by.items() for rank, (s, a, p, x, y) in enumerate(sorted(ps)[:most], 1))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least", [3, 20])
def test_collocations_against_brute_force(spark, least):
    rows = duckdb.sql(f"select lang, text from '{SF}/documents.parquet'").fetchall()
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(C.collocations(df, least, 2000)) == brute_collocations(rows, least, 2000)


def test_phrase_counts_with_hot_beginnings(spark, monkeypatch):
    """A third of all texts share a passage; its beginnings are routed by more words and their counts still add up."""
    rng = random.Random(7)
    hot = "the very same line of words again and again"
    rows = [("en", hot + " " + " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))) if i % 3 == 0 else ("de" if i % 2 else None, " ".join(rng.choice(["x", "yy", "z.", "Ä,"]) for _ in range(40))) for i in range(1200)]
    f, n = brute_counts(rows)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = {(r.lang, tuple(r.phrase.split())): r.n for r in C.phrase_counts(df, 10).where("words > 0").collect()}
    assert got == {k: v for k, v in f.items() if v >= 10 and (len(k[1]) > 1 or k in got)}
    assert all(k in got for k, v in f.items() if v >= 10)
    assert {r.lang: r.n for r in C.phrase_counts(df, 10).where("words = 0").collect()} == dict(n)


def test_runs_are_cut_without_loss(monkeypatch):
    """Windows over long texts overlap by a phrase; slices of a text end between tokens."""
    monkeypatch.setattr(C, "RUN", 64)
    monkeypatch.setattr(C, "SLICE", 50)
    text = "Aa bb,cc  dd\tee. " * 40 + "x" * 300 + " tail" + " ü" * 70
    run = C.Run("en")
    run.add(text)
    ids = np.concatenate(run.parts)
    words = list(run.ids)
    want = " ".join(re.sub("[.,]", " . ", text.lower()).split()).split(" ") + ["."]
    assert [words[i].decode() for i in ids.tolist()] == want
    got = [x[i : i + 5].tolist() for x, m in run.slices() for i in range(m)]
    padded = np.concatenate([ids, np.zeros(5, np.int32)])
    assert got == [padded[i : i + 5].tolist() for i in range(len(ids))]


def test_quicksort_counts():
    rng = np.random.default_rng(5)
    words = rng.integers(1, 4, (500, 5)).astype(np.int32)
    ends = rng.integers(2, 6, 500)
    words[np.arange(5)[None, :] >= ends[:, None]] = 0
    weights = rng.integers(1, 5, 500)
    want = collections.Counter()
    for w, n in zip(words.tolist(), weights.tolist()):
        for k in range(2, 6):
            if w[k - 1]:
                want[tuple(w[:k])] += n
    for least in (1, 20, 10**6):
        got = {tuple(words[at, :k].tolist()): n for at, k, n in C.quicksort_counts(words, weights, np.full(500, 2), least)}
        assert got == {k: v for k, v in want.items() if v >= least}
    # a beginning routed by more words is given whatever its count
    assert {(2, 500)} <= {(k, int((words[:, 0] > 0).sum())) for _, k, _ in C.quicksort_counts(words, weights, np.full(500, 3), 10**6)}


def test_collocations_edges(spark):
    """Null languages and texts, empty texts, only separators, clashing columns, a very long text, empty tables."""
    rows = [(None, "a b a b"), ("und", "A B"), ("", "a b"), ("en", None), ("en", ""), ("en", " .,;\n"), ("en", "new york, new york! " * 30_000), ("zh", "日本 語　x 日本 語　x"), ("en", "a b c d e f g " * 5)]
    df = spark.createDataFrame([(a, b, 1, "x", 2.0) for a, b in rows], "lang string, text string, n int, phrase string, score double")
    assert rows_of(C.collocations(df, 2, 50)) == brute_collocations(rows, 2, 50)
    assert C.collocations(df.limit(0)).count() == 0
    assert C.collocations(df.where("lang = 'en' and text is null")).count() == 0
