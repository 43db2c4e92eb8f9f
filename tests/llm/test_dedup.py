"""Exact copies, near copies and repeated strings against brute force."""

import collections
import hashlib

import duckdb
import numpy as np
import pytest

from freightlens.llm import queries
from freightlens.llm.exact_dedup import CountingQuotientFilter, exact_groups, without_exact_copies
from freightlens.llm.near_dedup import bag_minhash, near_classes, occurrences, without_near_copies
from freightlens.llm.repeats import remove_repeats
from freightlens.llm.words import alnum_words

SF = "/root/testdata/sf0.001"


def texts(folder=SF):
    return duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall()


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 40, 100).astype(np.uint64) << np.uint64(31) for _ in range(5)]
    merged = CountingQuotientFilter.merge([CountingQuotientFilter.unpack(CountingQuotientFilter.of(p).pack()) for p in parts])
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    got, n = merged.repeated()
    assert got.tolist() == values[counts > 1].tolist() and n.tolist() == counts[counts > 1].tolist()
    assert sum(len(x.quotients) for _, x in merged.blocks(6)) == len(values)


def expected_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return groups


def test_exact_groups(spark):
    rows = texts()
    groups = expected_exact(rows)
    got = {r.doc_id: r for r in queries.QUERIES["op5_exact_dedup"](spark, SF).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        g, r = groups[t or ""], got[i]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(g), len(g), i == max(g), hashlib.sha256((t or "").encode()).hexdigest())


def test_exact_edges(docs, nothing):
    got = exact_groups(docs).collect()
    assert len(got) == docs.count()
    assert sorted((r.doc_id, r.kept) for r in got if r.group_size == 3) == [(0, False), (1, False), (1, True)]
    assert {(r.doc_id, r.kept) for r in got if r.group_size == 2} == {(2, False), (3, True)}
    assert [r.kept for r in got if r.doc_id is None] == [True]
    left = without_exact_copies(docs)
    assert left.columns == docs.columns
    assert collections.Counter(r.doc_id for r in left.collect()) == collections.Counter(r.doc_id for r in got if r.kept)
    assert exact_groups(nothing).count() == 0 and without_exact_copies(nothing).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_bag_minhash_is_unbiased(seed):
    rng = np.random.default_rng(seed)
    n, m = 120, 3000
    elements = rng.integers(0, 1 << 63, n).astype(np.uint64)
    a = rng.integers(0, 9, n)
    b = np.where(rng.random(n) < 0.6, a, rng.integers(0, 9, n))
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    owner = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
    s = bag_minhash(owner, np.concatenate([elements[a > 0], elements[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, m)
    assert abs((s[0] == s[1]).mean() - true) < 5 * (true * (1 - true) / m) ** 0.5
    alone = bag_minhash(np.zeros((b > 0).sum(), int), elements[b > 0], b[b > 0], 1, m)
    assert (alone[0] == s[1]).all()


def bag(text):
    w = alnum_words((text or "").encode())
    k = min(5, len(w))
    return collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else collections.Counter()


def brute_classes(rows):
    bags = {t: bag(t) for t in {t or "" for _, t in rows}}
    root = {t: t for t in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = list(bags)
    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = bags[a], bags[b]
            both = sum((x & y).values())
            if both and both >= 0.8 * (sum(x.values()) + sum(y.values()) - both) - 1e-9:
                root[find(a)] = find(b)
    out = collections.defaultdict(list)
    for i, t in rows:
        out[find(t or "")].append(i)
    return {i: (min((x for x in g if x is not None), default=None), len(g)) for g in out.values() for i in g}


def test_multiset_intersection():
    a, b = b"a b c d e a b c d e f", b"a b c d e a b c d e g"
    both = len(np.intersect1d(occurrences(a, 5), occurrences(b, 5)))
    assert both == sum((bag(a.decode()) & bag(b.decode())).values())


def test_near_classes(spark):
    rows = texts()
    want = brute_classes(rows)
    got = queries.QUERIES["op7_near_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_near_hub_and_chains(spark):
    """A hub whose copies are alike to it but not to each other, and a chain."""
    words = [f"word{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(30):
        w = list(words)
        w[(i * 4) % 118 + 1] = f"changed{i}"
        w[(i * 4 + 57) % 118 + 1] = f"other{i}"
        rows.append((i + 1, " ".join(w)))
    chain = [f"link{i}" for i in range(80)]
    for i in range(6):
        rows.append((100 + i, " ".join(chain[i * 5 :] + [f"new{j}" for j in range(i * 5)])))
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == brute_classes(rows)


def test_near_hub_is_compared_first(spark, monkeypatch):
    """A hub with 200 copies that are not alike to each other: each is verified against the hub, not against many others."""
    from freightlens.llm import near_dedup

    verified, stage = [], near_dedup.stage

    def counted(df, name):
        out = stage(df, name)
        if name == "near-likely":
            verified.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "stage", counted)
    words = [f"word{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(200):
        w = list(words)
        w[i % 50 + 5], w[i % 49 + 62] = f"changed{i}", f"other{i}"
        rows.append((i + 1, " ".join(w)))
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.class_size) for r in got} == {(0, 201)}
    assert sum(verified) <= 2 * len(rows)


def test_near_copies_that_differ_in_their_own_ways(spark, monkeypatch):
    """200 copies below the threshold of their hub and of each other: candidates grow with the copies, not with their square."""
    from freightlens.llm import near_dedup

    compared, stage = [], near_dedup.stage

    def counted(df, name):
        out = stage(df, name)
        if name == "near-likely":
            compared.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "stage", counted)
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(220):
        w = list(words)
        for j in range(1 if i < 20 else 3):
            w[40 * j + 5 + rng.integers(30)] = f"changed{i}x{j}"
        rows.append((i + 1, " ".join(w)))
    rows.append((300, rows[100][1] + " and more"))
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == brute_classes(rows)
    assert 0 < sum(compared) <= 2 * len(rows)


def test_near_edges(docs, nothing):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_classes(docs).collect()
    want = brute_classes(rows)
    assert sorted((str(r.doc_id), r.class_id, r.class_size) for r in got) == sorted((str(i), *want[i]) for i, _ in rows)
    left = without_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert near_classes(nothing).count() == 0 and without_near_copies(nothing).count() == 0


def brute_removed(rows, length):
    where = collections.Counter(x[p : p + length] for _, x in rows for p in range(len(x) - length + 1))
    for i, x in rows:
        gone = bytearray(len(x))
        for p in range(len(x) - length + 1):
            if where[x[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for j in range(len(x)) if gone[j] and (j == 0 or not gone[j - 1]))
        yield i, len(x), sum(gone), spans, bytes(b for b, g in zip(x, gone) if not g)


def test_repeats(spark):
    rows = [(i, (t or "").encode()) for i, t in texts()]
    got = {r.doc_id: r for r in queries.QUERIES["op6_repeats"](spark, SF).collect()}
    for i, n, removed, spans, kept in brute_removed(rows, 200):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("seed", range(3))
def test_repeats_random(spark, seed):
    """Few letters, periodic runs, overlapping matches and matches of just the length."""
    rng = np.random.default_rng(seed)
    pool = ["".join(rng.choice(list("ab"), 60)) for _ in range(4)] + ["a" * 90, "abc" * 30]
    rows = [(i, "".join(rng.choice(pool, rng.integers(0, 6))) + "".join(rng.choice(list("abc"), rng.integers(0, 40)))) for i in range(40)]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id int, text string"), length=40).collect()}
    for i, n, removed, spans, kept in brute_removed([(i, t.encode()) for i, t in rows], 40):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (n, removed, spans, kept)


def test_repeats_edges(docs, nothing):
    got = remove_repeats(docs, length=50).collect()
    assert len(got) == docs.count()
    assert {(r.n_bytes, r.n_removed) for r in got if r.doc_id in (2, 3)} == {(0, 0)}
    assert all(r.n_removed == r.n_bytes for r in got if r.doc_id in (0, 1))
    assert remove_repeats(nothing).count() == 0


def test_buckets_are_even_for_crowded_keys(spark):
    """Keys that are the smallest of many hashes crowd at zero; buckets and filter slots stay even."""
    from freightlens.llm.common import bit_filter, in_filter, pack_keys

    rng = np.random.default_rng(8)
    keys = rng.integers(0, 1 << 62, (20_000, 101), dtype=np.int64).astype(np.uint64).min(1)
    rows = pack_keys([keys], None, 6).to_pylist()
    sizes = [len(r["keys"]) // 8 for r in rows]
    assert sum(sizes) == len(np.unique(keys)) and max(sizes) < 1.4 * sum(sizes) / 64
    held = bit_filter(spark.createDataFrame([(int(k),) for k in keys[:2000].view(np.int64)], "h long"), "h", 20)
    assert in_filter(keys[:2000], held).all()
    assert in_filter(keys[2000:], held).mean() < 0.01
