"""Top-k search and near-duplicate components against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import covertree, neardup


def best(vectors, k, every):
    """{(query, rank): (vec_id, score)} by comparing all pairs."""
    found = {}
    for q, x in vectors:
        if q % every:
            continue
        scored = sorted((-sum(int(np.floor(256 * a)) * int(np.floor(256 * b))
                              for a, b in zip(x, y)), d) for d, y in vectors if d != q)
        found |= {(q, i + 1): (d, -s) for i, (s, d) in enumerate(scored[:k])}
    return found


def search(df, k=3, every=4, **sizes):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in covertree.top_k(
        df, "vec_id", "v", F.col("id") % every == 0, k, **sizes).collect()}


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "large", "few"])
def test_top_k(spark, kind):
    rng = np.random.default_rng(4)
    n = 3 if kind == "few" else 160
    points = rng.normal(0, 1, (n, 8))
    if kind == "clusters":
        points = points * 0.01 + rng.normal(0, 3, (5, 8))[rng.integers(0, 5, n)]
    if kind == "copies":
        points[::3] = points[0]
    if kind == "large":
        points *= 1e6
    vectors = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(vectors, "vec_id long, v array<double>")
    assert search(df, query_block=10, data_block=30) == best(vectors, 3, 4)


def test_top_k_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, None]), (2, None), (3, [float("nan"), 1.0]), (4, []),
            (5, [float("inf"), 1.0]), (6, [1.0, 1.0]), (6, [1.0, 1.0]), (8, [-1.0, 0.0]),
            (None, [9.0, 9.0]), (12, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumn("id", F.lit(1))
    usable = [(0, rows[0][1]), (6, [1.0, 1.0]), (8, rows[8][1])]
    assert search(df, every=4) == best(usable, 3, 4)
    assert search(df.limit(0)) == {}
    huge = spark.createDataFrame([(0, [1e18]), (1, [1e18])], "vec_id long, v array<double>")
    with pytest.raises(Exception, match="64-bit|range|overflow"):
        search(huge)


def test_tree_covers_its_points():
    points = np.floor(np.random.default_rng(2).normal(0, 50, (600, 6)))
    points[100:200] = points[0]
    tree = covertree.CoverTree(points, leaf=5)
    assert sorted(tree.order) == list(range(600))
    for i, (c, r, s, e) in enumerate(zip(tree.center, tree.radius, tree.start, tree.end)):
        far = np.linalg.norm(points[tree.order[s:e]] - points[c], axis=1)
        assert far.max() <= r + 1e-9
        spans = [(tree.start[x], tree.end[x]) for x in tree.children[i]]
        if spans:
            assert spans[0][0] == s and spans[-1][1] == e
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(tree.center) > 20


def test_pruning_skips_far_pairs():
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 1000, (20, 16))
    points = np.floor(centers[np.repeat(np.arange(20), 50)] + rng.normal(0, 3, (1000, 16)))
    seen = []

    class Counted(covertree.Best):
        def offer(self, rows, ids, scores):
            seen.append(scores.size)
            super().offer(rows, ids, scores)

    queries = np.arange(0, 1000, 10)
    found = Counted(queries, 5)
    covertree.search(covertree.CoverTree(points[queries], 8), covertree.CoverTree(points, 8),
                     np.arange(1000), found)
    assert sum(seen) < 0.5 * 100 * 1000


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def expected(rows, percent=85):
    """{doc: (size, component)} by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def found(df):
    rows = neardup.near_duplicates(df, "doc_id", "text", 85).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}, len(rows)


def family(rng, base, copies, most):
    """Copies of a text with up to ``most`` words replaced by new ones."""
    out = []
    for _ in range(copies):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randint(0, most)):
            words[at] = f"n{rng.random()}"
        out.append(" ".join(words))
    return out


def corpus(seed, copies=40, most=8):
    rng = random.Random(seed)
    texts = []
    for _ in range(3):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(80, 200))]
        texts += family(rng, base, copies, most)
        texts += [" ".join(base[:k]) for k in range(len(base) - 30, len(base), 4)]
    texts += [" ".join(f"u{rng.random()}" for _ in range(rng.randint(1, 9))) for _ in range(20)]
    texts += ["A b C", "a B c", "a b", "a b c d e f g h", "a b c d e f g"] + texts[:5]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("setting", ["usual", "stars", "pruned"])
def test_components(spark, setting, monkeypatch):
    if setting != "usual":
        monkeypatch.setattr(neardup, "PAIRS_PER_DOC", 0)
        monkeypatch.setattr(neardup, "CROWDED", 4 if setting == "pruned" else 10**9)
        monkeypatch.setattr(neardup, "CENTERS", 40)
    rows = corpus(7 if setting == "usual" else 8, 40 if setting == "usual" else 20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, count = found(df)
    assert count == len(rows) and got == expected(rows)


def test_chains_reach_the_smallest(spark):
    """Neighbours in a chain link, its ends do not."""
    words = [f"c{i}" for i in range(400)]
    rows = [(100 - k, " ".join(words[8 * k:8 * k + 200])) for k in range(12)]
    got, _ = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == expected(rows) and {c for _, c in got.values()} == {89}


def test_component_edges(odd, nothing):
    got, count = found(odd)
    assert count == 10
    assert got[2] == (0, 2) and got[3] == (0, 3) and got[4] == (0, 4) and got[None][1] is None
    assert got[7] == (1, 7) and got[5] == (1, 5)
    assert found(nothing) == ({}, 0)


def test_permutation_fills_alike():
    """Sets that differ in one of 40 shingles agree in nearly all bins, filled ones too."""
    rng = np.random.default_rng(0)
    hasher = neardup.OnePermutation()
    a = rng.integers(0, 2**64, 40, dtype=np.uint64)
    one, two = hasher.signature(a), hasher.signature(a[1:])
    assert 0.9 < (one == two).mean() < 1 and (one != 2**64 - 1).all()
    single = hasher.signature(a[:1])
    assert len(set(single.tolist())) == 1


def test_bitmaps_never_rule_out_a_link(spark):
    """A differing bit needs a differing shingle, also in bitmaps that are nearly full."""
    rng = np.random.default_rng(5)
    for size in (3, 200, 5000):
        a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        drop = len(a) * 15 // 100
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**64, 2, dtype=np.uint64)]))
        bits = [np.unpackbits(neardup.bitmap(x).view(np.uint8)) for x in (a, b)]
        assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(a, b))


def test_pipeline_stage_drops_copies_from_080(spark):
    """Pairs at 0.815 are copies for the pipeline, those at 0.78 are not."""
    import corpus_pipeline

    rows = []
    for k in range(40):
        words = [f"w{k}x{i}" for i in range(200)]
        changed = [10, 50, 90, 130] if k < 30 else [10, 50, 90, 130, 170]
        copy = [f"new{k}" if i in changed else w for i, w in enumerate(words)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    a, b = (shingles(t) for _, t in rows[:2])
    assert 0.80 <= len(a & b) / len(a | b) < 0.85
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()}
    assert kept == {2 * k for k in range(40)} | {2 * k + 1 for k in range(30, 40)}


def test_bands_suit_the_threshold():
    assert neardup.band_rows(85) == neardup.ROWS
    for percent in (50, 70, 80, 85, 95):
        rows = neardup.band_rows(percent)
        assert (1 - (percent / 100) ** rows) ** neardup.BANDS <= neardup.MISSED
