"""FM-index searches and spelling groups next to brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from bazaarlake.llm import oracle, queries, spelling
from bazaarlake.llm.spelling import PREFIX, SUFFIX, FMIndex
from checks.compare import canonical, connect


def are_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:]


def groups(words, ratio=5):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs."""
    near = {a: [b for b in words if are_near(a, b)] for a in words}
    form = {}
    for a, found in near.items():
        best = min(found, key=lambda b: (-words[b], b), default=None)
        form[a] = best if found and words[best] >= ratio * words[a] else None

    def root(a):
        return a if form[a] is None else root(form[a])

    return {a: (form[a], root(a), n, len(near[a]), words.get(form[a])) for a, n in words.items()}


def vocabulary(rng, letters, sizes, n):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.choice(sizes)))
                   for _ in range(n)})


@pytest.mark.parametrize("seed", range(12))
def test_searches_equal_brute_force(seed):
    rng = random.Random(seed)
    words = vocabulary(rng, ["ab", "abcé", "abcdefgh"][seed % 3], range(2, 9), [1, 5, 200][seed % 3])
    asked = sorted({*words, "zz", "qqqqq", "ab"})
    index = FMIndex(words)
    found = []
    for side in (PREFIX, SUFFIX):
        pairs = [(asked[q], words[w]) for q, w in zip(*index.near(asked, side))]
        assert len(pairs) == len(set(pairs))
        for a, b in pairs:
            cut = len(a) // 2
            assert a[:cut] == b[:cut] if side == PREFIX else b.endswith(a[cut:])
        found.append(set(pairs))
    assert found[0] | found[1] == {(a, b) for a in asked for b in words if are_near(a, b)}


def test_ranks_count_signs():
    rng = np.random.default_rng(1)
    text = np.concatenate([[0], rng.integers(1, 5, 100), [0]])
    order = spelling.suffix_array(text)
    assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))
    ranks, shifted = spelling.Ranks(text, 5, order), text[order - 1]
    places = np.arange(len(text) + 1)
    table = ranks.all(places)
    for c in range(5):
        of, smaller = ranks.of(np.full(len(places), c), places)
        assert of.tolist() == table[:, c].tolist() == [(shifted[:p] == c).sum() for p in places]
        assert smaller.tolist() == [(shifted[:p] < c).sum() for p in places]


def as_dict(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("range_words", [7, 60, 10_000])
def test_groups_equal_brute_force(spark, range_words):
    """Small ranges: halves that many words share lead to many ranges and split tasks."""
    rng = random.Random(range_words)
    words = {w: rng.choice([5, 6, 30, 200, 5000]) for w in
             vocabulary(rng, "abé", range(6, 9), 300) + vocabulary(rng, "xyzuvw", range(6, 12), 100)
             + ["aaaaaa" + x for x in "bcdefgh"] + ["a" * 9000, "a" * 8999]}
    rows = [(w, n - 2) for w, n in words.items()] + [(w, 2) for w in words]
    df = spark.createDataFrame(rows, "word string, n long").selectExpr("*", "1 AS root", "2 AS part")
    assert as_dict(spelling.spelling_variants(df, range_words=range_words)) == groups(words)


def test_chains_lead_to_the_last(spark):
    words = {"aaaaaaa" + "b" * k: 5 * 6 ** (9 - k) for k in range(10)}
    got = as_dict(spelling.spelling_variants(
        spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == groups(words) and {r[1] for r in got.values()} == {"aaaaaaa"}


def test_odd_words(spark):
    rows = [(None, 9), ("", 9), ("short", 9), ("longer", None), ("rarely", 4), ("😀😀😀abc", 30),
            ("😀😀abc😀", 5), ("😀😀abc", 5), ("\x00\x00\x00abc", 6), ("\x00\x00\x00abcd", 6)]
    df = spark.createDataFrame(rows, "word string, n long")
    got = as_dict(spelling.spelling_variants(df, least_count=5))
    assert got == groups({w: n for w, n in rows if w and len(w) > 5 and n and n > 4})
    assert as_dict(spelling.spelling_variants(df.limit(0))) == {}
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, ratio=1)


def test_words_of_odd_texts(odd, nothing):
    counts = spelling.word_counts(odd, "text", "[A-Za-z]{4,}")
    got = {r.word: r.n for r in counts.collect()}
    assert got["wort"] == 40_000 and got["same"] == got["here"] == 2
    assert spelling.word_counts(nothing, "text", "[a-z]+").count() == 0


def test_words_of_the_query(spark):
    """The counted words are those of a plain reading of whole texts."""
    import re

    folder = "/root/testdata/sf0.001"
    counts = Counter()
    for row in queries.table(spark, folder, "documents").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row.text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                              "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{row.doc_id}:{run}".encode())
            at = h % len(run)
            word = run[:at] + run[at + 1:] if h % 199 == 0 else run
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) > 5 and n > 4}
    assert as_dict(queries.op11_spelling_variants(spark, folder)) == groups(words)


def test_query_equals_sql_on_more_rows(spark):
    folder = "/root/testdata/sf0.01"
    df = queries.op11_spelling_variants(spark, folder)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = connect(folder).execute(oracle.oracle_sql()["op11_spelling_variants"])
    columns = [c[0] for c in cursor.description]
    assert ours == canonical(columns, cursor.fetchall()) and len(ours) > 5000
