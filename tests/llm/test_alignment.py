"""Token alignment next to a plain alignment by byte offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from bazaarlake.llm import alignment, queries

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    fast = Tokenizer.from_file(BYTES)
    fast.encode_special_tokens = True
    return fast, SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def ours():
    return [kind(open(path, "rb").read()) for kind, path in (
        (alignment.ByteTokenizer, BYTES), (alignment.PieceTokenizer, PIECES))]


def byte_ends(tokens):
    at, ends = 0, []
    for token in tokens:
        at += len(token)
        ends.append(at)
    return ends


def plain(texts, tokenizers, ours):
    """The contract's columns per text, by comparing all ends of whole token lists."""
    fast, pieces = tokenizers
    rows = []
    for text in texts:
        a = fast.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        raw = (" " + (text or "")).encode()
        spelled = [[side.token_bytes[i] for i in ids] for side, ids in zip(ours, (a, b))]
        if not text or any(b"".join(s) != raw for s in spelled):
            rows.append(([], [], [], []))
            continue
        ends = [{end: n for n, end in enumerate(byte_ends(s))} for s in spelled]
        shared = sorted(ends[0].keys() & ends[1].keys())
        links = [(a[ends[0][e]], b[ends[1][e]]) for e in shared]
        groups, i, j = [], 0, 0
        for e in shared:
            x, y = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        rows.append((a, b, links, groups))
    count = Counter(link for row in rows for link in row[2])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    return [(len(a), len(b), len(g), len(links), sum(count[x] == best[x[1]] for x in links),
             sum(count[x] for x in links),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
            for a, b, links, g in rows]


COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def test_whole_table_equals_plain_alignment(spark, tokenizers, ours):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in queries.table(spark, folder, "documents").collect()}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS)
           for r in queries.op12_token_alignment(spark, folder).collect()}
    assert got == dict(zip(texts, plain(texts.values(), tokenizers, ours)))


ODD = ["a", " ", "  ", "\n", " \n a", "a ", "x▁y", "▁", "<|endoftext|>", "</s><s><unk>", "<0x41>",
       "naïve 😀 ünïcode 漢字", "\x00\x01", "a b", "don't we'll", "tab\tend\r\n", "▁▁a",
       "  two  spaces   three ", "é", "1234567 89", "ﬁ ﬂ ½ Ⅷ", "﻿x", "a" * 3000,
       " " * 25_000 + "x", "\n" * 12_000, "wort " * 20_000]


def test_odd_texts_equal_plain_alignment(spark, tokenizers, ours):
    rng = random.Random(2)
    texts = [None, "", *ODD, *ODD[:10], *["".join(rng.choice("ab é▁\n<0x>12😀'") for _ in range(n))
                                          for n in range(1, 120)]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").selectExpr(
        "*", "7 AS N_A", "id AS `odd.name`", "8 AS pairs", "9 AS n_best")
    out = alignment.align_tokenizers(df.repartition(3), "t", BYTES, PIECES, with_groups=True)
    assert out.columns == ["id", "t", "odd.name", "n_a", "n_b", "n_groups", "groups_sha256",
                           "groups", "n_links", "n_best", "count_sum"]
    rows = {r.id: r for r in out.collect()}
    want = plain(texts, tokenizers, ours)
    assert {i: tuple(r[c] for c in COLUMNS) for i, r in rows.items()} == dict(enumerate(want))
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256
               for r in rows.values() if r.n_a)


def test_nulls_repeats_and_empty(odd, nothing):
    out = alignment.align_tokenizers(odd, "text", BYTES, PIECES, keep=["doc_id", "odd.name"])
    rows = out.collect()
    assert out.columns == ["doc_id", "odd.name", *alignment_columns()] and len(rows) == 10
    seven = [r for r in rows if r.doc_id == 7]
    assert seven[0] == seven[1] and seven[0].count_sum >= 2 * seven[0].n_links
    assert [tuple(r[c] for c in COLUMNS) for r in rows if r.doc_id in (2, 3)] == [
        (0, 0, 0, 0, 0, 0, "")] * 2
    assert alignment.align_tokenizers(nothing, "text", BYTES, PIECES).count() == 0


def alignment_columns():
    return ["n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]


def test_windows_are_short_and_remembered(ours, monkeypatch):
    a, b = ours
    aligner = alignment.Aligner(a.token_bytes, b.token_bytes)
    text = "the cat sat on the mat and the cat sat on the mat again"
    ids = [[a.one(" " + text)] * 2, [b.encode([text])[0][0]] * 2]
    windows, begins = aligner.windows(ids)
    assert begins == [0, 14] and windows[:14] == windows[14:] and len(windows) == 28
    assert b"".join(w[0] for w in windows[:14]) == ids[0][0].astype("<u2").tobytes()
    first = aligner.align(ids)
    assert len(aligner.table) == 7  # distinct words
    monkeypatch.setattr(alignment, "MOST_WINDOWS", 6)
    again = aligner.align(ids)
    assert [g for g, _ in first] == [g for g, _ in again]
    assert all(np.array_equal(x, y) for (_, x), (_, y) in zip(first, again))
    assert len(aligner.table) == 7 and aligner.align([[], []]) == []


def test_pairs_bounded_by_vocabularies():
    codes = alignment.possible_pairs([b"a", b"ba", b"c"], [b"a", b"cba", b"a", b""])
    assert codes.tolist() == [0, 1, 2, 4, 5, 6]  # (a,a) (a,cba) (a,a') (ba,a) (ba,cba) (ba,a')


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError)):
        alignment.ByteTokenizer(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())
