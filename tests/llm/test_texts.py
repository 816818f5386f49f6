"""Encoding, compression rules and language identification against plain versions."""

import hashlib
import re
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarlake.llm import compression, language, pieces, queries

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=queries.tokenizer_path())


def digests(library, text):
    ids = library.encode(text or "", add_eos=True)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))


def test_pieces_equal_the_library(odd, library):
    found = pieces.encode_texts(odd, "text", queries.tokenizer_path(), with_ids=True)
    assert found.columns.count("n_tokens") == 1 and "odd.name" in found.columns
    rows = found.collect()
    assert len(rows) == 10
    for row in rows:
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == digests(library, row.text)
        assert row.ids == library.encode(row.text or "", add_eos=True)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab ▁\n\t\rü漢\x00<0x>/s' ", max_size=40))
def test_chunks_equal_the_library(library, text):
    with open(queries.tokenizer_path(), "rb") as file:
        table = pieces.ChunkTable(file.read())
    chunks = table.encode([text])[0]
    assert [i for c in chunks for i in table.ids[c]] == library.encode(text)


def test_table_starts_anew(monkeypatch, library):
    monkeypatch.setattr(pieces, "TABLE_CHARS", 10)
    with open(queries.tokenizer_path(), "rb") as file:
        table = pieces.ChunkTable(file.read())
    for text in ("some words here", "other words there", "some words here"):
        chunks = table.encode([text])[0]
        assert [i for c in chunks for i in table.ids[c]] == library.encode(text)


def test_crossing_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(queries.tokenizer_path(), "rb") as file:
        proto.ParseFromString(file.read())
    proto.pieces.add(piece="a▁b", score=-1.0, type=1)
    with pytest.raises(ValueError):
        pieces.check_model(proto.SerializeToString())


@needs_tables
def test_pieces_over_the_table(spark, library):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text").collect())
    rows = queries.op7_sentencepiece(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row)[1:] == digests(library, texts[row.doc_id])


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeats = sum(x in lines[:i] for i, x in enumerate(lines))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), symbols, repeats, len(hit), failed)


def test_base_rules(odd):
    rows = compression.compression_rules(odd.filter("doc_id <> 5 OR doc_id IS NULL"),
                                         "text").collect()
    assert len(rows) == 9
    for row in rows:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines,
                row.n_repeat_words, row.base_failed) == base(row.text)
    long = compression.compression_rules(odd.filter("doc_id = 5"), "text").first()
    assert long.n_words == 40_000 == long.n_repeat_words and not long.kept


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words(words):
    assert compression.repeated_words(words) == base(" ".join(words))[4]


@needs_tables
def test_rules_over_the_table(spark):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text").collect())
    rows = queries.op10_quality_rules(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines,
                row.n_repeat_words, row.base_failed) == base(texts[row.doc_id])
    assert all(r.kept for r in rows if not r.base_failed and 1.5 < r.ratio < 2.3)


def test_bands_reject_both_ends():
    zstd = compression.Compressor(3, 4096, compression.WHOLE_BANDS, compression.CHUNK_BANDS)
    import random

    noise = "".join(random.Random(1).choices([chr(c) for c in range(33, 0x2FFF)], k=9000))
    prose = " ".join(random.Random(2).choices(
        [f"w{i * 7919 % 10007}" for i in range(3000)], k=4000))
    assert not zstd.ratios(noise)[3] and not zstd.ratios("spam " * 3000)[3]
    assert zstd.ratios(prose)[3] and zstd.ratios("")[3]
    mixed = prose + " spam" * 2000  # one chunk is enough
    whole, _, most, fine = zstd.ratios(mixed)
    assert not fine and whole < 4.5 < most


def test_learned_bands_reject_junk_of_each_length(spark):
    """Menus of few words and base64 go at each length, prose stays; few texts teach nothing."""
    import math
    import random

    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = []
    for i in range(800):
        n = int(math.exp(rng.uniform(math.log(300), math.log(40_000))))
        texts.append((f"prose{i}", " ".join(rng.choices(words, k=n // 6))))
    for n in (600, 1500, 3000, 6000, 12_000, 25_000):
        menu = [w for w in words if len(w) > 4][:30]
        texts.append((f"menu{n}", " ".join(rng.choices(menu, k=n // 7))))
        texts.append((f"base64{n}", " ".join("".join(rng.choices(signs, k=40))
                                             for _ in range(n // 41))))
    df = spark.createDataFrame(texts, "doc_id string, text string")
    whole, chunks = compression.learn_bands(df, "text")
    assert (whole, chunks) == compression.learn_bands(df.union(df).repartition(5), "text")
    rows = compression.compression_rules(df, "text", whole_bands=whole, chunk_bands=chunks,
                                         keep=["doc_id"]).collect()
    junk = [r for r in rows if not r.doc_id.startswith("prose")]
    assert [r.doc_id for r in junk if r.kept] == []
    assert sum(not r.base_failed for r in junk) >= 10  # so the bands decide
    assert sum(r.kept for r in rows) >= 0.97 * 800
    fixed = compression.WHOLE_BANDS, compression.CHUNK_BANDS
    assert compression.learn_bands(df.limit(20), "text") == fixed
    assert compression.learn_bands(df.limit(0), "text") == fixed


def test_language_edges(odd, nothing, spark):
    net = language.fit_languages(odd, "text", "lang", "doc_id")
    rows = language.predict_languages(odd, "text", net).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 10 and set(net.languages) == {"de", "en", "fr"}
    for key in (2, 3, 4, 6):
        assert (by_id[key].lang_pred, by_id[key].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in rows)
    empty = language.fit_languages(nothing, "text", "lang", "doc_id")
    assert empty.languages == []
    assert language.predict_languages(odd, "text", empty).filter("lang_pred <> 'und'").count() == 0
    assert language.predict_languages(nothing, "text", net).count() == 0


def test_letters_are_those_of_unicode():
    assert not any(map(language.has_letter, ["", "² ½", "Ⅷ ①", "12_3", "😀 ٣"]))
    assert all(map(language.has_letter, ["a", "1é", "² ½ß", "漢", "ª", "ʰ"]))


def test_training_is_bounded_and_spread(spark):
    df = spark.createDataFrame([(i, "x" * 3000 + str(i), "en") for i in range(50)],
                               "doc_id long, text string, lang string")
    rows = language.training_windows(df, "text", "lang", "doc_id", docs=5).collect()
    assert len(rows) == 5 * language.WINDOWS_PER_DOC
    assert sum(not r.text.endswith("x") for r in rows) == 5  # the last window ends the text


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables here")
def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = dict(spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", "lang").collect())
    rows = queries.op6_language_id(spark, folder).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert len(held) > 200 and right / len(held) >= 0.97
