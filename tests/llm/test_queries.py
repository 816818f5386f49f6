"""Queries next to their SQL, and the whole pipeline next to a plain run."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from bazaarlake.llm import compression, language, oracle, queries
from checks.compare import canonical, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(oracle.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_equals_sql(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = connect(FOLDER).execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert ours == canonical(columns, cursor.fetchall())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before each stage and after the last."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_stages_keep_the_columns(stages):
    first = stages[0][0].asDict().keys()
    assert all(x[0].asDict().keys() == first for x in stages[1:5])
    assert all(len(b) < len(a) for a, b in zip(stages[2:], stages[3:5]))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and len(stages[5]) == len(stages[4])


def test_clean_documents_stay(stages):
    """Language identification drops what has no letters, and little else."""
    before, after = {r.doc_id: r for r in stages[0]}, {r.doc_id for r in stages[1]}
    gone = [r for i, r in before.items() if i not in after]
    assert all(not r.text or not re.search(r"[^\W\d_]", r.text) or len(r.text) < 200 for r in gone)
    assert len(gone) <= 0.02 * len(before)


def test_quality_stage(stages):
    zstd = compression.Compressor(3, 4096, compression.WHOLE_BANDS, compression.CHUNK_BANDS)
    want = set()
    for r in stages[1]:
        words = compression.WORD.findall(r.text or "")
        if (len(words) >= 10 and 100 * compression.repeated_words(words) <= 20 * len(words)
                and zstd.ratios(r.text)[3]):
            want.add(r.doc_id)
    assert {r.doc_id for r in stages[2]} == want


def test_dedup_stage(stages):
    from test_pairs import expected

    groups = expected([(r.doc_id, r.text) for r in stages[2]], corpus_pipeline.SIMILAR)
    assert {r.doc_id for r in stages[3]} == {c for _, c in groups.values()}


def test_mix_and_encoding_stages(spark, stages):
    docs = {r.doc_id: r for r in stages[3]}
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    leaves = len({(r.lang, r.source) for r in docs.values()})
    longest = max(words([r]) for r in docs.values())
    half = words(docs.values()) // 2
    assert half <= words(stages[4]) <= half + leaves * longest
    assert all(docs[r.doc_id] == r for r in stages[4])
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=queries.tokenizer_path())
    texts = {r.doc_id: r.text for r in stages[4]}
    assert {r.doc_id: r.ids for r in stages[5]} == {
        i: library.encode(t, add_eos=True) for i, t in texts.items()}


def test_run_equals_the_stages(spark, stages):
    got = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == {(r.doc_id, r.ids_sha256) for r in stages[5]}


@pytest.mark.parametrize("rows", ["odd", "nothing"])
def test_stages_on_odd_rows(request, spark, rows):
    docs = request.getfixturevalue(rows).selectExpr(
        "doc_id", "text", "lang", "source", "length(text) AS n_chars", "n_tokens", "KEPT")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
    assert corpus_pipeline.encode(spark, docs, FOLDER).count() == docs.count()


def test_language_stage_uses_no_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    net = language.fit_languages(docs, "text", "lang", "doc_id")
    assert language.predict_languages(docs.drop("lang"), "text", net).count() == docs.count()


def test_sharding_query_over_the_whole_table(spark):
    """Sizes, checksums and the law `rows`, next to a plain reading of the table."""
    import zlib
    from collections import defaultdict

    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in queries.table(spark, folder, "documents").collect()}
    rows = queries.op4_sharding(spark, folder).collect()
    raw = {i: (t or "").encode() for i, t in texts.items()}
    assert {r.doc_id: (r.size, r.text_crc32, r.law, r.grown_shard) for r in rows} == {
        i: (len(b) + 1, zlib.crc32(b), "rows", None) for i, b in raw.items()}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and set(slots) == set(range(queries.SHARDS))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_quality_query_over_the_whole_table(spark):
    """`kept` by compressing every text and chunk here, with the bounds the corpus gives."""
    import zstandard

    folder = "/root/testdata/sf0.01"
    docs = queries.table(spark, folder, "documents")
    whole, chunks = compression.learn_bands(docs, "text")
    assert whole != compression.WHOLE_BANDS

    def within(raw, bands):
        low, high = [x[1:] for x in bands if len(raw) >= x[0]][-1]
        packed = zstandard.ZstdCompressor(level=3, write_content_size=False).compress(raw)
        return low <= len(raw) / len(packed) <= high

    want = {}
    for row in docs.collect():
        words, raw = re.findall(r"[^\x20\x09-\x0D]+", row.text or ""), (row.text or "").encode()
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        many = {w for w in windows if windows.count(w) > 1} if len(set(windows)) < len(windows) else ()
        hit = {i + k for i, w in enumerate(windows) if w in many for k in range(5)}
        failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
        parts = [raw[i:i + 4096] for i in range(0, len(raw), 4096)] if len(raw) > 4096 else []
        want[row.doc_id] = (len(words), len(hit), failed, not failed and within(raw, whole)
                            and all(within(p, chunks) for p in parts))
    got = {r.doc_id: (r.n_words, r.n_repeat_words, r.base_failed, r.kept)
           for r in queries.op10_quality_rules(spark, folder).collect()}
    assert got == want and {kept for *_, kept in got.values()} == {True, False}
