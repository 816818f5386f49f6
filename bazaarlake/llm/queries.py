"""One query per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import alignment, compression, covertree, language, mixing, neardup, pieces
from bazaarlake.llm import reputation, secret_scan, shards, spelling, warc, wrappers

SHARDS = 16
# Target weights of the mix; sources have equal weights.
DOMAIN_WEIGHTS = {"crawl": 30, "reference": 45, "forum": 25}
LANGUAGE_WEIGHTS = {"en": 40, "de": 20, "fr": 20, "es": 20}
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block")]
FETCHED = "2024-01-01T00:00:00Z"  # the table has no fetch times


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def source_domain() -> Column:
    """The top level of the mix, from the source's name."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int")
    return F.when(number == 0, "crawl").when(number < 10, "reference").otherwise("forum")


def mix_weights(spark: SparkSession) -> DataFrame:
    rows = [([d], w) for d, w in DOMAIN_WEIGHTS.items()]
    rows += [([d, x], w) for d in DOMAIN_WEIGHTS for x, w in LANGUAGE_WEIGHTS.items()]
    return spark.createDataFrame(rows, "path array<string>, weight long")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix_documents(
        docs, "doc_id", "text", [source_domain(), "lang", "source"], mix_weights(spark),
        fraction=0.5, max_epochs=4, seed=17).withColumnRenamed("key", "doc_id")


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return covertree.top_k(vectors, "vec_id", "embedding", F.col("id") % 50 == 0, k=5)


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), "doc_id", "text", 85)


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    sharded = shards.shuffle_into_shards(docs, "doc_id", "text", SHARDS, seed=2024)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    return sharded.select("doc_id", size.alias("size"),
                          shards.crc32_text(F.col("text")).alias("text_crc32"),
                          F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return wrappers.extract_main_text(pages, "url", "html")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    learn = docs.filter(~F.coalesce(held_out, F.lit(False)))
    net = language.fit_languages(learn, "text", "lang", "doc_id")
    return language.predict_languages(
        docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")),
        "text", net, keep=["doc_id", "held_out"])


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode_texts(docs, "text", tokenizer_path(), keep=["doc_id"])


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels")
    # A page shows the document whose number ends its path; a document is labelled.
    shown = F.regexp_extract(reputation.url_path(F.col("url")), "/([0-9]{1,18})(?:[^0-9].*)?$", 1)
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = pages.select("url", shown.try_cast("long").alias("doc_id")).join(
        labels, "doc_id").select("url", bad.alias("bad"))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return reputation.judge_urls(pages, "url", outcomes, rules).drop("url")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    headers = warc.header_lines(("Content-Type", F.lit("text/html; charset=utf-8")),
                                ("Content-Length", F.octet_length("html")))
    responses = pages.withColumns({
        "id": warc.record_uuid(F.lit("response"), F.col("page_id").cast("string"),
                               F.coalesce("url", F.lit(""))),
        "date": F.lit(FETCHED), "headers": headers})
    return warc.derive_records(responses, "id", "url", "date", "headers", "html", ["page_id"])


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    whole, chunks = compression.learn_bands(docs, "text")
    return compression.compression_rules(
        docs, "text", whole_bands=whole, chunk_bands=chunks, keep=["doc_id"])


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")

    def typed(run):
        """One of 199 runs, by its hash, without one of its code points."""
        id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        h = F.crc32(F.concat(id_text, F.lit(":"), run).cast("binary"))
        at = (h % F.length(run)).cast("int")
        return F.when(h % 199 == 0, spelling.drop_code_point(run, at)).otherwise(run)

    # Runs of fewer letters cannot give a word of six.
    words = spelling.word_counts(docs, "text", "[A-Za-z\u00C0-\u00FF]{6,}", typed)
    return spelling.spelling_variants(words, ratio=5, least_length=6, least_count=5)


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return alignment.align_tokenizers(
        docs, "text", tokenizer_path("byte_bpe_50k.json"), tokenizer_path(), keep=["doc_id"])


def op13_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan_secrets(docs, "text", keep=["doc_id"])
    kinds = [rule.kind for rule in secret_scan.BASE_RULES]
    base = F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    def number(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("secrets")).alias("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
