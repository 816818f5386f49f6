"""Sharding, URL reputation, WARC derivatives and mixing."""

import html
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import mixing, reputation, shards, warc


def test_shards_are_level_and_whole(odd):
    parts = shards.shuffle_into_shards(odd, "doc_id", "text", 3, seed=1, bucket_bytes=50)
    rows = parts.collect()
    assert len(rows) == 10 and parts.columns.count("shard") == 1 and "odd.name" in parts.columns
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = shards.shuffle_into_shards(odd.repartition(5), "doc_id", "text", 3, seed=1,
                                       bucket_bytes=50).collect()
    key = lambda r: (str(r.doc_id), r.shard, r.slot)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_shards_are_shuffled(spark, nothing, tmp_path):
    df = spark.range(1000).selectExpr("id AS doc_id", "'t' AS text")
    for size in (10**9, 100):  # one bucket, many buckets
        rows = shards.shuffle_into_shards(df, "doc_id", "text", 1, seed=3,
                                          bucket_bytes=size).orderBy("slot").collect()
        order = [r.doc_id for r in rows]
        assert sorted(order) == list(range(1000))
        rises = sum(a < b for a, b in zip(order, order[1:]))
        assert 420 < rises < 580
    assert shards.shuffle_into_shards(nothing, "doc_id", "text", 4).count() == 0
    path = str(tmp_path / "shards")
    shards.write_shards(shards.shuffle_into_shards(df, "doc_id", "text", 4, seed=3), path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 1000 and back.select("shard").distinct().count() == 4


def test_crc32(odd):
    for row in odd.select("text", shards.crc32_text(F.col("text")).alias("crc")).collect():
        assert row.crc == zlib.crc32((row.text or "").encode())


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
         ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]


def test_rules_and_hosts(spark):
    urls = ["http://Example.COM/en/x", "https://www.example.com/en/1?q#f", "http://example.com",
            "http://a.net/es/1", "http://anet/es/1", "http://x.org?://y.com/", None, "no scheme",
            "http://b.example.com/fr/", "http://sub.www.example.com/en/", "://", "http://h#p/q"]
    df = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)],
                               "page_id long, url string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    none = spark.createDataFrame([], "url string, bad int")
    found = {r.page_id: r for r in reputation.judge_urls(df, "url", none, rules).collect()}
    assert len(found) == len(urls)
    assert [found[i].rule for i in range(12)] == [
        "example.com/en/", "www.example.com/en/", None, "net/es/", None, None, None, None, "com/",
        "www.example.com/en/", None, None]
    assert [found[i].verdict for i in (0, 1, 3, 8)] == ["block", "allow", "block", "allow"]
    assert (found[5].host, found[5].path) == ("x.org", "")
    assert [(found[i].host, found[i].path) for i in (6, 7, 10)] == [("", "")] * 3
    assert (found[0].host, found[0].path) == ("example.com", "/en/x")
    assert (found[11].host, found[11].path) == ("h", "")
    assert reputation.judge_urls(df.limit(0), "url", none, rules).count() == 0


def test_shrinking(spark):
    """Bad hosts are blocked, small bad ones only with a bad domain, others left alone."""
    seen = ([("http://bad.spam.org/", 1)] * 60 + [("http://two.spam.org/", 1)] * 40
            + [("http://good.site.org/", 0)] * 80 + [("http://few.site.org/", 1)] * 1
            + [("http://mid.site.org/", 0)] * 50 + [("http://other.edu/", 0)] * 70
            + [("http://other.edu/", None), (None, 1)])
    outcomes = spark.createDataFrame(seen, "url string, bad int")
    hosts = ["bad.spam.org", "new.spam.org", "good.site.org", "few.site.org", "unknown.com"]
    df = spark.createDataFrame([(h, f"http://{h}/x") for h in hosts], "name string, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    found = {r.name: r for r in reputation.judge_urls(df, "url", outcomes, rules).collect()}
    assert found["bad.spam.org"].verdict == "block" and found["bad.spam.org"].n_bad == 60
    assert all(found[h].verdict == "allow" for h in
               ("good.site.org", "few.site.org", "unknown.com"))
    bounds = {r.host: r.bad_bound for r in reputation.host_reputation(
        spark.createDataFrame([(h,) for h in hosts], "host string"), outcomes.select(
            reputation.url_host(F.col("url")).alias("host"), "bad")).collect()}
    assert bounds["new.spam.org"] > bounds["unknown.com"]
    assert bounds["few.site.org"] < bounds["bad.spam.org"]
    long = reputation.domain_of(F.lit("a.b.co.uk"), ("co.uk",))
    assert spark.range(1).select(long).first()[0] == "b.co.uk"


PAGE = ("<html><head><title>T &amp; U</title><style>p{}</style><script>var a='</p>';</script>"
        "</head><body><!-- <p>no</p> --><p>A&eacute;&#233;&#xE9; <b>b</b>\n c</p><p> </p>"
        "x&nbsp;y &unknown; &#0; &#38;lt; a&b<br>z</body></html>")


def responses(spark, rows):
    return spark.createDataFrame(rows, "id string, uri string, date string, headers string, "
                                       "html string, block string")


def test_plain_text(spark):
    text = spark.createDataFrame([(PAGE,)], "h string").select(warc.plain_text(F.col("h")))
    assert text.first()[0] == "T & U\nAééé b c\nx\u00a0y &unknown; � &lt; a&b\nz"
    names = "".join(f"&{n};|" for n in warc.REFERENCES) + "&#8364;&#x41;&#X1F600;"
    got = spark.createDataFrame([(names,)], "t string").select(
        warc.decode_references(F.col("t"))).first()[0]
    assert got == html.unescape(names)


def test_kept_columns_do_not_clash(spark):
    rows = [("urn:uuid:1", "u", "d", "h", "<p>x</p>" * 20_000, "c")] * 2
    source = responses(spark, rows).selectExpr("*", "5 AS `odd.name`", "6 AS Content_Type")
    records = warc.derive_records(source, "id", "uri", "date", "headers", "html",
                                  ["block", "odd.name", "Content_Type", "id"])
    assert records.columns == ["odd.name", "id", *warc.RECORD_COLUMNS]
    found = records.filter("record_type = 'conversion'").select("block", "`odd.name`").collect()
    assert len(found) == 2 and found[0] == found[1] and found[0].block == "\n".join(["x"] * 20_000)
    none = warc.derive_records(source.limit(0), "id", "uri", "date", "headers", "html")
    assert none.count() == 0 and none.columns == warc.RECORD_COLUMNS


def test_derivatives_are_linked(spark):
    rows = [("urn:uuid:1", "http://a/", "2024-01-01T00:00:00Z", "X: 1\r\nY: 2", PAGE, "c"),
            ("urn:uuid:2", None, None, None, None, "c"), ("urn:uuid:3", "u", "d", "", "", None)]
    records = warc.derive_records(responses(spark, rows), "id", "uri", "date", "headers", "html",
                                  ["id"]).collect()
    assert len(records) == 6
    by = {(r.id, r.record_type): r for r in records}
    for source, *_ in rows:
        meta, text = by[source, "metadata"], by[source, "conversion"]
        assert meta.linked_id == text.record_id and text.linked_id == meta.record_id
        assert meta.refers_to == text.refers_to == source
        assert text.record_id in meta.block and text.block_digest in meta.block
        assert all(r.content_length == len(r.block.encode()) for r in (meta, text))
    assert "X: 1\r\nY: 2\r\n" in by["urn:uuid:1", "metadata"].block
    assert by["urn:uuid:2", "conversion"].block == ""
    assert len({r.record_id for r in records}) == 6
    assert warc.derive_records(responses(spark, []), "id", "uri", "date", "headers",
                               "html").count() == 0


def test_files_round_trip(spark, tmp_path):
    rows = [(f"urn:uuid:{i}", f"http://a/{i}", "2024-01-01T00:00:00Z", "X: é", PAGE * (i + 1), "")
            for i in range(20)] + [("urn:uuid:x", None, None, None, None, None)]
    records = warc.derive_records(responses(spark, rows), "id", "uri", "date", "headers", "html")
    path = str(tmp_path / "warc")
    warc.write_warc(records, path, "2024-02-02T00:00:00Z")
    back = warc.read_warc(spark, path).collect()
    assert len(back) == 42 and all(r.whole for r in back)
    assert sorted(r.block for r in back) == sorted(r.block for r in records.collect())
    assert all("WARC-Refers-To: <urn:uuid:" in r.headers for r in back)
    raw = b"".join(p.read_bytes() for p in (tmp_path / "warc").glob("part-*"))
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")


def fill(total, nodes):
    """Shares of ``total`` by weight under caps, in exact fractions, by repeated filling."""
    share, live, left = {}, {n: w for n, (w, _) in nodes.items() if w > 0}, Fraction(total)
    while live:
        level = left / sum(live.values())
        full = [n for n, w in live.items() if nodes[n][1] <= level * w]
        if not full:
            return share | {n: level * w for n, w in live.items()}
        for n in full:
            share[n] = Fraction(nodes[n][1])
            left -= nodes[n][1]
            del live[n]
    return share


WEIGHTS = [(["a"], 3), (["b"], 1), (["z"], 0), (["a", "en"], 2), (["a", "de"], 1)]


def leaf_rows():
    sizes = {("a", "en"): 30, ("a", "de"): 400, ("b", "en"): 500, ("b", None): 90,
             ("z", "en"): 70, (None, "en"): 60}
    return [(i * 100 + j, " ".join(["w"] * 10), d, lang)
            for i, ((d, lang), n) in enumerate(sizes.items()) for j in range(n // 10)]


@pytest.mark.parametrize("fraction, epochs", [(0.3, 1), (0.6, 2), (1.0, 1), (5.0, 3)])
def test_mix_meets_budgets(spark, fraction, epochs):
    rows = leaf_rows()
    docs = spark.createDataFrame(rows, "k long, t string, d string, lang string")
    weights = spark.createDataFrame(WEIGHTS, "path array<string>, weight long")
    mixed = mixing.mix_documents(docs, "k", "t", ["d", "lang"], weights, fraction, epochs,
                                 seed=5).collect()
    leaf = {k: (d, lang) for k, _, d, lang in rows}
    taken, have = defaultdict(int), defaultdict(int)
    for row in mixed:
        taken[leaf[row.key]] += row.tokens_taken
        assert 0 < row.tokens_taken <= row.tokens == 10 and row.epoch < epochs
    for k, *_ in rows:
        have[leaf[k]] += 10 * epochs
    given = {tuple(p): w for p, w in WEIGHTS}
    tops = {d for d, _ in have}
    caps = {d: sum(v for (x, _), v in have.items() if x == d) for d in tops}
    caps["z"] = 0
    total = min(int(fraction * sum(have.values()) / epochs), sum(caps.values()))
    top = fill(total, {d: (given.get((d,), 1), caps[d]) for d in tops})
    for d in tops:
        want = fill(top.get(d, 0), {x: (given.get(x, 1), n) for x, n in have.items() if x[0] == d})
        for x, share in want.items():
            assert abs(taken[x] - (share if d != "z" else 0)) < 3, (x, share, taken[x])
    assert sum(taken.values()) == total
    cuts = [r for r in mixed if r.tokens_taken < r.tokens]
    assert len(cuts) <= len(have)
    pairs = [(r.key, r.epoch) for r in mixed]
    assert len(set(pairs)) == len(pairs)
    partial = {x for x in have if 0 < taken[x] % (have[x] // epochs)}
    assert {leaf[r.key] for r in cuts} <= partial


def test_mix_edges(odd, nothing, spark):
    weights = spark.createDataFrame([], "path array<string>, weight long")
    rows = mixing.mix_documents(odd, "doc_id", "text", ["lang", "source"], weights, 1.0).collect()
    assert all(r.tokens_taken == r.tokens > 0 and r.epoch == 0 for r in rows)
    assert sorted(str(r.key) for r in rows) == ["1", "5", "6", "7", "7", "8", "None"]
    assert mixing.mix_documents(nothing, "doc_id", "text", ["lang"], weights, 0.5).count() == 0
    half = mixing.mix_documents(odd, "doc_id", "text", ["lang", "source"], weights, 0.5, seed=1)
    again = mixing.mix_documents(odd.repartition(7), "doc_id", "text", ["lang", "source"], weights,
                                 0.5, seed=1)
    assert sorted(map(str, half.collect())) == sorted(map(str, again.collect()))
