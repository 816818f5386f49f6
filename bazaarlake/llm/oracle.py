"""DuckDB restatements of the queries that SQL can express."""

from __future__ import annotations

from bazaarlake.llm import queries, secret_scan, warc
from bazaarlake.llm.reputation import LEAST_STRENGTH, MAX_BAD, MOST_STRENGTH, Z

_WORD = r"[^\x20\x09-\x0D]+"


def _share(level: int) -> str:
    """One level of budgets: children of a parent filled in the order of cap / weight."""
    parent = "p" + str(level - 1)
    return f"""
    r{level} AS (SELECT n.*, b.budget AS given,
        coalesce(sum(cap) OVER (PARTITION BY n.{parent} ORDER BY cap::DOUBLE / w, n.p{level}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS taken,
        sum(w) OVER (PARTITION BY n.{parent} ORDER BY cap::DOUBLE / w, n.p{level}
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS open
      FROM n{level} n JOIN b{level - 1} b ON b.{parent} = n.{parent}),
    f{level} AS (SELECT *, cap * open <= (given - taken) * w AS full_node FROM r{level}),
    s{level} AS (SELECT *, given - coalesce(sum(CASE WHEN full_node THEN cap END)
          OVER (PARTITION BY {parent}), 0)::HUGEINT AS rest,
        (sum(CASE WHEN NOT full_node THEN w END) OVER (PARTITION BY {parent}))::HUGEINT AS all_w
      FROM f{level}),
    t{level} AS (SELECT *, rest * w // all_w AS part, rest * w % all_w AS odd FROM s{level}),
    u{level} AS (SELECT *, rest - (sum(CASE WHEN NOT full_node THEN part END)
          OVER (PARTITION BY {parent}))::HUGEINT AS spare,
        row_number() OVER (PARTITION BY {parent}, full_node ORDER BY odd DESC, p{level}) AS nth
      FROM t{level}),
    b{level} AS (SELECT p{level}, CASE WHEN full_node THEN cap
        ELSE part + (nth <= spare)::INT END AS budget FROM u{level})"""


def _mixing() -> str:
    domain = " ".join(f"WHEN '{k}' THEN {v}" for k, v in queries.DOMAIN_WEIGHTS.items())
    language = " ".join(f"WHEN '{k}' THEN {v}" for k, v in queries.LANGUAGE_WEIGHTS.items())
    return rf"""
    WITH docs AS (SELECT doc_id, len(regexp_extract_all(text, '{_WORD}')) AS tokens,
        CASE WHEN num = 0 THEN 'crawl' WHEN num < 10 THEN 'reference' ELSE 'forum' END AS domain,
        coalesce('=' || lang, '-') AS l, coalesce('=' || source, '-') AS s
      FROM (SELECT *, try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) AS num
            FROM documents)),
    d AS (SELECT doc_id, tokens, '' AS p0, domain AS p1, domain || '/' || l AS p2,
        domain || '/' || l || '/' || s AS p3, l FROM docs WHERE tokens > 0),
    leaves AS (SELECT p0, p1, p2, p3, any_value(l) AS l, sum(tokens)::HUGEINT AS available
      FROM d GROUP BY ALL),
    n3 AS (SELECT p2, p3, 1 AS w, available * 4 AS cap FROM leaves),
    n2 AS (SELECT p1, p2, CASE substr(any_value(l), 2) {language} ELSE 1 END AS w,
        (sum(available) * 4)::HUGEINT AS cap FROM leaves GROUP BY ALL),
    n1 AS (SELECT p0, p1, CASE p1 {domain} ELSE 1 END AS w,
        (sum(available) * 4)::HUGEINT AS cap FROM leaves GROUP BY ALL),
    b0 AS (SELECT '' AS p0, least(floor(sum(available) * 0.5::DOUBLE)::HUGEINT,
        (sum(available) * 4)::HUGEINT) AS budget FROM leaves),
    {_share(1)}, {_share(2)}, {_share(3)},
    plan AS (SELECT p3, budget // available AS whole, budget % available AS rest
      FROM b3 JOIN leaves USING (p3) WHERE budget > 0),
    placed AS (SELECT d.doc_id, tokens, plan.*, coalesce(sum(tokens) OVER (PARTITION BY p3
        ORDER BY md5('17|' || whole::VARCHAR || '|' || d.doc_id::VARCHAR), d.doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN plan USING (p3))
    SELECT doc_id, unnest(range(whole::BIGINT))::INT AS epoch, tokens, tokens AS tokens_taken
      FROM placed WHERE whole > 0
    UNION ALL
    SELECT doc_id, whole::INT, tokens, least(tokens, rest - before)::BIGINT
      FROM placed WHERE before < rest"""


def _top_k() -> str:
    return """
    WITH vectors AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE))
        AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, d.vec_id,
        list_inner_product(q.v, d.v)::BIGINT AS score
      FROM vectors q JOIN vectors d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
    ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id
        ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
    SELECT * FROM ranked WHERE rank <= 5"""


def _near_duplicates() -> str:
    """Word windows of all texts, all pairs that share one, then the closure of the links."""
    return rf"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
      FROM documents),
    shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM
      (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words
       WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a
      JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * c >= 85 * (x.n + y.n - c)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION
      SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.c AS component_id, r.c = d.doc_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id"""


def _strength(name: str, groups: str) -> str:
    return f"""
    {name} AS (SELECT CASE WHEN t > 0 THEN b / t ELSE 0 END AS mean,
        CASE WHEN g < 2 OR b = 0 OR b = t THEN {MOST_STRENGTH} ELSE least({MOST_STRENGTH},
          greatest({LEAST_STRENGTH}, (t - nn / t - (g - 1)) / greatest(1e-9,
            (bb - b * (b / t)) / ((b / t) * (1 - b / t)) - (g - 1)) - 1)) END AS strength
      FROM (SELECT count(*) AS g, sum(n)::DOUBLE AS t, sum(bad)::DOUBLE AS b,
          sum(n * n)::DOUBLE AS nn, sum(bad * bad / n) AS bb FROM {groups} WHERE n > 0))"""


def _reputation() -> str:
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
        f"THEN '{{}}'" for h, p, _ in sorted(
            queries.URL_RULES, key=lambda r: -len(r[0] + r[1])))
    ordered = sorted(queries.URL_RULES, key=lambda r: -len(r[0] + r[1]))
    rule = fits.format(*[h + p for h, p, _ in ordered])
    verdict = fits.format(*[v for *_, v in ordered])
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
    WITH page AS (SELECT page_id, translate(coalesce(regexp_extract(url,
          '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{upper}', '{upper.lower()}') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
    outcome AS (SELECT host, (quality = 0 OR toxic = 1)::INT AS bad FROM page JOIN labels
      ON doc_id = try_cast(regexp_extract(path, '/([0-9]{{1,18}})([^0-9].*)?$', 1) AS BIGINT)),
    hosts AS (SELECT host, list_aggregate(string_split(host, '.')[-2:], 'string_agg', '.')
        AS domain, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad
      FROM (SELECT DISTINCT host FROM page) LEFT JOIN outcome USING (host) GROUP BY host),
    domains AS (SELECT domain, string_split(domain, '.')[-1] AS suffix, sum(n) AS n,
        sum(bad) AS bad FROM hosts GROUP BY ALL),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
    {_strength("k0", "suffixes")}, {_strength("k1", "domains")}, {_strength("k2", "hosts")},
    s AS (SELECT suffix, (bad + strength * mean) / (n + strength) AS sm FROM suffixes, k0),
    d AS (SELECT domain, (bad + strength * sm) / (n + strength) AS dm
      FROM domains JOIN s USING (suffix), k1),
    h AS (SELECT host, n, bad, (bad + strength * dm) / (n + strength) AS hm, strength
      FROM hosts JOIN d USING (domain), k2)
    SELECT page_id, host, path, CASE {rule} END AS rule, coalesce(CASE {verdict} END,
        CASE WHEN hm - {Z} * sqrt(hm * (1 - hm) / (n + strength + 1)) > {MAX_BAD}
             THEN 'block' ELSE 'allow' END) AS verdict, n AS n_labelled, bad AS n_bad
    FROM page JOIN h USING (host)"""


def _warc() -> str:
    names = ", ".join("'{}': '{}'".format(name, sign.replace("'", "''"))
                      for name, sign in warc.REFERENCES.items())
    uuid = ("'urn:uuid:' || x[1:8] || '-' || x[9:12] || '-' || x[13:16] || '-' || x[17:20] "
            "|| '-' || x[21:32]")
    return rf"""
    WITH source AS (SELECT page_id, url, coalesce(html, '') AS html,
        'Content-Type: text/html; charset=utf-8' || coalesce(chr(13) || chr(10)
          || 'Content-Length: ' || octet_length(encode(html)), '') AS headers,
        sha256('response' || chr(10) || page_id || chr(10) || coalesce(url, '')) AS x FROM pages),
    named AS (SELECT *, {uuid} AS id FROM source),
    meta AS (SELECT * EXCLUDE x, sha256('metadata' || chr(10) || id) AS x FROM named),
    both_ids AS (SELECT * EXCLUDE x, {uuid} AS mid, sha256('conversion' || chr(10) || id) AS x
      FROM meta),
    a AS (SELECT * EXCLUDE x, {uuid} AS cid, regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(html, '{warc.HIDDEN_PATTERN}', ' ', 'g'), '{warc.SPACE_PATTERN}', ' ', 'g'),
        '{warc.BREAK_PATTERN}', chr(10), 'g'), '{warc.TAG_PATTERN}', '', 'g') AS raw
      FROM both_ids),
    b AS (SELECT *, list_transform(string_split(raw, '&'), lambda part, i: CASE WHEN i = 1
        THEN part ELSE '&' || part END) AS parts FROM a),
    c AS (SELECT *, list_aggregate(list_transform(parts, lambda part: coalesce(
        map {{{names}}}[regexp_extract(part, '^&([A-Za-z][A-Za-z0-9]*);', 1)]
          || substr(part, length(regexp_extract(part, '^&([A-Za-z][A-Za-z0-9]*);', 1)) + 3),
        CASE WHEN regexp_matches(part, '^&#[0-9]{{1,7}};') THEN
          chr(try_cast(regexp_extract(part, '^&#([0-9]+);', 1) AS INT))
            || regexp_replace(part, '^&#[0-9]+;', '') END, part)), 'string_agg', '') AS decoded
      FROM b),
    t AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(coalesce(decoded, ''),
        ' *\n[ \n]*', chr(10), 'g'), ' +', ' ', 'g'), '^[ \n]+|[ \n]+$', '', 'g') AS txt FROM c),
    m AS (SELECT *, 'source-record: ' || id || chr(13) || chr(10)
        || 'source-payload-digest: sha256:' || sha256(html) || chr(13) || chr(10)
        || 'source-payload-bytes: ' || octet_length(encode(html)) || chr(13) || chr(10)
        || 'conversion-record: ' || cid || chr(13) || chr(10)
        || 'conversion-digest: sha256:' || sha256(txt) || chr(13) || chr(10)
        || 'conversion-chars: ' || length(txt) || chr(13) || chr(10)
        || headers || chr(13) || chr(10) AS facts FROM t),
    records AS (
      SELECT *, 'metadata' AS record_type, mid AS record_id, cid AS linked_id,
        'application/warc-fields' AS content_type, facts AS block FROM m
      UNION ALL
      SELECT *, 'conversion', cid, mid, 'text/plain; charset=utf-8', txt FROM m)
    SELECT page_id, record_type, record_id, id AS refers_to, '{queries.FETCHED}' AS refers_to_date,
      url AS target_uri, linked_id, headers AS source_headers, 'sha256:' || sha256(html)
        AS source_digest, content_type, block, octet_length(encode(block))::BIGINT
        AS content_length, 'sha256:' || sha256(block) AS block_digest FROM records"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 (reversed polynomial EDB88320) of a text's UTF-8 bytes."""
    table = list(range(256))
    for _ in range(8):
        table = [(x >> 1) ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})),
        (2 * i + 1)::INT, 2))::BIGINT)), lambda c, b: xor(c >> 8, list_extract({table}::BIGINT[], (xor(c, b)
        & 255) + 1))))"""


def _spelling() -> str:
    """All words under all patterns with one code point left out or masked; shared ones are near."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
    WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text,
        '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{upper}', '{upper.lower()}') AS run FROM documents),
    typed AS (SELECT run, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT)
        || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
      FROM (SELECT run, {_crc32("doc_id::VARCHAR || ':' || run")} AS h FROM runs
            WHERE length(run) >= 6)),
    words AS (SELECT word, count(*) AS n FROM typed WHERE length(word) >= 6 GROUP BY word
      HAVING count(*) >= 5),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
    cut AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS k
      FROM places),
    masked AS (SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS k
      FROM places),
    near AS (
      SELECT a.word, b.word AS other, b.n AS m FROM masked a JOIN masked b USING (i, k)
        WHERE a.word <> b.word
      UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.k
      UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.k),
    best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other
      FROM near GROUP BY word),
    formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
      FROM words w LEFT JOIN best USING (word)),
    steps AS (SELECT word, word AS root, form AS next FROM formed UNION ALL
      SELECT s.word, f.word, f.form FROM steps s JOIN formed f ON f.word = s.next)
    SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
    FROM formed f JOIN steps s ON s.word = f.word AND s.next IS NULL"""


def _any_case(pattern: str) -> str:
    """Letters outside classes and escapes as classes of both cases."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        sign = pattern[at:at + (4 if pattern.startswith("\\x", at) else 1)]
        inside = sign == "[" or (inside and sign != "]")
        both = len(sign) == 1 and sign.isalpha() and not inside
        out.append(f"[{sign.upper()}{sign.lower()}]" if both else sign)
        at += len(sign)
    return "".join(out)


def _secrets() -> str:
    """Matches and the pieces between them give each match's place."""
    parts = []
    for order, rule in enumerate(secret_scan.BASE_RULES + secret_scan.MORE_RULES):
        pattern = (_any_case(rule.pattern) if rule.any_case else rule.pattern).replace("'", "''")
        parts.append(f"""
        SELECT doc_id, {order} AS k, '{rule.kind}' AS kind, place, place + length(hit) AS till FROM (
          SELECT doc_id, hits[i] AS hit, coalesce(list_sum(list_transform(hits[1:i - 1],
              lambda x: length(x))), 0)::BIGINT + list_sum(list_transform(pieces[1:i],
              lambda x: length(x)))::BIGINT AS place
          FROM (SELECT doc_id, hits, pieces, unnest(range(1, len(hits) + 1)) AS i FROM
            (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits,
               string_split_regex(text, '{pattern}') AS pieces FROM documents) WHERE len(hits) > 0))
        WHERE length(regexp_extract(hit, '{pattern}', {rule.group})) >= {rule.least}""")
    base = len(secret_scan.BASE_RULES)
    count = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}"
                      for r in secret_scan.BASE_RULES)
    sums = ", ".join(f"sum((kind = '{r.kind}')::INT) AS n_{r.kind}"
                     for r in secret_scan.BASE_RULES)
    return f"""
    WITH found AS ({" UNION ALL ".join(parts)}),
    spans AS (SELECT doc_id, {sums}, string_agg(kind || ':' || place || ':' || till, ','
        ORDER BY place, k) AS spans, string_agg(kind || ':' || place || ':' || till, ','
        ORDER BY place, k) FILTER (k < {base}) AS base FROM found GROUP BY doc_id)
    SELECT doc_id, {count}, sha256(coalesce(base, '')) AS base_sha256,
      coalesce(spans, '') AS spans FROM documents LEFT JOIN spans USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": _mixing(), "op2_top_k": _top_k(),
            "op3_near_duplicates": _near_duplicates(),
            "op8_url_filters": _reputation(), "op9_warc": _warc(),
            "op11_spelling_variants": _spelling(), "op13_secret_scans": _secrets()}
