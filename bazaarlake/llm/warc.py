"""Metadata and plain-text conversion records derived from WARC responses."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm.batches import quoted

# Fixed values of HTML: elements without readable text, elements that break lines.
UNREAD = "script style noscript template textarea svg".split()
BREAKING = ("address article aside blockquote body br dd div dl dt fieldset figure footer form "
            "h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section table td "
            "th title tr ul").split()
# All named references that end in a semicolon, as HTML lists them.
REFERENCES = {name[:-1]: sign for name, sign in html5.items() if name.endswith(";")}
HIDDEN_PATTERN = "(?is)<(?:!--.*?-->|" + "|".join(
    rf"{name}\b[^>]*>.*?</{name}\s*>" for name in UNREAD) + ")"
# White space other than single spaces, which stay as they are.
SPACE_PATTERN = r"[\t\r\n\f][ \t\r\n\f]*| [ \t\r\n\f]+"
BREAK_PATTERN = rf"(?is)</?(?:{'|'.join(BREAKING)})\b[^>]*>"
TAG_PATTERN = r"(?s)<[/!?A-Za-z][^>]*>"
VERSION = "WARC/1.1"
RECORD_COLUMNS = ("record_type record_id refers_to refers_to_date target_uri linked_id "
                  "source_headers source_digest content_type block content_length "
                  "block_digest").split()
_END = "\r\n\r\n"


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it occurs."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def decode_references(text: Column) -> Column:
    """Numeric references and the named ones of ``REFERENCES``, each decoded once."""
    # A map is searched from its start, so names are looked up below their first letter.
    named: dict[str, list[Column]] = {}
    for name, sign in REFERENCES.items():
        named.setdefault(name[0], []).extend([F.lit(name), F.lit(sign)])
    by_letter = F.create_map(*[x for letter, pairs in named.items()
                               for x in (F.lit(letter), F.create_map(*pairs))])

    def sign_of(name: Column) -> Column:
        code = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 9), 16, 10).cast(
            "long")).when(name.startswith("#"), F.substring(name, 2, 9).cast("long"))
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")),
                        "UTF-32")
        return F.when(name.startswith("#"), sign).otherwise(
            F.try_element_at(F.try_element_at(by_letter, F.substring(name, 1, 1)), name))

    def decoded(part: Column, at: Column) -> Column:
        name = F.regexp_extract(
            part, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        whole = F.concat(F.lit("&"), part)
        return F.when(at == 0, part).otherwise(_once(name, lambda n: F.when(n == "", whole).otherwise(
            F.coalesce(F.concat(sign_of(n), part.substr(F.length(n) + 2, F.length(part))), whole))))

    return _once(text, lambda t: F.when(F.instr(t, "&") == 0, t).otherwise(
        F.array_join(F.transform(F.split(t, "&"), decoded), "")))


def plain_text(html: Column) -> Column:
    """Readable text of a page: one line per block, single spaces, references decoded."""
    text = F.regexp_replace(html, HIDDEN_PATTERN, " ")
    text = F.regexp_replace(text, SPACE_PATTERN, " ")
    text = F.regexp_replace(text, BREAK_PATTERN, "\n")
    text = decode_references(F.regexp_replace(text, TAG_PATTERN, ""))
    text = F.regexp_replace(text, r" +\n[ \n]*|\n[ \n]+", "\n")
    return F.btrim(F.regexp_replace(text, "  +", " "), F.lit(" \n"))


def record_uuid(*parts: Column) -> Column:
    """A name-based ``urn:uuid`` of the parts: the same source gives the same record id."""
    return F.regexp_replace(F.sha2(F.concat_ws("\n", *parts), 256),
                            "^(.{8})(.{4})(.{4})(.{4})(.{12}).*", "urn:uuid:$1-$2-$3-$4-$5")


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def header_lines(*pairs: tuple[str, Column]) -> Column:
    """``Name: value`` lines; those with a null value are left out."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), value.cast("string"))
                                 for name, value in pairs])


def derive_records(
    responses: DataFrame, record_id: str, uri: str, date: str, headers: str, payload: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """A metadata and a conversion record for each response record.

    Columns: those of ``keep``, then record_type, record_id, refers_to,
    refers_to_date, target_uri, linked_id (the sibling record), source_headers,
    source_digest, content_type, block, content_length, block_digest. The
    conversion's block is the page's plain text; the metadata's lists the source's
    headers, digests and sizes and names the conversion. A null or empty payload gives an
    empty conversion, a null uri, date or header text leaves its line out; pages of any
    length are taken whole. Equal responses give equal records, no rows give no records.
    Columns of ``keep`` that have a name of the list (in any case) are replaced by it.
    One scan, no shuffle.
    """
    of = lambda name: F.col(quoted(name)).cast("string")
    kept = [c for c in keep or () if c.lower() not in RECORD_COLUMNS]
    source = responses.select(
        *[F.col(quoted(c)).alias(f"__kept_{i}") for i, c in enumerate(kept)],
        of(record_id).alias("__id"),
        of(uri).alias("__uri"), of(date).alias("__date"), of(headers).alias("__headers"),
        F.coalesce(of(payload), F.lit("")).alias("__payload"))
    source = source.withColumns({
        "__digest": digest(F.col("__payload")),
        "__conversion": record_uuid(F.lit("conversion"), F.col("__id")),
        "__metadata": record_uuid(F.lit("metadata"), F.col("__id")),
        "__text": plain_text(F.col("__payload"))})
    source = source.withColumn("__text_digest", digest(F.col("__text")))
    facts = F.concat(header_lines(
        ("source-record", F.col("__id")), ("source-payload-digest", F.col("__digest")),
        ("source-payload-bytes", F.octet_length("__payload")),
        ("conversion-record", F.col("__conversion")),
        ("conversion-digest", F.col("__text_digest")),
        ("conversion-chars", F.length("__text"))), F.lit("\r\n"),
        F.coalesce(F.concat("__headers", F.lit("\r\n")), F.lit("")))
    source = source.withColumn("__facts", facts)
    record = lambda kind, own, other, content, block, sum_: F.struct(
        F.lit(kind).alias("record_type"), F.col(own).alias("record_id"),
        F.col(other).alias("linked_id"), F.lit(content).alias("content_type"),
        F.col(block).alias("block"), sum_.alias("block_digest"))
    two = F.array(record("metadata", "__metadata", "__conversion", "application/warc-fields",
                         "__facts", digest(F.col("__facts"))),
                  record("conversion", "__conversion", "__metadata",
                         "text/plain; charset=utf-8", "__text", F.col("__text_digest")))
    made = {
        "record_type": F.col("__record.record_type"), "record_id": F.col("__record.record_id"),
        "refers_to": F.col("__id"), "refers_to_date": F.col("__date"),
        "target_uri": F.col("__uri"), "linked_id": F.col("__record.linked_id"),
        "source_headers": F.col("__headers"), "source_digest": F.col("__digest"),
        "content_type": F.col("__record.content_type"), "block": F.col("__record.block"),
        "content_length": F.octet_length("__record.block").cast("long"),
        "block_digest": F.col("__record.block_digest")}
    return source.withColumn("__record", F.explode(two)).select(
        *[F.col(f"__kept_{i}").alias(c) for i, c in enumerate(kept)],
        *[made[name].alias(name) for name in RECORD_COLUMNS])


def record_text(records: DataFrame, made: str) -> Column:
    """The whole WARC record without the two line ends that follow it."""
    angle = lambda name: F.concat(F.lit("<"), F.col(name), F.lit(">"))
    return F.concat(F.lit(VERSION + "\r\n"), header_lines(
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", angle("record_id")),
        ("WARC-Date", F.lit(made)), ("WARC-Refers-To", angle("refers_to")),
        ("WARC-Refers-To-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To-Date", F.col("refers_to_date")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Related-Record-ID", angle("linked_id")),
        ("WARC-Source-Payload-Digest", F.col("source_digest")),
        ("WARC-Block-Digest", F.col("block_digest")), ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length"))), F.lit(_END), F.col("block"))


def write_warc(records: DataFrame, path: str, made: str) -> None:
    """WARC files, one per task, by Spark's text writer with the record end as separator."""
    records.select(record_text(records, made).alias("value")).write.option(
        "lineSep", _END).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of uncompressed text WARC files as (headers, block, whole).

    Files are split at record ends, so large files are read by many tasks. ``whole``
    is false where a block does not have its Content-Length, as when a block
    holds the start of another record.
    """
    raw = spark.read.option("lineSep", f"{_END}{VERSION}\r\n").text(path)
    body = F.regexp_replace("value", rf"^{VERSION}\r\n", "")
    body = F.regexp_replace(body, r"\r\n\r\n\z", "")
    head = F.substring_index(body, _END, 1)
    rows = raw.select(head.alias("headers"), body.substr(
        F.length(head) + 5, F.length(body)).alias("block"))
    return rows.withColumn("whole", F.octet_length("block") == F.regexp_extract(
        "headers", r"(?i)(?:^|\n)Content-Length: *([0-9]+)", 1).try_cast("int"))
