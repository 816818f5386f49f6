"""Gzip JSON feeds: one document per file, a list, an envelope or one object.

A feed path may name a file or a Spark-style folder of part files, and every
scanner takes a glob, so a feed grows by adding files. Gzip cannot be split:
parallelism is the number of files.

A row is read as a map from name to raw text, whatever its JSON types, because
feeds disagree on them (ids as number or string); the builders cast later. Names
are put into snake case in that map, before any is looked for, so every spelling of
a name is found; of colliding spellings the first that holds a value wins. Known names
become columns, all others stay in the map ``other_fields``. No inference pass
runs over the data.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import fixed_values as fixed
from bazaarlake.functions.names import FEED_POSITION, snake

log = logging.getLogger(__name__)

_GLOB = "*.json.gz"
_MAP, _MAPS = "map<string,string>", "array<map<string,string>>"
OTHER = "other_fields"


def list_feed(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Paths below a prefix that end in ``.json.gz`` (any depth), in name order.

    Only names are read: the binary source skips the content when it is pruned.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", _GLOB).load(_join(root, prefix))
    )
    return files.select(F.col("_metadata.file_path").alias("path")).orderBy("path")


def _join(root: str, prefix: str) -> str:
    return f"{root.rstrip('/')}/{prefix.strip('/')}".rstrip("/")


@dataclass(frozen=True)
class Feed:
    """The names a feed's builder looks for, and the envelope's key."""

    key: str
    names: tuple[str, ...]
    nested: tuple[tuple[str, str], ...] = ()
    items: bool = False


_ITEM_NAMES = tuple(dict.fromkeys((
    *fixed.ITEM_PRODUCT, *fixed.ITEM_QUANTITY, *fixed.ITEM_UNIT_PRICE, *fixed.ITEM_LINE_TOTAL,
    "transaction_id", "order_key", *fixed.ITEM_PARENT_DATE[:1],
)))
# Names of objects inside an order line, as in a price by currency.
_INNER = ("vnd", "usd", "amount", "id", "value")
ORDERS = Feed("orders", (
    *fixed.ORDER_ID, *fixed.ORDER_TRANSACTION, *fixed.ORDER_CUSTOMER, *fixed.ORDER_DATE,
    *fixed.SHIPPING_CITY, *fixed.SHIPPING_ADDRESS, *fixed.ORDER_STATUS,
    *fixed.ORDER_PAYMENT_STATUS, *fixed.ORDER_TOTAL_VND, *fixed.ORDER_TOTAL_USD,
    "channel", "source", *fixed.ORDER_STORE,
), (*fixed.CUSTOMER_NESTED, *fixed.SHIPPING_CITY_NESTED, *fixed.SHIPPING_ADDRESS_NESTED), True)
PAYMENTS = Feed("transactions", (
    *fixed.PAYMENT_TRANSACTION, *fixed.PAYMENT_ORDER, *fixed.ORDER_CUSTOMER,
    *fixed.PAYMENT_GATEWAY, *fixed.PAYMENT_METHOD, *fixed.PAYMENT_AMOUNT, *fixed.PAYMENT_STATUS,
    *fixed.PAYMENT_DATE, *fixed.PAYMENT_CODES,
), fixed.CUSTOMER_NESTED)
BANK = Feed("transactions", (
    *fixed.BANK_TRANSACTION, *fixed.BANK_ACCOUNT, *fixed.BANK_TYPE, *fixed.BANK_AMOUNT, "status",
    *fixed.BANK_DATE,
))
EVENTS = Feed("events", (
    *fixed.EVENT_ID, *fixed.EVENT_SESSION, "customer_id", *fixed.EVENT_TYPE, *fixed.EVENT_TIME,
    *fixed.EVENT_PRODUCT, *fixed.EVENT_SOURCE, *fixed.EVENT_DEVICE, "browser", "utm_source",
    "utm_campaign",
))
CUSTOMERS = Feed("customers", fixed.CUSTOMER_NAMES)
PRODUCTS = Feed("products", fixed.PRODUCT_NAMES)
LOCATIONS = Feed("locations", (
    *fixed.LOCATION_ID, *fixed.LOCATION_CODE, *fixed.LOCATION_NAME, *fixed.LOCATION_TYPE,
    "city", "address", "phone", *fixed.IS_ACTIVE,
))
STAFF = Feed("staff", (
    *fixed.STAFF_ID, *fixed.STAFF_CODE, *fixed.STAFF_NAME, *fixed.STAFF_POSITION, "email",
    "phone", *fixed.STAFF_LOCATION, *fixed.STAFF_HIRED, *fixed.IS_ACTIVE,
), fixed.STAFF_LOCATION_NESTED)


# -- names inside maps --------------------------------------------------------
def _snake(name: Column, likely: Column | None = None) -> Column:
    """``functions.names.snake`` as an expression.

    ``likely`` maps spellings that often come to their snake case, so that the patterns
    run over the others alone.
    """
    humps = F.regexp_replace(name, "(?<=[0-9a-z])(?=[A-Z])", "_")
    made = F.lower(F.btrim(F.regexp_replace(humps, "[^0-9A-Za-z]+", "_"), F.lit("_")))
    return made if likely is None else F.coalesce(F.try_element_at(likely, name), made)


def _snakes(names: Column, likely: Column | None = None) -> Column:
    return F.transform(names, lambda name: _snake(name, likely))


def _spellings(names: Iterable[str]) -> Column:
    """Names as they are, in camel case and in capitals, each with its snake case."""
    found = dict.fromkeys(names)
    for name in list(found):
        first, *more = name.split("_")
        found |= dict.fromkeys((first + "".join(map(str.capitalize, more)), name.upper()))
    return F.create_map(*[F.lit(x) for spelled in found for x in (spelled, snake(spelled))])


# Rows of a file that are looked at for lists of names, and how many lists are put into snake
# case once; rows with any other list have their names put into snake case one by one.
_LOOKED, _LIKELY = 256, 64


def _file_kinds(listed: Column) -> Column:
    """The first lists of names that a file's rows have, each with its snake case.

    A list in which two names are the same in snake case has none.
    """
    def named(names: Column) -> Column:
        return F.when(F.size(F.array_distinct(names)) == F.size(names), names)

    first = F.transform(F.slice(listed, 1, _LOOKED), lambda raw: F.map_keys(raw))
    kinds = F.slice(F.array_distinct(F.array_compact(first)), 1, _LIKELY)
    return _bound(kinds, lambda found: F.map_from_arrays(found, F.transform(
        found, lambda names: _bound(_snakes(names), named))))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entries(fields: Column, likely: Column | None = None) -> Column:
    return F.transform(F.map_entries(fields), lambda e: F.struct(
        _snake(e.key, likely).alias("k"), e.value.alias("v")))


def _inner_entries(entries: Column) -> Column:
    """Entries that hold an object replaced by its entries, named ``outer_inner``."""
    def opened(e: Column) -> Column:
        inner = F.transform(_entries(F.from_json(e.v, _MAP), _spellings(_INNER)), lambda x: F.struct(
            F.concat(e.k, F.lit("_"), x.k).alias("k"), x.v.alias("v")))
        return F.when(e.v.startswith("{"), F.coalesce(inner, F.array(e))).otherwise(F.array(e))

    return F.flatten(F.transform(entries, opened))


def _named(entries: Column) -> Column:
    """A map of entries; of one name's values the first that is not null.

    Names are looked for one by one only where some come twice.
    """
    def of(es: Column, names: Column) -> Column:
        firsts = F.transform(F.array_distinct(names), lambda n: F.get(
            es.v, (F.array_position(names, n) - 1).cast("int")))
        return F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_arrays(
            names, es.v)).otherwise(F.map_from_arrays(F.array_distinct(names), firsts))

    known = F.filter(entries, lambda e: e.v.isNotNull())
    return _bound(known, lambda es: _bound(es.k, lambda names: of(es, names)))


def _others(fields: Column, known: Iterable[str]) -> Column:
    names = list(dict.fromkeys(known))
    return F.map_filter(fields, lambda k, _: ~k.isin(*names))


def _item(raw: Column) -> Column:
    """An order line with objects inside it flattened, however deep they are.

    A line is opened once per brace inside its values, which is at least its depth; lines
    without objects are not opened at all.
    """
    braces = F.array_max(F.transform(F.map_values(raw), lambda v: F.when(
        v.startswith("{"), F.length(v) - F.length(F.replace(v, F.lit("{"), F.lit(""))))))
    levels = F.when(braces > 0, F.sequence(F.lit(1), braces)).otherwise(F.array().cast("array<int>"))
    entries = F.aggregate(levels, _entries(raw, _spellings(_ITEM_NAMES)),
                          lambda es, _: _inner_entries(es))
    return _bound(_named(entries), lambda m: F.struct(
        *[F.try_element_at(m, F.lit(n)).alias(n) for n in _ITEM_NAMES],
        _others(m, _ITEM_NAMES).alias(OTHER)))


def _objects(feed: Feed) -> dict[str, list[str]]:
    """The names looked for inside each column that may hold an object."""
    found: dict[str, list[str]] = {}
    for column, path in feed.nested:
        found.setdefault(column, []).append(path)
    return {column: list(dict.fromkeys(paths)) for column, paths in found.items()}


def _opened(rows: DataFrame, feed: Feed) -> DataFrame:
    """``fields``, and per object its raw map and names: one step each, so made once."""
    objects = _objects(feed)
    raw = rows.select("fields", FEED_POSITION, *[F.from_json(F.try_element_at(
        "fields", F.lit(column)), _MAP).alias(f"_{column}") for column in objects])
    return raw.select("*", *[_snakes(F.map_keys(f"_{column}"), _spellings(paths)).alias(
        f"_{column}_names") for column, paths in objects.items()])


def _inside(column: str, name: str) -> Column:
    """A name's value in an opened object; of several spellings the first that is not null."""
    values, names = F.map_values(f"_{column}"), F.col(f"_{column}_names")
    first = F.get(values, (F.array_position(names, F.lit(name)) - 1).cast("int"))
    known = F.filter(F.arrays_zip(names.alias("k"), values.alias("v")),
                     lambda e: (e.k == name) & e.v.isNotNull())
    repeated = F.size(F.array_distinct(names)) < F.size(names)
    return F.coalesce(first, F.when(repeated, F.get(known, F.lit(0)).v))


def _columns(feed: Feed) -> list[Column]:
    """Known names as text, known objects as structs, order lines, and the rest as a map."""
    fields, objects = F.col("fields"), _objects(feed)
    names = [n for n in dict.fromkeys(feed.names) if n not in objects]
    out = [F.try_element_at(fields, F.lit(n)).alias(n) for n in names]
    for column, paths in objects.items():
        out.append(F.when(F.col(f"_{column}").isNotNull(), F.struct(
            *[_inside(column, path).alias(path) for path in paths])).alias(column))
    known = [*names, *objects]
    if feed.items:
        lines = F.from_json(F.try_element_at(fields, F.lit("line_items")), _MAPS)
        out.append(F.transform(lines, _item).alias("line_items"))
        known.append("line_items")
    return [*out, _others(fields, known).alias(OTHER)]


# -- documents ----------------------------------------------------------------
def read_json_gz(
    spark: SparkSession, paths: str | list[str], key: str,
    keep_name: str | None = None, drop_name: str | None = None, keep_path: str | None = None,
) -> DataFrame:
    """(file, listed): each file's rows as maps of raw text; null where it cannot be read.

    A file holds a list, an envelope with a list under ``key``, or one object. Files
    that vanish or whose archive is broken give no row (``skipped_files`` names
    them). ``keep_name`` and ``drop_name`` are patterns on the lower-cased file name,
    ``keep_path`` is a part of the path below the folder read; Spark prunes files by
    them before opening any.
    """
    documents = (
        spark.read.option("wholetext", True)
        .option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        .option("recursiveFileLookup", True).option("pathGlobFilter", _GLOB)
        .text(paths)
    )
    documents = _named_files(documents, paths, keep_name, drop_name, keep_path)
    text = F.ltrim(F.col("value"))
    listed = F.when(text.startswith("["), F.from_json(text, _MAPS)).otherwise(F.coalesce(
        F.from_json(text, f"struct<`{key}`:{_MAPS}>")[key],
        F.array(F.from_json(text, _MAP))))
    return documents.select(F.col("_metadata.file_path").alias("file"), listed.alias("listed"))


def _named_files(files: DataFrame, paths: str | list[str], keep_name: str | None,
                 drop_name: str | None, keep_path: str | None) -> DataFrame:
    name = F.lower(F.col("_metadata.file_name"))
    if keep_name is not None:
        files = files.filter(name.rlike(keep_name))
    if drop_name is not None:
        files = files.filter(~name.rlike(drop_name))
    if keep_path is not None:
        root = paths if isinstance(paths, str) else paths[0]
        below = F.substring_index(F.col("_metadata.file_path"), root.split("://")[-1], -1)
        files = files.filter(below.contains(keep_path))
    return files


def unwrap_envelope(documents: DataFrame) -> DataFrame:
    """(fields, feed_position) per row; the position is file and place in the file.

    ``fields`` maps snake-case names to raw text. Rows without any value are left out.
    They are found on the raw map, as Spark would work a filter on names out a second time.
    """
    # Each step is one projection: names are worked out once for a file's rows with like names.
    kinds = documents.withColumn("kinds", _file_kinds(F.col("listed")))
    rows = kinds.select("file", "kinds", F.posexplode(_once("listed")).alias("row", "raw"))
    held = rows.filter(F.exists(F.map_values("raw"), lambda v: v.isNotNull()))
    named = held.select("file", "row", "raw", F.try_element_at(
        "kinds", F.map_keys("raw")).alias("names"))
    straight = F.map_from_arrays("names", F.map_values("raw"))
    fields = F.when(F.col("names").isNull(), _named(_entries(F.col("raw")))).when(
        F.exists(F.map_values("raw"), lambda v: v.isNull()),
        F.map_filter(straight, lambda _, v: v.isNotNull())).otherwise(straight)
    return named.select(fields.alias("fields"), F.struct("file", "row").alias(FEED_POSITION))


def _once(list_column: str) -> Column:
    """A list to unfold: for a bare column Spark adds a filter on its size, below all that
    makes it, and so makes it twice."""
    return F.coalesce(F.col(list_column), F.array())


def _scan(spark: SparkSession, path: str, feed: Feed, **names: str | None) -> DataFrame:
    position = "struct<file:string,row:int>"
    try:
        rows = unwrap_envelope(read_json_gz(spark, path, feed.key, **names))
    except Exception as error:  # an absent feed is an empty table
        if "PATH_NOT_FOUND" not in str(error):
            raise
        log.error("feed %s not found, read as empty", path)
        rows = spark.createDataFrame([], f"fields {_MAP}, {FEED_POSITION} {position}")
    return _opened(rows, feed).select(*_columns(feed), FEED_POSITION)


def feed_report(spark: SparkSession, root: str, frames: dict[str, DataFrame]) -> DataFrame:
    """feed, row_count, column_count, skipped: what was read, and files that gave no row.

    ``frames`` are scanned feeds, best as written copies. Columns are the names that hold
    a value, known or not. ``skipped`` lists files that are there but could not be read
    or hold no row.
    """
    listed = list_feed(spark, root).select(F.col("path").alias("file"))
    parts = []
    for name, df in frames.items():
        known = [c for c in df.columns if c not in (OTHER, FEED_POSITION)]
        # Plain aggregates per file and list of other names: rows with like names are few groups.
        held = df.groupBy(F.col(f"{FEED_POSITION}.file").alias("file"), F.map_keys(OTHER).alias(
            "others")).agg(F.count(F.lit(1)).alias("rows"), *[
                F.bool_or(F.col(c).isNotNull()).alias(f"has_{i}") for i, c in enumerate(known)])
        seen = F.array_compact(F.array(*[
            F.when(F.col(f"has_{i}"), F.lit(c)) for i, c in enumerate(known)]))
        parts.append(held.select(F.lit(name).alias("feed"), "file", "rows", F.array_union(
            seen, "others").alias("columns")))
    read = parts[0]
    for part in parts[1:]:
        read = read.unionByName(part)
    totals = read.groupBy("feed").agg(
        F.sum("rows").alias("row_count"),
        F.size(F.array_distinct(F.flatten(F.collect_set("columns")))).alias("column_count"))
    folders = read.select("feed", F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
    missed = listed.join(read.select("file").distinct(), "file", "left_anti").withColumn(
        "folder", F.regexp_replace("file", "/[^/]*$", "")).join(folders, "folder").groupBy(
        "feed").agg(F.sort_array(F.collect_list("file")).alias("skipped"))
    return totals.join(missed, "feed", "left").withColumn(
        "skipped", F.coalesce("skipped", F.array().cast("array<string>")))


def skipped_files(spark: SparkSession, root: str, prefix: str, scanned: DataFrame) -> DataFrame:
    """(path, reason) of the files below a prefix from which ``scanned`` has no row."""
    read = scanned.select(F.col(f"{FEED_POSITION}.file").alias("path")).distinct()
    missed = list_feed(spark, root, prefix).join(read, "path", "left_anti")
    # As the load's report does, the driver takes the names of files that gave nothing.
    return reasons(spark, [row.path for row in missed.collect()] + _empty_files(
        spark, _join(root, prefix)))


def _empty_files(spark: SparkSession, folder: str) -> list[str]:
    """Feed files without a byte, which Spark's readers do not list."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed, found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True), []
    while listed.hasNext():
        status = listed.next()
        if status.getLen() == 0 and status.getPath().getName().endswith(_GLOB[1:]):
            found.append(status.getPath().toString())
    return found


REASONS = ("vanished", "empty file", "not gzip", "broken archive", "not JSON", "no rows")


def reasons(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, reason) for files that gave no row, one of ``REASONS`` each.

    Only these files are opened: their sizes and first bytes as binary files, their
    texts by the reader that skips what it cannot unpack.
    """
    named = spark.createDataFrame([(p,) for p in paths], "path string")
    if not paths:
        return named.withColumn("reason", F.lit(""))
    there = spark.read.format("binaryFile").option("ignoreMissingFiles", True)
    text = spark.read.option("wholetext", True).option("ignoreCorruptFiles", True).option(
        "ignoreMissingFiles", True)
    sizes = {p: _size(spark, p) for p in paths}
    present = [p for p, size in sizes.items() if size]
    empty = [p for p, size in sizes.items() if size == 0]
    files = named.limit(0).selectExpr("path", "0L AS size", "false AS packed")
    texts = named.limit(0).selectExpr("path", "'' AS text")
    if present:
        files = there.load(present).select(
            F.col("_metadata.file_path").alias("path"), F.col("length").alias("size"),
            F.hex(F.substring("content", 1, 2)).eqNullSafe("1F8B").alias("packed"))
        texts = text.text(present).select(
            F.col("_metadata.file_path").alias("path"), F.btrim("value").alias("text"))
    reason = (
        F.when(F.col("path").isin(empty), "empty file").when(F.col("size").isNull(), "vanished")
        .when(~F.col("packed"), "not gzip").when(F.col("text").isNull(), "broken archive")
        .when(F.try_parse_json("text").isNull(), "not JSON").otherwise("no rows"))
    return named.join(files, "path", "left").join(texts, "path", "left").select(
        "path", reason.alias("reason"))


def _size(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file, None where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(target).getLen() if system.exists(target) else None


def scan_customers(
    spark: SparkSession, root: str, prefix: str = "shared/customers/"
) -> DataFrame:
    """Files named after customers; when there are none, every file of the folder."""
    path, named = _join(root, prefix), "customer"
    try:
        name = F.lower(F.element_at(F.split("path", "/"), -1))
        if list_feed(spark, root, prefix).filter(name.contains(named)).isEmpty():
            log.warning("no customer file name below %s; reading all files", path)
            named = None
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    return _scan(spark, path, CUSTOMERS, keep_name=named)


def scan_products(spark: SparkSession, root: str, prefix: str = "shared/") -> DataFrame:
    return _scan(spark, _join(root, prefix + "products.json.gz"), PRODUCTS)


def scan_sapo_orders(spark: SparkSession, root: str, prefix: str = "sapo/") -> DataFrame:
    return _scan(spark, _join(root, prefix), ORDERS,
                 keep_name="order", drop_name="transaction|location")


def scan_sapo_locations(spark: SparkSession, root: str, prefix: str = "shared/") -> DataFrame:
    return _scan(spark, _join(root, prefix + "sapo_locations.json.gz"), LOCATIONS)


def scan_shopify_orders(spark: SparkSession, root: str, prefix: str = "shopify/") -> DataFrame:
    """Files whose path holds ``orders_batch`` (case matters)."""
    return _scan(spark, _join(root, prefix), ORDERS, keep_path="orders_batch")


def scan_shopify_staff(spark: SparkSession, root: str, prefix: str = "shopify/") -> DataFrame:
    return _scan(spark, _join(root, prefix + "staff.json.gz"), STAFF)


def scan_online_orders(
    spark: SparkSession, root: str, prefix: str = "online_orders/"
) -> DataFrame:
    return _scan(spark, _join(root, prefix + "online_orders.json.gz"), ORDERS)


def scan_cart_events(spark: SparkSession, root: str, prefix: str = "cart_tracking/") -> DataFrame:
    return _scan(spark, _join(root, prefix + "cart_events.json.gz"), EVENTS)


def scan_bank_transactions(spark: SparkSession, root: str, prefix: str = "mercury/") -> DataFrame:
    return _scan(spark, _join(root, prefix + "transactions.json.gz"), BANK)


def scan_payments(
    spark: SparkSession, root: str, gateway: str, prefix: str | None = None
) -> DataFrame:
    if gateway not in fixed.PAYMENT_GATEWAYS:
        raise ValueError(f"unknown gateway {gateway!r}; known: {fixed.PAYMENT_GATEWAYS}")
    folder = f"{gateway}/" if prefix is None else prefix
    return _scan(spark, _join(root, folder + "transactions.json.gz"), PAYMENTS)


def scan_all_payments(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {gateway: scan_payments(spark, root, gateway) for gateway in fixed.PAYMENT_GATEWAYS}


def scan_sources(spark: SparkSession, root: str) -> dict[str, object]:
    """The wired feeds as lazy frames, payments keyed by gateway."""
    return {
        "customers": scan_customers(spark, root),
        "products": scan_products(spark, root),
        "sapo_locations": scan_sapo_locations(spark, root),
        "shopify_orders": scan_shopify_orders(spark, root),
        "sapo_orders": scan_sapo_orders(spark, root),
        "online_orders": scan_online_orders(spark, root),
        "cart_events": scan_cart_events(spark, root),
        "bank_transactions": scan_bank_transactions(spark, root),
        "payments_by_gateway": scan_all_payments(spark, root),
    }


