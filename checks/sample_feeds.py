"""Raw retail feeds derived from a TPC-H-like star schema with an event log.

Gives every feed its own spellings and nesting, names that no builder knows among
them, so that readers and builders have something to harmonise. All work is joins
and projections over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.fixed_values import PAYMENT_GATEWAYS
from bazaarlake.functions.names import FEED_POSITION

_MONTHS_LATER = "interval 344 month"  # moves 1990s orders next to the 2024 events


class SampleFeeds:
    """Lazy raw frames over the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # -- orders -------------------------------------------------------------
    def _orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey as k", "o_custkey as customer",
            "if(o_orderkey % 50 <> 0, concat('TXN-', string(o_orderkey)), null) as txn",
            f"timestamp(o_orderdate + {_MONTHS_LATER}) as at",
            "o_totalprice as total", "floor(o_totalprice / 250) / 100 as usd",
            "concat('City ', string(o_orderkey % 10)) as city",
            "concat('Street ', string(o_orderkey % 100)) as street",
            "case o_orderstatus when 'F' then 'completed' when 'O' then 'pending' end as state",
            "if(o_orderkey % 7 <> 0, 'paid', null) as paid",
            "int(substr(o_orderpriority, 1, 1)) as priority",
        )

    def _channel(self, rows: DataFrame, channel: int) -> DataFrame:
        """One channel's share of the order rows, in its spelling."""
        return self.spelled(rows.filter(f"k % 3 = {channel}"), channel)

    def orders_as(self, channel: int) -> DataFrame:
        """All orders in the spelling of one channel."""
        return self.spelled(self._orders(), channel)

    @staticmethod
    def spelled(rows: DataFrame, channel: int) -> DataFrame:
        """Order rows in the column names and nesting of a channel."""
        store = "string(k % 20)"
        columns = (
            (
                "string(k) as id", "txn as `Transaction-Code`",
                "named_struct('ID', customer) as customer", "at as CreatedAt",
                "named_struct('cityName', city, 'address1', street) as shippingAddress",
                "state as status", "paid as financial_status", "total as amountVND",
                "usd as amount_usd", "concat('note ', string(k)) as `Gift Note`",
            ),
            (
                "string(k) as code", "txn as txn_id", "customer as customerId",
                "at as created_on",
                "named_struct('provinceName', city, 'fullAddress', street) as delivery_address",
                "state as order_status", "total",
            ),
            (
                "string(k) as `Order ID`", "txn as transaction_id", "customer as CustomerId",
                "at as order_date", "city as shipping_city", "street as shipping_address_1",
                "state as status", "paid as payment_status", "total as grand_total_vnd",
                "usd as `Grand-Total USD`",
                "if(k % 4 <> 0, 1000 + k % 20, null) as location_id",
                f"if(k % 4 <> 0, concat('LC', {store}), null) as location_code",
                f"if(k % 4 <> 0, concat('Store ', {store}), null) as location_name",
                f"if(k % 4 <> 0, concat('City ', {store}), null) as location_city",
            ),
        )[channel]
        extra = [c for c in ("line_items", FEED_POSITION) if c in rows.columns]
        if FEED_POSITION not in extra:
            extra.append(f"named_struct('order', k) as {FEED_POSITION}")
        return rows.selectExpr(*columns, *extra)

    def shopify_orders(self) -> DataFrame:
        return self._channel(self._orders(), 0)

    def sapo_orders(self) -> DataFrame:
        return self._channel(self._orders(), 1)

    def online_orders(self) -> DataFrame:
        return self._channel(self._orders(), 2)

    def lines(self) -> DataFrame:
        """Order headers, each with one line: lists stay short whatever an order holds."""
        lines = self.table("lineitem").selectExpr(
            "l_orderkey as k",
            "array(named_struct('variantId', l_partkey, 'qty', l_quantity, "
            "'price', named_struct('VND', floor(l_extendedprice * 100 / l_quantity) / 100), "
            "'lineTotal', if(l_linenumber <> 1, l_extendedprice, null))) as line_items",
            f"struct(l_linenumber, l_suppkey, l_extendedprice, l_quantity) as {FEED_POSITION}",
        )
        return self._orders().join(lines, "k")

    def order_lines(self) -> dict[str, DataFrame]:
        lines = self.lines()
        return {
            "shopify_orders": self._channel(lines, 0),
            "sapo_orders": self._channel(lines, 1),
            "online_orders": self._channel(lines, 2),
        }

    # -- payments -----------------------------------------------------------
    def payments(self, gateway: str) -> DataFrame:
        own = f"k % 4 <> 0 and k % 5 = {PAYMENT_GATEWAYS.index(gateway)}"
        if gateway == "odoo":
            own = f"({own}) or k % 22 = 2"  # second payments of orders paid elsewhere
        rows = self._orders().filter(own).selectExpr(
            "k", "string(k) as order", "customer",
            "coalesce(txn, concat('PAY-', string(k))) as txn",
            "element_at(array(' Success ', 'completed', 'pending', 'error', 'refunded'), "
            "priority) as word",
            "if(k % 17 <> 0, at + make_interval(0, 0, 0, 0, int(k % 200)), null) as at",
            "if(k % 3 = 0, total, floor(total * 50) / 100) as amount",
        )
        columns = {
            "momo": (
                "txn as transactionId", "order as orderId", "customer as customer_id", "amount",
                "case when k % 10 = 0 then 0 when k % 3 <> 0 then 49 end as resultCode",
                "'pending' as message", "'wallet' as payType", "at as response_time_iso",
            ),
            "odoo": (
                "txn as txn_id", "order as reference_id",
                "named_struct('id', customer) as customer", "'odoo' as gateway",
                "'card' as method", "amount", "word as status", "at as paid_at",
            ),
            "paypal": (
                "txn as paypal_transaction_id", "order as order_code",
                "named_struct('customerId', customer) as customer",
                "amount as transaction_amount_vnd", "word as transaction_status",
                "at as transaction_initiation_date",
            ),
            "sapo": (
                "txn as transaction_id", "order as order_id", "customer as customer_id",
                "'counter' as channel", "amount as amount_vnd", "word as payment_status",
                "at as created_at",
            ),
            "zalopay": (
                "txn as app_trans_id", "order as order_code", "customer as customer_id",
                "amount", "case when k % 2 = 0 then 1 when k % 3 = 0 then 2 end as returnCode",
                "word as message",
                "date_format(at, \"yyyy-MM-dd'T'HH:mm:ss\") as server_time_iso",
            ),
        }[gateway]
        return rows.selectExpr(*columns, f"named_struct('order', k) as {FEED_POSITION}")

    def all_payments(self) -> dict[str, DataFrame]:
        return {gateway: self.payments(gateway) for gateway in PAYMENT_GATEWAYS}

    # -- the rest -----------------------------------------------------------
    def bank_transactions(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "string(c_custkey) as id", "c_nationkey as account_id",
            "if(c_acctbal < 0, 'transfer', null) as kind", "c_acctbal as amount",
            "if(c_custkey % 5 <> 0, 'settled', null) as status",
            "if(c_custkey % 97 <> 0, "
            "timestamp(date_add(date'2023-09-01', int(c_custkey % 365))), null) as createdAt",
            f"named_struct('row', c_custkey) as {FEED_POSITION}",
        )

    def cart_events(self) -> DataFrame:
        pick = "int(regexp_extract(props, '([0-9]+)', 1)) % 4"
        return self.table("events").selectExpr(
            "string(event_id) as id",
            "concat(string(user_id), '-', date_format(ts, 'yyyyMMdd')) as session",
            "if(event_id % 13 <> 0, user_id, null) as customer_id", "event_type as type",
            "timestamp(ts) as timestamp", "event_id % 100 as item_id",
            f"case {pick} when 0 then 'ads' when 1 then 'email' when 2 then 'organic' end "
            "as channel",
            "if(event_id % 2 = 0, 'mobile', null) as deviceType", "'chrome' as browser",
            f"if({pick} = 0, 'spring', null) as utmCampaign",
            f"named_struct('row', event_id) as {FEED_POSITION}",
        )

    def _with_nation(self, table: str, key: str) -> DataFrame:
        nations = self.table("nation").select("n_nationkey", "n_name")
        return self.table(table).join(nations, F.col(key) == F.col("n_nationkey"), "left")

    def customers(self) -> DataFrame:
        return self._with_nation("customer", "c_nationkey").selectExpr(
            "string(c_custkey) as id",
            "if(c_custkey % 9 <> 0, concat('user', string(c_custkey), '@example.com'), null) "
            "as email",
            "c_name as name", "n_name as country",
            "timestamp(date_add(date'2023-01-01', int(c_custkey % 700))) as createdAt",
            "if(c_custkey % 3 <> 0, lower(c_mktsegment), null) as customerSegment",
            f"named_struct('row', c_custkey) as {FEED_POSITION}",
        )

    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey as id", "p_name as name", "concat('SKU-', string(p_partkey)) as sku",
            "p_type as category", "p_brand as brand",
            "if(p_partkey % 11 <> 0, p_retailprice, null) as priceVND",
            "if(p_partkey % 7 <> 0, p_size, null) as stock_quantity",
            "case p_partkey % 5 when 0 then ' No ' when 1 then 'yes' end as isActive",
            f"named_struct('row', p_partkey) as {FEED_POSITION}",
        )

    def sapo_locations(self) -> DataFrame:
        return self._with_nation("supplier", "s_nationkey").selectExpr(
            "string(s_suppkey) as id", "concat('S', string(s_suppkey)) as code",
            "s_name as name", "if(s_suppkey % 3 = 0, 'warehouse', null) as type",
            "n_name as city", "if(s_acctbal < 0, 'no', null) as active",
            f"named_struct('order', s_suppkey) as {FEED_POSITION}",
        )

    def staff(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey as id", "s_name as name", "if(s_suppkey % 4 <> 0, 'clerk', null) as role",
            "named_struct('id', s_suppkey % 10) as location",
            "timestamp(date_add(date'2022-01-01', int(s_suppkey % 500))) as joinedAt",
            "if(s_suppkey % 6 = 0, '0', null) as active",
            f"named_struct('row', s_suppkey) as {FEED_POSITION}",
        )

    def raw_sources(self) -> dict[str, object]:
        """The frames ``scan_sources`` would give, orders without their lines."""
        return {
            "customers": self.customers(), "products": self.products(),
            "sapo_locations": self.sapo_locations(), "shopify_orders": self.shopify_orders(),
            "sapo_orders": self.sapo_orders(), "online_orders": self.online_orders(),
            "cart_events": self.cart_events(), "bank_transactions": self.bank_transactions(),
            "payments_by_gateway": self.all_payments(),
        }


def write_all_feeds(feeds: SampleFeeds, root: str) -> None:
    """Every feed under ``root`` in the layout ``scan_sources`` reads.

    Orders are written twice over: their headers, and a header per order line.
    """
    lines = feeds.order_lines()
    for raw, more, path, name in (
        (feeds.shopify_orders(), lines["shopify_orders"], "shopify", "orders_batch"),
        (feeds.sapo_orders(), lines["sapo_orders"], "sapo/batches", "orders"),
        (feeds.online_orders(), lines["online_orders"], "online_orders/online_orders.json.gz",
         "part"),
    ):
        write_feed(raw, f"{root}/{path}", "orders", name)
        write_feed(more, f"{root}/{path}", "orders", name)
    write_feed(feeds.customers(), f"{root}/shared/customers", "customers", "customer_batch")
    for raw, path, key in (
        (feeds.products(), "shared/products.json.gz", "products"),
        (feeds.sapo_locations(), "shared/sapo_locations.json.gz", "locations"),
        (feeds.staff(), "shopify/staff.json.gz", "staff"),
        (feeds.cart_events(), "cart_tracking/cart_events.json.gz", "events"),
        (feeds.bank_transactions(), "mercury/transactions.json.gz", "transactions"),
    ):
        write_feed(raw, f"{root}/{path}", key)
    for gateway, raw in feeds.all_payments().items():
        write_feed(raw, f"{root}/{gateway}/transactions.json.gz", "transactions", "transactions")


def feed_documents(df: DataFrame, key: str, rows_per_document: int = 2_000) -> DataFrame:
    """Envelope documents of a bounded number of rows, in the order of their feed position.

    Rows move twice, into that order and to their documents; a document is made where its
    rows arrive, and once.
    """
    columns = [c for c in df.columns if c != FEED_POSITION]
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    placed = df.select(F.col(FEED_POSITION).alias("at"), row).orderBy("at")
    numbered = placed.withColumn(
        "_document", F.floor(F.monotonically_increasing_id() / rows_per_document))
    documents = numbered.repartitionByRange("_document").groupBy("_document").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "row"))), lambda x: x.row).alias(key))
    return documents.sortWithinPartitions("_document").select(key)


def write_feed(
    df: DataFrame, path: str, key: str, name: str = "part", rows_per_document: int = 2_000
) -> None:
    """Write envelope documents, one gzip file each, of a bounded number of rows.

    Rows keep the order of their feed position: inside a document by sorting its
    list, between documents by the order of the file names.
    """
    feed_documents(df, key, rows_per_document).write.mode("append").option(
        "maxRecordsPerFile", 1).option("mapreduce.output.basename", name).option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path, compression="gzip")
