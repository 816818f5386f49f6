"""Names, tokens and thresholds that decide results.

Everything below is data, stated as text in its natural order. The order of a
candidate list matters: the first spelling that holds a value wins.
"""

from __future__ import annotations

# --- order spellings -------------------------------------------------------
ORDER_ID = ("order_id", "id", "code", "order_number")
ORDER_TRANSACTION = ("transaction_id", "txn_id", "transaction_code")
ORDER_CUSTOMER = ("customer_id",)
CUSTOMER_NESTED = (("customer", "id"), ("customer", "customer_id"))
ORDER_DATE = ("order_date", "created_at", "created_on", "timestamp", "response_time_iso")
# Items inherit the order date from a shorter list than the order itself uses.
ITEM_PARENT_DATE = ("order_date", "created_at", "created_on", "timestamp")
SHIPPING_CITY = (
    "shipping_city", "delivery_city",
    "shipping_province", "delivery_province",
    "shipping_province_name", "delivery_province_name",
)
SHIPPING_CITY_NESTED = (
    ("shipping_address", "city"), ("shipping_address", "city_name"),
    ("shipping_address", "province"), ("shipping_address", "province_name"),
    ("delivery_address", "city"), ("delivery_address", "city_name"),
    ("delivery_address", "province"), ("delivery_address", "province_name"),
)
SHIPPING_ADDRESS = (
    "shipping_address_1", "shipping_address1", "delivery_address_1", "delivery_address1",
    "shipping_street", "delivery_street", "shipping_line_1", "delivery_line_1",
    "shipping_full_address", "delivery_full_address",
    "shipping_address_text", "delivery_address_text",
)
SHIPPING_ADDRESS_NESTED = (
    ("shipping_address", "address"), ("shipping_address", "address1"),
    ("shipping_address", "line1"), ("shipping_address", "street"),
    ("shipping_address", "full_address"),
    ("delivery_address", "address"), ("delivery_address", "address1"),
    ("delivery_address", "line1"), ("delivery_address", "street"),
    ("delivery_address", "full_address"),
)
ORDER_STATUS = ("status", "order_status")
ORDER_PAYMENT_STATUS = ("payment_status", "financial_status")
ORDER_TOTAL_VND = ("total_vnd", "amount_vnd", "grand_total_vnd", "total", "transaction_amount_vnd")
ORDER_TOTAL_USD = ("total_usd", "amount_usd", "grand_total_usd")
ORDER_STORE = (
    "location_id", "location_code", "location_name", "location_city", "location_address",
    "location_phone",
)

# --- order line spellings --------------------------------------------------
ITEM_PRODUCT = ("product_id", "id", "item_id", "variant_id")
ITEM_QUANTITY = ("quantity", "qty")
ITEM_UNIT_PRICE = ("unit_price_vnd", "price_vnd", "unit_price", "price")
ITEM_LINE_TOTAL = ("line_total_vnd", "total_vnd", "line_total", "amount_vnd")

# --- payment spellings -----------------------------------------------------
PAYMENT_TRANSACTION = ("transaction_id", "txn_id", "id", "paypal_transaction_id", "app_trans_id")
PAYMENT_ORDER = ("order_id", "reference_id", "order_code", "orderid")
PAYMENT_GATEWAY = ("payment_gateway", "gateway", "provider", "source")
PAYMENT_METHOD = ("payment_method", "method", "pay_type", "channel")
PAYMENT_AMOUNT = ("amount_vnd", "transaction_amount_vnd", "amount", "total_vnd")
PAYMENT_STATUS = ("payment_status", "status", "transaction_status", "message")
PAYMENT_DATE = (
    "payment_date", "created_at", "paid_at", "timestamp", "transaction_initiation_date",
    "response_time_iso", "server_time_iso", "createdat",
)
PAYMENT_CODES = ("result_code", "return_code")

# --- bank spellings --------------------------------------------------------
BANK_TRANSACTION = ("transaction_id", "id")
BANK_ACCOUNT = ("account_id", "accountid")
BANK_TYPE = ("transaction_type", "kind", "type")
BANK_AMOUNT = ("amount_vnd", "amount")
BANK_DATE = ("transaction_date", "created_at", "createdat", "timestamp")

# --- browsing event spellings ----------------------------------------------
EVENT_ID = ("event_id", "id")
EVENT_SESSION = ("session_id", "session")
EVENT_TYPE = ("event_type", "type")
EVENT_TIME = ("event_timestamp", "timestamp", "created_at")
EVENT_PRODUCT = ("product_id", "id_item", "item_id")
EVENT_SOURCE = ("source", "channel")
EVENT_DEVICE = ("device", "device_type")

# --- dimension spellings ---------------------------------------------------
LOCATION_ID = ("location_id", "id")
LOCATION_CODE = ("location_code", "code")
LOCATION_NAME = ("location_name", "name")
LOCATION_TYPE = ("location_type", "type")
IS_ACTIVE = ("is_active", "active")
STAFF_ID = ("staff_id", "id")
STAFF_CODE = ("staff_code", "code")
STAFF_NAME = ("full_name", "name")
STAFF_POSITION = ("position", "role", "title")
STAFF_LOCATION = ("location_id", "store_id")
STAFF_LOCATION_NESTED = (("location", "id"),)
STAFF_HIRED = ("hire_date", "created_at", "joined_at")

CUSTOMER_NAMES = (
    "customer_id", "id", "email", "full_name", "name", "phone", "city", "country", "created_at",
    "customer_segment", "lifetime_value_vnd", "total_orders", "first_order_date",
    "last_order_date",
)
PRODUCT_NAMES = (
    "product_id", "id", "product_name", "name", "sku", "barcode", "category", "brand",
    "price_vnd", "price_usd", "stock_quantity", "is_active",
)

# --- text tokens -----------------------------------------------------------
TRUE_TOKENS = ("true", "1", "yes")
FALSE_TOKENS = ("false", "0", "no")
STATUS_TO_PAID = ("success", "completed", "succeeded", "authorized")
STATUS_TO_PENDING = ("pending", "processing")
STATUS_TO_FAILED = ("failed", "error")
VIEW_PAID = ("paid", "completed", "success")
VIEW_PENDING = ("pending", "processing")
VIEW_FAILED = ("failed", "error")
UNKNOWN = "unknown"

# --- channels, gateways, feeds ---------------------------------------------
ORDER_CHANNELS = {
    "shopify_orders": ("shopify", "shopify"),
    "sapo_orders": ("sapo_pos", "sapo"),
    "online_orders": ("online", "online_orders"),
}
PAYMENT_GATEWAYS = ("momo", "odoo", "paypal", "sapo", "zalopay")

# --- customer segments: (label, least orders, least value in VND) -----------
SEGMENTS = (
    ("vip", 10, 10_000_000),
    ("loyal", 5, 5_000_000),
    ("active", 1, None),
)

# --- payment view ----------------------------------------------------------
OVERDUE_AFTER_DAYS = 7
