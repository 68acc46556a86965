"""Table schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original application's for equal results).
# ---------------------------------------------------------------------------

# Platforms, in their original order.
PLATFORMS = ["woocommerce", "gomag", "shopify", "merchantpro"]

PLATFORM_LABELS = {
    "woocommerce": "WooCommerce",
    "gomag": "GoMag",
    "shopify": "Shopify",
    "merchantpro": "MerchantPro",
}

# The 13 standard target columns, in table order.
STANDARD_COLUMNS = [
    "order_id",
    "order_date",
    "order_status",
    "order_total",
    "currency",
    "product_id",
    "product_sku",
    "product_name",
    "product_price",
    "product_quantity",
    "product_total",
    "source_site",
    "synced_at",
]

# Column transform names offered by the mapping editor.
TRANSFORMS = ["toString", "toNumber", "toDate", "split(',')"]

STANDARD_ORDER_STATUSES = ["order_processed", "order_cancelled"]

# Default status mappings per platform: (source status, target status), in order.
DEFAULT_STATUS_MAPPINGS = {
    "woocommerce": [
        ("pending", "order_processed"),
        ("processing", "order_processed"),
        ("on-hold", "order_processed"),
        ("completed", "order_processed"),
        ("cancelled", "order_cancelled"),
        ("refunded", "order_cancelled"),
        ("failed", "order_cancelled"),
    ],
    "gomag": [
        ("Noua", "order_processed"),
        ("In curs de livrare", "order_processed"),
        ("Livrata", "order_processed"),
        ("Finalizata", "order_processed"),
        ("Anulata", "order_cancelled"),
        ("Retur", "order_cancelled"),
    ],
    "shopify": [
        ("fulfilled", "order_processed"),
        ("unfulfilled", "order_processed"),
        ("partially_fulfilled", "order_processed"),
        ("cancelled", "order_cancelled"),
    ],
    "merchantpro": [
        ("awaiting", "order_processed"),
        ("in_process", "order_processed"),
        ("shipped", "order_processed"),
        ("delivered", "order_processed"),
        ("returned", "order_cancelled"),
        ("cancelled", "order_cancelled"),
    ],
}

DEFAULT_SYNC_SCHEDULE = "0 6 * * *"
LOOKBACK_OPTIONS = [30, 90, 120, 365]
DEFAULT_LOOKBACK_DAYS = 30
DEFAULT_CURRENCY = "RON"
UNMAPPED_PREFIX = "[UNMAPPED] "
HISTORY_KEEP_PER_SITE = 100
HISTORY_LIMIT_ONE_SITE = 20
HISTORY_LIMIT_ALL_SITES = 5
REPORT_TIME_ZONE = "Europe/Bucharest"

# Page sizes of the store APIs (used to cut landed pages).
PAGE_SIZE = {"woocommerce": 100, "gomag": 50, "merchantpro": 100, "shopify": 250}

# Top-level keys dropped before column detection.
WOO_IGNORED_TOP_KEYS = [
    "billing", "shipping",
    "customer_id", "customer_ip_address", "customer_user_agent", "customer_note",
    "created_via", "cart_hash", "date_completed", "date_paid",
]
GOMAG_IGNORED_TOP_KEYS = ["number", "invoice", "statusId", "payment", "shipping", "billing"]

# Standard status used when a detected status has no default.
DETECT_FALLBACK_STATUS = "order_processed"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

MATCH_KEYS = ["order_id", "product_id", "product_sku", "source_site"]

FACT_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.TimestampType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_total", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_sku", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_price", T.DoubleType()),
    T.StructField("product_quantity", T.LongType()),
    T.StructField("product_total", T.DoubleType()),
    T.StructField("source_site", T.StringType()),
    T.StructField("synced_at", T.TimestampType()),
])

FACT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACT_SCHEMA.fields)

STATUS_MAP_SCHEMA = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("source_status", T.StringType()),
    T.StructField("target_status", T.StringType()),
])

COLUMN_MAP_SCHEMA = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("source_column", T.StringType()),
    T.StructField("target_column", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("transform", T.StringType()),
])

SITE_SCHEMA = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("product_feed_url", T.StringType()),
    T.StructField("sync_schedule", T.StringType()),
    T.StructField("lookback_days", T.IntegerType()),
    T.StructField("hourly_sync_enabled", T.BooleanType()),
    T.StructField("last_sync_at", T.TimestampType()),
    T.StructField("last_sync_status", T.StringType()),
    T.StructField("last_sync_row_count", T.LongType()),
    T.StructField("enabled", T.BooleanType()),
])

HISTORY_SCHEMA = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("duration_seconds", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("sync_type", T.StringType()),
    T.StructField("error", T.StringType()),
])

REJECT_SCHEMA_EXTRA = T.StructField("reject_reason", T.StringType())
