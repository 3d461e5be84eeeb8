"""Entity contracts and the fixed values the cleaning rules depend on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column contracts -----------------------------------------
CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone_number", "registration_date",
    "customer_segment", "preferred_channel", "age_group", "income_level", "avg_order_value",
    "promo_sensitivity", "email_opt_in", "sms_opt_in", "push_opt_in", "last_purchase_date",
    "total_lifetime_orders", "preferred_category",
]
PROMOTION_COLUMNS = [
    "promotion_id", "campaign_name", "promo_type", "discount_value", "min_order_value", "start_date",
    "end_date", "campaign_duration_days", "target_segment", "campaign_channel", "campaign_objective",
    "target_category", "expected_response_rate", "budget_allocated", "cost_per_acquisition",
]
ORDER_COLUMNS = [
    "order_id", "customer_id", "order_date", "order_status", "promotion_id", "order_channel", "order_value",
    "attributed_to_promo", "customer_segment_at_time",
]
ORDER_ITEM_COLUMNS = [
    "order_item_id", "order_id", "product_id", "product_category", "quantity", "unit_price", "promotion_id",
    "attributed_to_promo",
]
TRACKING_COLUMNS = ["operation", "source_updated_at", "business_date"]

# --- fixed values: accepted labels ------------------------------------------
CATEGORIES = ["Beauty", "Books", "Clothing", "Electronics", "Home", "Sports"]
SEGMENTS = ["High_Value", "Low_Value", "Medium_Value", "New_Customer"]
CHANNELS = ["Direct", "Email", "Push", "SMS", "Social"]
INCOME_LEVELS = ["High", "Low", "Medium", "Premium"]
AGE_GROUPS = ["18-25", "26-35", "36-45", "46-55", "55+"]
PROMO_TYPES = ["BOGO", "Fixed_Amount", "Free_Shipping", "Percentage_Discount"]
TARGET_SEGMENTS = ["All_Customers", "High_Value", "Lapsed", "Low_Value", "Medium_Value", "New_Customer"]
CAMPAIGN_CHANNELS = ["Email", "In_App", "Push", "SMS", "Social", "Website_Banner"]
CAMPAIGN_OBJECTIVES = ["Acquisition", "Cross_Sell", "Reactivation", "Retention", "Upsell"]
ORDER_STATUSES = ["CANCEL", "ERROR", "INVALID", "PAID", "PENDING"]
STATUS_SYNONYMS = {"cancelled": "CANCEL", "canceled": "CANCEL"}
UNKNOWN = "Unknown"
UNKNOWN_STATUS = "UNKNOWN"

TRUE_TOKENS = ["true", "t", "yes", "y", "1"]
FALSE_TOKENS = ["false", "f", "no", "n", "0"]

OPERATIONS = ["I", "U", "D"]
BATCH_STATUSES = ["started", "ingested", "completed", "failed"]
FILE_STATUSES = ["started", "completed", "failed"]
SEVERITIES = ["low", "medium", "high"]
DEFAULT_PIPELINE = "retail_daily"
HASH_SEPARATOR = "\u001f"
UNKNOWN_KEY = -1
MISSING_AGE = 999999
MAX_ERROR_CHARS = 4000
MAX_REPORTED_ERRORS = 25
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class EntitySpec:
    """One source entity: its raw table, its key, and its ordered text columns."""

    name: str
    table: str
    key: str
    columns: tuple[str, ...]
    date_column: str | None = None

    @property
    def csv_columns(self) -> list[str]:
        return [*self.columns, *TRACKING_COLUMNS]

    @property
    def csv_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.csv_columns])

    @property
    def bronze_schema(self) -> T.StructType:
        business = [T.StructField(c, T.StringType()) for c in self.columns]
        return T.StructType([*business, *BRONZE_METADATA.fields])


BRONZE_METADATA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("file_checksum", T.StringType()),
        T.StructField("source_updated_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("source_row_number", T.LongType()),
        T.StructField("source_record_hash", T.StringType()),
        T.StructField("logical_date", T.DateType()),
    ]
)

ENTITIES: dict[str, EntitySpec] = {
    spec.name: spec
    for spec in (
        EntitySpec("customers", "customers_raw", "customer_id", tuple(CUSTOMER_COLUMNS), "registration_date"),
        EntitySpec("promotions", "promotions_raw", "promotion_id", tuple(PROMOTION_COLUMNS), "start_date"),
        EntitySpec("orders", "orders_raw", "order_id", tuple(ORDER_COLUMNS), "order_date"),
        EntitySpec("order_items", "order_items_raw", "order_item_id", tuple(ORDER_ITEM_COLUMNS)),
    )
}


def token_map(labels: list[str], synonyms: dict[str, str] | None = None) -> dict[str, str]:
    """Map each label's token form to the label itself, plus any extra spellings."""
    return {label.lower(): label for label in labels} | (synonyms or {})


CATEGORY_MAP = token_map(CATEGORIES)
SEGMENT_MAP = token_map(SEGMENTS)
CHANNEL_MAP = token_map(CHANNELS)
INCOME_MAP = token_map(INCOME_LEVELS)
AGE_MAP = {label.replace("-", ""): label for label in AGE_GROUPS}
PROMO_TYPE_MAP = token_map(PROMO_TYPES)
TARGET_SEGMENT_MAP = token_map(TARGET_SEGMENTS)
CAMPAIGN_CHANNEL_MAP = token_map(CAMPAIGN_CHANNELS)
CAMPAIGN_OBJECTIVE_MAP = token_map(CAMPAIGN_OBJECTIVES)
STATUS_MAP = token_map(ORDER_STATUSES, STATUS_SYNONYMS)
