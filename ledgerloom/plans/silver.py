"""Current-state tables: one clean, typed, flagged row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions import parsing as P
from ledgerloom.functions import text as X
from ledgerloom.operators.joins import lookup
from ledgerloom.operators.versions import first_per_key
from ledgerloom.specs import ENTITIES, EntitySpec

MONEY = (12, 2)
SIGNATURE = "_signature"


def cleaned_texts(current: DataFrame, spec: EntitySpec, signed: bool = True) -> DataFrame:
    """Every business column as trimmed text, plus the signature over all but the key, as bytes."""
    texts = current.select(*[X.text_clean(F.col(c)).alias(c) for c in spec.columns])
    return texts.withColumn(SIGNATURE, F.unhex(X.row_signature(*[F.col(c) for c in spec.columns if c != spec.key]))) if signed else texts


def null_if_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def null_if_not_positive(c: Column) -> Column:
    return F.when(c > 0, c)


def null_if_outside(c: Column, low: int, high: int) -> Column:
    return F.when(c.between(low, high), c)


def default_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def keep_if_referenced(c: Column, found: Column) -> Column:
    return F.when(found.isNotNull(), c)


def missing_or(c: Column, wrong: Column) -> Column:
    """NULL, or a value for which ``wrong`` holds; never NULL itself."""
    return c.isNull() | F.coalesce(wrong, F.lit(False))


def bad_date_range(start: Column, end: Column) -> Column:
    return start.isNull() | end.isNull() | F.coalesce(end < start, F.lit(False))


def newest_clean(df: DataFrame, key: str, dated: str | None = None) -> DataFrame:
    """One row per clean key: raw keys that differ only in spaces meet here."""
    order = [F.col(dated).desc_nulls_last()] if dated else []
    return first_per_key(df, [key], [*order, F.col(SIGNATURE).desc()]).drop(SIGNATURE)


def silver_customers(current: DataFrame) -> DataFrame:
    t = cleaned_texts(current, ENTITIES["customers"])
    c = F.col
    registered = P.parse_date(c("registration_date"))
    typed = t.select(
        P.digits_to_bigint(c("customer_id")).alias("customer_id"),
        X.name_case(c("first_name")).alias("first_name"),
        X.name_case(c("last_name")).alias("last_name"),
        F.lower("email").alias("email"),
        "phone_number",
        registered.alias("registration_date"),
        X.canonical_text(c("customer_segment"), specs.SEGMENT_MAP).alias("customer_segment"),
        X.canonical_text(c("preferred_channel"), specs.CHANNEL_MAP).alias("preferred_channel"),
        X.age_band(c("age_group")).alias("age_group"),
        X.canonical_text(c("income_level"), specs.INCOME_MAP).alias("income_level"),
        P.to_decimal(c("avg_order_value"), *MONEY).alias("avg_order_value"),
        P.to_decimal(c("promo_sensitivity"), 6, 3).alias("promo_sensitivity"),
        *[P.bool_value(c(name)).alias(name) for name in ("email_opt_in", "sms_opt_in", "push_opt_in")],
        P.parse_date(c("last_purchase_date")).alias("last_purchase_date"),
        P.to_signed_int(c("total_lifetime_orders")).alias("total_lifetime_orders"),
        X.canonical_text(c("preferred_category"), specs.CATEGORY_MAP).alias("preferred_category"),
        X.invalid_phone(c("phone_number")).alias("invalid_phone_flag"),
        c("last_purchase_date").isNull().alias("missing_last_purchase_flag"),
        (c("registration_date").isNotNull() & registered.isNull()).alias("invalid_registration_date_flag"),
        SIGNATURE,
    )
    return newest_clean(typed.where("customer_id is not null"), "customer_id", "registration_date")


def silver_promotions(current: DataFrame) -> DataFrame:
    t = cleaned_texts(current, ENTITIES["promotions"])
    c = F.col
    typed = t.select(
        P.digits_to_bigint(c("promotion_id")).alias("promotion_id"),
        "campaign_name",
        X.canonical_text(c("promo_type"), specs.PROMO_TYPE_MAP).alias("promo_type"),
        P.to_decimal(c("discount_value"), *MONEY).alias("discount_value"),
        P.to_decimal(c("min_order_value"), *MONEY).alias("min_order_value"),
        P.parse_date(c("start_date")).alias("start_date"),
        P.parse_date(c("end_date")).alias("end_date"),
        P.to_signed_int(c("campaign_duration_days")).alias("campaign_duration_days"),
        X.canonical_text(c("target_segment"), specs.TARGET_SEGMENT_MAP).alias("target_segment"),
        X.canonical_text(c("campaign_channel"), specs.CAMPAIGN_CHANNEL_MAP).alias("campaign_channel"),
        X.canonical_text(c("campaign_objective"), specs.CAMPAIGN_OBJECTIVE_MAP).alias("campaign_objective"),
        X.canonical_text(c("target_category"), specs.CATEGORY_MAP).alias("target_category"),
        P.to_decimal(c("expected_response_rate"), 8, 4).alias("expected_response_rate"),
        P.to_decimal(c("budget_allocated"), 14, 2).alias("budget_allocated"),
        P.to_decimal(c("cost_per_acquisition"), *MONEY).alias("cost_per_acquisition"),
        SIGNATURE,
    ).where("promotion_id is not null")
    rate, budget, cpa = c("expected_response_rate"), c("budget_allocated"), c("cost_per_acquisition")
    bad_range = bad_date_range(c("start_date"), c("end_date"))
    clean = typed.select(
        "promotion_id", "campaign_name", "promo_type",
        null_if_negative(c("discount_value")).alias("discount_value"),
        null_if_negative(c("min_order_value")).alias("min_order_value"),
        "start_date", "end_date",
        null_if_negative(c("campaign_duration_days")).alias("campaign_duration_days"),
        "target_segment", "campaign_channel", "campaign_objective", "target_category",
        null_if_outside(rate, 0, 1).alias("expected_response_rate"),
        null_if_negative(budget).alias("budget_allocated"),
        null_if_negative(cpa).alias("cost_per_acquisition"),
        bad_range.alias("invalid_date_range_flag"),
        missing_or(c("discount_value"), c("discount_value") < 0).alias("negative_discount_flag"),
        missing_or(rate, (rate < 0) | (rate > 1)).alias("invalid_expected_response_rate_flag"),
        (missing_or(budget, budget < 0) | missing_or(cpa, cpa < 0)).alias("invalid_budget_flag"),
        (~bad_range).alias("is_valid_date_range"),
        SIGNATURE,
    )
    return newest_clean(clean, "promotion_id", "start_date")


def typed_orders(current: DataFrame) -> DataFrame:
    t = cleaned_texts(current, ENTITIES["orders"])
    c = F.col
    return t.select(
        P.digits_to_bigint(c("order_id")).alias("order_id"),
        P.digits_to_bigint(c("customer_id")).alias("customer_id"),
        P.parse_date(c("order_date")).alias("order_date"),
        X.order_status(c("order_status")).alias("order_status"),
        P.digits_to_bigint(c("promotion_id")).alias("promotion_id"),
        X.canonical_text(c("order_channel"), specs.CHANNEL_MAP).alias("order_channel"),
        P.to_decimal(c("order_value"), *MONEY).alias("order_value"),
        default_false(P.bool_value(c("attributed_to_promo"))).alias("attributed_to_promo"),
        X.canonical_text(c("customer_segment_at_time"), specs.SEGMENT_MAP).alias("customer_segment_at_time"),
        c("promotion_id").isNull().alias("_no_promotion_text"),
        SIGNATURE,
    ).where("order_id is not null")


def typed_order_items(current: DataFrame) -> DataFrame:
    t = cleaned_texts(current, ENTITIES["order_items"])
    c = F.col
    return t.select(
        P.digits_to_bigint(c("order_item_id")).alias("order_item_id"),
        P.digits_to_bigint(c("order_id")).alias("order_id"),
        P.digits_to_bigint(c("product_id")).alias("product_id"),
        X.canonical_text(c("product_category"), specs.CATEGORY_MAP).alias("product_category"),
        P.to_signed_int(c("quantity")).alias("quantity"),
        P.to_decimal(c("unit_price"), *MONEY).alias("unit_price"),
        P.digits_to_bigint(c("promotion_id")).alias("promotion_id"),
        default_false(P.bool_value(c("attributed_to_promo"))).alias("attributed_to_promo"),
        c("promotion_id").isNull().alias("_no_promotion_text"),
        SIGNATURE,
    ).where("order_item_id is not null")


def with_known(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Add ``_known_<key>``: the key itself where the parent has it, else NULL."""
    keys = parent.select(key, F.col(key).alias(f"_known_{key}"))
    return lookup(child, keys, [key])


def silver_orders(current: DataFrame, customers: DataFrame, promotions: DataFrame) -> DataFrame:
    """Orders of known customers; a promotion survives only if it is known."""
    bought = with_known(typed_orders(current), customers, "customer_id")
    bought = bought.where("_known_customer_id is not null").drop("_known_customer_id")
    linked = with_known(bought, promotions, "promotion_id")
    c = F.col
    found = c("_known_promotion_id")
    clean = linked.select(
        "order_id", "customer_id", "order_date", "order_status",
        keep_if_referenced(c("promotion_id"), found).alias("promotion_id"),
        "order_channel",
        null_if_negative(c("order_value")).alias("order_value"),
        "attributed_to_promo", "customer_segment_at_time",
        c("_no_promotion_text").alias("missing_promotion_flag"),
        (c("attributed_to_promo") & c("_no_promotion_text")).alias("promo_attributed_without_promotion_id_flag"),
        missing_or(c("order_value"), c("order_value") < 0).alias("invalid_order_value_flag"),
        (~c("_no_promotion_text") & found.isNull()).alias("invalid_promotion_reference_flag"),
        SIGNATURE,
    )
    return newest_clean(clean, "order_id", "order_date")


def line_total(quantity: Column, unit_price: Column) -> Column:
    return (quantity * unit_price).cast("decimal(23,2)")


def silver_order_items(
    current: DataFrame, orders: DataFrame, promotions: DataFrame, store: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Items of surviving orders; revenue only from valid quantity and price.

    ``store`` may write what the next shuffle reads and give it back as stored, so that shuffles do not add up on disk.
    """
    placed = with_known(store(typed_order_items(current)), orders, "order_id")
    placed = placed.where("_known_order_id is not null").drop("_known_order_id")
    linked = with_known(store(placed), promotions, "promotion_id")
    c = F.col
    found = c("_known_promotion_id")
    clean = linked.select(
        "order_item_id", "order_id", "product_id", "product_category",
        null_if_not_positive(c("quantity")).alias("quantity"),
        null_if_negative(c("unit_price")).alias("unit_price"),
        keep_if_referenced(c("promotion_id"), found).alias("promotion_id"),
        "attributed_to_promo",
        missing_or(c("quantity"), c("quantity") <= 0).alias("invalid_quantity_flag"),
        missing_or(c("unit_price"), c("unit_price") < 0).alias("invalid_unit_price_flag"),
        (c("attributed_to_promo") & c("_no_promotion_text")).alias("promo_attributed_without_promotion_id_flag"),
        (~c("_no_promotion_text") & found.isNull()).alias("invalid_promotion_reference_flag"),
        SIGNATURE,
    )
    one = newest_clean(clean, "order_item_id")
    total = line_total(c("quantity"), c("unit_price"))
    return one.select(
        "order_item_id", "order_id", "product_id", "product_category", "quantity", "unit_price",
        total.alias("item_revenue"), total.alias("line_total"), "promotion_id", "attributed_to_promo",
        "invalid_quantity_flag", "invalid_unit_price_flag", "promo_attributed_without_promotion_id_flag",
        "invalid_promotion_reference_flag",
    )
