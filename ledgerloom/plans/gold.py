"""Star schema: dimensions with an unknown member, and two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions.keys import calendar_parts, date_key_or_unknown, product_key
from ledgerloom.operators.joins import lookup


def with_unknown_member(df: DataFrame, **values) -> DataFrame:
    """Append one typed row: the given values, NULL elsewhere."""
    member = df.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(member)


def dim_customer(customers: DataFrame) -> DataFrame:
    dim = customers.select(
        F.col("customer_id").alias("customer_key"), "customer_id", "first_name", "last_name", "email", "phone_number",
        "registration_date", "customer_segment", "preferred_channel", "age_group", "income_level",
        F.col("avg_order_value").alias("source_avg_order_value"), "promo_sensitivity", "email_opt_in", "sms_opt_in",
        "push_opt_in", "last_purchase_date", F.col("total_lifetime_orders").alias("source_lifetime_orders"),
        "preferred_category",
    )
    labels = ("first_name", "customer_segment", "preferred_channel", "age_group", "income_level", "preferred_category")
    return with_unknown_member(
        dim, customer_key=specs.UNKNOWN_KEY, customer_id=specs.UNKNOWN_KEY, **dict.fromkeys(labels, specs.UNKNOWN)
    )


def dim_promotion(promotions: DataFrame) -> DataFrame:
    flags = [c for c in promotions.columns if c.endswith("_flag") or c == "is_valid_date_range"]
    dim = promotions.drop(*flags).select(F.col("promotion_id").alias("promotion_key"), "*")
    labels = ("campaign_name", "promo_type", "target_segment", "campaign_channel", "campaign_objective", "target_category")
    return with_unknown_member(
        dim, promotion_key=specs.UNKNOWN_KEY, promotion_id=specs.UNKNOWN_KEY, **dict.fromkeys(labels, specs.UNKNOWN)
    )


def dim_product(order_items: DataFrame) -> DataFrame:
    """One member per product and category seen together."""
    category = F.coalesce("product_category", F.lit(specs.UNKNOWN)).alias("product_category")
    pairs = order_items.where("product_id is not null").select("product_id", category).distinct()
    dim = pairs.select(product_key(F.col("product_id"), F.col("product_category")).alias("product_key"), "*")
    return with_unknown_member(
        dim, product_key=specs.UNKNOWN_KEY, product_id=specs.UNKNOWN_KEY, product_category=specs.UNKNOWN
    )


def date_spine(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last, inclusive; no rows when there are no dates."""
    day = F.col(column).cast("date")
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date"))


def dim_date(orders: DataFrame) -> DataFrame:
    dim = date_spine(orders, "order_date").select(*calendar_parts(F.col("full_date")))
    return with_unknown_member(
        dim, date_key=specs.UNKNOWN_KEY, month_name=specs.UNKNOWN, day_name=specs.UNKNOWN
    )


def or_unknown(name: str):
    return F.coalesce(F.col(name), F.lit(specs.UNKNOWN_KEY).cast("bigint")).alias(name)


def fact_orders(orders: DataFrame, customers: DataFrame, promotions: DataFrame) -> DataFrame:
    """Orders with dimension keys. ``customers`` and ``promotions`` are the dimensions."""
    buyers = customers.select("customer_id", "customer_key")
    offers = promotions.select("promotion_id", "promotion_key")
    keyed = lookup(orders, buyers, ["customer_id"])
    keyed = lookup(keyed, offers, ["promotion_id"])
    return keyed.select(
        "order_id", or_unknown("customer_key"), or_unknown("promotion_key"),
        date_key_or_unknown(F.col("order_date")).alias("order_date_key"), "order_date", "order_status",
        F.coalesce("order_channel", F.lit(specs.UNKNOWN)).alias("order_channel"), "order_value",
        "attributed_to_promo",
        F.coalesce("customer_segment_at_time", F.lit(specs.UNKNOWN)).alias("customer_segment_at_time"),
    )


def fact_order_items(
    order_items: DataFrame, orders_fact: DataFrame, products: DataFrame, promotions: DataFrame
) -> DataFrame:
    """Positive lines of orders in the fact, with dimension keys."""
    lines = order_items.where("quantity > 0 and unit_price > 0").withColumn(
        "product_category", F.coalesce("product_category", F.lit(specs.UNKNOWN))
    )
    placed = orders_fact.select("order_id", F.col("order_id").alias("_fact_order"))
    offers = promotions.select("promotion_id", "promotion_key")
    kept = lookup(lines, placed, ["order_id"]).where("_fact_order is not null")
    keyed = lookup(kept, products, ["product_id", "product_category"])
    keyed = lookup(keyed, offers, ["promotion_id"])
    return keyed.select(
        "order_item_id", "order_id", or_unknown("product_key"), or_unknown("promotion_key"), "quantity",
        "unit_price", "line_total", "attributed_to_promo",
    )
