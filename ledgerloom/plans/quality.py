"""The data-quality report: twenty checks over the newest raw versions and the clean tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import parsing as P
from ledgerloom.functions import text as X
from ledgerloom.operators.joins import unsent
from ledgerloom.plans.silver import bad_date_range, cleaned_texts
from ledgerloom.specs import ENTITIES, EntitySpec

Check = tuple[str, str, Column]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unpivot_counts(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """Evaluate all of a table's aggregates in one pass, then turn them into one row each."""
    totals = df.agg(*[total.alias(f"c{i}") for i, (_, _, total) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(issue).alias("issue_type"), F.lit(table).alias("table_name"),
            F.coalesce(F.col(f"c{i}").cast("bigint"), F.lit(0).cast("bigint")).alias("affected_row_count"),
            F.lit(severity).alias("severity"),
        )
        for i, (issue, severity, _) in enumerate(checks)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_keys(current: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rows beyond the first of each clean key, as one total.

    One scan of the key column: keys are counted per task before they are shuffled.
    """
    counted = current.select(X.text_clean(F.col(spec.key)).alias("key")).where("key is not null").groupBy("key").count()
    return counted.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0).cast("bigint")).alias("n_records"))


def negative_or_bad(c: Column) -> Column:
    return P.bad_number(c, P.DECIMAL, P.negative_text(c))


def customer_checks(current: DataFrame) -> DataFrame:
    t = cleaned_texts(current, ENTITIES["customers"], signed=False)
    registered = F.col("registration_date")
    return unpivot_counts(t, "customers_raw", [
        ("invalid_phone", "medium", F.count_if(X.invalid_phone(F.col("phone_number")))),
        ("invalid_registration_date", "medium", F.count_if(registered.isNotNull() & P.parse_date(registered).isNull())),
    ])


def attributed_without_promotion() -> Column:
    return F.count_if(F.coalesce(P.bool_value(F.col("attributed_to_promo")), F.lit(False)) & F.col("promotion_id").isNull())


def order_checks(current: DataFrame) -> DataFrame:
    t = cleaned_texts(current, ENTITIES["orders"], signed=False)
    return unpivot_counts(t, "orders_raw", [
        ("missing_promotion_id", "low", F.count_if(F.col("promotion_id").isNull())),
        ("promo_attributed_without_promotion_id", "high", attributed_without_promotion()),
        ("invalid_order_value", "high", F.count_if(negative_or_bad(F.col("order_value")))),
    ])


def order_item_checks(current: DataFrame) -> DataFrame:
    t = cleaned_texts(current, ENTITIES["order_items"], signed=False)
    quantity = F.col("quantity")
    not_positive = quantity.startswith("-") | ~quantity.rlike(P.NON_ZERO_DIGIT)
    return unpivot_counts(t, "order_items_raw", [
        ("invalid_quantity", "high", F.count_if(P.bad_number(quantity, P.SIGNED, not_positive))),
        ("invalid_unit_price", "high", F.count_if(negative_or_bad(F.col("unit_price")))),
        ("promo_attributed_without_promotion_id", "high", attributed_without_promotion()),
    ])


def promotion_checks(current: DataFrame) -> DataFrame:
    t = cleaned_texts(current, ENTITIES["promotions"], signed=False)
    rate = F.col("expected_response_rate")
    bad_rate = P.bad_number(rate, P.DECIMAL, P.negative_text(rate) | (~rate.startswith("-") & P.above_one_text(rate)))
    bad_money = negative_or_bad(F.col("budget_allocated")) | negative_or_bad(F.col("cost_per_acquisition"))
    bad_range = bad_date_range(P.parse_date(F.col("start_date")), P.parse_date(F.col("end_date")))
    return unpivot_counts(t, "promotions_raw", [
        ("invalid_date_range", "high", F.count_if(bad_range)),
        ("negative_discount_value", "high", F.count_if(negative_or_bad(F.col("discount_value")))),
        ("invalid_expected_response_rate", "medium", F.count_if(bad_rate)),
        ("invalid_budget_or_cpa", "high", F.count_if(bad_money)),
    ])


def unmatched_references(current: DataFrame, column: str, parent: DataFrame, blank_counts: bool) -> DataFrame:
    """Current rows whose reference has no clean parent, counted per reference text.

    Rows are first counted per distinct text, so neither a hot reference nor the
    blank one travels as rows. ``blank_counts`` says whether a blank is a fault.
    """
    texts = current.select(X.text_clean(F.col(column)).alias("reference"))
    counted = texts.groupBy("reference").agg(F.count("*").alias("n_records"))
    if not blank_counts:
        counted = counted.where("reference is not null")
    # Unreadable references match nothing; distinct negative stand-ins keep them spread out.
    stand_in = -2 - F.pmod(F.xxhash64("reference"), F.lit(1 << 62))
    keyed = counted.withColumn(column, F.coalesce(P.digits_to_bigint(F.col("reference")), stand_in))
    return keyed.join(unsent(parent.select(column)), column, "left_anti").select("reference", "n_records")


def counted_check(issue: str, table: str, severity: str, counted: DataFrame) -> DataFrame:
    return unpivot_counts(counted, table, [(issue, severity, F.sum("n_records"))])


def attribution_mismatch(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items whose attribution or promotion differs from their order's, counted per order.

    Items are counted per (order, attribution, promotion) before the join.
    """
    grouped = order_items.groupBy("order_id", "attributed_to_promo", "promotion_id").agg(F.count("*").alias("n_records"))
    order = orders.select(
        "order_id", F.col("attributed_to_promo").alias("order_attributed"), F.col("promotion_id").alias("order_promotion_id")
    )
    differs = ~F.col("attributed_to_promo").eqNullSafe(F.col("order_attributed")) | ~F.col("promotion_id").eqNullSafe(
        F.col("order_promotion_id")
    )
    return grouped.join(unsent(order), "order_id").where(differs)


def data_quality_report(current: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """All checks that found something."""
    orders, items = current["orders"], current["order_items"]
    mismatch = attribution_mismatch(silver["order_items"], silver["orders"])
    duplicates = [
        counted_check("duplicate_primary_key", s.table, "high", duplicate_keys(current[e], s)) for e, s in ENTITIES.items()
    ]
    checks = [
        *duplicates,
        customer_checks(current["customers"]),
        order_checks(orders),
        order_item_checks(items),
        promotion_checks(current["promotions"]),
        counted_check("invalid_customer_reference", "orders_raw", "high",
                      unmatched_references(orders, "customer_id", silver["customers"], True)),
        counted_check("invalid_promotion_reference", "orders_raw", "high",
                      unmatched_references(orders, "promotion_id", silver["promotions"], False)),
        counted_check("invalid_order_reference", "order_items_raw", "high",
                      unmatched_references(items, "order_id", silver["orders"], True)),
        counted_check("inconsistent_order_item_promotion_attribution", "order_items_raw", "medium", mismatch),
    ]
    return union_all(checks).where("affected_row_count > 0")


def by_severity(report: DataFrame) -> DataFrame:
    """Affected rows of each severity, most first."""
    summed = report.groupBy("severity").agg(F.sum("affected_row_count").alias("affected_rows"))
    return summed.orderBy(F.col("affected_rows").desc(), "severity")


def high_total(report: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("affected_row_count"), F.lit(0).cast("bigint"))
    return report.where("severity = 'high'").agg(total.alias("affected_rows"))


def ranked_issues(report: DataFrame) -> DataFrame:
    rank = F.when(F.col("severity") == "high", 1).when(F.col("severity") == "medium", 2).otherwise(3)
    return report.orderBy(rank, F.col("affected_row_count").desc(), "table_name", "issue_type").limit(100)
