"""Reusable data tests. Each returns its failing rows; an empty result is a pass."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.operators.joins import unmatched_counts
from ledgerloom.plans.quality import union_all
from ledgerloom.session import run_together


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values held by more than one row."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records")).where("n_records > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list, counted; NULL passes."""
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-NULL references without a parent, counted per value."""
    present = child.where(F.col(column).isNotNull()).select(F.col(column).alias(key))
    missing = unmatched_counts(present, parent, key)
    return missing.withColumnRenamed(key, column)


def no_negative_revenue(orders_fact: DataFrame, items_fact: DataFrame) -> DataFrame:
    orders = orders_fact.where("order_value < 0").select(
        F.lit("fact_orders").alias("table_name"), F.col("order_id").cast("string").alias("record_id"),
        F.col("order_value").cast("decimal(23,2)").alias("invalid_amount"),
    )
    items = items_fact.where("line_total < 0").select(
        F.lit("fact_order_items").alias("table_name"), F.col("order_item_id").cast("string").alias("record_id"),
        F.col("line_total").cast("decimal(23,2)").alias("invalid_amount"),
    )
    return orders.unionByName(items)


@dataclass(frozen=True)
class TableTests:
    """The tests declared for one table."""

    layer: str
    table: str
    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)
    related: dict[str, tuple[str, str, str]] = field(default_factory=dict)


def _plus_unknown(values: list[str], unknown: str = specs.UNKNOWN) -> list[str]:
    return [*values, unknown]


ALL_CATEGORIES = _plus_unknown(specs.CATEGORIES)
ALL_CHANNELS = _plus_unknown(specs.CHANNELS)

SUITE = [
    *[TableTests("bronze", s.table, not_null=[s.key]) for s in specs.ENTITIES.values()],
    TableTests("silver", "customers", ["customer_id"], ["customer_id"], {
        "customer_segment": _plus_unknown(specs.SEGMENTS),
        "preferred_channel": ALL_CHANNELS,
        "age_group": _plus_unknown(specs.AGE_GROUPS),
        "income_level": _plus_unknown(specs.INCOME_LEVELS),
        "preferred_category": ALL_CATEGORIES,
    }),
    TableTests("silver", "promotions", ["promotion_id"], ["promotion_id"], {
        "promo_type": _plus_unknown(specs.PROMO_TYPES),
        "target_segment": _plus_unknown(specs.TARGET_SEGMENTS),
        "campaign_channel": _plus_unknown(specs.CAMPAIGN_CHANNELS),
        "campaign_objective": _plus_unknown(specs.CAMPAIGN_OBJECTIVES),
        "target_category": ALL_CATEGORIES,
    }),
    TableTests("silver", "orders", ["order_id"], ["order_id", "customer_id"], {
        "order_status": _plus_unknown(specs.ORDER_STATUSES, specs.UNKNOWN_STATUS),
        "order_channel": ALL_CHANNELS,
    }, {
        "customer_id": ("silver", "customers", "customer_id"),
        "promotion_id": ("silver", "promotions", "promotion_id"),
    }),
    TableTests("silver", "order_items", ["order_item_id"], ["order_item_id", "order_id"],
               {"product_category": ALL_CATEGORIES}, {
        "order_id": ("silver", "orders", "order_id"),
        "promotion_id": ("silver", "promotions", "promotion_id"),
    }),
    TableTests("silver", "data_quality_report", [], ["issue_type", "table_name", "affected_row_count"],
               {"severity": specs.SEVERITIES}),
    TableTests("gold", "dim_customer", ["customer_key", "customer_id"], ["customer_key", "customer_id"]),
    TableTests("gold", "dim_promotion", ["promotion_key"], ["promotion_key"]),
    TableTests("gold", "dim_product", ["product_key"], ["product_key", "product_id", "product_category"],
               {"product_category": ALL_CATEGORIES}),
    TableTests("gold", "dim_date", ["date_key"], ["date_key"]),
    TableTests("gold", "fact_orders", ["order_id"], ["order_id", "customer_key", "order_date_key"], {}, {
        "customer_key": ("gold", "dim_customer", "customer_key"),
        "promotion_key": ("gold", "dim_promotion", "promotion_key"),
        "order_date_key": ("gold", "dim_date", "date_key"),
    }),
    TableTests("gold", "fact_order_items", ["order_item_id"], ["order_item_id", "order_id", "product_key"], {}, {
        "order_id": ("gold", "fact_orders", "order_id"),
        "product_key": ("gold", "dim_product", "product_key"),
        "promotion_key": ("gold", "dim_promotion", "promotion_key"),
    }),
]


def _result(tests: TableTests, column: str, kind: str, failures) -> F.struct:
    return F.struct(
        F.lit(f"{tests.layer}.{tests.table}").alias("table_name"), F.lit(column).alias("column_name"),
        F.lit(kind).alias("test"), F.coalesce(failures.cast("bigint"), F.lit(0).cast("bigint")).alias("failures"),
    )


def row_rules(df: DataFrame, tests: TableTests) -> DataFrame:
    """A table's not-null and accepted-value tests, all in one pass over it."""
    rules = [(c, "not_null", F.col(c).isNull()) for c in tests.not_null]
    rules += [(c, "accepted_values", ~F.col(c).isin(values)) for c, values in tests.accepted.items()]
    totals = df.agg(*[F.count_if(wrong).alias(f"r{i}") for i, (_, _, wrong) in enumerate(rules)])
    results = [_result(tests, c, kind, F.col(f"r{i}")) for i, (c, kind, _) in enumerate(rules)]
    return totals.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def _total(failing: DataFrame, tests: TableTests, column: str, kind: str) -> DataFrame:
    total = failing.agg(F.count("*").alias("n")) if kind == "unique" else failing.agg(F.sum("n_records").alias("n"))
    return total.select(_result(tests, column, kind, F.col("n")).alias("r")).select("r.*")


def table_results(read, tests: TableTests) -> DataFrame:
    """One row per declared test of a table with its failing-row count."""
    df = read(tests.layer, tests.table)
    frames = [row_rules(df, tests)]
    frames += [_total(unique(df, c), tests, c, "unique") for c in tests.unique]
    for column, (layer, table, key) in tests.related.items():
        failing = relationships(df, column, read(layer, table), key)
        frames.append(_total(failing, tests, column, "relationships"))
    return union_all(frames)


def amount_results(read) -> DataFrame:
    failing = no_negative_revenue(read("gold", "fact_orders"), read("gold", "fact_order_items"))
    result = _result(TableTests("gold", "facts"), "invalid_amount", "no_negative_revenue", F.col("n"))
    return failing.agg(F.count("*").alias("n")).select(result.alias("r")).select("r.*")


def run_suite(spark: SparkSession, read, suite: list[TableTests] | None = None) -> DataFrame:
    """Run every declared test, some tables at a time; ``read(layer, table)`` supplies tables.

    What returns to the driver is one row per declared test, whatever the tables' size.
    """
    tables = [table_results(read, tests) for tests in suite or SUITE]
    results = [*tables, amount_results(read)]
    rows = [r for part in run_together([df.collect for df in results]) for r in part]
    return spark.createDataFrame(rows, results[0].schema)
