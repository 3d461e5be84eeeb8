"""Profile of one raw batch, and a summary of its suspicious rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.parsing import parse_date
from ledgerloom.functions.text import strip_all
from ledgerloom.plans.quality import Check, union_all, unpivot_counts
from ledgerloom.specs import TRUE_TOKENS, EntitySpec

SAMPLE_ROWS = 5
NUMBER = r"^\s*[+-]?(\d+([.]\d*)?|[.]\d+)([eE][+-]?\d+)?\s*$"


def missing(c: Column) -> Column:
    return c.isNull() | (c == "")


def by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """One (column_name, value) row per cell, so all columns share one small set of aggregates."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def in_order(profile: DataFrame, entity: str, columns: list[str], *measures: Column) -> DataFrame:
    """A row for every column, also those of an empty batch."""
    names = df_of_names(profile.sparkSession, columns)
    return names.join(profile, "column_name", "left").select(F.lit(entity).alias("table_name"), "column_name", *measures)


def df_of_names(spark: SparkSession, columns: list[str]) -> DataFrame:
    names = F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name")
    return spark.range(1).select(names)


def null_counts(df: DataFrame, entity: str, columns: list[str]) -> DataFrame:
    """Missing values per column, in one pass."""
    counted = by_column(df, columns).groupBy("column_name").agg(F.count_if(missing(F.col("value"))).alias("null_count"))
    return in_order(counted, entity, columns, F.coalesce("null_count", F.lit(0).cast("bigint")).alias("null_count"))


def row_counts(df: DataFrame, entity: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(F.lit(entity).alias("table_name"), "row_count")


def duplicate_rows(df: DataFrame, entity: str, columns: list[str]) -> DataFrame:
    """Rows beyond the first of each group of identical rows, NULL equal to NULL."""
    groups = df.groupBy(*columns).count()
    extra = F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint")
    return groups.agg(extra.alias("duplicate_row_count")).select(F.lit(entity).alias("table_name"), "duplicate_row_count")


def sample_rows(df: DataFrame, columns: list[str], limit: int = SAMPLE_ROWS) -> DataFrame:
    return df.orderBy("source_row_number", *columns).limit(limit).select("source_row_number", *columns)


def inferred_types(df: DataFrame, entity: str, columns: list[str]) -> DataFrame:
    """The narrowest type every present value of a column fits, decided in one pass.

    No present value: double. Values readable as whole numbers beside missing ones: double.
    """
    v = F.col("value")
    shown = ~missing(v)
    facts = by_column(df, columns).groupBy("column_name").agg(
        F.count("*").alias("n_rows"),
        F.count_if(shown).alias("n"),
        F.count_if(shown & v.rlike(r"^\s*[+-]?\d+\s*\z") & v.try_cast("bigint").isNotNull()).alias("n_int"),
        F.count_if(shown & number(v).isNotNull()).alias("n_number"),
        F.count_if(shown & F.lower(v).isin("true", "false")).alias("n_bool"),
    )
    whole = F.col("n") == F.col("n_rows")
    kind = (
        F.when(F.coalesce("n", F.lit(0)) == 0, "double")
        .when((F.col("n_int") == F.col("n")) & whole, "bigint")
        .when(F.col("n_number") == F.col("n"), "double")
        .when((F.col("n_bool") == F.col("n")) & whole, "boolean")
        .otherwise("string")
    )
    return in_order(facts, entity, columns, kind.alias("column_type"))


def truthy(c: Column) -> Column:
    """Lenient boolean: anything but a true token is false."""
    return F.coalesce(F.lower(strip_all(c)).isin(TRUE_TOKENS), F.lit(False))


def number(c: Column) -> Column:
    """Decimal notation with an optional exponent; a cast alone would also take texts such as ``1d``."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def _flag(c: Column) -> Column:
    return F.count_if(F.coalesce(c, F.lit(False)))


def _attributed_without_promotion() -> Check:
    wrong = truthy(F.col("attributed_to_promo")) & missing(F.col("promotion_id"))
    return "promo_attributed_without_promotion_id", "high", _flag(wrong)


def _day(name: str) -> Column:
    return parse_date(strip_all(F.col(name)))


def raw_issue_summary(batch: dict[str, DataFrame]) -> DataFrame:
    """Thirteen loose checks on raw rows; those that found something.

    An unreadable number is not negative, but an unreadable rate is outside its range.
    """
    c = F.col
    registered, rate = c("registration_date"), number(c("expected_response_rate"))
    start, end = _day("start_date"), _day("end_date")
    checks: dict[str, list[Check]] = {
        "customers": [
            ("invalid_registration_date", "medium", _flag(~missing(registered) & _day("registration_date").isNull())),
            ("negative_phone_number", "medium", _flag(c("phone_number").startswith("-"))),
            ("missing_last_purchase_date", "low", _flag(missing(c("last_purchase_date")))),
        ],
        "orders": [
            ("missing_promotion_id", "low", _flag(missing(c("promotion_id")))),
            _attributed_without_promotion(),
            ("negative_order_value", "high", _flag(number(c("order_value")) < 0)),
        ],
        "order_items": [
            ("invalid_quantity", "high", _flag(number(c("quantity")) <= 0)),
            ("invalid_unit_price", "high", _flag(number(c("unit_price")) < 0)),
            _attributed_without_promotion(),
        ],
        "promotions": [
            ("negative_discount_value", "high", _flag(number(c("discount_value")) < 0)),
            ("invalid_expected_response_rate", "medium", _flag(~F.coalesce(rate.between(0, 1), F.lit(False)))),
            ("invalid_budget_or_cpa", "high",
             _flag(F.coalesce(number(c("budget_allocated")) < 0, F.lit(False))
                   | F.coalesce(number(c("cost_per_acquisition")) < 0, F.lit(False)))),
            ("invalid_date_range", "high", _flag(start.isNull() | end.isNull() | (end < start))),
        ],
    }
    frames = [unpivot_counts(batch[name], name, rules) for name, rules in checks.items()]
    return union_all(frames).where("affected_row_count > 0")


def batch_profile(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per column of a batch: type, missing values, and the table's totals."""
    columns = spec.csv_columns
    return (
        inferred_types(df, spec.name, columns)
        .join(null_counts(df, spec.name, columns), ["table_name", "column_name"])
        .join(row_counts(df, spec.name), "table_name")
        .join(duplicate_rows(df, spec.name, columns), "table_name")
    )
