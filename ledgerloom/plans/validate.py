"""Validation of one landed batch: row rules, duplicates, and references.

Every rule yields (entity, business_key, rule, detail). One row anywhere rejects the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions.keys import source_record_hash
from ledgerloom.functions.parsing import lacks_offset, parse_utc_timestamp, parse_whole_date
from ledgerloom.functions.text import strip_all
from ledgerloom.operators.joins import lookup
from ledgerloom.operators.versions import available_keys
from ledgerloom.plans.quality import union_all
from ledgerloom.specs import ENTITIES, EntitySpec


class BatchRejected(ValueError):
    """Raised when a batch breaks any rule; carries the first errors."""


def quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def error_rows(df: DataFrame, entity: str, key: Column, rule: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(entity).alias("entity"), key.alias("business_key"), rule.alias("rule"), detail.alias("detail")
    )


def _error(condition: Column, rule: str, detail: Column) -> Column:
    return F.when(condition, F.struct(F.lit(rule).alias("rule"), detail.alias("detail")))


def row_errors(batch: DataFrame, spec: EntitySpec, logical_date: Column) -> DataFrame:
    """Rules that need only the row: all are evaluated in one pass."""
    key, operation = strip_all(F.col(spec.key)), F.col("operation")
    stamp, day = strip_all(F.col("source_updated_at")), strip_all(F.col("business_date"))
    instant, business = parse_utc_timestamp(F.col("source_updated_at")), parse_whole_date(F.col("business_date"))
    no_offset = instant.isNull() & lacks_offset(F.col("source_updated_at"))
    rules = [
        _error(key == "", "blank_key", F.lit(f"blank {spec.key}")),
        _error(~operation.isin(specs.OPERATIONS), "invalid_operation",
               F.concat(F.lit("invalid operation "), quoted(operation))),
        _error(no_offset, "source_time_without_offset",
               F.concat(F.lit("source_updated_at has no UTC offset: "), quoted(stamp))),
        _error(instant.isNull() & ~no_offset, "invalid_source_time",
               F.concat(F.lit("invalid source_updated_at: "), quoted(stamp))),
        _error(instant.cast("date") != logical_date, "source_time_off_date",
               F.lit("source_updated_at lies outside the batch date")),
        _error(business.isNull(), "invalid_business_date", F.concat(F.lit("invalid business_date "), quoted(day))),
        _error(business > logical_date, "future_business_date", F.lit("business_date lies after the batch date")),
    ]
    found = batch.select(key.alias("_key"), F.explode(F.array_compact(F.array(*rules))).alias("e"))
    return error_rows(found, spec.name, F.col("_key"), F.col("e.rule"), F.col("e.detail"))


def duplicate_keys(batch: DataFrame, spec: EntitySpec) -> DataFrame:
    """Stripped keys that occur more than once in the file; blank keys are another rule's."""
    counted = batch.groupBy(strip_all(F.col(spec.key)).alias("_key")).count().where("_key <> '' and count > 1")
    detail = F.concat(F.lit("key "), quoted(F.col("_key")), F.lit(" occurs more than once"))
    return error_rows(counted, spec.name, F.col("_key"), F.lit("duplicate_key"), detail)


def duplicate_versions(batch: DataFrame, spec: EntitySpec) -> DataFrame:
    """Identical rows of one file, found by their version hash."""
    counted = batch.groupBy(source_record_hash(spec).alias("_hash")).count().where("count > 1")
    detail = F.concat(F.lit("version "), F.col("_hash"), F.lit(" occurs more than once"))
    return error_rows(counted, spec.name, F.lit(""), F.lit("duplicate_version"), detail)


def without_parent(rows: DataFrame, parents: DataFrame) -> DataFrame:
    """Rows whose ``business_key`` is not in ``parents``; every one of them, however many share a key."""
    found = parents.select("business_key", F.lit(True).alias("_found"))
    return lookup(rows, found, ["business_key"]).where("_found is null")


def missing_keys(batch: DataFrame, known: DataFrame, spec: EntitySpec) -> DataFrame:
    """Updates and deletes of keys that are not current."""
    raw = F.col(spec.key)
    changes = batch.where("operation in ('U', 'D')").select(
        raw.alias("business_key"), raw.alias("_key"), "operation", "source_row_number"
    )
    detail = F.concat("operation", F.lit(" of a key that is not current"))
    absent = without_parent(changes, known)
    return error_rows(absent, spec.name, F.col("_key"), F.lit("missing_existing_key"), detail)


def unknown_references(
    batch: DataFrame, spec: EntitySpec, column: str, available: DataFrame, blank_allowed: bool
) -> DataFrame:
    """Rows, other than deletes, whose raw reference is not among the available keys."""
    rows = batch.where("operation <> 'D'").select(
        F.col(spec.key).alias("_key"), F.col(column).alias("business_key"), "source_row_number"
    )
    if blank_allowed:
        rows = rows.where("business_key <> ''")
    lost = without_parent(rows, available)
    rule = f"unknown_{column.removesuffix('_id')}"
    detail = F.concat(F.lit(f"unknown {column} "), F.col("business_key"))
    return error_rows(lost, spec.name, F.col("_key"), F.lit(rule), detail)


def blank_products(items: DataFrame) -> DataFrame:
    blank = items.where("operation <> 'D' and product_id = ''")
    return error_rows(blank, "order_items", F.col("order_item_id"), F.lit("blank_product"), F.lit("blank product_id"))


# Which columns refer to which entity, and whether a blank reference is allowed.
REFERENCES: dict[str, list[tuple[str, str, bool]]] = {
    "orders": [("customer_id", "customers", False), ("promotion_id", "promotions", True)],
    "order_items": [("order_id", "orders", False), ("promotion_id", "promotions", True)],
}
PARENTS = ["customers", "promotions", "orders"]
Frames = dict[str, DataFrame]


def batch_available(batch: Frames, known: Frames) -> Frames:
    """The keys references may use: current ones as this batch will leave them."""
    return {e: available_keys(known[e], batch[e], ENTITIES[e]) for e in PARENTS}


def reference_errors(batch: Frames, available: Frames, entity: str) -> list[DataFrame]:
    """One frame per foreign key of an entity, and blank products of items."""
    frames = [
        unknown_references(batch[entity], ENTITIES[entity], column, available[parent], blank_allowed)
        for column, parent, blank_allowed in REFERENCES.get(entity, [])
    ]
    return [*frames, blank_products(batch[entity])] if entity == "order_items" else frames


def entity_errors(batch: Frames, known: Frames, available: Frames, entity: str, logical_date: Column) -> DataFrame:
    """Every broken rule among one entity's rows."""
    rows, spec = batch[entity], ENTITIES[entity]
    return union_all([
        row_errors(rows, spec, logical_date), duplicate_keys(rows, spec), duplicate_versions(rows, spec),
        missing_keys(rows, known[entity], spec), *reference_errors(batch, available, entity),
    ])


def batch_errors(batch: Frames, known: Frames, available: Frames, logical_date: Column) -> DataFrame:
    """Every broken rule of a batch; ``known`` holds the current keys per entity."""
    return union_all([entity_errors(batch, known, available, e, logical_date) for e in ENTITIES])


def first_errors(errors: DataFrame, limit: int = specs.MAX_REPORTED_ERRORS) -> DataFrame:
    return errors.orderBy("entity", "business_key", "rule", "detail").limit(limit)


def require_valid(errors: DataFrame) -> None:
    lines = [f"{r.entity} {r.business_key}: {r.detail}" for r in first_errors(errors).collect()]
    if lines:
        raise BatchRejected("Batch validation failed:\n- " + "\n- ".join(lines))
