"""The raw layer: every version of every row, partitioned by logical date and load attempt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.keys import source_record_hash
from ledgerloom.functions.parsing import parse_day, parse_utc_timestamp, parse_whole_date, to_stored_type
from ledgerloom.operators.joins import lookup, unsent
from ledgerloom.operators.versions import first_per_key
from ledgerloom.specs import OPERATIONS, EntitySpec


def to_bronze(
    feed: DataFrame, spec: EntitySpec, batch_id: Column, logical_date: Column, source_file: Column,
    file_checksum: Column, ingested_at: Column, stored_types: dict[str, str] | None = None,
) -> DataFrame:
    """Attach version metadata to a validated text batch; business columns keep their stored type."""
    types = stored_types or {}
    return feed.select(
        *[to_stored_type(F.col(c), types.get(c, "string")).alias(c) for c in spec.columns],
        batch_id.alias("batch_id"),
        source_file.alias("source_file"),
        file_checksum.alias("file_checksum"),
        parse_utc_timestamp(F.col("source_updated_at")).alias("source_updated_at"),
        ingested_at.cast("timestamp").alias("ingested_at"),
        "operation",
        parse_whole_date(F.col("business_date")).alias("business_date"),
        "source_row_number",
        source_record_hash(spec).alias("source_record_hash"),
        logical_date.cast("date").alias("logical_date"),
    )


def evolved(stored: T.StructType, spec: EntitySpec) -> T.StructType:
    """A stored table's columns with their own types, and the contract's columns it lacks, as text."""
    names = {f.name for f in stored.fields}
    return T.StructType([*stored.fields, *[f for f in bronze_read_schema(spec).fields if f.name not in names]])


def stored_types(stored: T.StructType, spec: EntitySpec) -> dict[str, str]:
    """The types that new rows' business columns are converted to."""
    return {f.name: f.dataType.simpleString() for f in stored.fields if f.name in spec.columns}


def evolve_schema(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Give an older raw table the contract's missing columns, as NULL text; keep its own types."""
    present = set(df.columns)
    missing = [f for f in evolved(df.schema, spec).fields if f.name not in present and f.name in spec.bronze_schema.names]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def as_texts(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """The business columns of a typed raw table as the texts that cleaning starts from."""
    typed = {f.name for f in df.schema.fields if f.name in spec.columns and f.dataType != T.StringType()}
    return df.select(*[F.col(c).cast("string").alias(c) if c in typed else F.col(c) for c in df.columns]) if typed else df


def new_versions(bronze: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch rows whose hash the raw layer lacks, one per hash (the earliest in its file).

    The hash covers the source time, which lies on the logical date, so only the
    partitions of the batch's dates need reading.
    """
    once = first_per_key(batch, ["source_record_hash"], [F.col("source_row_number"), F.col("file_checksum")])
    return once.join(unsent(bronze.select("source_record_hash")), "source_record_hash", "left_anti")


def operation_counts() -> list[Column]:
    """Counts of inserted, updated and deleted rows."""
    labels = zip(("rows_inserted", "rows_updated", "rows_deleted"), OPERATIONS, strict=True)
    return [F.count_if(F.col("operation") == code).alias(label) for label, code in labels]


def batch_metrics(batch: DataFrame, keys: list[str]) -> DataFrame:
    return batch.groupBy(*keys).agg(
        F.count("*").alias("rows_received"), *operation_counts(),
        F.max("source_updated_at").alias("last_source_updated_at"),
    )


def committed_rows(bronze: DataFrame, batches: DataFrame) -> DataFrame:
    """Rows of published attempts only. The batch table has one row per date, so it is broadcast."""
    published = batches.where(F.col("status").isin("ingested", "completed")).select("attempt_id")
    return bronze.join(F.broadcast(published), "attempt_id", "left_semi")


def bronze_read_schema(spec: EntitySpec) -> T.StructType:
    return spec.bronze_schema.add("attempt_id", T.StringType())


def batch_manifest(feed: DataFrame, keys: list[str]) -> DataFrame:
    """Row and operation counts per entity and date."""
    return feed.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        *[F.count_if(F.col("operation") == code).alias(f"{code.lower()}_count") for code in OPERATIONS],
    )


def business_date(feed: DataFrame, spec: EntitySpec, orders: DataFrame | None = None) -> DataFrame:
    """The row's own date if readable and not after the logical date, else the logical date.

    Items take the date of their order; ``orders`` holds (order_id, order_date), unique.
    """
    dated = feed
    if not spec.date_column:
        dated = lookup(feed, orders, ["order_id"])
    own = parse_day(F.col(spec.date_column or "order_date"))
    derived = F.when(own <= F.col("logical_date"), own).otherwise(F.col("logical_date"))
    return dated.withColumn("derived_business_date", derived)


