"""Row versions: newest per key, state at a date, lineage checks, new identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.joins import unsent
from ledgerloom.specs import EntitySpec

VERSION_ORDER = ["source_updated_at", "ingested_at", "batch_id", "source_record_hash"]


def newest_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in VERSION_ORDER]


def not_deleted() -> Column:
    return F.coalesce(F.col("operation"), F.lit("I")) != "D"


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. The rank limit is applied in each task before the shuffle."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def newest_version(versions: DataFrame, spec: EntitySpec) -> DataFrame:
    """Newest version per raw key, tombstones included.

    Newest-of is associative: the newest of (newest versions so far, later batches) is the
    newest of all, in whatever order batches arrive, so a stored result can be carried on.
    """
    return first_per_key(versions, [spec.key], newest_first())


def latest_version(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """Newest version per raw key; tombstones go only after ranking, or deleted keys revive."""
    return newest_version(bronze, spec).where(not_deleted())


def state_as_of(bronze: DataFrame, spec: EntitySpec, as_of: str) -> DataFrame:
    """Rows current at the end of a logical date; the date filter prunes partitions."""
    return latest_version(bronze.where(F.col("logical_date") <= F.lit(as_of).cast("date")), spec)


def current_keys(current: DataFrame, spec: EntitySpec) -> DataFrame:
    return current.where(F.col(spec.key).isNotNull()).select(F.col(spec.key).alias("business_key"))


def available_keys(known: DataFrame, batch: DataFrame, spec: EntitySpec) -> DataFrame:
    """Known keys, plus those a batch inserts or updates, less those it deletes.

    A key met with several operations in one batch keeps the effect of the last row.
    """
    key = F.coalesce(F.col(spec.key), F.lit("")).alias("business_key")
    change = batch.where(F.col("operation").isin("I", "U", "D")).select(key, "operation", "source_row_number")
    last = change.groupBy("business_key").agg(F.max_by("operation", "source_row_number").alias("operation"))
    kept = known.join(unsent(last), "business_key", "left_anti")
    return kept.unionByName(last.where("operation <> 'D'").select("business_key"))


def late_rows(bronze: DataFrame) -> DataFrame:
    return bronze.where((F.col("operation") == "I") & (F.col("business_date") < F.col("logical_date")))


def with_previous(df: DataFrame, key: str, value: str, staging: str) -> DataFrame:
    """Add ``previous_<value>``: the value of the key's preceding version.

    A plain lag would sort all versions of one key in one task. Instead the rows are
    range-partitioned on key and version order, so a hot key spans as many chunks as its rows need,
    and written to ``staging`` with their chunk number. Lag runs inside (key, chunk) groups;
    each group's first row takes the closing value of the key's previous chunk.
    """
    oldest_first = [F.col(c).asc_nulls_first() for c in VERSION_ORDER]
    columns = [key, value, *VERSION_ORDER, *[c for c in df.columns if c not in (key, value, *VERSION_ORDER)]]
    ranged = df.select(*columns).repartitionByRange(F.col(key).asc_nulls_first(), *oldest_first)
    chunked = ranged.withColumn("_chunk", F.spark_partition_id())
    chunked.write.parquet(staging)
    stored = df.sparkSession.read.schema(chunked.schema).parquet(staging)
    held = F.struct(F.col(value).alias("v"))
    before = F.lag(held).over(W.partitionBy(key, "_chunk").orderBy(*oldest_first))
    closing = stored.groupBy(key, "_chunk").agg(F.max_by(held, F.struct(*VERSION_ORDER)).alias("_closing"))
    carried = closing.select(
        key, "_chunk", F.lag("_closing").over(W.partitionBy(key).orderBy("_chunk")).alias("_carried")
    )
    joined = stored.withColumn("_before", before).join(carried, [key, "_chunk"], "left")
    previous = F.coalesce("_before", "_carried")["v"]
    return joined.withColumn(f"previous_{value}", previous).drop("_before", "_carried", "_chunk")


def status_transitions(bronze: DataFrame, spec: EntitySpec, staging: str) -> DataFrame:
    """Each update of an order with its former status and whether the move is allowed."""
    versions = bronze.select(spec.key, "order_status", "operation", "logical_date", *VERSION_ORDER)
    moved = with_previous(versions, spec.key, "order_status", staging).where("operation = 'U'")
    now, was = F.col("order_status"), F.col("previous_order_status")
    allowed = (
        now.isin("PAID", "PENDING", "CANCEL", "ERROR", "INVALID")
        & ((now == was)
           | ((was == "PENDING") & now.isin("PAID", "CANCEL"))
           | (was.isin("ERROR", "INVALID") & (now == "CANCEL")))
    )
    return moved.select(
        spec.key, "logical_date", was.alias("previous_status"), now.alias("new_status"),
        F.coalesce(allowed, F.lit(False)).alias("is_allowed"),
    )


def assign_next_ids(rows: DataFrame, known: DataFrame, order_by: str, block: int = 1_000_000) -> DataFrame:
    """Number new rows densely from the highest known key, in the order of an integer column.

    Ranks run inside blocks of the ordering column; a running total over the much smaller
    block table supplies each block's start, so no window spans the data. The ordering
    column must be unique, as a row number is; a block then holds at most ``block`` rows.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(order_by) / F.lit(block)))
    sizes = blocked.groupBy("_block").agg(F.count("*").alias("_size"))
    running = F.sum("_size").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    top = known.agg(F.coalesce(F.max("key"), F.lit(0)).alias("_top")).withColumn("_one", F.lit(1))
    starts = sizes.select("_block", F.coalesce(running, F.lit(0)).alias("_start"), F.lit(1).alias("_one"))
    bases = starts.join(F.broadcast(top), "_one").select("_block", (F.col("_start") + F.col("_top")).alias("_base"))
    ranked = blocked.withColumn("_rank", F.row_number().over(W.partitionBy("_block").orderBy(order_by)))
    numbered = ranked.join(bases, "_block")
    next_id = F.col("_base") + F.col("_rank")
    return numbered.withColumn("next_id", next_id).drop("_block", "_base", "_rank")
