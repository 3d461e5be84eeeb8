"""Batch, file and watermark state as small tables, and its transitions as set operations.

These tables hold one row per date (four for files), so rewriting them whole is cheap.
Each transition takes and returns DataFrames; ``ControlTables`` applies it to storage.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions.keys import batch_id
from ledgerloom.plans import datatests
from ledgerloom.plans.quality import union_all
from ledgerloom.sources.store import TableStore
from ledgerloom.specs import ENTITIES

COUNTS = ["rows_received", "rows_inserted", "rows_updated", "rows_deleted", "rows_rejected"]
COUNT_FIELDS = ", ".join(f"{c} bigint" for c in COUNTS)
BATCHES = (
    "batch_id string, pipeline_name string, logical_date date, source_file string, file_checksum string, "
    f"started_at timestamp, completed_at timestamp, status string, {COUNT_FIELDS}, "
    "last_source_updated_at timestamp, error_message string, attempt_id string"
)
FILES = (
    "pipeline_name string, logical_date date, source_file string, batch_id string, file_checksum string, "
    f"started_at timestamp, completed_at timestamp, status string, {COUNT_FIELDS}, "
    "last_source_updated_at timestamp, error_message string"
)
WATERMARKS = (
    "pipeline_name string, last_logical_date date, batch_id string, last_source_updated_at timestamp, "
    "updated_at timestamp"
)
FILE_KEY = ["pipeline_name", "logical_date", "source_file"]
DAY_KEY = ["pipeline_name", "logical_date"]
PUBLISHED = ["ingested", "completed"]
MANY_FILES = "multiple"


class ControlError(RuntimeError):
    """A control-state rule forbids the requested step."""


def upsert(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    kept = table.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.select(*table.columns))


def _typed(df: DataFrame, values: dict[str, Column], like: DataFrame) -> DataFrame:
    """Rows shaped like a table: given values, own columns, NULL for the rest."""
    def column(field):
        source = values.get(field.name, F.col(field.name) if field.name in df.columns else F.lit(None))
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in like.schema.fields])


def start_batches(batches: DataFrame, starting: DataFrame) -> DataFrame:
    """New or reset rows for (pipeline_name, logical_date, file_checksum, started_at, attempt_id).

    Published batches are left alone.
    """
    published = batches.where(F.col("status").isin(PUBLISHED)).select(*DAY_KEY)
    open_days = starting.join(published, DAY_KEY, "left_anti")
    zero = dict.fromkeys(COUNTS, F.lit(0))
    fresh = _typed(open_days, {
        "batch_id": batch_id(F.col("pipeline_name"), F.col("logical_date")),
        "source_file": F.lit(MANY_FILES), "status": F.lit("started"), **zero,
    }, batches)
    return upsert(batches, fresh, ["batch_id"])


def publish_batches(batches: DataFrame, totals: DataFrame) -> DataFrame:
    """Mark batches ingested with their totals: (batch_id, counts, last_source_updated_at, completed_at)."""
    given = [*COUNTS[:-1], "last_source_updated_at", "completed_at"]
    renamed = totals.select("batch_id", *[F.col(c).alias(f"_{c}") for c in given])
    published = _typed(batches.join(renamed, "batch_id"), {
        "status": F.lit("ingested"), "rows_rejected": F.lit(0), "error_message": F.lit(None),
        **{c: F.col(f"_{c}") for c in given},
    }, batches)
    return upsert(batches, published, ["batch_id"])


def fail_batches(batches: DataFrame, failures: DataFrame) -> DataFrame:
    """Mark batches failed: (batch_id, message, failed_at). At least one row counts as rejected."""
    failed = _typed(batches.join(failures, "batch_id"), {
        "status": F.lit("failed"), "completed_at": F.col("failed_at"),
        "rows_rejected": F.greatest("rows_rejected", F.lit(1)),
        "error_message": F.substring("message", 1, specs.MAX_ERROR_CHARS),
    }, batches)
    return upsert(batches, failed, ["batch_id"])


def files_match(files: DataFrame, checksums: DataFrame) -> DataFrame:
    """Per date: whether every given (source_file, file_checksum) is recorded as completed."""
    recorded = files.where("status = 'completed'").select(*FILE_KEY, "file_checksum", F.lit(True).alias("_same"))
    checked = checksums.join(recorded, [*FILE_KEY, "file_checksum"], "left")
    return checked.groupBy(*DAY_KEY).agg(F.bool_and(F.coalesce("_same", F.lit(False))).alias("all_match"))


def rerun_decisions(batches: DataFrame, files: DataFrame, checksums: DataFrame) -> DataFrame:
    """Per delivered date: load it, skip it as already done, or refuse it as changed."""
    matched = files_match(files, checksums)
    decided = matched.join(batches.select(*DAY_KEY, "status"), DAY_KEY, "left")
    done = F.coalesce(F.col("status").isin(PUBLISHED), F.lit(False))
    decision = F.when(done & F.col("all_match"), "noop").when(done, "conflict").otherwise("load")
    return decided.select(*DAY_KEY, "status", "all_match", decision.alias("decision"))


def reused_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files whose bytes are already recorded under another pipeline or date."""
    other = files.select("source_file", "file_checksum", *[F.col(c).alias(f"_{c}") for c in DAY_KEY])
    both = loaded.join(other, ["source_file", "file_checksum"])
    moved = (F.col("_pipeline_name") != F.col("pipeline_name")) | (F.col("_logical_date") != F.col("logical_date"))
    return both.where(moved).select(*FILE_KEY, "file_checksum")


def upsert_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Record completed files with their metrics; an earlier error is cleared."""
    rows = _typed(loaded, {
        "status": F.lit("completed"), "rows_rejected": F.lit(0), "error_message": F.lit(None),
    }, files)
    return upsert(files, rows, FILE_KEY)


def rebuild_decisions(batches: DataFrame) -> DataFrame:
    """Completed batches need no rebuild, ingested ones do, others are an error."""
    decision = F.when(F.col("status") == "completed", "skip").when(F.col("status") == "ingested", "rebuild")
    return batches.select("batch_id", "logical_date", "status", F.coalesce(decision, F.lit("error")).alias("decision"))


def completion_checks(batches: DataFrame, files: DataFrame) -> DataFrame:
    """Per batch: its file counts, and whether it may be completed."""
    counted = files.groupBy("batch_id").agg(
        F.count("*").alias("file_count"), F.count_if(F.col("status") == "completed").alias("completed_count")
    )
    zero = F.lit(0).cast("bigint")
    checked = batches.join(counted, "batch_id", "left").select(
        "batch_id", "logical_date", "status", F.coalesce("file_count", zero).alias("file_count"),
        F.coalesce("completed_count", zero).alias("completed_count"),
    )
    whole = (F.col("file_count") == len(ENTITIES)) & (F.col("completed_count") == len(ENTITIES))
    decision = (
        F.when(F.col("status") == "completed", "noop")
        .when(F.col("status") != "ingested", "wrong_status")
        .when(whole, "complete").otherwise("missing_files")
    )
    return checked.withColumn("decision", decision)


def complete_batches(batches: DataFrame, files: DataFrame, completed_at: Column) -> DataFrame:
    """Complete every batch that may be."""
    ready = completion_checks(batches, files).where("decision = 'complete'").select("batch_id")
    done = _typed(batches.join(ready, "batch_id"), {
        "status": F.lit("completed"), "completed_at": completed_at,
    }, batches)
    return upsert(batches, done, ["batch_id"])


def watermark_candidates(batches: DataFrame, updated_at: Column) -> DataFrame:
    return batches.where("status = 'completed'").select(
        "pipeline_name", F.col("logical_date").alias("last_logical_date"), "batch_id", "last_source_updated_at",
        updated_at.cast("timestamp").alias("updated_at"),
    )


def advance_watermark(watermarks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Keep the furthest row per pipeline; the watermark never moves back, and a tie takes the new row."""
    columns = ["pipeline_name", "last_logical_date", "batch_id", "last_source_updated_at", "updated_at"]
    both = watermarks.select(*columns, F.lit(0).alias("_new")).unionByName(
        candidates.select(*columns, F.lit(1).alias("_new"))
    )
    reach = F.struct(F.coalesce("last_logical_date", F.lit("0001-01-01").cast("date")), F.col("_new"))
    best = both.groupBy("pipeline_name").agg(F.max_by(F.struct(*columns[1:]), reach).alias("w"))
    return best.select("pipeline_name", "w.*")


def constraint_violations(batches: DataFrame, files: DataFrame) -> DataFrame:
    """What a database would refuse: repeated keys and unknown states, counted per value."""
    def repeated(df: DataFrame, table: str, rule: str, keys: list[str]) -> DataFrame:
        value = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        return datatests.unique(df.select(value.alias("value")), "value").select(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "value", "n_records")

    def unknown_state(df: DataFrame, table: str, states: list[str]) -> DataFrame:
        return datatests.accepted_values(df, "status", states).select(
            F.lit(table).alias("table_name"), F.lit("status").alias("rule"), F.col("status").alias("value"), "n_records")

    return union_all([
        repeated(batches, "ingestion_batches", "one_per_day", DAY_KEY),
        unknown_state(batches, "ingestion_batches", specs.BATCH_STATUSES),
        repeated(files, "ingested_files", "one_per_file", FILE_KEY),
        repeated(files, "ingested_files", "bytes_once", ["source_file", "file_checksum"]),
        unknown_state(files, "ingested_files", specs.FILE_STATUSES),
    ])


class ControlTables:
    """The stored control state of one pipeline. One writer per pipeline is a precondition."""

    LAYER = "control"
    SCHEMAS = {"ingestion_batches": BATCHES, "ingested_files": FILES, "pipeline_watermarks": WATERMARKS}

    def __init__(self, store: TableStore, pipeline: str = specs.DEFAULT_PIPELINE):
        self.store, self.pipeline = store, pipeline
        self.spark: SparkSession = store.spark

    def table(self, name: str) -> DataFrame:
        if self.store.exists(self.LAYER, name):
            return self.store.read(self.LAYER, name)
        return self.spark.createDataFrame([], self.SCHEMAS[name])

    def save(self, df: DataFrame, name: str) -> None:
        self.store.write(df.coalesce(1), self.LAYER, name)

    def batches(self) -> DataFrame:
        return self.table("ingestion_batches")

    def files(self) -> DataFrame:
        return self.table("ingested_files")

    def watermarks(self) -> DataFrame:
        return self.table("pipeline_watermarks")

    def batch(self, logical_date: date):
        rows = self.batches().where(
            (F.col("pipeline_name") == self.pipeline) & (F.col("logical_date") == F.lit(logical_date))
        ).limit(1).collect()
        return rows[0] if rows else None

    def rerun_decision(self, checksums: DataFrame) -> str:
        """For the four checksums of one date: load, noop or conflict."""
        return rerun_decisions(self.batches(), self.files(), checksums).collect()[0]["decision"]

    def start(self, logical_date: date, checksum: str, attempt: str, now: datetime) -> None:
        starting = self.spark.createDataFrame(
            [(self.pipeline, logical_date, checksum, now, attempt)],
            "pipeline_name string, logical_date date, file_checksum string, started_at timestamp, attempt_id string",
        )
        self.save(start_batches(self.batches(), starting), "ingestion_batches")

    def fail(self, identifier: str, message: str, now: datetime) -> None:
        failure = self.spark.createDataFrame(
            [(identifier, message, now)], "batch_id string, message string, failed_at timestamp"
        )
        self.save(fail_batches(self.batches(), failure), "ingestion_batches")

    def publish(self, loaded_files: DataFrame) -> None:
        """Record the files, then flip the batch row: the row is what makes the data visible."""
        files = self.files()
        if not reused_files(files, loaded_files).isEmpty():
            raise ControlError("a source file with the same checksum is already recorded elsewhere")
        self.save(upsert_files(files, loaded_files), "ingested_files")
        totals = loaded_files.groupBy("batch_id").agg(
            *[F.sum(c).alias(c) for c in COUNTS[:-1]],
            F.max("last_source_updated_at").alias("last_source_updated_at"),
            F.max("completed_at").alias("completed_at"),
        )
        self.save(publish_batches(self.batches(), totals), "ingestion_batches")

    def should_rebuild(self, logical_date: date) -> bool:
        row = self.batch(logical_date)
        if row is None:
            raise ControlError(
                f"Nothing was ingested by {self.pipeline} for {logical_date}"
            )
        if row["status"] not in PUBLISHED:
            raise ControlError(f"Batch {row['batch_id']} stands at {row['status']!r} and cannot be rebuilt from")
        return row["status"] == "ingested"

    def complete(self, logical_date: date, now: datetime) -> bool:
        """Complete a date and advance the watermark; False if it was complete already."""
        row = self.batch(logical_date)
        if row is None:
            raise ControlError(f"Nothing to complete for {self.pipeline} on {logical_date}")
        one = self.batches().where(F.col("batch_id") == row["batch_id"])
        decision = completion_checks(one, self.files()).collect()[0]["decision"]
        if decision == "noop":
            return False
        if decision != "complete":
            raise ControlError(f"Batch {row['batch_id']} is not complete: {decision}")
        others = self.batches().where(F.col("batch_id") != row["batch_id"])
        done = complete_batches(one, self.files(), F.lit(now))
        # The watermark goes first: a crash between the two writes leaves the date ingested, and
        # repeating the step gives the same watermark.
        self.save(advance_watermark(self.watermarks(), watermark_candidates(done, F.lit(now))), "pipeline_watermarks")
        self.save(others.unionByName(done), "ingestion_batches")
        return True
