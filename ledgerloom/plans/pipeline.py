"""One date end to end: load, rebuild, test, complete. Each step can be repeated safely."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import specs
from ledgerloom.functions.keys import source_file
from ledgerloom.operators.versions import current_keys, latest_version, newest_version, not_deleted
from ledgerloom.plans import control, datatests, gold, quality, silver, validate
from ledgerloom.plans.control import ControlError, ControlTables
from ledgerloom.plans.quality import union_all
from ledgerloom.session import run_together, use_utc
from ledgerloom.sources import bronze, landing
from ledgerloom.sources.store import TableStore, key_bucket, layer_path
from ledgerloom.specs import ENTITIES


class DataTestsFailed(RuntimeError):
    """Some declared data test returned failing rows."""


Read = Callable[[str, str], DataFrame]


def _report(read: Read) -> DataFrame:
    return quality.data_quality_report(
        {e: read("current", e) for e in ENTITIES}, {e: read("silver", e) for e in ENTITIES}
    )


BUILDERS: dict[tuple[str, str], Callable[[Read], DataFrame]] = {
    ("silver", "customers"): lambda r: silver.silver_customers(r("current", "customers")),
    ("silver", "promotions"): lambda r: silver.silver_promotions(r("current", "promotions")),
    ("silver", "orders"): lambda r: silver.silver_orders(
        r("current", "orders"), r("silver", "customers"), r("silver", "promotions")),
    ("silver", "order_items"): lambda r: silver.silver_order_items(
        r("current", "order_items"), r("silver", "orders"), r("silver", "promotions")),
    ("silver", "data_quality_report"): _report,
    ("gold", "dim_customer"): lambda r: gold.dim_customer(r("silver", "customers")),
    ("gold", "dim_promotion"): lambda r: gold.dim_promotion(r("silver", "promotions")),
    ("gold", "dim_product"): lambda r: gold.dim_product(r("silver", "order_items")),
    ("gold", "dim_date"): lambda r: gold.dim_date(r("silver", "orders")),
    ("gold", "fact_orders"): lambda r: gold.fact_orders(
        r("silver", "orders"), r("gold", "dim_customer"), r("gold", "dim_promotion")),
    ("gold", "fact_order_items"): lambda r: gold.fact_order_items(
        r("silver", "order_items"), r("gold", "fact_orders"), r("gold", "dim_product"), r("gold", "dim_promotion")),
}
# Tables of one phase read only tables of earlier phases, so they are built side by side.
PHASES = [
    [("silver", "customers"), ("silver", "promotions")],
    [("silver", "orders"), ("gold", "dim_customer"), ("gold", "dim_promotion")],
    [("silver", "order_items"), ("gold", "fact_orders"), ("gold", "dim_date")],
    [("silver", "data_quality_report"), ("gold", "dim_product")],
    [("gold", "fact_order_items")],
]


def build_layers(read: Read, write: Callable[[DataFrame, str, str], None]) -> None:
    """Rebuild the clean and star layers, each table written before the next reads it."""
    for phase in PHASES:
        run_together([partial(lambda t: write(BUILDERS[t](read), *t), table) for table in phase])


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class Pipeline:
    """A stored warehouse of one pipeline under ``root``."""

    def __init__(self, spark: SparkSession, root: str, name: str = specs.DEFAULT_PIPELINE, key_buckets: int = 16):
        """``key_buckets``: of each table of newest versions; a day rewrites only those that its keys fall in."""
        self.spark, self.name, self.key_buckets = use_utc(spark), name, key_buckets
        self.store = TableStore(spark, root)
        self.control = ControlTables(self.store, name)

    # --- reading -----------------------------------------------------------
    def bronze_path(self, entity: str) -> str:
        return self.store.path("bronze", ENTITIES[entity].table)

    def raw_schema(self, entity: str) -> T.StructType:
        """The raw table's schema as stored with it, with the contract's columns it lacks.

        A table that another loader wrote has no stored schema yet; its files' own one is taken over.
        """
        path, spec = self.bronze_path(entity), ENTITIES[entity]
        kept = f"{path}/{RAW_SCHEMA}"
        if self.store.files.exists(kept):
            stored = T.StructType.fromJson(json.loads(self.store.files.read_text(kept)))
        elif self.store.files.exists(path):
            stored = self.spark.read.option("mergeSchema", True).parquet(path).schema
        else:
            return bronze.bronze_read_schema(spec)
        return bronze.evolved(stored, spec)

    def all_bronze(self, entity: str) -> DataFrame:
        """Raw rows of every attempt, published or not; columns keep the types they are stored with."""
        path, schema = self.bronze_path(entity), self.raw_schema(entity)
        if not any(n[0] not in "_." for n in self.store.files.names(path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def bronze(self, entity: str) -> DataFrame:
        """Raw rows of published batches, business columns as text."""
        return self._published(entity, self.control.batches())

    def _published(self, entity: str, batches: DataFrame) -> DataFrame:
        rows = bronze.committed_rows(self.all_bronze(entity), batches)
        return bronze.as_texts(rows, ENTITIES[entity]).select(bronze.bronze_read_schema(ENTITIES[entity]).names)

    def unmerged_versions(self, entity: str) -> DataFrame:
        """Versions that decide the newest ones: those stored so far, and of batches not yet completed.

        A date is completed only after its rebuild stored its versions, so completed
        batches need not be read again.
        """
        if not self.store.exists("newest", entity):
            return self.bronze(entity)
        return self.store.read("newest", entity).unionByName(self._waiting(entity))

    def _waiting(self, entity: str) -> DataFrame:
        """Rows of published batches that are not completed yet."""
        return self._published(entity, self.control.batches().where("status = 'ingested'"))

    def read(self, layer: str, table: str) -> DataFrame:
        if layer == "bronze":
            return self.bronze(next(n for n, s in ENTITIES.items() if s.table == table))
        if layer == "current":
            return self.store.read("newest", table).where(not_deleted())
        return self.store.read(layer, table)

    # --- loading -----------------------------------------------------------
    def _identifier(self, logical_date: date) -> str:
        return f"{self.name}:{logical_date.isoformat()}"

    def _checksums(self, logical_date: date, directory: str) -> DataFrame:
        """The four files' names and checksums, fixed once for the whole load."""
        day = F.lit(logical_date)
        name = F.concat(F.lit("data/incoming/"), day.cast("string"), F.lit("/"), F.col("entity"), F.lit(".csv"))
        named = landing.file_checksums(self.spark, directory).select(
            F.lit(self.name).alias("pipeline_name"), day.alias("logical_date"), name.alias("source_file"),
            "file_checksum", "entity",
        )
        return self.spark.createDataFrame(named.collect(), named.schema)

    def _staged(self, attempt: str, kind: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write an attempt's intermediate frames side by side; later steps read what was written."""
        base = f"{self.store.path('staging', attempt)}/{kind}"
        run_together([partial(df.write.parquet, f"{base}/{name}") for name, df in frames.items()])
        return {n: self.spark.read.schema(df.schema).parquet(f"{base}/{n}") for n, df in frames.items()}

    def _stage(self, directory: str, attempt: str) -> dict[str, DataFrame]:
        """Parse the files once into numbered text rows."""
        read = run_together([partial(landing.read_entity_csv, self.spark, directory, s) for s in ENTITIES.values()])
        numbered = [landing.with_row_number(rows).drop("_file") for rows in read]
        return self._staged(attempt, "rows", dict(zip(ENTITIES, numbered, strict=True)))

    def _errors(self, batch: dict[str, DataFrame], attempt: str, day: Column) -> DataFrame:
        """All broken rules of a staged batch, kept with the attempt."""
        latest = {e: latest_version(self.unmerged_versions(e).select(*KEY_COLUMNS, s.key), s) for e, s in ENTITIES.items()}
        known = self._staged(attempt, "known", {e: current_keys(latest[e], s) for e, s in ENTITIES.items()})
        available = self._staged(attempt, "available", validate.batch_available(batch, known))
        errors = {e: validate.entity_errors(batch, known, available, e, day) for e in ENTITIES}
        return union_all(list(self._staged(attempt, "errors", errors).values()))

    def load(self, logical_date: date, directory: str, now: datetime | None = None) -> dict:
        """Validate a landed batch and append its new versions; a repeated batch is a no-op."""
        now = now or utc_now()
        identifier, attempt = self._identifier(logical_date), uuid.uuid4().hex
        landing.require_files(self.spark, directory)
        landing.check_headers(self.spark, directory)
        checksums = self._checksums(logical_date, directory)
        decision = self.control.rerun_decision(checksums)
        if decision == "noop":
            return {"batch_id": identifier, "idempotent_noop": True}
        if decision == "conflict":
            raise ControlError("This date was loaded from other files, or not from all of them")
        manifest = landing.manifest_checksum(checksums).collect()[0]["manifest_checksum"]
        self.control.start(logical_date, manifest, attempt, now)
        try:
            staged = self._stage(directory, attempt)
            validate.require_valid(self._errors(staged, attempt, F.lit(logical_date)))
            metrics = self._append(staged, checksums, logical_date, identifier, attempt, now)
            self.control.publish(metrics)
            # What was staged is in the raw layer now; a refused attempt keeps its rows and errors.
            self.store.files.remove(self.store.path("staging", attempt))
        except Exception as error:
            self.control.fail(identifier, str(error), now)
            raise
        return {"batch_id": identifier, "idempotent_noop": False, "attempt_id": attempt}

    def _append(self, staged, checksums, logical_date, identifier, attempt, now) -> DataFrame:
        """Write each entity's new versions under this attempt; returns per-file metrics."""
        sums = {r["entity"]: r["file_checksum"] for r in checksums.collect()}
        day = F.lit(logical_date)

        def append(name: str, spec: specs.EntitySpec) -> list:
            file_name = source_file(name, day)
            schema = self.raw_schema(name)
            # Stored before the first row that has the new columns.
            self.store.files.replace_text(f"{self.bronze_path(name)}/{RAW_SCHEMA}", schema.json())
            rows = bronze.to_bronze(
                staged[name], spec, F.lit(identifier), day, file_name, F.lit(sums[name]), F.lit(now), bronze.stored_types(schema, spec)
            )
            same_day = self.bronze(name).where(F.col("logical_date") == day)
            fresh = bronze.new_versions(same_day, rows).select(*rows.columns, F.lit(attempt).alias("attempt_id"))
            fresh.write.mode("append").partitionBy("logical_date", "attempt_id").parquet(self.bronze_path(name))
            written = self.all_bronze(name).where((F.col("attempt_id") == attempt) & (F.col("logical_date") == day))
            received = rows.agg(
                F.count("*").alias("rows_received"), F.max("source_updated_at").alias("last_source_updated_at"))
            counted = written.agg(*bronze.operation_counts()).withColumn("source_file", file_name)
            return counted.join(received.withColumn("source_file", file_name), "source_file").select(
                F.lit(self.name).alias("pipeline_name"), day.alias("logical_date"), "source_file",
                F.lit(identifier).alias("batch_id"), F.lit(sums[name]).alias("file_checksum"),
                F.lit(now).alias("started_at"), F.lit(now).alias("completed_at"), *control.COUNTS[:-1],
                "last_source_updated_at",
            ).collect()

        four = run_together([partial(append, n, s) for n, s in ENTITIES.items()])
        schema = (
            "pipeline_name string, logical_date date, source_file string, batch_id string, file_checksum string, "
            "started_at timestamp, completed_at timestamp, rows_received bigint, rows_inserted bigint, "
            "rows_updated bigint, rows_deleted bigint, last_source_updated_at timestamp"
        )
        return self.spark.createDataFrame([row for rows in four for row in rows], schema)

    # --- rebuilding ----------------------------------------------------------
    def rebuild(self) -> None:
        """Store the newest versions, then rebuild everything above them.

        The clean tables and the report both read the stored newest versions. Their buckets in which no key of a waiting
        batch falls are neither read nor written.
        """
        def merge(name: str, spec: specs.EntitySpec) -> None:
            if self.store.bucket_count("newest", name) != self.key_buckets:
                self.store.write_buckets(newest_version(self.unmerged_versions(name), spec), "newest", name, spec.key, self.key_buckets)
                return
            fresh = self._waiting(name)
            # At most as many as there are buckets.
            touched = [r[0] for r in fresh.select(key_bucket(spec.key, self.key_buckets)).distinct().collect()]
            if touched:
                held = self.store.read("newest", name, buckets=touched).unionByName(fresh)
                self.store.write_buckets(newest_version(held, spec), "newest", name, spec.key, self.key_buckets, touched)

        run_together([partial(merge, n, s) for n, s in ENTITIES.items()])
        build_layers(self.read, self.store.write)

    def run_tests(self) -> DataFrame:
        """Run the declared tests; any failing row stops the pipeline."""
        results = datatests.run_suite(self.spark, self.read)
        broken = results.where("failures > 0").collect()
        if broken:
            raise DataTestsFailed("; ".join(f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in broken))
        return results

    def run_date(self, logical_date: date, directory: str, now: datetime | None = None) -> dict:
        """All steps for one date. A failure before completion resumes at the rebuild next time."""
        result = self.load(logical_date, directory, now)
        if self.control.should_rebuild(logical_date):
            self.rebuild()
            self.run_tests()
            self.control.complete(logical_date, now or utc_now())
        return result

    # --- reset ---------------------------------------------------------------
    def reset(self, confirm: bool) -> None:
        """Empty the raw layer, the control tables and all that was built; refuses without confirmation.

        The control tables go first, so no later reader sees a row of what is then removed: raw partitions, their
        stored schemas, staged rows and the built layers. A reader that began before ends with a missing file.
        """
        if not confirm:
            raise ValueError("Refusing to reset data without confirmation")
        for name, schema in ControlTables.SCHEMAS.items():
            self.control.save(self.spark.createDataFrame([], schema), name)
        for name, spec in ENTITIES.items():
            self.store.write(self.spark.createDataFrame([], bronze.bronze_read_schema(spec)), "newest", name)
            self.store.files.remove(self.bronze_path(name))
        for layer in ("staging", "silver", "gold"):
            self.store.files.remove(layer_path(self.store.root, layer))


#: Kept beside a raw table's partitions; readers of tables skip names that begin so.
RAW_SCHEMA = "_schema.json"
KEY_COLUMNS = ["operation", "source_updated_at", "ingested_at", "batch_id", "source_record_hash"]
