"""A warehouse built from the driver tables, each table written once when first needed."""

from __future__ import annotations

import threading
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions.keys import batch_id, source_record_hash
from ledgerloom.operators.versions import available_keys, current_keys, latest_version
from ledgerloom.plans import silver
from ledgerloom.plans.control import MANY_FILES, watermark_candidates
from ledgerloom.plans.pipeline import BUILDERS
from ledgerloom.plans.validate import PARENTS
from ledgerloom.session import read_finely, run_together, use_utc
from ledgerloom.sources import feeds
from ledgerloom.sources.store import TableStore, fresh_dir
from ledgerloom.specs import ENTITIES

OTHER = "retail_weekly"
AS_OF = "2024-01-31 00:00:00"
LANDING_WRITE = {
    "header": True, "quote": '"', "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
# The event type whose daily count stands for an entity's file.
FILE_EVENTS = {"signup": "customers", "click": "promotions", "purchase": "orders", "view": "order_items"}


#: Largest piece of a file that one task reads. A source row becomes several wide raw rows, which a task has to sort in its memory.
SPLIT = "32m"


class Warehouse:
    """Layers over the driver tables, and landed CSV files.

    Feed and raw rows follow from a source row alone, and the newest versions from one shuffle: they are plans, so a query
    moves the columns that it reads and no others. Clean and star layers are written once when first needed, each
    without its neighbours; so are the newest versions' business columns for the report, which reads them many times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.store = TableStore(spark, fresh_dir(spark, "warehouse"))
        self.lock = threading.RLock()
        self.landed: dict[str, str] = {}

    # --- layers ------------------------------------------------------------
    def read(self, layer: str, name: str) -> DataFrame:
        """A layer's table. Stored ones, and what they need, are written when first read."""
        if layer in ("feed", "bronze") or (layer == "current" and not self.store.exists(layer, name)):
            return self.build(layer, name)
        self.write(layer, [name])
        return self.store.read(layer, name)

    def write(self, layer: str, names: list[str]) -> None:
        """Store those of a layer's tables that are not stored yet, side by side."""
        with self.lock:
            if layer == "silver" and "order_items" in names and not self.store.exists(layer, "order_items"):
                self.write_items()
            missing = [n for n in names if not self.store.exists(layer, n)]
            plans = [self.build(layer, n) for n in missing]
            run_together([partial(self.store.write, p, layer, n) for n, p in zip(missing, plans, strict=True)])

    def write_items(self) -> None:
        """Store the clean items in three statements.

        In one, the shuffles of its newest versions, two lookups and newest clean rows would stand on disk together, and
        the first is as large as the others.
        """
        root, steps = fresh_dir(self.spark, "items"), []

        def store(rows: DataFrame) -> DataFrame:
            steps.append(f"{root}/{len(steps)}")
            rows.write.option("compression", "zstd").parquet(steps[-1])
            for done in steps[:-1]:
                self.store.files.remove(done)
            return self.spark.read.schema(rows.schema).parquet(steps[-1])

        try:
            parents = [self.read("silver", "orders"), self.read("silver", "promotions")]
            self.store.write(silver.silver_order_items(self.read("current", "order_items"), *parents, store), "silver", "order_items")
        finally:
            self.store.files.remove(root)

    def build(self, layer: str, name: str) -> DataFrame:
        """The unwritten plan of a table over its inputs."""
        if layer == "feed":
            return feeds.csv_feed(self.spark, self.sf_dir, name)
        if layer == "dirty":
            return feeds.csv_feed(self.spark, self.sf_dir, name, feeds.DIRTY_CHANGES)
        if layer == "available":
            known = current_keys(self.newest(name), ENTITIES[name])
            return available_keys(known, self.read("dirty", name), ENTITIES[name])
        if layer == "bronze":
            entity = next(n for n, s in ENTITIES.items() if s.table == name)
            return feeds.as_bronze(self.feed(entity), entity)
        if layer == "current":
            return self.newest(name)
        if name == "data_quality_report":
            self.write("current", list(ENTITIES))
        return BUILDERS[layer, name](self.read)

    def bronze(self, entity: str) -> DataFrame:
        return self.read("bronze", ENTITIES[entity].table)

    def current(self, entity: str) -> DataFrame:
        """The newest versions with all raw columns. Hashes are shuffled as bytes, which have the order of their digits."""
        digits = F.col("source_record_hash")
        newest = latest_version(self.bronze(entity).withColumn("source_record_hash", F.unhex(digits)), ENTITIES[entity])
        return newest.withColumn("source_record_hash", F.lower(F.hex(digits)))

    def newest(self, entity: str) -> DataFrame:
        """Their business columns. Versions that agree in time and batch are told apart by the first 8 bytes of their
        hashes, which are a third of a shuffled row when whole; two that differ agree in those with a chance of 2 ** -64."""
        spec = ENTITIES[entity]
        start = F.substring(F.unhex("source_record_hash"), 1, 8)
        return latest_version(self.bronze(entity).withColumn("source_record_hash", start), spec).select(*spec.columns)

    def plan(self, layer: str, name: str) -> DataFrame:
        """A layer's table for a query that reads few of its columns: as stored, or its plan, which moves only those."""
        return self.store.read(layer, name) if self.store.exists(layer, name) else self.build(layer, name)

    def silver(self, name: str) -> DataFrame:
        return self.read("silver", name)

    def gold(self, name: str) -> DataFrame:
        return self.read("gold", name)

    # --- batches as text -----------------------------------------------------
    def feed(self, entity: str) -> DataFrame:
        return self.read("feed", entity)

    def dirty_batch(self) -> dict[str, DataFrame]:
        """The batch of the day after the feed, in which most rules are broken by some rows."""
        self.write("dirty", list(ENTITIES))
        return {entity: self.read("dirty", entity) for entity in ENTITIES}

    def dirty_available(self) -> dict[str, DataFrame]:
        """The keys that batch's references may use."""
        self.write("available", PARENTS)
        return {entity: self.read("available", entity) for entity in PARENTS}

    def landing(self, day: str | None = None) -> str:
        """Directory of landed CSV files; with ``day``, of that date's batch.

        Rows are written in feed order, so part files in name order are the file.
        """
        with self.lock:
            root = f"{self.store.root}/incoming"
            if not self.landed:
                for entity, spec in ENTITIES.items():
                    sorted_path = f"{root}-sorted/{entity}"
                    ordered = self.feed(entity).orderBy("logical_date", "source_row_number", source_record_hash(spec))
                    ordered.select(*spec.csv_columns, "logical_date").write.options(**LANDING_WRITE).partitionBy(
                        "logical_date").csv(sorted_path)
                    for date in feeds.DATES:
                        self.store.files.move(f"{sorted_path}/logical_date={date}", f"{root}/{date}/{entity}.csv")
                self.landed = {date: f"{root}/{date}" for date in feeds.DATES}
        return self.landed[day] if day else root

    # --- control and run history, from events ---------------------------------
    def events(self) -> DataFrame:
        return feeds.read_table(self.spark, self.sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))

    def batches(self) -> DataFrame:
        """One batch per day of events; status and rejections follow the day of the month."""
        def kind(*types: str):
            return F.count_if(F.col("event_type").isin(*types))

        day = F.day("logical_date")
        daily = self.events().groupBy(F.to_date("ts").alias("logical_date")).agg(
            F.count("*").alias("rows_received"), kind("signup").alias("rows_inserted"),
            kind("purchase", "view").alias("rows_updated"), kind("click").alias("rows_deleted"),
            kind("error").alias("_errors"), F.max("ts").alias("last_source_updated_at"),
        )
        status = F.when(day % 11 == 0, "failed").when(day % 13 == 0, "started").otherwise("completed")
        started = F.col("logical_date").cast("timestamp") + F.expr("make_dt_interval(0, 22, cast(rows_received % 60 as int))")
        done = F.col("status") != "started"
        rejected = F.when(day % 10 == 0, F.col("_errors")).otherwise(F.lit(0)).cast("bigint")
        return daily.withColumn("status", status).withColumn("started_at", started).select(
            batch_id(F.lit(specs.DEFAULT_PIPELINE), F.col("logical_date")).alias("batch_id"),
            F.lit(specs.DEFAULT_PIPELINE).alias("pipeline_name"), "logical_date",
            F.lit(MANY_FILES).alias("source_file"),
            F.sha2(F.col("logical_date").cast("string"), 256).alias("file_checksum"), "started_at",
            F.when(done, F.col("started_at") + F.expr("make_dt_interval(0, 0, 0, rows_received * 0.5)")).alias("completed_at"),
            "status", "rows_received", "rows_inserted", "rows_updated", "rows_deleted", rejected.alias("rows_rejected"),
            "last_source_updated_at",
            F.when(F.col("status") == "failed", F.concat(F.lit("Batch validation failed: "), F.col("_errors").cast("string"),
                                                         F.lit(" rows"))).alias("error_message"),
            F.sha2(F.concat(F.lit("attempt "), F.col("logical_date").cast("string")), 256).alias("attempt_id"),
        )

    def files(self) -> DataFrame:
        """Four files per batch, from the counts of four event types."""
        event, none = F.col("event_type"), F.lit(0).cast("bigint")
        entity = F.create_map(*[F.lit(x) for pair in FILE_EVENTS.items() for x in pair])[event]
        counted = self.events().where(event.isin(list(FILE_EVENTS))).groupBy(
            F.to_date("ts").alias("logical_date"), "event_type"
        ).agg(F.count("*").alias("rows_received"), F.max("ts").alias("last_source_updated_at"))
        named = counted.withColumn("source_file", F.concat(
            F.lit("data/incoming/"), F.col("logical_date").cast("string"), F.lit("/"), entity, F.lit(".csv")))
        batch = self.batches().select(
            "pipeline_name", "logical_date", "batch_id", "started_at", "completed_at",
            F.col("status").alias("_batch_status"), "error_message",
        )
        late_failure = (F.col("_batch_status") == "failed") & (event == "purchase")
        status = F.when(F.col("_batch_status") == "started", "started").when(late_failure, "failed").otherwise("completed")

        def counts(*types: str):
            return F.when(event.isin(*types), F.col("rows_received")).otherwise(none)

        return named.join(batch, "logical_date").select(
            "pipeline_name", "logical_date", "source_file", "batch_id",
            F.sha2("source_file", 256).alias("file_checksum"), "started_at", "completed_at", status.alias("status"),
            "rows_received", counts("signup").alias("rows_inserted"), counts("purchase", "view").alias("rows_updated"),
            counts("click").alias("rows_deleted"), none.alias("rows_rejected"), "last_source_updated_at",
            F.when(late_failure, F.col("error_message")).alias("error_message"),
        )

    def watermarks(self) -> DataFrame:
        batches = self.batches()
        newest = batches.where("status = 'completed'").orderBy(F.col("logical_date").desc()).limit(1)
        return watermark_candidates(newest, F.col("completed_at"))

    def runs(self) -> DataFrame:
        """One run per hour of events."""
        hour = F.date_trunc("hour", "ts")
        failed = F.count_if((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0)) > 0
        hourly = self.events().groupBy(hour.alias("execution_date")).agg(
            failed.alias("_failed"), F.count("*").alias("_n"), F.min("ts").alias("start_date"), F.max("ts").alias("_end")
        )
        state = F.when(F.col("_failed"), "failed").when(F.col("_n") % 11 == 0, "running").otherwise("success")
        return hourly.withColumn("state", state).select(
            F.lit(specs.DEFAULT_PIPELINE).alias("dag_id"), self.run_id(F.col("execution_date")).alias("run_id"),
            "execution_date", F.when(F.hour("execution_date") % 7 == 0, "manual").otherwise("scheduled").alias("run_type"),
            "state", F.col("execution_date").alias("queued_at"), "start_date",
            F.when(F.col("state") != "running", F.col("_end")).alias("end_date"),
        )

    @staticmethod
    def run_id(execution_date):
        return F.concat(F.lit("run__"), F.date_format(execution_date, "yyyy-MM-dd'T'HH"))

    def tasks(self) -> DataFrame:
        """Every event is a task attempt of its hour's run."""
        event, eid = F.col("event_type"), F.col("event_id")
        state = F.when((event == "error") & (eid % 5 == 0), "failed").when(
            (event == "click") & (eid % 7 == 0), "up_for_retry").otherwise("success")
        return self.events().select(
            F.lit(specs.DEFAULT_PIPELINE).alias("dag_id"), self.run_id(F.date_trunc("hour", "ts")).alias("run_id"),
            event.alias("task_id"), state.alias("state"), (F.col("user_id") % 3 + 1).cast("int").alias("try_number"),
            F.col("ts").alias("start_date"),
            F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("value") * 100).cast("bigint") * 10000).alias("end_date"),
            F.col("value").alias("duration"),
        )

    # --- the same with a second pipeline and job beside them --------------------
    # The others share dates and run ids, are newer, and fail or retry: a query that mixes them is wrong.
    def monitored_batches(self) -> DataFrame:
        mine, later = self.batches(), F.expr("interval 3 days")
        other = mine.withColumns({
            "pipeline_name": F.lit(OTHER), "batch_id": batch_id(F.lit(OTHER), F.col("logical_date")), "status": F.lit("failed"),
            "rows_received": F.col("rows_received") * 3, "rows_rejected": F.col("rows_received"),
        })
        completed = other.withColumns({"status": F.lit("completed"), "logical_date": F.to_date(F.col("logical_date") + later)})
        return mine.unionByName(other).unionByName(completed)

    def monitored_files(self) -> DataFrame:
        mine = self.files()
        return mine.unionByName(mine.withColumns({"pipeline_name": F.lit(OTHER), "logical_date": F.date_add("logical_date", 1)}))

    def monitored_watermarks(self) -> DataFrame:
        mine = self.watermarks()
        older = F.col("updated_at") - F.expr("interval 9 days")
        return mine.withColumns({"pipeline_name": F.lit(OTHER), "updated_at": older}).unionByName(mine)

    def monitored_runs(self) -> DataFrame:
        """The other job's runs share run ids; its newest one is queued and has not started."""
        mine, never = self.runs(), F.lit(None).cast("timestamp")
        other = mine.withColumns({"dag_id": F.lit(OTHER), "state": F.lit("failed")})
        queued = other.withColumns({
            "state": F.lit("queued"), "execution_date": F.col("execution_date") + F.expr("interval 30 days"), "start_date": never, "end_date": never,
        })
        return mine.unionByName(other).unionByName(queued)

    def monitored_tasks(self) -> DataFrame:
        mine = self.tasks()
        return mine.unionByName(mine.withColumns({"dag_id": F.lit(OTHER), "state": F.lit("failed"), "try_number": F.lit(9)}))


_open: dict[tuple[str, str], Warehouse] = {}
_open_lock = threading.Lock()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The application's warehouse over a directory of driver tables."""
    read_finely(use_utc(spark), SPLIT)
    # Shuffle files go when their statement ends, not when the driver happens to collect its garbage.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _open_lock:
        if key not in _open:
            _open[key] = Warehouse(spark, sf_dir.rstrip("/"))
        _open[key].spark = spark
        return _open[key]


