"""The registered queries. Each takes (spark, sf_dir) and returns one DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.catalog.warehouse import AS_OF, LANDING_WRITE, OTHER, Warehouse, warehouse
from ledgerloom.functions import keys as K
from ledgerloom.functions import parsing as P
from ledgerloom.functions import text as X
from ledgerloom.operators import versions as V
from ledgerloom.operators.joins import unsent
from ledgerloom.plans import control, datatests, monitor, profiling, quality, silver, validate
from ledgerloom.plans.pipeline import Pipeline
from ledgerloom.plans.quality import union_all
from ledgerloom.session import run_together
from ledgerloom.sources import bronze, feeds, landing, reports
from ledgerloom.sources.store import fresh_dir
from ledgerloom.specs import ENTITIES
from ledgerloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
UPDATE_DAY = "2026-09-02"
LAST_DAY = "2026-09-03"
DIRTY_DAY = feeds.DIRTY_DATE
c = F.col


def query(name: str):
    """Register a function of the warehouse under a query name."""
    def register(build: Callable[[Warehouse], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(warehouse(spark, sf_dir))
        return build
    return register


def simple(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    query(name)(build)


def day(text: str):
    return F.lit(text).cast("date")


def each(build: Callable[[str, specs.EntitySpec], DataFrame]) -> DataFrame:
    """The union of one frame per entity."""
    return union_all([build(name, spec) for name, spec in ENTITIES.items()])


def joined_row(spec: specs.EntitySpec):
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in spec.csv_columns]).alias("row_text")


# --- sources and sinks -----------------------------------------------------------

def landed(w: Warehouse) -> list[str]:
    """The directories of all delivered dates."""
    return [w.landing(date) for date in feeds.DATES]


@query("read_feed")
def read_feed(w: Warehouse) -> DataFrame:
    return each(lambda n, s: landing.read_entity_csv(w.spark, landed(w), s).select(
        F.lit(n).alias("entity"), landing.arrival_date(c("_file")).alias("logical_date"), joined_row(s)))


@query("header_check")
def header_check(w: Warehouse) -> DataFrame:
    """All delivered headers, and those of a further date: swapped names, a name too few, no header at all, and quoted names."""
    root, odd = fresh_dir(w.spark, "headers"), feeds.DIRTY_DATE
    for (name, spec), change in zip(ENTITIES.items(), (
        lambda n: [n[1], n[0], *n[2:]], lambda n: n[:-1], None, lambda n: [f'"{x}"' for x in n]), strict=True):
        rows = w.feed(name).where(c("logical_date") == day(LAST_DAY)).select(F.concat_ws(",", *spec.csv_columns).alias("value"))
        head = w.spark.createDataFrame([(",".join(change(list(spec.csv_columns))),)] if change else [], "value string")
        head.unionByName(rows).coalesce(1).write.text(f"{root}/{odd}/{name}.csv")
    report = landing.header_report(w.spark, [*landed(w), f"{root}/{odd}"])
    return report.groupBy("entity", landing.arrival_date(c("file")).alias("logical_date")).agg(F.bool_and("is_expected").alias("is_expected"))


@query("missing_files")
def missing_files(w: Warehouse) -> DataFrame:
    """Files each delivered date lacks, and the row count of those it has."""
    absent = F.array(*[F.lit(f"{d}/{f}") for d in feeds.DATES for f in landing.missing_files(w.spark, w.landing(d))])

    def one(name: str, spec) -> DataFrame:
        rows = landing.read_entity_csv(w.spark, landed(w), spec).groupBy(
            landing.arrival_date(c("_file")).alias("logical_date")).agg(F.count("*").alias("row_count"))
        file_name = F.lit(f"{name}.csv")
        path = F.concat(c("logical_date").cast("string"), F.lit("/"), file_name)
        return rows.select("logical_date", file_name.alias("file_name"),
                           F.array_contains(absent.cast("array<string>"), path).alias("is_missing"), "row_count")
    return each(one)


@query("feed_operation")
def feed_operation(w: Warehouse) -> DataFrame:
    batch = w.dirty_batch()
    return each(lambda n, s: batch[n].select(
        F.lit(n).alias("entity"), F.col(s.key).alias("raw_key"),
        X.normalise_operation(F.concat(F.lit(" \t"), F.lower("operation"), F.lit("\n"))).alias("operation"),
    ))


@query("row_number_lineage")
def row_number_lineage(w: Warehouse) -> DataFrame:
    return each(lambda n, s: landing.with_row_number(landing.read_entity_csv(w.spark, landed(w), s)).select(
        F.lit(n).alias("entity"), landing.arrival_date(c("_file")).alias("logical_date"), "source_row_number",
        K.source_record_hash(s).alias("source_record_hash")))


@query("file_checksum")
def file_checksum(w: Warehouse) -> DataFrame:
    return union_all([landing.file_checksums(w.spark, w.landing(d)).withColumn("logical_date", day(d)) for d in feeds.DATES])


@query("manifest_checksum")
def manifest_checksum(w: Warehouse) -> DataFrame:
    return landing.manifest_checksum(w.files(), ["logical_date"])


@query("record_hash")
def record_hash(w: Warehouse) -> DataFrame:
    return each(lambda n, s: w.feed(n).select(
        F.lit(n).alias("entity"), F.col(s.key).alias("raw_key"), "logical_date", "operation",
        K.source_record_hash(s).alias("source_record_hash")))


@query("append_new_versions")
def append_new_versions(w: Warehouse) -> DataFrame:
    """The update batch offered again together with the last one: only unseen hashes are new."""
    def one(name: str, spec) -> DataFrame:
        rows = w.bronze(name)
        stored = rows.where(F.col("logical_date") <= day(UPDATE_DAY))
        offered = rows.where(F.col("logical_date") >= day(UPDATE_DAY))
        return bronze.new_versions(stored, offered).groupBy("logical_date").agg(
            F.count("*").alias("rows_written"), *bronze.operation_counts()
        ).withColumn("entity", F.lit(name))
    return each(one)


@query("committed_rows")
def committed_rows(w: Warehouse) -> DataFrame:
    """Three attempts are written, two are published: only their rows are visible."""
    attempt = F.sha2(F.concat(F.lit("attempt "), F.col("batch_id")), 256)
    states = F.create_map(*[F.lit(x) for pair in zip(feeds.DATES, ("completed", "ingested", "started"), strict=True) for x in pair])
    batches = w.bronze("customers").select("logical_date", "batch_id").distinct().select(
        attempt.alias("attempt_id"), states[F.col("logical_date").cast("string")].alias("status"))
    return each(lambda n, s: bronze.committed_rows(
        w.bronze(n).withColumn("attempt_id", attempt), batches
    ).groupBy("logical_date", "operation").agg(F.count("*").alias("row_count")).withColumn("entity", F.lit(n)))


@query("evolve_schema")
def evolve_schema(w: Warehouse) -> DataFrame:
    """Older raw tables without the last two business columns gain them as NULL and keep all else."""
    def one(name: str, spec) -> DataFrame:
        lost = spec.columns[-2:]
        after = bronze.evolve_schema(w.bronze(name).drop(*lost), spec)
        held = F.concat_ws("|", *[F.coalesce(c(x), F.lit("~")) for x in spec.columns[:-2]]).alias("held")
        absent = F.lit(True)
        for x in lost:
            absent = absent & c(x).isNull()
        return after.select(F.lit(name).alias("entity"), held, absent.alias("gained_as_null"),
                            F.lit(sorted(after.columns) == sorted(spec.bronze_schema.names)).alias("whole"), "source_record_hash")
    return each(one)


#: The types of an older, typed raw table, by column; all others are text.
TYPED = {
    "customers": {"customer_id": "bigint", "avg_order_value": "decimal(12,2)", "promo_sensitivity": "float", "email_opt_in": "boolean",
                  "total_lifetime_orders": "int"},
    "promotions": {"promotion_id": "bigint", "discount_value": "double", "campaign_duration_days": "int", "budget_allocated": "decimal(14,2)",
                   "expected_response_rate": "float"},
    "orders": {"order_id": "bigint", "customer_id": "bigint", "order_value": "decimal(12,2)", "attributed_to_promo": "boolean"},
    "order_items": {"order_item_id": "bigint", "order_id": "bigint", "quantity": "int", "unit_price": "double", "attributed_to_promo": "boolean"},
}
#: What a text must look like to be converted here; a batch with any other fails.
FITS = {"bigint": P.SIGNED, "int": P.SIGNED, "decimal": P.DECIMAL, "float": P.DECIMAL, "double": P.DECIMAL}


@query("convert_types")
def convert_types(w: Warehouse) -> DataFrame:
    """The texts of all four feeds converted to the types of older, typed raw tables and to date and timestamp, shown as one row of texts.

    Every type keeps its own columns; feeds hold texts that fit no type, which are left out as empty.
    """
    def one(name: str, spec) -> DataFrame:
        cells = []
        for column in [*spec.columns, "business_date", "source_updated_at"]:
            kind = TYPED[name].get(column, {"business_date": "date", "source_updated_at": "timestamp"}.get(column, "string"))
            text, plain = X.strip_all(c(column)), kind.split("(")[0]
            if plain == "boolean":
                text = F.when(F.lower(text).isin(specs.TRUE_TOKENS + specs.FALSE_TOKENS), c(column)).otherwise(F.lit(""))
            elif plain in FITS:
                text = F.when(text.rlike(FITS[plain]), c(column)).otherwise(F.lit(""))
            else:
                text = c(column)
            made = P.to_stored_type(text, kind)
            if plain in ("float", "double"):
                made = made.cast("decimal(20,4)")
            elif plain == "timestamp":
                made = F.date_format(made, "yyyy-MM-dd HH:mm:ss")
            cells.append(F.coalesce(made.cast("string"), F.lit("~")))
        return w.feed(name).select(F.lit(name).alias("entity"), F.concat_ws("|", *cells).alias("converted"))
    return each(one)


@query("profile_sink")
def profile_sink(w: Warehouse) -> DataFrame:
    """The column profiles of a whole batch written as JSON and read back."""
    path = f"{fresh_dir(w.spark, 'profile')}/profile"
    reports.write_profile(each(lambda n, s: profiling.batch_profile(update_batch(w, n), s)), path)
    schema = "table_name string, column_name string, column_type string, null_count bigint, row_count bigint, duplicate_row_count bigint"
    return w.spark.read.schema(schema).json(path)


@query("issue_sink")
def issue_sink(w: Warehouse) -> DataFrame:
    """The issue summary written as one CSV file and read back."""
    path = f"{fresh_dir(w.spark, 'issues')}/issues"
    reports.write_summary(profiling.raw_issue_summary({n: update_batch(w, n) for n in ENTITIES}), path)
    schema = "issue_type string, table_name string, affected_row_count bigint, severity string"
    return w.spark.read.schema(schema).option("header", True).csv(path)


@query("reset_empty")
def reset_empty(w: Warehouse) -> DataFrame:
    """Rows readers see before and after a reset of the control tables."""

    pipeline = Pipeline(w.spark, fresh_dir(w.spark, "reset"))
    for name, spec in ENTITIES.items():
        attempt = F.concat(F.lit("a-"), F.col("batch_id")).alias("attempt_id")
        w.bronze(name).select("*", attempt).write.partitionBy("logical_date", "attempt_id").parquet(pipeline.bronze_path(name))
    batches = w.bronze("customers").select("batch_id", "logical_date").distinct().select(
        F.lit(specs.DEFAULT_PIPELINE).alias("pipeline_name"), "logical_date", F.lit("c").alias("file_checksum"),
        F.col("logical_date").cast("timestamp").alias("started_at"), F.concat(F.lit("a-"), "batch_id").alias("attempt_id"))
    empty = pipeline.control.batches()
    started = control.start_batches(empty, batches).withColumn("status", F.lit("completed"))
    pipeline.control.save(started, "ingestion_batches")

    def visible(stage: str) -> DataFrame:
        return each(lambda n, s: pipeline.bronze(n).agg(F.count("*").alias("visible_rows")).select(
            F.lit(stage).alias("stage"), F.lit(s.table).alias("table_name"), "visible_rows"))
    before = visible("before")
    path = f"{pipeline.store.root}/counts"
    before.write.parquet(path)
    pipeline.reset(confirm=True)
    return w.spark.read.schema(before.schema).parquet(path).unionByName(visible("after"))


@query("batch_manifest")
def batch_manifest(w: Warehouse) -> DataFrame:
    return each(lambda n, s: bronze.batch_manifest(w.feed(n), ["logical_date"]).withColumn("entity", F.lit(n)))


def update_batch(w: Warehouse, entity: str) -> DataFrame:
    return w.feed(entity).where(F.col("logical_date") == day(UPDATE_DAY))


# --- cleaning functions over the whole raw layer ------------------------------------

def over(w: Warehouse, entity: str, *columns) -> DataFrame:
    """Select over the newest raw versions of an entity, with the raw key."""
    spec = ENTITIES[entity]
    return w.current(entity).select(F.col(spec.key).alias("raw_key"), *columns)


def texts(w: Warehouse, entity: str) -> DataFrame:
    """Newest versions with cleaned texts, keeping the raw key."""
    spec = ENTITIES[entity]
    return w.current(entity).select(
        F.col(spec.key).alias("raw_key"), *[X.text_clean(F.col(c)).alias(c) for c in spec.columns])


def both(name: str, orders: dict, items: dict) -> None:
    """Register a row rule of orders and order items over both tables; the columns have the same names."""
    simple(name, lambda w: texts(w, "orders").select(F.lit("orders").alias("entity"), "raw_key", *[make().alias(n) for n, make in orders.items()]).unionByName(
        texts(w, "order_items").select(F.lit("order_items").alias("entity"), "raw_key", *[make().alias(n) for n, make in items.items()])))


def function_query(name: str, entity: str, **columns) -> None:
    """Register a query of column functions over an entity's cleaned texts."""
    simple(name, lambda w: texts(w, entity).select("raw_key", *[make().alias(n) for n, make in columns.items()]))


simple("fn_text_clean", lambda w: over(
    w, "customers", *[X.text_clean(c(n)).alias(n) for n in ENTITIES["customers"].columns]))
function_query("fn_token", "customers", segment_token=lambda: X.normalize_token(c("customer_segment")),
               channel_token=lambda: X.normalize_token(c("preferred_channel")),
               category_token=lambda: X.normalize_token(c("preferred_category")))
function_query("fn_parse_date", "customers", registration_date=lambda: P.parse_date(c("registration_date")),
               last_purchase_date=lambda: P.parse_date(c("last_purchase_date")))
function_query("fn_bool", "customers", email_opt_in=lambda: P.bool_value(c("email_opt_in")),
               sms_opt_in=lambda: P.bool_value(c("sms_opt_in")), push_opt_in=lambda: P.bool_value(c("push_opt_in")))
function_query("fn_bigint", "orders", order_id=lambda: P.digits_to_bigint(c("order_id")),
               customer_id=lambda: P.digits_to_bigint(c("customer_id")),
               promotion_id=lambda: P.digits_to_bigint(c("promotion_id")))
function_query("fn_int", "order_items", quantity=lambda: P.to_signed_int(c("quantity")))
function_query("fn_decimal", "promotions", discount_value=lambda: P.to_decimal(c("discount_value"), 12, 2),
               expected_response_rate=lambda: P.to_decimal(c("expected_response_rate"), 8, 4),
               budget_allocated=lambda: P.to_decimal(c("budget_allocated"), 14, 2))
function_query("fn_canonical", "promotions",
               promo_type=lambda: X.canonical_text(c("promo_type"), specs.PROMO_TYPE_MAP),
               target_segment=lambda: X.canonical_text(c("target_segment"), specs.TARGET_SEGMENT_MAP),
               campaign_channel=lambda: X.canonical_text(c("campaign_channel"), specs.CAMPAIGN_CHANNEL_MAP),
               campaign_objective=lambda: X.canonical_text(c("campaign_objective"), specs.CAMPAIGN_OBJECTIVE_MAP),
               target_category=lambda: X.canonical_text(c("target_category"), specs.CATEGORY_MAP))
function_query("fn_age_band", "customers", age_group=lambda: X.age_band(c("age_group")))
function_query("fn_status", "orders", order_status=lambda: X.order_status(c("order_status")))
function_query("fn_initcap", "customers", first_name=lambda: X.name_case(c("first_name")),
               last_name=lambda: X.name_case(c("last_name")), campaign=lambda: X.name_case(F.concat_ws("-", "first_name", "email")))
function_query("fn_lower", "customers", email=lambda: F.lower("email"))
function_query("fn_signature", "orders", row_signature=lambda: X.row_signature(
    *[c(n) for n in ENTITIES["orders"].columns if n != "order_id"]))
function_query("fn_date_key", "orders", order_date_key=lambda: K.date_key_or_unknown(P.parse_date(c("order_date"))))
simple("fn_utc_ts", lambda w: union_all([w.dirty_batch()[n].select(
    F.lit(n).alias("entity"), F.col(s.key).alias("raw_key"), "source_updated_at",
    P.parse_utc_timestamp(c("source_updated_at")).alias("instant"),
    P.lacks_offset(c("source_updated_at")).alias("lacks_offset")) for n, s in ENTITIES.items()]))
simple("fn_batch_id", lambda w: w.feed("orders").select(
    F.col("order_id").alias("raw_key"), "operation",
    K.batch_id(F.lit(specs.DEFAULT_PIPELINE), c("logical_date")).alias("batch_id")))


@query("business_date")
def business_date(w: Warehouse) -> DataFrame:
    """Items look their order up in the state at the end of the last date."""
    orders = V.first_per_key(
        w.current("orders").select(X.text_clean(c("order_id")).alias("order_id"), "order_date", *V.VERSION_ORDER),
        ["order_id"], V.newest_first()).select("order_id", "order_date")
    return each(lambda n, s: bronze.business_date(w.feed(n), s, orders).select(
        F.lit(n).alias("entity"), F.col(s.key).alias("raw_key"), "logical_date", "operation", "derived_business_date"))


# --- row rules --------------------------------------------------------------------------

def money(name: str):
    return P.to_decimal(c(name), 12, 2)


simple("valid_keys", lambda w: each(lambda n, s: texts(w, n).select(
    F.lit(n).alias("entity"), P.digits_to_bigint(c(s.key)).alias("key")).where("key is not null")))
function_query("clean_nonneg", "promotions", discount_value=lambda: silver.null_if_negative(money("discount_value")),
               campaign_duration_days=lambda: silver.null_if_negative(P.to_signed_int(c("campaign_duration_days"))),
               budget_allocated=lambda: silver.null_if_negative(P.to_decimal(c("budget_allocated"), 14, 2)))
function_query("clean_positive", "order_items",
               quantity=lambda: silver.null_if_not_positive(P.to_signed_int(c("quantity"))),
               unit_price=lambda: silver.null_if_negative(money("unit_price")))
function_query("clean_rate", "promotions", expected_response_rate=lambda: silver.null_if_outside(
    P.to_decimal(c("expected_response_rate"), 8, 4), 0, 1))
def attributed():
    return silver.default_false(P.bool_value(c("attributed_to_promo")))


def bad_amount(name: str):
    return silver.missing_or(money(name), money(name) < 0)


both("default_false", {"attributed_to_promo": attributed}, {"attributed_to_promo": attributed})
both("flags_numeric", {"invalid_quantity": lambda: F.lit(None).cast("boolean"), "invalid_amount": lambda: bad_amount("order_value")},
     {"invalid_quantity": lambda: silver.missing_or(P.to_signed_int(c("quantity")), P.to_signed_int(c("quantity")) <= 0),
      "invalid_amount": lambda: bad_amount("unit_price")})
simple("flags_missing", lambda w: texts(w, "orders").select(
    F.lit("orders").alias("entity"), "raw_key", c("promotion_id").isNull().alias("is_missing")).unionByName(
    texts(w, "customers").select(F.lit("customers").alias("entity"), "raw_key",
                                 c("last_purchase_date").isNull().alias("is_missing"))))
BARE = {"attributed_without_promotion": lambda: attributed() & c("promotion_id").isNull()}
both("flags_attribution", BARE, BARE)
function_query("flags_phone", "customers", invalid_phone=lambda: X.invalid_phone(c("phone_number")))
function_query("flags_date", "customers", invalid_registration_date=lambda: c("registration_date").isNotNull()
               & P.parse_date(c("registration_date")).isNull())
function_query("flags_range", "promotions",
               invalid_date_range=lambda: silver.bad_date_range(P.parse_date(c("start_date")), P.parse_date(c("end_date"))),
               is_valid_date_range=lambda: ~silver.bad_date_range(P.parse_date(c("start_date")), P.parse_date(c("end_date"))))


def _rate():
    return P.to_decimal(c("expected_response_rate"), 8, 4)


def _budget():
    return P.to_decimal(c("budget_allocated"), 14, 2)


function_query("flags_rate_budget", "promotions",
               invalid_rate=lambda: silver.missing_or(_rate(), (_rate() < 0) | (_rate() > 1)),
               invalid_budget=lambda: silver.missing_or(_budget(), _budget() < 0)
               | silver.missing_or(money("cost_per_acquisition"), money("cost_per_acquisition") < 0))
simple("line_total", lambda w: w.silver("order_items").select(
    "order_item_id", silver.line_total(c("quantity"), c("unit_price")).alias("line_total")))


def linked(w: Warehouse, entity: str) -> DataFrame:
    """Rows with their promotion reference, as text and number, and the promotion it finds."""
    rows = texts(w, entity).select(F.lit(entity).alias("entity"), "raw_key", c("promotion_id").alias("promotion_text"),
                                   P.digits_to_bigint(c("promotion_id")).alias("promotion_id"))
    return silver.with_known(rows, w.silver("promotions"), "promotion_id")


def linked_both(w: Warehouse) -> DataFrame:
    return linked(w, "orders").unionByName(linked(w, "order_items"))


simple("keep_if_referenced", lambda w: linked_both(w).select(
    "entity", "raw_key", silver.keep_if_referenced(c("promotion_id"), c("_known_promotion_id")).alias("promotion_id")))
simple("flags_reference", lambda w: linked_both(w).select(
    "entity", "raw_key", (c("promotion_text").isNotNull() & c("_known_promotion_id").isNull()).alias("dangling_promotion")))


# --- versions -------------------------------------------------------------------------------

simple("latest_version", lambda w: each(lambda n, s: V.latest_version(w.bronze(n), s).select(
    F.lit(n).alias("entity"), F.col(s.key).alias("raw_key"), "operation", "logical_date", "source_record_hash")))
simple("current_keys", lambda w: each(lambda n, s: V.current_keys(
    V.latest_version(w.bronze(n).select(*dict.fromkeys([s.key, "operation", *V.VERSION_ORDER])), s), s
).withColumn("entity", F.lit(n))))
simple("available_keys", lambda w: each(lambda n, s: V.available_keys(
    V.current_keys(w.current(n), s), w.dirty_batch()[n], s).withColumn("entity", F.lit(n))))
simple("state_as_of", lambda w: each(lambda n, s: V.state_as_of(w.bronze(n), s, UPDATE_DAY).select(
    F.lit(n).alias("entity"), F.col(s.key).alias("raw_key"), "operation", "source_record_hash")))
simple("late_rows", lambda w: each(lambda n, s: V.late_rows(w.bronze(n)).groupBy("logical_date", "business_date").agg(
    F.count("*").alias("row_count")).withColumn("entity", F.lit(n))))
simple("status_transitions", lambda w: V.status_transitions(
    w.bronze("orders"), ENTITIES["orders"], f"{fresh_dir(w.spark, 'transitions')}/chunks"))


@query("next_ids")
def next_ids(w: Warehouse) -> DataFrame:
    """Rows first inserted on the last date, numbered after the highest key known the day before."""
    spec = ENTITIES["orders"]
    before = V.state_as_of(w.bronze("orders"), spec, UPDATE_DAY)
    known = before.select(P.digits_to_bigint(X.text_clean(c("order_id"))).alias("key"))
    new = w.bronze("orders").where((c("logical_date") == day(LAST_DAY)) & (c("operation") == "I"))
    rows = new.select(P.digits_to_bigint(c("order_id")).alias("source_key"))
    return V.assign_next_ids(rows, known, "source_key", block=10_000)


# --- clean layer and star schema --------------------------------------------------------------

for _layer, _table, _name in [
    ("silver", "customers", "silver_customers"), ("silver", "promotions", "silver_promotions"),
    ("silver", "orders", "silver_orders"), ("silver", "order_items", "silver_order_items"),
    ("silver", "data_quality_report", "data_quality_report"),
    ("gold", "dim_customer", "dim_customer"), ("gold", "dim_promotion", "dim_promotion"),
    ("gold", "dim_product", "dim_product"), ("gold", "dim_date", "dim_date"),
    ("gold", "fact_orders", "fact_orders"), ("gold", "fact_order_items", "fact_order_items"),
]:
    simple(_name, lambda w, layer=_layer, table=_table: w.build(layer, table))


# --- quality -----------------------------------------------------------------------------------

def report(w: Warehouse) -> DataFrame:
    return w.silver("data_quality_report")


simple("dq_duplicate_keys", lambda w: each(lambda n, s: quality.duplicate_keys(w.current(n), s).select(
    c("n_records").alias("duplicates"), F.lit(n).alias("entity"))))


@query("orphan_refs")
def orphan_refs(w: Warehouse) -> DataFrame:
    cases = [("orders", "customer_id", "customers", True), ("orders", "promotion_id", "promotions", False),
             ("order_items", "order_id", "orders", True)]
    return union_all([
        quality.unmatched_references(w.current(entity), column, w.silver(parent), blank).select(
            F.lit(entity).alias("entity"), F.lit(column).alias("column_name"), "reference", "n_records")
        for entity, column, parent, blank in cases
    ])


simple("attribution_mismatch", lambda w: quality.attribution_mismatch(w.silver("order_items"), w.silver("orders")))
simple("dq_by_severity", lambda w: quality.by_severity(report(w)))
simple("dq_high_total", lambda w: quality.high_total(report(w)))
simple("dq_ranked", lambda w: quality.ranked_issues(report(w)))


# --- data tests: declared tables, and copies broken by arithmetic on the key ---------------------

@query("test_unique")
def test_unique(w: Warehouse) -> DataFrame:
    """Keys repeated in the raw layer, and in clean tables with some rows doubled."""
    raw = union_all([datatests.unique(texts(w, n).select(c(s.key).alias("value")), "value").withColumn(
        "table_name", F.lit(s.table)) for n, s in ENTITIES.items()])
    doubled = union_all([
        datatests.unique(df.unionByName(df.where(c(k) % 97 == 0)).select(c(k).cast("string").alias("value")), "value")
        .withColumn("table_name", F.lit(t))
        for t, k, df in [("customers", "customer_id", w.silver("customers")), ("orders", "order_id", w.silver("orders")),
                         ("fact_order_items", "order_item_id", w.gold("fact_order_items"))]])
    return raw.unionByName(doubled)


@query("test_not_null")
def test_not_null(w: Warehouse) -> DataFrame:
    """Rows whose reference was blanked for some keys."""
    orders = w.silver("orders").withColumn("customer_id", F.when(c("order_id") % 89 != 0, c("customer_id")))
    items = w.plan("silver", "order_items").withColumn("order_id", F.when(c("order_item_id") % 89 != 0, c("order_id")))
    return datatests.not_null(orders, "customer_id").select(
        F.lit("orders").alias("table_name"), c("order_id").alias("key")).unionByName(
        datatests.not_null(items, "order_id").select(F.lit("order_items").alias("table_name"), c("order_item_id").alias("key")))


@query("test_accepted_values")
def test_accepted_values(w: Warehouse) -> DataFrame:
    """Labels as they stand before cleaning, and clean labels with some replaced."""
    raw = datatests.accepted_values(w.current("orders"), "order_channel", datatests.ALL_CHANNELS)
    broken = w.silver("orders").withColumn("order_channel", F.when(c("order_id") % 83 == 0, F.lit("Fax")).otherwise(c("order_channel")))
    bad = datatests.accepted_values(broken, "order_channel", datatests.ALL_CHANNELS)
    return raw.withColumn("table_name", F.lit("orders_raw")).unionByName(bad.withColumn("table_name", F.lit("orders")))


@query("test_relationships")
def test_relationships(w: Warehouse) -> DataFrame:
    """References shifted out of range for some rows."""
    orders = w.silver("orders").withColumn(
        "customer_id", F.when(c("order_id") % 79 == 0, c("customer_id") + 1_000_000_000_000).otherwise(c("customer_id")))
    items = w.gold("fact_order_items").withColumn(
        "product_key", F.when(c("order_item_id") % 79 == 0, -c("order_id") - 2).otherwise(c("product_key")))
    first = datatests.relationships(orders, "customer_id", w.silver("customers"), "customer_id")
    second = datatests.relationships(items, "product_key", w.gold("dim_product"), "product_key")
    return first.select(F.lit("orders").alias("table_name"), c("customer_id").alias("value"), "n_records").unionByName(
        second.select(F.lit("fact_order_items").alias("table_name"), c("product_key").alias("value"), "n_records"))


@query("test_no_negative_revenue")
def test_no_negative_revenue(w: Warehouse) -> DataFrame:
    """Amounts negated for some keys."""
    orders = w.gold("fact_orders").withColumn(
        "order_value", F.when(c("order_id") % 73 == 0, -c("order_value")).otherwise(c("order_value")))
    items = w.gold("fact_order_items").withColumn(
        "line_total", F.when(c("order_item_id") % 73 == 0, -c("line_total")).otherwise(c("line_total")))
    return datatests.no_negative_revenue(orders, items)


simple("data_test_suite", lambda w: datatests.run_suite(w.spark, w.read))


# --- batch validation ---------------------------------------------------------------------------

def known_keys(w: Warehouse) -> dict[str, DataFrame]:
    return {n: V.current_keys(w.newest(n), s) for n, s in ENTITIES.items()}


simple("batch_row_errors", lambda w: each(lambda n, s: validate.row_errors(w.dirty_batch()[n], s, day(DIRTY_DAY))))
simple("batch_dup_keys", lambda w: each(lambda n, s: validate.duplicate_keys(w.dirty_batch()[n], s)))
simple("batch_dup_versions", lambda w: each(lambda n, s: validate.duplicate_versions(w.dirty_batch()[n], s)))
simple("batch_missing_keys", lambda w: each(lambda n, s: validate.missing_keys(w.dirty_batch()[n], known_keys(w)[n], s)))
simple("batch_ref_errors", lambda w: union_all([
    frame for e in ENTITIES for frame in validate.reference_errors(w.dirty_batch(), w.dirty_available(), e)]))
simple("batch_errors", lambda w: validate.first_errors(
    validate.batch_errors(w.dirty_batch(), known_keys(w), w.dirty_available(), day(DIRTY_DAY))))
simple("batch_metrics", lambda w: each(lambda n, s: bronze.batch_metrics(w.bronze(n), ["batch_id", "logical_date"]).withColumn(
    "entity", F.lit(n))))


# --- profile of the update batch ------------------------------------------------------------------

simple("profile_rows", lambda w: each(lambda n, s: profiling.row_counts(update_batch(w, n), n)))
simple("profile_nulls", lambda w: each(lambda n, s: profiling.null_counts(update_batch(w, n), n, s.csv_columns)))


@query("profile_duplicates")
def profile_duplicates(w: Warehouse) -> DataFrame:
    """Identical rows over all columns, in batches where rows with keys ending in 7 came twice and in 77 thrice."""
    def doubled(name: str, spec) -> DataFrame:
        rows = update_batch(w, name)
        again = [rows.where(F.col(spec.key).endswith(end)) for end in ("7", "77")]
        return profiling.duplicate_rows(union_all([rows, *again]), name, spec.csv_columns)
    return each(doubled)


simple("profile_types", lambda w: each(lambda n, s: profiling.inferred_types(update_batch(w, n), n, s.csv_columns)))
simple("profile_sample", lambda w: each(lambda n, s: profiling.sample_rows(update_batch(w, n), s.csv_columns).select(
    F.lit(n).alias("table_name"), "source_row_number", joined_row(s))))
simple("raw_issue_summary", lambda w: profiling.raw_issue_summary({n: update_batch(w, n) for n in ENTITIES}))


# --- control state ----------------------------------------------------------------------------------

def delivered(w: Warehouse) -> DataFrame:
    """Checksums offered again: as recorded, but with one file changed on every fifth day."""
    changed = (F.day("logical_date") % 5 == 0) & c("source_file").endswith("orders.csv")
    checksum = F.when(changed, F.sha2(F.concat("file_checksum", F.lit("!")), 256)).otherwise(c("file_checksum"))
    return w.files().select("pipeline_name", "logical_date", "source_file", checksum.alias("file_checksum"))


@query("control_upsert")
def control_upsert(w: Warehouse) -> DataFrame:
    """Every date is started again a day late, then the started ones are published."""
    batches = w.batches()
    starting = batches.select("pipeline_name", "logical_date", F.sha2("file_checksum", 256).alias("file_checksum"),
                              (c("started_at") + F.expr("interval 1 day")).alias("started_at"),
                              F.sha2("attempt_id", 256).alias("attempt_id"))
    started = control.start_batches(batches, starting)
    totals = w.files().groupBy("batch_id").agg(
        *[F.sum(x).alias(x) for x in control.COUNTS[:-1]], F.max("last_source_updated_at").alias("last_source_updated_at"),
        F.max("started_at").alias("completed_at"))
    open_totals = totals.join(started.where("status = 'started'").select("batch_id"), "batch_id", "left_semi")
    published = control.publish_batches(started, open_totals)
    return published.withColumn("has_error", c("error_message").isNotNull()).drop("error_message")


simple("files_match", lambda w: control.files_match(w.files(), delivered(w)))
simple("rerun_noop", lambda w: control.rerun_decisions(w.batches(), w.files(), delivered(w)))


@query("control_files")
def control_files(w: Warehouse) -> DataFrame:
    """Files of every third date are loaded again with one more row each."""
    again = w.files().where(F.day("logical_date") % 3 == 0)
    loaded = again.withColumn("rows_received", c("rows_received") + 1).withColumn(
        "file_checksum", F.sha2(F.concat("file_checksum", F.lit("2")), 256))
    return control.upsert_files(w.files(), loaded)


@query("control_failed")
def control_failed(w: Warehouse) -> DataFrame:
    """Every batch that is not completed fails with an over-long message."""
    failures = w.batches().where("status <> 'completed'").select(
        "batch_id", F.repeat(F.concat("batch_id", F.lit(" broke; ")), 300).alias("message"),
        (c("started_at") + F.expr("interval 5 minutes")).alias("failed_at"))
    return control.fail_batches(w.batches(), failures)


def ingested(w: Warehouse) -> DataFrame:
    """Batches with the completed ones of every fourth date set back to ingested."""
    back = (F.day("logical_date") % 4 == 0) & (c("status") == "completed")
    return w.batches().withColumn("status", F.when(back, F.lit("ingested")).otherwise(c("status")))


simple("should_rebuild", lambda w: control.rebuild_decisions(ingested(w)))


@query("completion_check")
def completion_check(w: Warehouse) -> DataFrame:
    """One date's files are incomplete."""
    files = w.files().where(~((F.day("logical_date") == 8) & c("source_file").endswith("promotions.csv")))
    return control.completion_checks(ingested(w), files)


@query("control_completed")
def control_completed(w: Warehouse) -> DataFrame:
    return control.complete_batches(ingested(w), w.files(), F.lit(AS_OF)).select("batch_id", "status", "completed_at")


@query("watermark_advance")
def watermark_advance(w: Warehouse) -> DataFrame:
    """Forward from an older mark, refused from a newer one, replaced on a tie, set from nothing."""
    batches = w.batches()
    offered = control.watermark_candidates(batches, F.lit(AS_OF))
    top = offered.orderBy(c("last_logical_date").desc()).limit(1)
    shifts = F.explode(F.array(*[
        F.struct(F.lit(n).alias("pipeline_name"), F.lit(s).alias("shift")) for n, s in
        (("older", -3), ("newer", 3), ("tied", 0), ("unset", None))])).alias("p")
    named = top.drop("pipeline_name").select("*", shifts).select("*", "p.*").drop("p")
    old = named.select("pipeline_name", F.date_add("last_logical_date", c("shift")).alias("last_logical_date"),
                       F.lit("before").alias("batch_id"), "last_source_updated_at", "updated_at")
    return control.advance_watermark(old, named.drop("shift"))


@query("file_reuse")
def file_reuse(w: Warehouse) -> DataFrame:
    """The same bytes delivered under a second pipeline name are refused."""
    other = w.files().where(F.day("logical_date") % 6 == 0).withColumn("pipeline_name", F.lit("retail_copy"))
    return control.reused_files(w.files(), other)


@query("control_constraints")
def control_constraints(w: Warehouse) -> DataFrame:
    """Copies of the control tables with some rows doubled or mislabelled."""
    batches, files = w.batches(), w.files()
    lost = F.when(F.day("logical_date") == 9, F.lit("lost")).otherwise(c("status"))
    doubled = batches.withColumn("status", lost).unionByName(batches.where(F.day("logical_date") == 7))
    moved = files.where(F.day("logical_date") == 5).withColumn("pipeline_name", F.lit("retail_copy"))
    return control.constraint_violations(doubled, files.withColumn("status", lost).unionByName(moved))


# --- monitoring ---------------------------------------------------------------------------------------

# Every fixture holds a second pipeline and job; spans are a dashboard's time range.
SPAN = ("2024-01-08 00:00:00", "2024-01-21 12:00:00")

simple("batches_stale", lambda w: monitor.batches_stale(w.monitored_batches(), AS_OF))
simple("latest_completed", lambda w: monitor.latest_completed(w.monitored_batches()))
simple("batches_unfinished", lambda w: monitor.batches_unfinished(w.monitored_batches()))
simple("volume_vs_trailing", lambda w: monitor.volume_vs_trailing(w.monitored_batches()))
simple("latest_files", lambda w: monitor.latest_files(w.monitored_files()))
simple("watermark_age", lambda w: monitor.watermark_age(w.monitored_watermarks(), AS_OF))
simple("watermark_state", lambda w: monitor.watermark_state(w.monitored_watermarks(), AS_OF))
simple("latest_run", lambda w: monitor.latest_run_state(w.monitored_runs()))
simple("latest_run_duration", lambda w: monitor.latest_run_duration(w.monitored_runs(), AS_OF))
simple("queued_run_duration", lambda w: monitor.latest_run_duration(w.monitored_runs(), AS_OF, OTHER))
simple("run_success_rate", lambda w: monitor.run_success_rate(w.monitored_runs(), AS_OF))
simple("latest_run_tasks", lambda w: monitor.latest_run_tasks(w.monitored_tasks(), w.monitored_runs()))
simple("task_runs", lambda w: monitor.task_runs(w.monitored_tasks(), w.monitored_runs()))
simple("run_counts_in_range", lambda w: monitor.run_daily_counts(w.monitored_runs(), SPAN))
for _suffix, _span in (("", None), ("_in_range", SPAN)):
    simple(f"batch_history{_suffix}", lambda w, span=_span: monitor.batch_history(w.monitored_batches(), AS_OF, span))
    simple(f"batch_row_metrics{_suffix}", lambda w, span=_span: monitor.batch_row_metrics(w.monitored_batches(), span))
    simple(f"run_history{_suffix}", lambda w, span=_span: monitor.run_history(w.monitored_runs(), AS_OF, span))
    simple(f"run_durations{_suffix}", lambda w, span=_span: monitor.run_durations(w.monitored_runs(), AS_OF, span))
    simple(f"run_failures{_suffix}", lambda w, span=_span: monitor.run_failures(w.monitored_runs(), span))
    simple(f"task_durations{_suffix}", lambda w, span=_span: monitor.task_durations(w.monitored_tasks(), w.monitored_runs(), span))
    simple(f"task_failures{_suffix}", lambda w, span=_span: monitor.task_failures(w.monitored_tasks(), w.monitored_runs(), span))
    simple(f"task_retries{_suffix}", lambda w, span=_span: monitor.task_retries(w.monitored_tasks(), w.monitored_runs(), span))
simple("run_daily_counts", lambda w: monitor.run_daily_counts(w.monitored_runs()))
simple("alert_latest_run_failed", lambda w: monitor.alert_latest_run_failed(w.monitored_runs()))
simple("alert_watermark_stale", lambda w: monitor.alert_watermark_stale(w.monitored_watermarks(), AS_OF))
simple("alert_batch_stuck", lambda w: monitor.alert_batch_stuck(w.monitored_batches(), AS_OF))
simple("alert_high_severity", lambda w: monitor.alert_high_severity(report(w)))
simple("alert_rejected_rows", lambda w: monitor.alert_rejected_rows(w.monitored_batches()))


# --- streaming ------------------------------------------------------------------------------------------

def acceptable(w: Warehouse, day_text: str, root: str) -> dict[str, DataFrame]:
    """Inserts of one date that break no rule: unique keys, and references to each other.

    Stored below ``root``, as every later date is made from them and items need all the others.
    """
    def inserts(name: str) -> DataFrame:
        spec, key = ENTITIES[name], X.strip_all(c(ENTITIES[name].key))
        rows = w.feed(name).where((c("logical_date") == day(day_text)) & (c("operation") == "I") & (key != "")).withColumn("_key", key)
        on_date = P.parse_utc_timestamp(c("source_updated_at")).cast("date") == day(day_text)
        rows = rows.where(on_date & (P.parse_whole_date(c("business_date")) <= day(day_text)))
        once = rows.groupBy("_key").count().where("count = 1")
        return rows.join(unsent(once), "_key", "left_semi").select(*spec.csv_columns, "source_row_number")

    def known(rows: DataFrame, column: str, parent: str, blank_allowed: bool = False) -> DataFrame:
        keys = kept[parent].select(F.col(ENTITIES[parent].key).alias(column)).distinct().withColumn("_known", F.lit(True))
        fits = F.coalesce("_known", F.lit(False)) | (F.lit(blank_allowed) & (c(column) == ""))
        return rows.join(unsent(keys), column, "left").where(fits).drop("_known")

    def store(name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{root}/{name}")
        return w.spark.read.schema(rows.schema).parquet(f"{root}/{name}")

    first = ("customers", "promotions")
    kept = dict(zip(first, run_together([partial(store, name, inserts(name)) for name in first]), strict=True))
    kept["orders"] = store("orders", known(known(inserts("orders"), "customer_id", "customers"), "promotion_id", "promotions", True))
    items = known(known(inserts("order_items"), "order_id", "orders"), "promotion_id", "promotions", True)
    kept["order_items"] = store("order_items", items.where("product_id <> ''"))
    return kept


QUOTED_BREAK = ("customers", "last_name", "customer_id")


def share(key: str):
    """A number below 20 from the digest of a key."""
    return F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 4), 16, 10).cast("int") % 20


def streamed_dates(w: Warehouse, root: str) -> dict[str, dict[str, DataFrame]]:
    """What three dates deliver: sound inserts, one field in ten of which spans lines; updates and deletes of some of
    them; and changes of which some break a row rule, beside updates that do not."""
    first, second, third = feeds.DATES
    kept = acceptable(w, first, root)
    table, column, key = QUOTED_BREAK
    broken = F.when(share(key) % 10 == 0, F.concat(c(column), F.lit("\n"), c(column))).otherwise(c(column))
    kept[table] = kept[table].withColumn(column, broken)

    def later(name: str, date: str, operation, business=None) -> DataFrame:
        spec = ENTITIES[name]
        moved = F.regexp_replace("source_updated_at", f"^{first}", date)
        changed = kept[name].withColumn("operation", operation).withColumn("source_updated_at", moved).withColumn("business_date", business if business is not None else F.lit(date))
        return changed.where("operation <> ''").select(*spec.csv_columns, "source_row_number")

    # Only items are deleted, as nothing refers to them.
    updates = {n: later(n, second, F.when(share(s.key) == 1, "U").when((share(s.key) == 2) & F.lit(n == "order_items"), "D").otherwise("")) for n, s in ENTITIES.items()}
    wrong = {n: later(n, third, F.when(share(s.key) == 3, "U").when(share(s.key) == 4, "Q").otherwise(""),
                      F.when(share(s.key) == 3, F.lit(third)).otherwise(F.lit("2026-13-01"))) for n, s in ENTITIES.items()}
    return {first: kept, second: updates, third: wrong}


@query("stream_ingest")
def stream_ingest(w: Warehouse) -> DataFrame:
    """Published raw rows after streaming five dates: inserts with line breaks in fields, updates and deletes, changes that
    break row rules (refused as a whole), the first date's rows again under a later one (refused, as their times
    lie on the first), and a date that lacks files. Running the stream again adds nothing."""
    root = fresh_dir(w.spark, "stream")
    delivered = streamed_dates(w, f"{root}/sound")
    delivered[feeds.DIRTY_DATE] = delivered[feeds.DATES[0]]

    def deliver(date: str, name: str) -> None:
        # Rows come in any order: nothing that is read back depends on their places.
        rows = delivered[date][name].select(*ENTITIES[name].csv_columns)
        rows.write.options(**LANDING_WRITE).csv(f"{root}/incoming/{date}/{name}.csv")

    run_together([partial(deliver, date, name) for date in delivered for name in ENTITIES])
    w.feed("customers").limit(0).select(*ENTITIES["customers"].csv_columns).coalesce(1).write.options(**LANDING_WRITE).csv(f"{root}/incoming/2026-09-05/customers.csv")
    pipeline = Pipeline(w.spark, f"{root}/warehouse")
    for _ in range(2):
        # The second run finds every file seen.
        ingest.ingest_all(pipeline, f"{root}/incoming", f"{root}/checkpoint")
    return each(lambda n, s: pipeline.bronze(n).select(
        F.lit(n).alias("entity"), F.col(s.key).alias("raw_key"), "logical_date", "operation", "source_updated_at",
        F.length(joined_row_of(s)).alias("row_length"), "source_record_hash"))


def joined_row_of(spec: specs.EntitySpec):
    return F.concat_ws("|", *[F.coalesce(F.col(x), F.lit("")) for x in spec.columns])
