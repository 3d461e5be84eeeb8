"""What the warehouse of the registered queries writes and moves."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog.queries import QUERIES
from ledgerloom.catalog.warehouse import SPLIT, Warehouse, warehouse
from ledgerloom.operators.versions import latest_version
from ledgerloom.sources import feeds
from ledgerloom.sources.store import shared_dir
from ledgerloom.specs import ENTITIES


@pytest.fixture
def tables(spark, tmp_path):
    """A few rows of each source table, among them a key that occurs twice and one without a value."""
    keys = [*range(1, 60), 3, None]
    rows = {
        "customer": ("c_custkey bigint, c_name string, c_acctbal double", [(k, f"Customer {n}", 10.0 * n) for n, k in enumerate(keys)]),
        "part": ("p_partkey bigint, p_name string, p_size int, p_retailprice double", [(k, f"part {n}", n % 50, 1.5 * n) for n, k in enumerate(keys)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate string, o_totalprice double", [(k, n % 59 + 1, "2024-03-01", 2.5 * n) for n, k in enumerate(keys)]),
        "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_extendedprice double",
                     [(k, line, n % 59 + 1, 1.0 * line, 7.25 * n) for n, k in enumerate(keys) for line in (1, 2)]),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def stored(w: Warehouse) -> set[str]:
    return {f"{layer}/{name}" for layer in w.store.files.names(w.store.root) for name in w.store.files.names(f"{w.store.root}/{layer}")}


def test_a_query_writes_only_what_it_reads_again(spark, tables):
    w = warehouse(spark, tables)
    QUERIES["fn_lower"](spark, tables).count()
    QUERIES["flags_numeric"](spark, tables).count()
    assert stored(w) == set()
    QUERIES["dim_customer"](spark, tables).count()
    assert stored(w) == {"silver/customers"}
    QUERIES["dim_date"](spark, tables).count()
    assert stored(w) == {"silver/customers", "silver/promotions", "silver/orders"}


def test_columns_that_a_query_does_not_read_are_not_shuffled(spark, tables):
    plan = QUERIES["fn_lower"](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "customer_id" in plan and "unhex" in plan
    # Raw rows have these columns; the query and the order of versions do not.
    assert not [c for c in ("source_file", "file_checksum", "source_row_number") if c in plan]


def test_newest_versions_equal_those_of_stored_raw_rows(spark, tables):
    w = Warehouse(spark, tables)
    for name, spec in ENTITIES.items():
        raw = feeds.as_bronze(feeds.csv_feed(spark, tables, name), name)
        raw.write.parquet(f"{tables}/raw-{name}")
        # A key that ties in all but its hash keeps the row of the greatest one.
        want = latest_version(spark.read.schema(raw.schema).parquet(f"{tables}/raw-{name}"), spec)
        got = w.current(name).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0
        before = sorted(map(str, want.select(*spec.columns).collect()))
        w.write("current", [name])
        assert sorted(map(str, w.read("current", name).collect())) == before


def test_silver_moves_the_beginnings_of_hashes(spark, tables):
    w = Warehouse(spark, tables)
    for name in ENTITIES:
        plan = w.newest(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "substring(unhex(" in plan
        # Ties in all but the hash still go to the greatest one.
        want = w.current(name).select(*ENTITIES[name].columns)
        assert sorted(map(str, w.newest(name).collect())) == sorted(map(str, want.collect()))


def test_a_query_of_two_columns_does_not_store_the_items(spark, tmp_path):
    tables = f"{tmp_path}/small"
    shutil.copytree("/root/testdata/sf0.001", tables)
    w = warehouse(spark, tables)
    QUERIES["test_not_null"](spark, tables).count()
    assert "silver/order_items" not in stored(w)
    before = sorted(map(str, QUERIES["test_not_null"](spark, tables).collect()))
    w.write("silver", ["order_items"])
    assert sorted(map(str, QUERIES["test_not_null"](spark, tables).collect())) == before and before


def test_clean_items_are_stored_in_steps(spark, tables):
    """The newest versions, the lookup of orders and that of promotions are statements of their own; no step stays."""
    w = Warehouse(spark, tables)
    want = sorted(map(str, w.build("silver", "order_items").collect()))
    write, written = w.store.write, {}

    def kept(df, layer, name):
        written[name] = df
        write(df, layer, name)

    w.store.write = kept
    w.write("silver", ["order_items"])
    plan = written["order_items"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "unhex" not in plan
    assert sorted(map(str, w.read("silver", "order_items").collect())) == want and want
    assert not [n for n in w.store.files.names(f"{shared_dir(spark)}/ledgerloom") if n.startswith("items-")]


def test_shuffle_files_go_with_their_statement(spark, tables):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "false")
        warehouse(spark, tables)
        assert spark.conf.get(name) == "true"
    finally:
        spark.conf.set(name, before)


def test_large_splits_are_cut_and_small_ones_kept(spark, tables):
    name = "spark.sql.files.maxPartitionBytes"
    try:
        spark.conf.set(name, "128m")
        warehouse(spark, tables)
        assert spark.conf.get(name) == SPLIT
        spark.conf.set(name, "1m")
        warehouse(spark, tables)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)


def test_the_report_reads_stored_versions(spark, tables):
    w = warehouse(spark, tables)
    report = w.silver("data_quality_report")
    assert {f"current/{e}" for e in ENTITIES} <= stored(w)
    assert report.agg(F.sum("affected_row_count")).first()[0] > 0


def test_streamed_dates_are_made_from_stored_inserts(spark, tables, tmp_path):
    """Joins and counts that choose sound inserts run once, not again for every date and entity."""
    from ledgerloom.catalog.queries import streamed_dates

    dates = streamed_dates(warehouse(spark, tables), f"{tmp_path}/sound")
    for delivered in dates.values():
        for rows in delivered.values():
            plan = rows._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan and "Aggregate" not in plan and "Relation" in plan
    first = dates[feeds.DATES[0]]
    orders = {r.order_id for r in first["orders"].collect()}
    assert orders and {r.order_id for r in first["order_items"].collect()} <= orders
