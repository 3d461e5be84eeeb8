from __future__ import annotations

import csv
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.versions import latest_version
from ledgerloom.plans.control import ControlError
from ledgerloom.plans.pipeline import DataTestsFailed, Pipeline
from ledgerloom.plans.validate import BatchRejected
from ledgerloom.specs import ENTITIES

DAY1, DAY2, DAY3 = dt.date(2026, 9, 1), dt.date(2026, 9, 2), dt.date(2026, 9, 3)
NOW = dt.datetime(2026, 9, 3, 12)
DEFAULTS = {
    "customers": {"first_name": "ann", "customer_segment": "high value", "registration_date": "2024-01-02 08:00:00"},
    "promotions": {"campaign_name": "Sale", "promo_type": "bogo", "start_date": "2026-08-01", "end_date": "2026-09-01",
                   "discount_value": "5", "expected_response_rate": "0.5", "budget_allocated": "10", "cost_per_acquisition": "1"},
    "orders": {"order_date": "2026-08-30 10:00:00", "order_status": "paid", "order_value": "10.00"},
    "order_items": {"product_id": "7", "product_category": "home", "quantity": "2", "unit_price": "5.00"},
}


def row(entity, key, day, op="I", **values):
    spec = ENTITIES[entity]
    base = dict.fromkeys(spec.csv_columns, "") | DEFAULTS[entity] | {
        spec.key: key, "operation": op, "source_updated_at": f"{day}T00:00:01Z", "business_date": str(day)}
    return base | values


def deliver(root, day, rows, header=None):
    target = root / str(day)
    target.mkdir(parents=True, exist_ok=True)
    for entity, spec in ENTITIES.items():
        with (target / f"{entity}.csv").open("w", newline="", encoding="utf-8") as handle:
            writer = csv.writer(handle, lineterminator="\n")
            writer.writerow(spec.csv_columns)
            writer.writerows([[r[c] for c in spec.csv_columns] for r in rows.get(entity, [])])
    return str(target)


def first_day():
    return {
        "customers": [row("customers", "1", DAY1), row("customers", "2", DAY1)],
        "promotions": [row("promotions", "3", DAY1)],
        "orders": [row("orders", "10", DAY1, customer_id="1", promotion_id="3", attributed_to_promo="yes"),
                   row("orders", "11", DAY1, customer_id="2", order_status="pending", order_date="")],
        "order_items": [row("order_items", "100", DAY1, order_id="10"), row("order_items", "101", DAY1, order_id="11", unit_price="0.00")],
    }


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A pipeline with its first date completed."""
    root = tmp_path_factory.mktemp("pipeline")
    pipeline = Pipeline(spark, str(root / "warehouse"))
    pipeline.run_date(DAY1, deliver(root / "incoming", DAY1, first_day()), NOW)
    return pipeline, root / "incoming"


def status(pipeline, day):
    found = pipeline.control.batch(day)
    return found and found["status"]


def test_first_date_builds_the_star(loaded):
    pipeline, _ = loaded
    assert status(pipeline, DAY1) == "completed"
    mark = pipeline.control.watermarks().collect()
    assert [(m.pipeline_name, m.last_logical_date) for m in mark] == [("retail_daily", DAY1)]
    batch = pipeline.control.batch(DAY1)
    assert (batch.rows_received, batch.rows_inserted, batch.rows_updated, batch.rows_rejected) == (7, 7, 0, 0)
    orders = {r.order_id: r for r in pipeline.read("gold", "fact_orders").collect()}
    assert orders[10].promotion_key == 3 and orders[11].promotion_key == -1 and orders[11].order_date_key == -1
    items = pipeline.read("gold", "fact_order_items").collect()
    assert [(r.order_item_id, r.line_total) for r in items] == [(100, Decimal("10.00"))]
    silver_items = {r.order_item_id: r for r in pipeline.read("silver", "order_items").collect()}
    assert silver_items[101].unit_price == 0 and not silver_items[101].invalid_unit_price_flag
    assert {r.customer_key for r in pipeline.read("gold", "dim_customer").collect()} == {1, 2, -1}
    assert pipeline.read("gold", "dim_date").count() == 2


def test_repeating_a_date_changes_nothing(loaded):
    pipeline, incoming = loaded
    before = pipeline.bronze("orders").count()
    result = pipeline.run_date(DAY1, str(incoming / str(DAY1)), NOW)
    assert result["idempotent_noop"] is True and pipeline.bronze("orders").count() == before
    assert pipeline.control.complete(DAY1, NOW) is False


def test_changed_bytes_for_a_finished_date_are_refused(loaded, tmp_path):
    pipeline, _ = loaded
    rows = first_day()
    rows["customers"].append(row("customers", "9", DAY1))
    with pytest.raises(ControlError, match="loaded from other files"):
        pipeline.load(DAY1, deliver(tmp_path, DAY1, rows), NOW)
    assert status(pipeline, DAY1) == "completed"


TWICE = row("customers", "6", DAY2)
BAD = [
    ("customers", row("customers", " ", DAY2), "blank customer_id"),
    ("customers", row("customers", "20", DAY2, op="X"), "invalid operation 'X'"),
    ("customers", row("customers", "21", DAY2, source_updated_at="2026-09-02T00:00:00"), "has no UTC offset"),
    ("customers", row("customers", "22", DAY2, source_updated_at="soon"), "invalid source_updated_at: 'soon'"),
    ("customers", row("customers", "23", DAY2, source_updated_at="2026-09-02T23:30:00-01:00"), "outside the batch date"),
    ("customers", row("customers", "24", DAY2, business_date="2026-09-03"), "business_date lies after the batch date"),
    ("customers", row("customers", "25", DAY2, business_date="2026-02-30"), "invalid business_date '2026-02-30'"),
    ("customers", row("customers", "77", DAY2, op="U"), "U of a key that is not current"),
    ("customers", row("customers", "78", DAY2, op="D"), "D of a key that is not current"),
    ("customers", row("customers", " 1", DAY2, op="U"), "customers  1: U of a key that is not current"),
    ("customers", TWICE, "key '6' occurs more than once"),
    ("customers", TWICE, "version "),
    ("orders", row("orders", "12", DAY2, customer_id="99"), "unknown customer_id 99"),
    ("orders", row("orders", "13", DAY2, customer_id="1", promotion_id="98"), "unknown promotion_id 98"),
    ("order_items", row("order_items", "102", DAY2, order_id="97"), "unknown order_id 97"),
    ("order_items", row("order_items", "103", DAY2, order_id="10", product_id=""), "blank product_id"),
]


def test_bad_rows_reject_the_whole_batch(loaded, tmp_path):
    pipeline, _ = loaded
    rows = {"customers": [row("customers", "4", DAY2)]}
    for entity, bad, _ in BAD:
        rows.setdefault(entity, []).append(bad)
    with pytest.raises(BatchRejected, match="Batch validation failed") as error:
        pipeline.load(DAY2, deliver(tmp_path, DAY2, rows), NOW)
    for _, _, message in BAD:
        assert message in str(error.value)
    failed = pipeline.control.batch(DAY2)
    assert failed.status == "failed" and failed.rows_rejected == 1 and failed.error_message == str(error.value)
    assert pipeline.bronze("customers").where(F.col("logical_date") == F.lit(DAY2)).count() == 0
    with pytest.raises(ControlError, match="stands at 'failed'"):
        pipeline.control.should_rebuild(DAY2)


def test_one_bad_row_is_enough(loaded, tmp_path):
    pipeline, _ = loaded
    rows = {"customers": [row("customers", "4", DAY2)], "orders": [row("orders", "12", DAY2, customer_id="99")]}
    with pytest.raises(BatchRejected) as error:
        pipeline.load(DAY2, deliver(tmp_path, DAY2, rows), NOW)
    assert str(error.value) == "Batch validation failed:\n- orders 12: unknown customer_id 99"


def test_missing_file_and_date_raise(loaded, tmp_path):
    pipeline, _ = loaded
    directory = deliver(tmp_path, DAY2, {})
    (tmp_path / str(DAY2) / "orders.csv").unlink()
    with pytest.raises(FileNotFoundError):
        pipeline.load(DAY2, directory, NOW)
    with pytest.raises(ControlError, match="Nothing was ingested"):
        pipeline.control.should_rebuild(dt.date(2020, 1, 1))


def test_second_date_after_failures_then_a_late_one(loaded):
    """Updates, a delete whose child stays behind, and a late insert."""
    pipeline, incoming = loaded
    rows = {
        "customers": [row("customers", "1", DAY2, op="U", first_name="o'neil")],
        "orders": [row("orders", "11", DAY2, op="D", customer_id="2"),
                   row("orders", "12", DAY2, customer_id="1", business_date="2026-08-30")],
        "order_items": [row("order_items", "103", DAY2, order_id="12", product_category="toys")],
    }
    directory = deliver(incoming, DAY2, rows)
    pipeline.load(DAY2, directory, NOW)
    assert status(pipeline, DAY2) == "ingested"
    with pytest.raises(ControlError, match="Nothing to complete"):
        pipeline.control.complete(DAY3, NOW)
    # A rerun resumes at the rebuild, as after a crash before completion.
    assert pipeline.run_date(DAY2, directory, NOW)["idempotent_noop"] is True
    assert status(pipeline, DAY2) == "completed"
    names = {r.customer_id: r.first_name for r in pipeline.read("silver", "customers").collect()}
    assert names[1] == "O'Neil"
    assert {r.order_id for r in pipeline.read("silver", "orders").collect()} == {10, 12}
    assert {r.order_item_id for r in pipeline.read("silver", "order_items").collect()} == {100, 103}
    report = {(r.table_name, r.issue_type): r.affected_row_count for r in pipeline.read("silver", "data_quality_report").collect()}
    assert report["order_items_raw", "invalid_order_reference"] == 1
    assert pipeline.bronze("orders").count() == 4
    products = {(r.product_id, r.product_category) for r in pipeline.read("gold", "dim_product").collect()}
    assert products == {(7, "Home"), (7, "Unknown"), (-1, "Unknown")}


def test_watermark_does_not_move_back(loaded):
    pipeline, _ = loaded
    earlier = dt.date(2026, 8, 31)
    incoming = pipeline.store.root + "/../incoming"
    import pathlib
    rows = {"customers": [row("customers", "50", earlier)]}
    pipeline.run_date(earlier, deliver(pathlib.Path(incoming), earlier, rows), NOW)
    mark = pipeline.control.watermarks().collect()[0]
    assert mark.last_logical_date == DAY2 and mark.batch_id == f"retail_daily:{DAY2}"


def test_carried_newest_versions_equal_those_of_the_whole_raw_layer(loaded):
    pipeline, _ = loaded
    for name, spec in ENTITIES.items():
        whole = latest_version(pipeline.bronze(name), spec).select(spec.key, "source_record_hash")
        assert sorted(pipeline.read("current", name).select(spec.key, "source_record_hash").collect()) == sorted(whole.collect())


def test_rows_of_an_unpublished_attempt_are_invisible(loaded):
    pipeline, _ = loaded
    before = pipeline.bronze("customers").count()
    stray = pipeline.all_bronze("customers").limit(1).withColumn("attempt_id", F.lit("crashed"))
    stray.write.mode("append").partitionBy("logical_date", "attempt_id").parquet(pipeline.bronze_path("customers"))
    assert pipeline.all_bronze("customers").count() == before + 1
    assert pipeline.bronze("customers").count() == before


def test_failing_data_tests_stop_the_run(loaded):
    pipeline, _ = loaded
    good = pipeline.read("gold", "dim_date")
    pipeline.store.write(good.unionByName(good), "gold", "dim_date")
    with pytest.raises(DataTestsFailed, match="gold.dim_date.date_key unique"):
        pipeline.run_tests()
    pipeline.store.write(good, "gold", "dim_date")
    assert pipeline.run_tests().count() == 63


def test_same_bytes_under_another_pipeline_are_refused(loaded, spark):
    pipeline, incoming = loaded
    other = Pipeline(spark, pipeline.store.root, "second")
    with pytest.raises(ControlError, match="already recorded"):
        other.load(DAY1, str(incoming / str(DAY1)), NOW)


def test_reset_needs_confirmation(spark, tmp_path):
    pipeline = Pipeline(spark, str(tmp_path / "w"))
    pipeline.load(DAY1, deliver(tmp_path / "in", DAY1, first_day()), NOW)
    with pytest.raises(ValueError, match="Refusing"):
        pipeline.reset(confirm=False)
    assert pipeline.bronze("orders").count() == 2
    pipeline.reset(confirm=True)
    assert pipeline.bronze("orders").count() == 0 and pipeline.control.batch(DAY1) is None
    assert pipeline.load(DAY1, str(tmp_path / "in" / str(DAY1)), NOW)["idempotent_noop"] is False
    assert pipeline.bronze("orders").count() == 2


def test_no_orders_leave_only_unknown_members(spark, tmp_path):
    pipeline = Pipeline(spark, str(tmp_path / "w"))
    pipeline.run_date(DAY1, deliver(tmp_path / "in", DAY1, {"customers": [row("customers", "1", DAY1)]}), NOW)
    assert [r.date_key for r in pipeline.read("gold", "dim_date").collect()] == [-1]
    assert pipeline.read("gold", "fact_orders").count() == 0


def test_an_older_typed_table_is_loaded_onto(spark, tmp_path):
    """A raw table without two columns and with typed ones keeps its types; new columns come as text."""
    pipeline = Pipeline(spark, str(tmp_path / "warehouse"))
    pipeline.run_date(DAY1, deliver(tmp_path / "incoming", DAY1, first_day()), NOW)
    path = pipeline.bronze_path("orders")
    older = pipeline.all_bronze("orders").drop("order_channel", "customer_segment_at_time").withColumn("order_value", F.col("order_value").cast("decimal(12,2)"))
    older = older.withColumn("attributed_to_promo", F.col("attributed_to_promo").isin("yes"))
    older.write.parquet(str(tmp_path / "older"), partitionBy=["logical_date", "attempt_id"])
    pipeline.store.files.remove(path)
    pipeline.store.files.move(str(tmp_path / "older"), path)
    assert dict(pipeline.all_bronze("orders").dtypes)["order_channel"] == "string"

    rows = {"orders": [row("orders", "10", DAY2, op="U", customer_id="1", order_value="12.505", order_channel="Push", attributed_to_promo="NO", source_updated_at=f"{DAY2}T01:00:00Z")]}
    pipeline.run_date(DAY2, deliver(tmp_path / "incoming", DAY2, rows), NOW)
    stored = dict(pipeline.all_bronze("orders").dtypes)
    assert (stored["order_value"], stored["attributed_to_promo"], stored["order_channel"]) == ("decimal(12,2)", "boolean", "string")
    raw = {r.source_updated_at.day: r for r in pipeline.all_bronze("orders").where("order_id = '10'").collect()}
    assert (raw[1].order_channel, raw[2].order_channel, raw[2].order_value, raw[2].attributed_to_promo) == (None, "Push", Decimal("12.51"), False)
    assert {t for _, t in pipeline.bronze("orders").select("order_value", "attributed_to_promo").dtypes} == {"string"}
    silver = {r.order_id: r for r in pipeline.read("silver", "orders").collect()}
    assert silver[10].order_value == Decimal("12.51") and silver[10].order_channel == "Push" and silver[11].order_value == Decimal("10.00")

    bad = {"orders": [row("orders", "10", DAY3, op="U", customer_id="1", order_value="twelve", source_updated_at=f"{DAY3}T01:00:00Z")]}
    with pytest.raises(Exception, match="invalid decimal value: twelve"):
        pipeline.load(DAY3, deliver(tmp_path / "incoming", DAY3, bad), NOW)
    assert status(pipeline, DAY3) == "failed" and pipeline.bronze("orders").where(F.col("logical_date") == F.lit(DAY3)).count() == 0


def test_a_reset_leaves_no_raw_file(spark, tmp_path):
    pipeline = Pipeline(spark, str(tmp_path / "warehouse"))
    with pytest.raises(ValueError, match="without confirmation"):
        pipeline.reset(confirm=False)
    pipeline.run_date(DAY1, deliver(tmp_path / "incoming", DAY1, first_day()), NOW)
    open_before = pipeline.bronze("customers")
    assert list((tmp_path / "warehouse" / "bronze").rglob("*.parquet"))
    pipeline.reset(confirm=True)
    assert not list((tmp_path / "warehouse" / "bronze").rglob("*.parquet")) and not (tmp_path / "warehouse" / "gold").exists()
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|No such file"):
        open_before.collect()
    assert all(pipeline.bronze(e).count() == 0 for e in ENTITIES)
    pipeline.run_date(DAY1, deliver(tmp_path / "again", DAY1, first_day()), NOW)
    assert pipeline.bronze("customers").count() == 2 and pipeline.read("gold", "fact_orders").count() == 2


def test_a_day_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    pipeline = Pipeline(spark, str(tmp_path / "warehouse"))
    rows = first_day()
    rows["customers"] += [row("customers", str(k), DAY1) for k in range(100, 400)]
    pipeline.run_date(DAY1, deliver(tmp_path / "incoming", DAY1, rows), NOW)

    def files(entity):
        return {r.f for r in pipeline.store.read("newest", entity).select(F.input_file_name().alias("f")).distinct().collect()}

    before = {e: files(e) for e in ENTITIES}
    changes = {"customers": [row("customers", "150", DAY2, op="U", last_name="new"), row("customers", "151", DAY2, op="D"), row("customers", "900", DAY2)]}
    pipeline.run_date(DAY2, deliver(tmp_path / "incoming", DAY2, changes), NOW)
    after = {e: files(e) for e in ENTITIES}
    assert len(before["customers"]) == pipeline.key_buckets
    assert 1 <= len(after["customers"] - before["customers"]) <= 3 and len(before["customers"] & after["customers"]) >= pipeline.key_buckets - 3
    assert all(after[e] == before[e] for e in ENTITIES if e != "customers")
    current = {r.customer_id: r.last_name for r in pipeline.read("current", "customers").collect()}
    assert len(current) == 302 and current["150"] == "new" and "151" not in current and "900" in current
    # As if everything had been computed anew from the raw layer.
    whole = {r.customer_id: r.last_name for r in latest_version(pipeline.bronze("customers"), ENTITIES["customers"]).collect()}
    assert current == whole
