from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins
from ledgerloom.operators import versions as V
from ledgerloom.plans import quality, validate
from ledgerloom.sources import bronze
from ledgerloom.specs import ENTITIES

ORDERS = ENTITIES["orders"]
VERSIONS = ("order_id string, order_status string, operation string, logical_date date, source_updated_at timestamp, "
            "ingested_at timestamp, batch_id string, source_record_hash string")


def version(key, status, op, day, second=0, h="h"):
    at = dt.datetime(2026, 9, day, 0, 0, second)
    return (key, status, op, dt.date(2026, 9, day), at, at, f"b{day}", h)


def frame(spark, rows):
    return spark.createDataFrame(rows, VERSIONS)


def test_a_tombstone_hides_its_key_only_if_it_is_newest(spark):
    rows = [version("5", "a", "I", 1), version("5", "b", "D", 2), version("6", "a", "I", 1), version("6", "b", "D", 2),
            version("6", "c", "I", 3), version(" 5", "z", "I", 1), version("7", "a", None, 1)]
    got = {(r.order_id, r.order_status) for r in V.latest_version(frame(spark, rows), ORDERS).collect()}
    assert got == {("6", "c"), (" 5", "z"), ("7", "a")}


def test_ties_fall_to_the_hash_and_nulls_come_last(spark):
    rows = [version("1", "x", "U", 1, h="a"), version("1", "y", "U", 1, h="b"), version("2", "p", "U", 1, h=None), version("2", "q", "U", 1, h="0")]
    got = {(r.order_id, r.order_status) for r in V.latest_version(frame(spark, rows), ORDERS).collect()}
    assert got == {("1", "y"), ("2", "q")}


def test_any_batch_order_gives_the_same_newest_rows(spark):
    rng = random.Random(7)
    rows = [version(str(rng.randrange(9)), str(i), rng.choice("IUD"), 1 + rng.randrange(5), rng.randrange(4), f"{i:04}") for i in range(200)]
    first = sorted(V.latest_version(frame(spark, rows), ORDERS).collect())
    rng.shuffle(rows)
    assert sorted(V.latest_version(frame(spark, rows).repartition(7), ORDERS).collect()) == first


def test_newest_version_is_limited_before_the_shuffle(spark):
    plan = V.latest_version(frame(spark, [version("1", "a", "I", 1)]), ORDERS)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("row_number(), 1, Partial")


def test_state_as_of_folds_only_earlier_dates(spark):
    rows = [version("1", "a", "I", 1), version("1", "b", "U", 2), version("1", "c", "D", 3)]
    states = [[r.order_status for r in V.state_as_of(frame(spark, rows), ORDERS, f"2026-09-0{d}").collect()] for d in (1, 2, 3)]
    assert states == [["a"], ["b"], []]


def test_available_keys_apply_the_last_operation_of_a_key(spark):
    known = spark.createDataFrame([("1",), ("2",), ("3",)], "business_key string")
    batch = spark.createDataFrame(
        [("1", "D", 2), ("2", "D", 3), ("2", "I", 4), ("9", "U", 5), ("8", "X", 6)], "order_id string, operation string, source_row_number bigint")
    assert sorted(r[0] for r in V.available_keys(known, batch, ORDERS).collect()) == ["2", "3", "9"]


def test_previous_status_crosses_chunks(spark, tmp_path):
    rng = random.Random(3)
    statuses = ["PENDING", "PAID", "CANCEL", "ERROR", "INVALID"]
    rows, seen = [], {}
    for i in range(300):
        key = "hot" if i % 3 == 0 else str(i % 7)
        at = dt.datetime(2026, 9, 1) + dt.timedelta(seconds=17 * i)
        rows.append((key, rng.choice(statuses), "U", at.date(), at, at, "b", f"{i:05}"))
    expected = []
    for row in rows:
        expected.append((row[0], seen.get(row[0]), row[1]))
        seen[row[0]] = row[1]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = V.status_transitions(frame(spark, rows).repartition(5), ORDERS, str(tmp_path / "chunks")).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    chunks = spark.read.parquet(str(tmp_path / "chunks")).where("order_id = 'hot'")
    assert chunks.select("_chunk").distinct().count() > 1
    assert sorted((r.order_id, r.previous_status or "", r.new_status) for r in got) == sorted((k, p or "", s) for k, p, s in expected)
    for r in got:
        moves = {("PENDING", "PAID"), ("PENDING", "CANCEL"), ("ERROR", "CANCEL"), ("INVALID", "CANCEL")}
        assert r.is_allowed == (r.previous_status is not None and (r.previous_status == r.new_status or (r.previous_status, r.new_status) in moves))


def test_next_ids_are_dense_and_ordered(spark):
    rows = spark.createDataFrame([(k,) for k in random.Random(1).sample(range(5000), 700)], "k bigint")
    known = spark.createDataFrame([(41,), (12,), (None,)], "key bigint")
    got = [r.next_id for r in V.assign_next_ids(rows, known, "k", block=100).orderBy("k").collect()]
    assert got == list(range(42, 742))


def test_next_ids_start_at_one_without_known_keys(spark):
    rows = spark.createDataFrame([(3,), (1,)], "k bigint")
    none = spark.createDataFrame([], "key bigint")
    assert [r.next_id for r in V.assign_next_ids(rows, none, "k").orderBy("k").collect()] == [1, 2]


@pytest.fixture(scope="module")
def skewed(spark):
    """One key and NULL hold a third of the rows each."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 500)
    return spark.range(6000).select("id", key.cast("bigint").alias("k"))


def test_lookup_splits_the_hot_key_and_nulls(spark, skewed, tmp_path):
    """Adaptive execution deals the crowded partitions to several tasks, and no row is lost or repeated."""
    spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "parent"))
    skewed.withColumn("pad", F.sha2(F.col("id").cast("string"), 512)).repartition(8).write.parquet(str(tmp_path / "child"))
    child, parent = (spark.read.parquet(str(tmp_path / n)) for n in ("child", "parent"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.shuffle.partitions": "8", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        joined = joins.lookup(child, parent, ["k"])
        joined.withColumn("p", F.spark_partition_id()).write.parquet(str(tmp_path / "joined"))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    rows = spark.read.parquet(str(tmp_path / "joined")).collect()
    assert sorted((r.id, r.k, r.v) for r in rows if r.k is not None) == sorted(
        (k, key, 2 * key if key < 400 else None) for k in range(6000) if (key := 7 if k % 3 == 0 else k % 500) is not None and k % 3 != 1)
    assert sum(r.k is None and r.v is None for r in rows) == 2000 and len(rows) == 6000
    for value in (7, None):
        assert len({r.p for r in rows if r.k == value}) >= 3


def test_lookup_on_two_keys(spark):
    child = spark.createDataFrame([(1, "a", 10), (1, None, 11), (2, "b", 12)], "x int, y string, id int")
    parent = spark.createDataFrame([(1, "a", 5), (2, "c", 6)], "x int, y string, v int")
    got = joins.lookup(child, parent, ["x", "y"])
    assert {(r.id, r.v) for r in got.collect()} == {(10, 5), (11, None), (12, None)}


def test_unmatched_references_count_blank_and_unreadable_ones(spark):
    current = spark.createDataFrame([("1",), (" 1 ",), ("2",), (None,), ("",), ("x",), ("x",), ("12.0",)], "customer_id string")
    parent = spark.createDataFrame([(1,)], "customer_id bigint")
    got = {r.reference: r.n_records for r in quality.unmatched_references(current, "customer_id", parent, True).collect()}
    assert got == {"2": 1, None: 2, "x": 2, "12.0": 1}
    skip_blank = quality.unmatched_references(current, "customer_id", parent, False).collect()
    assert {r.reference for r in skip_blank} == {"2", "x", "12.0"}


def test_duplicate_keys_equal_rows_less_distinct_clean_keys(spark):
    rng = random.Random(5)
    raws = {" " * rng.randrange(3) + str(rng.randrange(60)) + " " * rng.randrange(2) for _ in range(150)} | {None, "", "  "}
    current = spark.createDataFrame([(r,) for r in raws], "order_id string")
    clean = [r.strip(" ") for r in raws if r and r.strip(" ")]
    assert quality.duplicate_keys(current, ORDERS).collect()[0].n_records == len(clean) - len(set(clean)) > 0


def test_stored_newest_versions_can_be_carried_on(spark):
    rng = random.Random(11)
    rows = [version(str(rng.randrange(9)), str(i), rng.choice("IUD"), 1 + rng.randrange(5), rng.randrange(4), f"{i:04}") for i in range(200)]
    late, early = [r for r in rows if r[3].day > 2], [r for r in rows if r[3].day <= 2]
    for first, second in ((early, late), (late, early)):
        carried = V.newest_version(frame(spark, first), ORDERS).unionByName(frame(spark, second))
        assert sorted(V.latest_version(carried, ORDERS).collect()) == sorted(V.latest_version(frame(spark, rows), ORDERS).collect())


def test_presence_always_gives_one_row(spark):
    empty = spark.createDataFrame([], "a int")
    assert [r.a for r in joins.presence(empty).collect()] == [None]
    assert [r.a for r in joins.presence(spark.createDataFrame([(4,)], "a int")).collect()] == [4]


def test_hashes_of_raw_rows_are_not_broadcast_by_estimate(spark, tmp_path):
    """Files of few bytes hold many hashes: the estimate is small, what would be sent is not."""
    rows = spark.range(40000).select(F.sha2(F.lit("h"), 256).alias("source_record_hash"), F.lit(1).alias("source_row_number"), F.lit("c").alias("file_checksum"))
    rows.write.parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    offered = spark.createDataFrame([("a" * 64, 2, "c"), ("a" * 64, 3, "c")], "source_record_hash string, source_row_number int, file_checksum string")
    found = bronze.new_versions(stored, offered.unionByName(stored))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [(r.source_record_hash, r.source_row_number) for r in found.collect()] == [("a" * 64, 2)]


def sent(df) -> bool:
    return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """Rows as a stored table, whose size Spark takes from its files."""
    def write(rows, schema):
        path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)
    return write


def test_keys_of_a_batch_are_not_broadcast_by_estimate(stored):
    """What the stream's checks join: current keys, and the keys that a batch changes."""
    batch = stored([("1", "U", 2), ("2", "D", 3), ("4", "I", 4)], "order_id string, operation string, source_row_number bigint")
    known = stored([("1",), ("2",), ("3",)], "business_key string")
    available = V.available_keys(known, batch, ORDERS)
    lost = validate.missing_keys(batch, known.where("business_key <> '1'"), ORDERS)
    assert not sent(available) and not sent(lost)
    assert sorted(r.business_key for r in available.collect()) == ["1", "3", "4"]
    assert [r.business_key for r in lost.collect()] == ["1"]


def test_parents_of_the_report_are_not_broadcast_by_estimate(stored):
    current = stored([("1",), ("2",), ("2",), (None,)], "customer_id string")
    parent = stored([(1,), (3,)], "customer_id bigint")
    orphans = quality.unmatched_references(current, "customer_id", parent, True)
    items = stored([(1, True, None), (1, True, 5), (1, True, 5), (2, False, None)], "order_id bigint, attributed_to_promo boolean, promotion_id bigint")
    orders = stored([(1, True, None), (2, False, None)], "order_id bigint, attributed_to_promo boolean, promotion_id bigint")
    differs = quality.attribution_mismatch(items, orders)
    found = joins.lookup(orders, parent.select(F.col("customer_id").alias("order_id")), ["order_id"])
    counted = joins.unmatched_counts(items, parent.select(F.col("customer_id").alias("order_id")), "order_id")
    assert not any(map(sent, (orphans, differs, found, counted)))
    assert {r.reference: r.n_records for r in orphans.collect()} == {"2": 2, None: 1}
    assert [(r.order_id, r.promotion_id, r.n_records) for r in differs.collect()] == [(1, 5, 2)]
