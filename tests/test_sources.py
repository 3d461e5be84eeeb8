from __future__ import annotations

import csv
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import profiling
from ledgerloom.sources import bronze, landing, reports
from ledgerloom.sources.store import Files, TableStore, layer_path
from ledgerloom.specs import ENTITIES

CUSTOMERS = ENTITIES["customers"]
ITEMS = ENTITIES["order_items"]


def write_csv(path, spec, rows, header=None):
    with path.open("w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle, lineterminator="\n")
        writer.writerow(header or spec.csv_columns)
        writer.writerows(rows)


def item(key, **values):
    row = dict.fromkeys(ITEMS.csv_columns, "") | {"order_item_id": key, "operation": "I"} | values
    return [row[c] for c in ITEMS.csv_columns]


@pytest.fixture
def batch_dir(tmp_path):
    for spec in ENTITIES.values():
        write_csv(tmp_path / f"{spec.name}.csv", spec, [])
    return tmp_path


def test_values_survive_quotes_commas_and_blanks(spark, batch_dir):
    rows = [item("1", product_category='say "hi", ok', operation=" u "), item(" 2 ", quantity="  "), item("3")]
    write_csv(batch_dir / "order_items.csv", ITEMS, rows)
    got = landing.with_row_number(landing.read_entity_csv(spark, str(batch_dir), ITEMS)).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.order_item_id, r.product_category, r.quantity, r.operation) for r in got] == [
        (2, "1", 'say "hi", ok', "", "U"), (3, " 2 ", "", "  ", "I"), (4, "3", "", "", "I")]


def test_a_field_may_span_lines(spark, batch_dir):
    write_csv(batch_dir / "order_items.csv", ITEMS, [item("1", product_category="two\nlines"), item("2")])
    assert [r.spans_lines for r in landing.scan_files(spark, str(batch_dir), ITEMS).collect()] == [True]
    got = landing.with_row_number(landing.read_entity_csv(spark, str(batch_dir), ITEMS)).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.product_category) for r in got] == [(2, "two\nlines"), (3, "")]


def test_only_part_files_with_line_breaks_are_read_whole(spark, tmp_path):
    parts = tmp_path / "order_items.csv"
    parts.mkdir()
    for part in range(4):
        texts = ["two\nlines" if (part, k) == (2, 7) else "x" * 50 for k in range(400)]
        rows = [item(str(1000 * part + k), product_category=texts[k]) for k in range(400)]
        write_csv(parts / f"part-{part}.csv", ITEMS, rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = landing.read_entity_csv(spark, str(tmp_path), ITEMS)
        blocks = {r["name"]: r["n"] for r in read.groupBy(F.element_at(F.split("_file", "/"), -1).alias("name")).agg(F.count_distinct("_block").alias("n")).collect()}
        assert blocks["part-2.csv"] == 1 and all(blocks[f"part-{k}.csv"] > 1 for k in (0, 1, 3))
        numbered = landing.with_row_number(read).orderBy("source_row_number").collect()
        assert [r.source_row_number for r in numbered] == list(range(2, 1602))
        assert [r.order_item_id for r in numbered] == [str(1000 * part + k) for part in range(4) for k in range(400)]
        assert numbered[807].product_category == "two\nlines"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_row_numbers_hold_across_splits(spark, batch_dir):
    write_csv(batch_dir / "order_items.csv", ITEMS, [item(str(k), product_category="x" * 50) for k in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = landing.read_entity_csv(spark, str(batch_dir), ITEMS)
        assert read.select("_block").distinct().count() > 5
        numbered = landing.with_row_number(read)
        assert numbered.where("source_row_number <> cast(order_item_id as int) + 2").count() == 0
        assert numbered.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_short_and_long_rows_read_like_a_dict_reader(spark, batch_dir):
    path = batch_dir / "order_items.csv"
    path.write_text(",".join(ITEMS.csv_columns) + "\n1,2\n" + ",".join(["9"] * 14) + "\n", encoding="utf-8")
    got = landing.read_entity_csv(spark, str(batch_dir), ITEMS).orderBy("order_item_id").collect()
    assert [(r.order_item_id, r.order_id, r.product_id, r.business_date) for r in got] == [("1", "2", "", ""), ("9", "9", "9", "9")]


def test_headers_must_match_in_order(spark, batch_dir):
    landing.check_headers(spark, str(batch_dir))
    swapped = [ITEMS.csv_columns[1], ITEMS.csv_columns[0], *ITEMS.csv_columns[2:]]
    write_csv(batch_dir / "order_items.csv", ITEMS, [item("1")], header=swapped)
    with pytest.raises(ValueError, match="order_items.csv.* begins with"):
        landing.check_headers(spark, str(batch_dir))
    (batch_dir / "order_items.csv").write_text("")
    with pytest.raises(ValueError, match="begins with None"):
        landing.check_headers(spark, str(batch_dir))


def test_all_four_files_are_required(spark, batch_dir):
    landing.require_files(spark, str(batch_dir))
    (batch_dir / "orders.csv").unlink()
    with pytest.raises(FileNotFoundError, match="orders.csv"):
        landing.require_files(spark, str(batch_dir))


def folded(data: bytes) -> str:
    """The checksum of a file by its definition."""
    ended = data.endswith(b"\n")
    lines = data.split(b"\n")[:-1] if ended else data.split(b"\n")
    lines = lines if data else []
    sums = [0] * 4
    for number, line in enumerate(lines, 1):
        digest = hashlib.sha256(b"%d:%s" % (number, line)).hexdigest()
        for k in range(4):
            sums[k] += int(digest[16 * k:16 * k + 16], 16)
    return hashlib.sha256(":".join(map(str, [*sums, len(lines), int(bool(data) and not ended)])).encode()).hexdigest()


def checksum(spark, directory):
    return {r.entity: r.file_checksum for r in landing.file_checksums(spark, str(directory)).collect()}


def test_checksums_fold_the_lines_of_the_bytes(spark, batch_dir):
    write_csv(batch_dir / "order_items.csv", ITEMS, [item("1", product_category="é\nü"), item("2")])
    (batch_dir / "orders.csv").write_bytes(b"a,b\r\n1,\xff\xfe\n\n3")
    (batch_dir / "customers.csv").write_bytes(b"")
    got = checksum(spark, batch_dir)
    assert got == {e: folded((batch_dir / f"{e}.csv").read_bytes()) for e in ENTITIES}
    manifest = landing.manifest_checksum(landing.file_checksums(spark, str(batch_dir))).collect()[0][0]
    assert manifest == hashlib.sha256("".join(sorted(got.values())).encode()).hexdigest()


def test_checksums_do_not_depend_on_splits_or_part_files(spark, batch_dir, tmp_path_factory):
    rows = [item(str(k), product_category="x" * (k % 90)) for k in range(4000)]
    write_csv(batch_dir / "order_items.csv", ITEMS, rows)
    whole = checksum(spark, batch_dir)["order_items"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(batch_dir / "order_items.csv")).rdd.getNumPartitions() > 10
        assert checksum(spark, batch_dir)["order_items"] == whole == folded((batch_dir / "order_items.csv").read_bytes())
        other = tmp_path_factory.mktemp("parts")
        for spec in ENTITIES.values():
            if spec is not ITEMS:
                write_csv(other / f"{spec.name}.csv", spec, [])
        (other / "order_items.csv").mkdir()
        for part, at in enumerate(range(0, 4000, 700)):
            write_csv(other / "order_items.csv" / f"part-{part:05d}.csv", ITEMS, rows[at:at + 700])
        (other / "order_items.csv" / "_SUCCESS").write_text("")
        assert checksum(spark, other)["order_items"] == whole
        rows[17], rows[3000] = rows[3000], rows[17]
        write_csv(batch_dir / "order_items.csv", ITEMS, rows)
        assert checksum(spark, batch_dir)["order_items"] != whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headers_are_compared_as_csv(spark):
    names = ITEMS.csv_columns
    lines = [",".join(names), ",".join(f'"{n}"' for n in names), ",".join([*names, ""]), ",".join(names[:-1]), ",".join([names[1], names[0], *names[2:]]), "", None, ",".join(names).upper()]
    df = spark.createDataFrame(list(enumerate(lines)), "k int, line string")
    got = {r.k: r.ok for r in df.select("k", landing.is_header(F.col("line"), ITEMS).alias("ok")).collect()}
    assert [got[k] for k in range(len(lines))] == [True, True, False, False, False, False, False, False]


def test_only_unseen_hashes_are_new(spark):
    schema = "source_record_hash string, source_row_number bigint, file_checksum string"
    stored = spark.createDataFrame([("a", 2, "f")], schema)
    batch = spark.createDataFrame([("a", 2, "g"), ("b", 5, "g"), ("b", 3, "g"), ("c", 4, "g")], schema)
    got = {(r.source_record_hash, r.source_row_number) for r in bronze.new_versions(stored, batch).collect()}
    assert got == {("b", 3), ("c", 4)}


def test_older_tables_gain_missing_columns_and_keep_their_types(spark):
    older = spark.createDataFrame([(1, "Ann")], "customer_id bigint, first_name string")
    got = bronze.evolve_schema(older, CUSTOMERS)
    assert set(got.columns) == set(CUSTOMERS.bronze_schema.names)
    row = got.collect()[0]
    assert row.customer_id == 1 and row.preferred_category is None
    assert dict(got.dtypes)["customer_id"] == "bigint"


def test_store_swaps_versions_and_survives_a_failed_write(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("silver", "t")
    store.write(spark.range(3), "silver", "t")
    before = store.read("silver", "t")
    bad = spark.range(2).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        store.write(bad, "silver", "t")
    assert store.read("silver", "t").count() == 3
    store.write(spark.range(5), "silver", "t")
    assert store.read("silver", "t").count() == 5
    assert before.count() == 3
    assert layer_path("/r", " silver ") == "/r/silver"


def test_files_helper_lists_and_replaces(spark, tmp_path):
    files = Files(spark)
    files.replace_text(str(tmp_path / "d" / "p"), "one")
    files.replace_text(str(tmp_path / "d" / "p"), "two")
    assert files.read_text(str(tmp_path / "d" / "p")) == "two"
    assert files.names(str(tmp_path / "d")) == ["p"] or files.names(str(tmp_path / "d"))[-1] == "p"
    assert files.names(str(tmp_path / "none")) == [] == files.data_files(str(tmp_path / "none"))
    assert [f.rsplit("/", 1)[1] for f in files.data_files(str(tmp_path / "d"))] == ["p"]


def test_profile_of_a_small_batch(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", "1.5", "true", ""), ("2", "2", "False", "x"), ("2", "2", "False", "x"), ("", "", "true", "7")], "a string, b string, c string, d string")
    columns = ["a", "b", "c", "d"]
    types = {r.column_name: r.column_type for r in profiling.inferred_types(rows, "t", columns).collect()}
    assert types == {"a": "double", "b": "double", "c": "boolean", "d": "string"}
    nulls = {r.column_name: r.null_count for r in profiling.null_counts(rows, "t", columns).collect()}
    assert nulls == {"a": 1, "b": 1, "c": 0, "d": 1}
    assert profiling.duplicate_rows(rows, "t", columns).collect()[0].duplicate_row_count == 1
    empty = rows.limit(0)
    assert [r.null_count for r in profiling.null_counts(empty, "t", columns).collect()] == [0] * 4
    assert {r.column_type for r in profiling.inferred_types(empty, "t", columns).collect()} == {"double"}
    reports.write_profile(profiling.null_counts(rows, "t", columns), str(tmp_path / "p"))
    lines = [json.loads(line) for f in (tmp_path / "p").glob("*.json") for line in f.read_text().splitlines()]
    assert {x["column_name"] for x in lines} == set(columns)
    reports.write_summary(profiling.row_counts(rows, "t"), str(tmp_path / "s"))
    assert [f.read_text() for f in (tmp_path / "s").glob("*.csv")] == ["table_name,row_count\nt,4\n"]


# Values as recorded for one delivered date of the source system.
RECORDED_ORDERS = [
    ("4364", "464", "2025-06-03 11:32:59.256565", "PAID", "", "Social", "132.41", "False", "Medium_Value", "D"),
    ("15045", "1266", "2026-09-02 13:05:00", "PAID", "", "SMS", "404.42", "False", "Low_Value", "I"),
]


def test_recorded_rows_read_as_expected(spark):
    from ledgerloom.plans import silver

    spec = ENTITIES["orders"]
    current = spark.createDataFrame([r[:9] for r in RECORDED_ORDERS], ", ".join(f"{c} string" for c in spec.columns))
    customers = spark.createDataFrame([(464,), (1266,)], "customer_id bigint")
    promotions = spark.createDataFrame([(1,)], "promotion_id bigint")
    got = {r.order_id: r for r in silver.silver_orders(current, customers, promotions).collect()}
    assert str(got[4364].order_value) == "132.41" and str(got[4364].order_date) == "2025-06-03 00:00:00"
    assert got[15045].missing_promotion_flag and not got[15045].promo_attributed_without_promotion_id_flag


def test_superseded_versions_go_and_the_last_one_stays(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    frames = []
    for n in range(4):
        store.write(spark.range(n + 1), "silver", "numbers")
        frames.append(store.read("silver", "numbers"))
    assert len([p for p in (tmp_path / "silver" / "numbers").iterdir() if p.name.startswith("v-")]) == 2
    assert [f.count() for f in frames[2:]] == [3, 4]
