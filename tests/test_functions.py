from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions import keys as K
from ledgerloom.functions import parsing as P
from ledgerloom.functions import text as X
from ledgerloom.plans import silver


@pytest.mark.parametrize("raw, clean", [("  a b ", "a b"), ("   ", None), ("", None), (None, None), ("\ta ", "\ta")])
def test_text_clean_trims_spaces_only(one, raw, clean):
    assert one(X.text_clean, raw) == clean


@pytest.mark.parametrize("raw", [" \t\n5\r ", " 5　", "\x1c5", "5"])
def test_strip_all_trims_every_white_space(one, raw):
    assert one(X.strip_all, raw) == raw.strip() == "5"


@pytest.mark.parametrize("raw, token", [("High Value", "high_value"), ("--A--b", "_a_b"), (" x ", "_x_"), ("a__b", "a_b")])
def test_token_keeps_edge_separators(one, raw, token):
    assert one(X.normalize_token, raw) == token


@pytest.mark.parametrize("raw, name", [
    ("mary-jane o'neil", "Mary-Jane O'Neil"), ("ALICE", "Alice"), ("r2d2 3po", "R2d2 3po"), ("élan vital", "Élan Vital"), (None, None),
])
def test_names_capitalise_every_run(one, raw, name):
    assert one(X.name_case, raw) == name


@pytest.mark.parametrize("raw, day", [
    ("2026-09-01junk", dt.datetime(2026, 9, 1)), ("2026-09-01 10:00", dt.datetime(2026, 9, 1)), ("41:02.4", None),
    ("2025-02-30", None), ("2024-02-29", dt.datetime(2024, 2, 29)), ("2023-02-29", None), ("2026-9-1", None),
    ("0000-01-01", None), ("2026-13-01", None), (" 2026-09-01", None), (None, None),
])
def test_parse_date_reads_a_valid_prefix(one, raw, day):
    assert one(P.parse_date, raw) == day


@pytest.mark.parametrize("raw, number", [
    ("0012", 12), ("12\n", None), ("-1", None), ("1.0", None), ("99999999999999999999", None), ("", None), ("١٢", None),
])
def test_bigint_needs_only_digits(one, raw, number):
    assert one(P.digits_to_bigint, raw) == number


@pytest.mark.parametrize("raw, number", [("-3", -3), ("3\n", None), ("+3", None), ("3000000000", None), ("two", None)])
def test_signed_int(one, raw, number):
    assert one(P.to_signed_int, raw) == number


@pytest.mark.parametrize("raw, number", [
    ("1.005", "1.01"), ("-1.005", "-1.01"), ("-0.004", "0.00"), ("12345678901.00", None), (".5", None), ("1e3", None), ("5.", None),
])
def test_decimal_rounds_half_away_from_zero(one, raw, number):
    got = one(lambda c: P.to_decimal(c, 12, 2), raw)
    assert got == (None if number is None else Decimal(number))


@pytest.mark.parametrize("raw, flag", [("TRUE", True), ("y", True), ("0", False), ("No", False), ("maybe", None), (None, None)])
def test_bool_value(one, raw, flag):
    assert one(P.bool_value, raw) is flag


def test_labels_and_defaults(one):
    assert one(lambda c: X.canonical_text(c, specs.SEGMENT_MAP), "new customer") == "New_Customer"
    assert one(lambda c: X.canonical_text(c, specs.SEGMENT_MAP), "vip") == "Unknown"
    assert one(lambda c: X.canonical_text(c, specs.SEGMENT_MAP), None) == "Unknown"
    assert [one(X.order_status, s) for s in ("cancelled", "Canceled", "cancel", "lost", None)] == ["CANCEL"] * 3 + ["UNKNOWN"] * 2
    assert [one(X.age_band, s) for s in ("26 - 35", "46–55", "55+", "n/a")] == ["26-35", "46-55", "55+", "Unknown"]


@pytest.mark.parametrize("raw, bad", [("-628", True), ("n/a", True), ("62812", False), (None, False)])
def test_invalid_phone(one, raw, bad):
    assert one(X.invalid_phone, raw) is bad


def test_report_sees_unrounded_numbers_and_the_clean_layer_rounded_ones(one):
    def money(c):
        return P.to_decimal(c, 12, 2)

    def report(c):
        return P.bad_number(c, P.DECIMAL, P.negative_text(c))

    assert one(lambda c: silver.missing_or(money(c), money(c) < 0), "-0.004") is False
    assert one(report, "-0.004") is True
    assert one(report, "-0.00") is False
    assert one(report, "abc") is True and one(report, None) is True
    assert [one(P.above_one_text, v) for v in ("1", "1.0000", "1.00004", "0.99", "10", "2", "001.5", "00.5")] == [
        False, False, True, False, True, True, True, False]


@pytest.mark.parametrize("raw, instant", [
    ("2026-09-01T00:00:00.200001Z", dt.datetime(2026, 9, 1, 0, 0, 0, 200001)),
    ("2026-09-01 05:00+07", dt.datetime(2026, 8, 31, 22)), ("2026-09-01T05:00:00+0700", dt.datetime(2026, 8, 31, 22)),
    (" 2026-09-01T05:00:00,5-07:30 ", dt.datetime(2026, 9, 1, 12, 30, 0, 500000)),
    ("2026-09-01T05:00:00", None), ("2026-13-01T00:00:00Z", None), ("yesterday", None), ("", None), ("2026-09-01", None),
])
def test_source_times_need_an_offset(one, spark, raw, instant):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(lambda c: P.parse_utc_timestamp(c).cast("timestamp_ntz"), raw) == instant
    assert one(P.lacks_offset, raw) is (raw in ("2026-09-01T05:00:00", "2026-09-01"))


def test_signature_skips_nulls_but_the_record_hash_keeps_blanks(spark, one):
    assert one(lambda a, b, c: X.row_signature(a, b, c), "a", None, "b") == hashlib.md5(b"a|b").hexdigest()
    spec = specs.ENTITIES["order_items"]
    row = dict.fromkeys(spec.csv_columns, "") | {"order_item_id": " 5", "operation": "I", "business_date": "2026-09-01"}
    got = spark.createDataFrame([tuple(row[c] for c in spec.csv_columns)], spec.csv_schema).select(
        K.source_record_hash(spec).alias("h")).collect()[0]["h"]
    assert got == hashlib.sha256("\x1f".join(["order_items", *row.values()]).encode()).hexdigest()


def test_product_key_takes_sixty_bits(one):
    digest = hashlib.md5(b"7|Home").hexdigest()
    assert one(lambda a, b: K.product_key(a, b), 7, "Home") == int(digest[:15], 16)


def test_calendar_parts_use_iso_weekdays(spark):
    rows = spark.createDataFrame([(dt.date(2026, 9, 6),), (dt.date(2026, 9, 7),)], "d date").select(*K.calendar_parts(F.col("d"))).collect()
    assert rows[0].asDict() == {
        "date_key": 20260906, "full_date": dt.date(2026, 9, 6), "year": 2026, "quarter": 3, "month": 9, "month_name": "September",
        "day": 6, "day_of_week": 7, "day_name": "Sunday", "is_weekend": True}
    assert rows[1]["day_of_week"] == 1 and rows[1]["is_weekend"] is False


def test_stored_types_reject_bad_values(one):
    assert one(lambda c: P.to_stored_type(c, "boolean"), " Yes ") is True
    assert one(lambda c: P.to_stored_type(c, "boolean"), "") is None
    assert one(lambda c: P.to_stored_type(c, "int"), "7") == 7
    for value, kind in (("maybe", "boolean"), ("x", "int"), ("2026-02-30", "date"), ("2026-09-01T00:00:00", "timestamp")):
        with pytest.raises(Exception, match="(?i)invalid|malformed|cast"):
            one(lambda c, kind=kind: P.to_stored_type(c, kind), value)
