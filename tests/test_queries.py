"""Every registered query against its DuckDB counterpart on the smallest driver tables."""

from __future__ import annotations

import hashlib
from pathlib import Path

import check_oracles
import pytest
from conftest import SMALL

import __spark_entry__ as registry
from ledgerloom.catalog.oracle import ORACLES
from ledgerloom.catalog.queries import QUERIES

# These depend on the bytes Spark's writers choose, so only their rows are checked.
ROWS_ONLY = {"file_checksum"}


@pytest.fixture(scope="module")
def duck():
    return check_oracles.connect(SMALL)


def test_only_byte_dependent_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_duckdb(spark, duck, name):
    verdict, rows, _ = check_oracles.compare(spark, duck, name, SMALL)
    assert verdict in ("ok", "rows only"), verdict
    assert rows > 0 or name in {"data_test_suite"}


def test_file_checksums_hash_the_landed_parts(spark):
    from ledgerloom.catalog.warehouse import warehouse

    w = warehouse(spark, SMALL)
    got = {(str(r.logical_date), r.entity): r.file_checksum for r in QUERIES["file_checksum"](spark, SMALL).collect()}
    for (date, entity), checksum in got.items():
        parts = sorted(Path(w.landing(date), f"{entity}.csv").glob("part-*.csv"))
        hashes = [hashlib.sha256(p.read_bytes()).hexdigest() for p in parts]
        assert checksum == (hashes[0] if len(hashes) == 1 else hashlib.sha256("".join(hashes).encode()).hexdigest())
    assert len(got) == 12


def test_entry_gives_order_lines(spark):
    df = registry.entry(spark)
    assert df.columns == ["order_item_id", "order_id", "product_key", "promotion_key", "quantity", "unit_price", "line_total", "attributed_to_promo"]
    assert df.count() > 0
