"""Every registered query's DuckDB SQL."""

from __future__ import annotations

from ledgerloom.catalog import oracle_batches, oracle_control  # noqa: F401  (each registers its queries)
from ledgerloom.catalog.oracle_base import ORACLES

__all__ = ["ORACLES"]
