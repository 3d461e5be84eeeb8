from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from ledgerloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    return local_session(cores="8", shuffle_partitions=4, memory="6g", **shared)


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column function on one value."""
    from pyspark.sql import functions as F

    def evaluate(function, *values):
        literals = [F.lit(v).cast("string") if v is None or isinstance(v, str) else F.lit(v) for v in values]
        return spark.range(1).select(function(*literals).alias("r")).collect()[0]["r"]
    return evaluate
