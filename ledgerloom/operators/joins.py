"""Lookup joins that stay balanced when one key, or NULL, holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unsent(parent: DataFrame) -> DataFrame:
    """A join's side that grows with the data, never to be sent whole to the driver and all tasks.

    Spark's estimate of a side is a share of its compressed files: a stored key counts as less than two bytes, a hash of a
    derived row as fewer than its source row has. Whatever the threshold, such a side is then broadcast at many times it.
    """
    return parent.hint("merge")


def lookup(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Left join ``child`` to a ``parent`` that is unique on ``keys``.

    A key, or NULL, that holds much of the child makes one large partition of the join's shuffle.
    Adaptive execution splits such partitions at run time and repeats only the parent's few rows of
    them, without counting keys first. For that ``parent`` has to be a stored table or a projection of one.
    """
    return child.join(unsent(parent), keys, "left")


def unmatched_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent, counted per key; NULL counts as unmatched.

    Counting before the anti-join leaves one row per distinct key to shuffle.
    """
    counted = child.groupBy(key).agg(F.count("*").alias("n_records"))
    return counted.join(unsent(parent.select(key)), key, "left_anti")


def presence(df: DataFrame, marker: Column | None = None) -> DataFrame:
    """Exactly one row even when ``df`` is empty; ``df`` must hold at most one row."""
    one = df.sparkSession.range(1).select(F.lit(1).alias("_present"))
    flagged = df.withColumn("_present", F.lit(1) if marker is None else marker)
    return one.join(flagged, "_present", "left").drop("_present")
