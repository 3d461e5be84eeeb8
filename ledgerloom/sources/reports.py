"""Report sinks: a profile as JSON, and a small summary as one CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_profile(profile: DataFrame, path: str) -> None:
    profile.write.mode("overwrite").json(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """At most one row per declared check, hence one file."""
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
