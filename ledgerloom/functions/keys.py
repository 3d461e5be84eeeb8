"""Derived keys, hashes, calendar parts and clock arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import specs

MICRO = "0.000001"


def product_key(product_id: Column, category: Column) -> Column:
    """A 60-bit key from the first 15 hex digits of the pair's md5."""
    digest = F.md5(F.concat(product_id.cast("string"), F.lit("|"), category))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def date_key_or_unknown(d: Column) -> Column:
    return F.coalesce(date_key(d), F.lit(specs.UNKNOWN_KEY))


def calendar_parts(d: Column) -> list[Column]:
    """Calendar columns of one day; weekdays follow ISO numbering."""
    iso_day = F.weekday(d) + 1
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (iso_day >= 6).alias("is_weekend"),
    ]


def batch_id(pipeline: Column, logical_date: Column) -> Column:
    return F.concat_ws(":", pipeline, F.date_format(logical_date, "yyyy-MM-dd"))


def source_file(entity: str, logical_date: Column) -> Column:
    return F.concat(F.lit("data/incoming/"), F.date_format(logical_date, "yyyy-MM-dd"), F.lit(f"/{entity}.csv"))


def source_record_hash(spec: specs.EntitySpec) -> Column:
    """SHA-256 over the entity name and the raw, untrimmed texts; empty strings count."""
    texts = [F.coalesce(F.col(c), F.lit("")) for c in spec.csv_columns]
    return F.sha2(F.concat_ws(specs.HASH_SEPARATOR, F.lit(spec.name), *texts), 256)


def seconds_between(start: Column, end: Column) -> Column:
    """Exact elapsed seconds with microseconds, as decimal(26,6)."""
    micros = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))).cast("decimal(19,0)")
    return (micros * F.lit(MICRO).cast("decimal(7,6)")).cast("decimal(26,6)")


def rounded(c: Column) -> Column:
    """One decimal place, halves away from zero."""
    return F.round(c, 1).cast("decimal(18,1)")


def duration_seconds(start: Column, end: Column, as_of: Column) -> Column:
    return seconds_between(start, F.coalesce(end, as_of))


def age_hours(at: Column, as_of: Column) -> Column:
    return (seconds_between(at, as_of) / F.lit(3600)).cast("decimal(26,6)")
