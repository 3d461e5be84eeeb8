"""Change feeds derived from the driver tables.

Those tables are clean, so every fault is added by arithmetic on the row key ``k``. Each
column rule is one expression in the SQL that Spark and DuckDB share, so both engines
evaluate the same text; ``bump`` is 1 in the update batch and 0 elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions.keys import batch_id, source_file
from ledgerloom.sources.bronze import to_bronze
from ledgerloom.specs import ENTITIES

ORPHAN = "'999999999'"


def text(expression: str) -> str:
    return f"cast({expression} as string)"


def money(column: str, bump: bool = True) -> str:
    added = " + cast(bump as decimal(12,2))" if bump else ""
    return text(f"cast({column} as decimal(12,2)){added}")


def pick(key: str, *entries: str) -> str:
    """The entry at ``key`` modulo the number of entries."""
    arms = " ".join(f"when {i} then '{e.replace(chr(39), chr(39) * 2)}'" for i, e in enumerate(entries))
    return f"case ({key}) % {len(entries)} {arms} end"


def padded(expression: str, width: int) -> str:
    return f"lpad({text(expression)}, {width}, '0')"


def clock(key: str) -> str:
    """A time of day from a key, as HH:MM:SS."""
    hour, minute = f"cast(floor(({key}) % 86400 / 3600) as bigint)", f"cast(floor(({key}) % 3600 / 60) as bigint)"
    return f"{padded(hour, 2)} || ':' || {padded(minute, 2)} || ':' || {padded(f'({key}) % 60', 2)}"


MIXED_SEGMENTS = ("High Value", "low-value", "MEDIUM_VALUE", "new customer", "vip", "")
MIXED_CHANNELS = ("direct", "E-mail", "EMAIL", "push", "Sms", "social", "")
MIXED_CATEGORIES = ("beauty", "Books", "CLOTHING", "electronics", "home", "sports ", "toys")
MIXED_BOOLEANS = ("TRUE", "no", "1", "F", "maybe", "")
PROMOTION_REF = (
    f"case when k % 17 = 0 then {ORPHAN} when k % 19 = 0 then '12.0' when k % 3 = 0 then {text('promo_ref')} else '' end"
)
MONTH_DAY = f"{padded('1 + k % 12', 2)} || '-' || {padded('1 + k % 28', 2)}"
DAY_28 = padded("1 + k % 28", 2)


@dataclass(frozen=True)
class FeedRule:
    """Where an entity's rows come from and how each text column is written."""

    source: str
    key: str
    carried: dict[str, str]
    columns: dict[str, str]


FEEDS: dict[str, FeedRule] = {
    "customers": FeedRule(
        "customer", "c_custkey", {"full_name": "c_name", "balance": "c_acctbal"},
        {
            "first_name": pick("k", "mary-jane", "  ALICE ", "o'neil", ""),
            "last_name": "full_name",
            "email": f"'User' || {text('k')} || '@Example.COM'",
            "phone_number": f"case when k % 9 = 0 then '-' || {text('k')} when k % 9 = 1 then 'n/a' "
                            f"when k % 9 = 2 then '' else '62812' || {padded('k % 100000000', 8)} end",
            "registration_date": "case when k % 8 = 0 then '41:02.4' when k % 8 = 1 then '2025-02-30' "
                                 f"when k % 8 = 2 then '' else '2024-' || {MONTH_DAY} || ' 08:00:00' end",
            "customer_segment": pick("k", *MIXED_SEGMENTS),
            "preferred_channel": pick("k + bump", *MIXED_CHANNELS),
            "age_group": pick("k", "18-25", "26 - 35", "3645", "46–55", "55+", "n/a"),
            "income_level": pick("k", "high", "LOW", "Medium ", "premium", "?"),
            "avg_order_value": f"case when k % 11 = 0 then 'abc' when k % 11 = 1 then '-0.004' else {money('balance')} end",
            "promo_sensitivity": f"'0.' || {padded('k % 10000', 4)}",
            "email_opt_in": pick("k", *MIXED_BOOLEANS),
            "sms_opt_in": pick("k + 1", *MIXED_BOOLEANS),
            "push_opt_in": pick("k + 2", *MIXED_BOOLEANS),
            "last_purchase_date": "case when k % 3 = 0 then '' else '2025-06-15junk' end",
            "total_lifetime_orders": f"case when k % 13 = 0 then '1.5' else {text('k % 40')} end",
            "preferred_category": pick("k", *MIXED_CATEGORIES),
        },
    ),
    "promotions": FeedRule(
        "part", "p_partkey", {"part_name": "p_name", "size": "p_size", "price": "p_retailprice"},
        {
            "campaign_name": "part_name",
            "promo_type": pick("k", "bogo", "fixed amount", "Free-Shipping", "PERCENTAGE_DISCOUNT", "gift"),
            "discount_value": f"case when k % 9 = 0 then '-' || {text('size')} when k % 9 = 1 then '' "
                              f"else {text('size + bump')} end",
            "min_order_value": money("price"),
            "start_date": f"case when k % 12 = 0 then '2026-09-' || {DAY_28} else '2026-08-' || {DAY_28} end",
            "end_date": f"case when k % 12 = 0 then '2026-08-' || {DAY_28} when k % 12 = 1 then '' "
                        f"else '2026-09-' || {DAY_28} end",
            "campaign_duration_days": text("k % 60 - 2"),
            "target_segment": pick("k", "all customers", "HIGH_VALUE", "lapsed", "Low-Value", "medium value",
                                   "New_Customer", "everyone"),
            "campaign_channel": pick("k + bump", "EMAIL", "in-app", "Push", "sms", "SOCIAL", "website banner", "radio"),
            "campaign_objective": pick("k", "acquisition", "Cross-Sell", "REACTIVATION", "retention", "upsell", "brand"),
            "target_category": pick("k", *MIXED_CATEGORIES),
            "expected_response_rate": "case when k % 10 = 0 then '1.00004' when k % 10 = 1 then '1.5' "
                                      f"when k % 10 = 2 then '-0.1' else '0.' || {padded('k % 1000', 3)} end",
            "budget_allocated": f"case when k % 14 = 0 then '-5' when k % 14 = 1 then 'x' else {text('k * 10')} end",
            "cost_per_acquisition": f"case when k % 14 = 0 then '-5' when k % 14 = 1 then 'x' else {text('k % 60')} end",
        },
    ),
    "orders": FeedRule(
        "orders", "o_orderkey",
        {"buyer": "o_custkey", "promo_ref": "o_custkey", "placed": "o_orderdate", "total": "o_totalprice"},
        {
            "customer_id": f"case when k % 29 = 0 then {ORPHAN} else {text('buyer')} end",
            "order_date": f"case when k % 31 = 0 then '' else {text('cast(placed as date)')} || ' 00:00:00' end",
            "order_status": pick("k + bump", "paid", "Pending", "cancelled", "CANCELED", "cancel", "error", "invalid", "lost"),
            "promotion_id": PROMOTION_REF,
            "order_channel": pick("k + bump", *MIXED_CHANNELS),
            "order_value": f"case when k % 23 = 0 then '-' || {money('total')} when k % 23 = 1 then '-0.004' "
                           f"when k % 23 = 2 then '' else {money('total')} end",
            "attributed_to_promo": pick("k", "yes", "no", "1", ""),
            "customer_segment_at_time": pick("k", *MIXED_SEGMENTS),
        },
    ),
    "order_items": FeedRule(
        "lineitem", "l_orderkey * 10 + l_linenumber",
        {"parent": "l_orderkey", "product": "l_partkey", "promo_ref": "l_partkey", "qty": "l_quantity",
         "price": "l_extendedprice"},
        {
            "order_id": f"case when k % 37 = 0 then {ORPHAN} else {text('parent')} end",
            "product_id": text("product"),
            "product_category": pick("product + bump", *MIXED_CATEGORIES),
            "quantity": "case when k % 16 = 0 then '0' when k % 16 = 1 then '-1' when k % 16 = 2 then 'two' "
                        f"else {text('cast(qty as bigint) + bump')} end",
            "unit_price": "case when k % 18 = 0 then '0.00' when k % 18 = 1 then '-3.50' when k % 18 = 2 then '' "
                          f"else {money('price')} end",
            "promotion_id": PROMOTION_REF,
            "attributed_to_promo": pick("k", "yes", "no", "1", ""),
        },
    ),
}


@dataclass(frozen=True)
class Change:
    """One slice of the feed: which keys change on a date, and how."""

    logical_date: str
    operation: str
    when: str
    bump: int = 0
    key_text: str = "cast(k as string)"
    business_date: str | None = None
    time_zone: str = "Z"


CHANGES = [
    Change("2026-09-01", "I", "k % 25 <> 4"),
    Change("2026-09-02", "U", "k % 10 = 3", bump=1),
    Change("2026-09-02", "D", "k % 50 = 7"),
    Change("2026-09-02", "U", "k % 41 = 0", bump=1, key_text="' ' || cast(k as string)"),
    Change("2026-09-03", "I", "k % 25 = 4", business_date="2026-09-01"),
]
DATES = ["2026-09-01", "2026-09-02", "2026-09-03"]
DIRTY_DATE = "2026-09-04"
FAR_KEY = text("k + 900000000000")

# A batch in which most rules of validation are broken by some rows.
DIRTY_CHANGES = [
    Change(DIRTY_DATE, "u", "k % 10 = 5", bump=1),
    Change(DIRTY_DATE, "I", "k % 101 = 0", key_text="'  '"),
    Change(DIRTY_DATE, "x", "k % 103 = 1"),
    Change(DIRTY_DATE, "U", "k % 107 = 2", time_zone=""),
    Change("2026-09-05", "U", "k % 109 = 3"),
    Change(DIRTY_DATE, "U", "k % 113 = 4", business_date="2026-13-01"),
    Change(DIRTY_DATE, "U", "k % 127 = 5", business_date="2026-09-09"),
    Change(DIRTY_DATE, "U", "k % 131 = 6"),
    Change(DIRTY_DATE, "U", "k % 131 = 6"),
    Change(DIRTY_DATE, "U", "k % 139 = 8", key_text=FAR_KEY),
    Change(DIRTY_DATE, "D", "k % 149 = 9", key_text=FAR_KEY),
    Change(DIRTY_DATE, "D", "k % 151 = 10"),
    Change(DIRTY_DATE, "I", "k % 157 = 11", key_text=f"{FAR_KEY} || 'n'", time_zone="+07:00"),
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a table that sits in fewer splits than there are cores to all of them.

    A table of many splits is left as it is read, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def csv_feed(spark: SparkSession, sf_dir: str, entity: str, changes: list[Change] | None = None) -> DataFrame:
    """The feed of one entity as the CSV text columns, its date and row number.

    One scan of the source table; each row explodes to the changes that apply to its key.
    """
    rule, spec = FEEDS[entity], ENTITIES[entity]
    slices = changes or CHANGES
    base = spread(read_table(spark, sf_dir, rule.source).selectExpr(
        f"{rule.key} as k", *[f"{source} as {name}" for name, source in rule.carried.items()]
    ))
    applied = [
        F.when(F.expr(c.when), F.struct(
            F.lit(i).alias("n"), F.lit(c.logical_date).alias("day"), F.lit(c.operation).alias("op"),
            F.lit(c.bump).alias("bump"), F.expr(c.key_text).alias("key_text"),
            F.lit(c.business_date or c.logical_date).alias("business"), F.lit(c.time_zone).alias("zone"),
        ))
        for i, c in enumerate(slices)
    ]
    rows = base.withColumn("change", F.explode(F.array_compact(F.array(*applied)))).select("*", "change.*")
    if entity == "order_items" and changes:
        blank = "case when k % 163 = 12 then '' else product_id end as product_id"
    else:
        blank = None
    shaped = rows.selectExpr(
        f"key_text as {spec.key}",
        *[f"{rule.columns[c]} as {c}" for c in spec.columns if c != spec.key],
        "upper(op) as operation",
        f"day || 'T' || {clock('k')} || zone as source_updated_at",
        "business as business_date",
        f"cast(2 + k * {len(slices)} + n as bigint) as source_row_number",
        "cast(day as date) as logical_date",
        "k",
    )
    if blank:
        shaped = shaped.selectExpr(*[blank if c == "product_id" else c for c in shaped.columns])
    return shaped


def as_bronze(feed: DataFrame, entity: str) -> DataFrame:
    """The feed as raw-layer rows."""
    day = F.col("logical_date")
    name = source_file(entity, day)
    ingested_at = day.cast("timestamp") + F.expr("interval 26 hours")
    return to_bronze(
        feed, ENTITIES[entity], batch_id(F.lit(specs.DEFAULT_PIPELINE), day), day, name, F.sha2(name, 256), ingested_at
    )
