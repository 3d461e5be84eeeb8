"""Connected components of a link table by large-star and small-star steps.

Each round points every node at the smallest node it knows and lets larger neighbours know it too,
so paths shorten geometrically. A round is two grouped minima, combined before they are shuffled,
and two joins whose crowded keys Spark splits. Rounds are written tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch


def star_step(scratch: Scratch, links: DataFrame, step: int) -> DataFrame:
    """One large-star and one small-star step over ordered links (high, low).

    Minima are stored before they are joined: Spark splits the crowded keys of a join only where both
    sides come straight from a shuffle.
    """
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = scratch.save(both.groupBy("high").agg(F.least(F.min("low"), F.col("high")).alias("root")), f"large-least-{step}")
    larger = links.select(F.col("low").alias("high"), F.col("high").alias("node"))
    large = larger.join(least, "high").select(F.col("node").alias("high"), F.col("root").alias("low"))
    # A node's own root is below it or the node itself; the first kind stays a link.
    own = least.where("root < high").select("high", F.col("root").alias("low"))
    large = scratch.save(large.unionByName(own).where("high > low").distinct(), f"large-{step}")

    least = scratch.save(large.groupBy("high").agg(F.min("low").alias("root")), f"small-least-{step}")
    small = large.join(least, "high").where("low > root").select(F.col("low").alias("high"), F.col("root").alias("low"))
    after = scratch.save(small.unionByName(least.select("high", F.col("root").alias("low"))).distinct(), f"links-{step}")
    for name in ("large-least", "large", "small-least"):
        scratch.drop(f"{name}-{step}")
    scratch.drop(f"links-{step - 1}")
    return after


def components(scratch: Scratch, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node reachable) for every node that is not its own component."""
    ordered = links.where(f"{a} is not null and {b} is not null and {a} != {b}").select(
        F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()
    links = scratch.save(ordered, "links-0")
    before, step = None, 0
    while True:
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)"))).first()
        if seen == before or seen[0] == 0:
            return links.select(F.col("high").alias("node"), F.col("low").alias("component"))
        before, step = seen, step + 1
        links = star_step(scratch, links, step)
