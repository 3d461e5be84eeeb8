"""A session with the settings the jobs rely on; a cluster's own settings win where it has them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

JOBS_AT_ONCE = 4
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def read_finely(spark: SparkSession, split: str) -> SparkSession:
    """Cut files into pieces of at most ``split`` bytes; a session that asks for smaller ones keeps them."""
    name = "spark.sql.files.maxPartitionBytes"
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if size(spark.conf.get(name)) > size(split):
        spark.conf.set(name, split)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """For tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_together(jobs: list[Callable]) -> list:
    """Submit independent Spark jobs side by side and wait for all; results in order."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=JOBS_AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]
