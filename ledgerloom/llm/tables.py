"""Session settings, intermediate tables and digests shared by the corpus operators."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.store import fresh_dir

#: Texts can be long, so Arrow batches are bounded by bytes as well as by rows. Shuffle files go
#: as soon as the statement that wrote them has ended; what later steps need is a written table.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> None:
    """Apply the settings to this session and give executors this package; every operator calls it first."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not getattr(context, "_ledgerloom_shipped", False):
        # Spark serves the archive to every executor, wherever the driver found the package.
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/ledgerloom", "zip", package.parent, package.name)
        context.addPyFile(archive)
        context._ledgerloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; whatever Spark can read a path of."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables in the folder the executors share. They cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = fresh_dir(spark, purpose)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the stored table."""
        path = f"{self.root}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        gateway = self.spark.sparkContext
        for name in names:
            path = gateway._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(gateway._jsc.hadoopConfiguration()).delete(path, True)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def sha256_hex(c):
    """Lower-case hex SHA-256 of a binary or string column."""
    return F.sha2(c.cast("binary"), 256)


def digest_of(text):
    """A digest that tells the texts of rows apart where ids do not; null is as empty."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def spare_names(df: DataFrame, count: int) -> list[str]:
    """Names that no column of the table has, in whatever case Spark compares them."""
    taken = {c.lower() for c in df.columns}
    return [name for name in (f"_{k}" for k in range(count + len(taken))) if name not in taken][:count]


#: Bits of a sieve. Its table has at most SLOTS / 64 rows, whatever it was made of.
SLOTS = 1 << 23


def slot_of(*columns):
    """The word of a sieve and the bit in it that stand for a row."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(SLOTS))
    return F.floor(slot / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))


def sieve(rows: DataFrame, *names: str) -> DataFrame:
    """A table of bounded size (word, bits) that tells most other rows from these by their columns ``names``."""
    word, bit = slot_of(*[F.col(n) for n in names])
    return rows.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def sifted(rows: DataFrame, held: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may be among those the sieve was made of, and rows that surely are not."""
    word, bits = spare_names(rows, 2)
    at, bit = slot_of(*[F.col(n) for n in names])
    met = rows.withColumn(word, at).join(F.broadcast(held.toDF(word, bits)), word, "left")
    may = F.coalesce(F.col(bits).bitwiseAND(bit), F.lit(0)) != 0
    return met.where(may).drop(word, bits), met.where(~may).drop(word, bits)
