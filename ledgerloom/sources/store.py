"""Layer tables: immutable version directories and one small pointer file per table."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"
POINTER = "_current"
BUCKET = "key_bucket"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/ledgerloom/{purpose}-{uuid.uuid4().hex}"


class Files:
    """The few file-system calls a DataFrame writer does not offer."""

    def __init__(self, spark: SparkSession):
        self._sc = spark.sparkContext
        self._hadoop = self._sc._jvm.org.apache.hadoop.fs
        self._conf = self._sc._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._hadoop.Path(path)
        return target, target.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        target, fs = self._at(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        target, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []

    def data_files(self, path: str) -> list[str]:
        """The file itself, or the visible files of a directory in name order."""
        target, fs = self._at(path)
        if not fs.exists(target):
            return []
        found = [s.getPath() for s in fs.listStatus(target) if s.isFile()]
        return sorted(p.toString() for p in found if p.getName()[0] not in "_.")

    def empty_files(self, path: str) -> list[str]:
        """Those data files without a byte, which Spark's readers leave out; the others are not gathered."""
        target, fs = self._at(path)
        listed, found = fs.listLocatedStatus(target), []
        while listed.hasNext():
            status = listed.next()
            if status.isFile() and status.getLen() == 0 and status.getPath().getName()[0] not in "_.":
                found.append(status.getPath().toString())
        return found

    def read_text(self, path: str) -> str:
        target, fs = self._at(path)
        stream = fs.open(target)
        try:
            return self._sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, path: str, text: str) -> None:
        """Write beside the target, then rename over it: readers see the old text or the new."""
        beside, fs = self._at(f"{path}.{uuid.uuid4().hex}")
        fs.mkdirs(beside.getParent())
        stream = fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        modes = self._sc._gateway.new_array(self._hadoop.Options.Rename, 1)
        modes[0] = self._hadoop.Options.Rename.OVERWRITE
        context = self._hadoop.FileContext.getFileContext(beside.toUri(), self._conf)
        context.rename(beside, self._hadoop.Path(path), modes)

    def move(self, source: str, target: str) -> None:
        start, fs = self._at(source)
        end = self._hadoop.Path(target)
        fs.mkdirs(end.getParent())
        if not fs.rename(start, end):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        target, fs = self._at(path)
        fs.delete(target, True)


def layer_path(root: str, layer: str) -> str:
    """A layer's name is its directory, without any prefix."""
    return f"{root}/{layer.strip()}"


class TableStore:
    """Full-rebuild tables under one root. One writer per store is a precondition."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        self._schemas: dict[str, T.StructType] = {}

    def path(self, layer: str, name: str) -> str:
        return f"{layer_path(self.root, layer)}/{name}"

    def exists(self, layer: str, name: str) -> bool:
        return self.files.exists(f"{self.path(layer, name)}/{POINTER}")

    def write(self, df: DataFrame, layer: str, name: str, partition_by: list[str] | None = None) -> None:
        """Write a new version, then swap the pointer; a failed write leaves the old version current.

        The version before stays for readers that began with it; older ones and remains of failed writes go.
        The swap needs a file system whose rename is atomic; an object store without one is no place for a root.
        """
        version, base = f"v-{uuid.uuid4().hex}", self.path(layer, name)
        before = self.files.read_text(f"{base}/{POINTER}").strip() if self.exists(layer, name) else None
        writer = df.write.mode("errorifexists").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path(layer, name)}/{version}")
        self.files.replace_text(f"{self.path(layer, name)}/{POINTER}", version)
        for old in self.files.names(base):
            if old.startswith("v-") and old not in (version, before):
                self.files.remove(f"{base}/{old}")
        self._schemas[f"{layer}/{name}"] = df.schema

    def read(self, layer: str, name: str, schema: T.StructType | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The current version; of a bucketed table all buckets, or those named."""
        base = self.path(layer, name)
        version = self.files.read_text(f"{base}/{POINTER}").strip()
        known = schema or self._schemas.get(f"{layer}/{name}")
        if not version.startswith("{"):
            return (self.spark.read.schema(known) if known else self.spark.read).parquet(f"{base}/{version}")
        kept = json.loads(version)
        known = known or T.StructType.fromJson(kept["schema"])
        paths = [f"{base}/{v}/{BUCKET}={b}" for b, v in kept["buckets"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(known).parquet(*paths) if paths else self.spark.createDataFrame([], known)

    def bucket_count(self, layer: str, name: str) -> int:
        """Into how many buckets a stored table is cut; 0 where it is not."""
        text = self.files.read_text(f"{self.path(layer, name)}/{POINTER}") if self.exists(layer, name) else ""
        return json.loads(text)["count"] if text.startswith("{") else 0

    def write_buckets(self, df: DataFrame, layer: str, name: str, key: str, count: int, replaced: list[int] | None = None) -> None:
        """Replace the ``replaced`` buckets of a table (all, unless named) by those of ``df``; others keep their files.

        The pointer lists the version directory of every bucket, so one rename shows all new buckets at once.
        Directories that neither the new list nor the one before names are removed.
        """
        version, base = f"v-{uuid.uuid4().hex}", self.path(layer, name)
        text = self.files.read_text(f"{base}/{POINTER}").strip() if self.exists(layer, name) else ""
        before = json.loads(text)["buckets"] if text.startswith("{") else {}
        dealt = df.withColumn(BUCKET, key_bucket(key, count))
        dealt.repartition(BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{base}/{version}")
        written = {n.split("=")[1] for n in self.files.names(f"{base}/{version}") if n.startswith(f"{BUCKET}=")}
        stays = {b: v for b, v in before.items() if replaced is not None and int(b) not in replaced}
        after = stays | dict.fromkeys(written, version)
        self.files.replace_text(f"{base}/{POINTER}", json.dumps({"count": count, "buckets": after, "schema": df.schema.jsonValue()}))
        named = {(v, b) for kept in (before, after) for b, v in kept.items()}
        for old in self.files.names(base):
            if old.startswith("v-") and old not in (version, text):
                inside = [n for n in self.files.names(f"{base}/{old}") if n.startswith(f"{BUCKET}=")]
                gone = [n for n in inside if (old, n.split("=")[1]) not in named]
                for n in [""] if len(gone) == len(inside) else gone:
                    self.files.remove(f"{base}/{old}/{n}".rstrip("/"))
        self._schemas[f"{layer}/{name}"] = df.schema


def key_bucket(key: str, buckets: int) -> Column:
    """The bucket of a raw key; a null key has one too."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key), F.lit(""))), F.lit(buckets)).cast("int")
