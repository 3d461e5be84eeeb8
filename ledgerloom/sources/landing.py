"""Reading one landed batch: four CSV files (or directories of part files) in one directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.text import normalise_operation
from ledgerloom.sources.store import Files
from ledgerloom.specs import ENTITIES, EntitySpec

FIRST_DATA_ROW = 2
BROADCAST_SPLITS = 50_000
ARRIVAL_DATE = r"/(\d{4}-\d{2}-\d{2})/"
# RFC 4180 quoting: a doubled quote inside a quoted field, nothing trimmed.
CSV_OPTIONS = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def entity_path(directory: str, spec: EntitySpec) -> str:
    return f"{directory.rstrip('/')}/{spec.name}.csv"


def entity_paths(directories: str | list[str], spec: EntitySpec) -> list[str]:
    return [entity_path(d, spec) for d in ([directories] if isinstance(directories, str) else directories)]


def landed_paths(spark: SparkSession, directories: str | list[str], spec: EntitySpec) -> list[str]:
    """Those of an entity's paths that are there."""
    files = Files(spark)
    return [p for p in entity_paths(directories, spec) if files.exists(p)]


def missing_files(spark: SparkSession, directory: str) -> list[str]:
    found = set(Files(spark).names(directory))
    return [f"{name}.csv" for name in ENTITIES if f"{name}.csv" not in found]


def require_files(spark: SparkSession, directory: str) -> None:
    absent = missing_files(spark, directory)
    if absent:
        raise FileNotFoundError(f"Missing source files in {directory}: {', '.join(absent)}")


def plain_path(path: Column) -> Column:
    """A file's path without scheme and escapes, however Spark spells it."""
    return F.regexp_replace(F.url_decode(path), "^[a-z0-9]+:/+|^/+", "")


def inventory(spark: SparkSession, directories: str | list[str], spec: EntitySpec) -> DataFrame:
    """file and bytes of every landed file of an entity; contents are not read, and only empty files are listed here."""
    paths = landed_paths(spark, directories, spec)
    empty = spark.createDataFrame([(f, 0) for p in paths for f in Files(spark).empty_files(p)], "file string, bytes bigint")
    if not paths:
        return empty
    listed = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    return listed.where(~F.element_at(F.split("file", "/"), -1).rlike("^[_.]")).unionByName(empty)


def scan_files(spark: SparkSession, directories: str | list[str], spec: EntitySpec) -> DataFrame:
    """file, found (its first line) and spans_lines (some quoted field has a line break) of one entity's files.

    One pass over the lines; a line inside such a field holds an odd number of quotes. An empty file has no first line.
    """
    files = inventory(spark, directories, spec).withColumn("_name", plain_path(F.col("file")))
    paths = landed_paths(spark, directories, spec)
    if not paths:
        return files.select("file", F.lit(None).cast("string").alias("found"), F.lit(False).alias("spans_lines"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_path"), place.alias("_place"), (quotes % 2 == 1).alias("_odd"))
    scanned = lines.groupBy(plain_path(F.col("_path")).alias("_name")).agg(
        F.min_by("value", "_place").alias("found"), F.max("_odd").alias("spans_lines"))
    return files.join(scanned, "_name", "left").select("file", "found", F.coalesce("spans_lines", F.lit(False)).alias("spans_lines"))


def is_header(line: Column, spec: EntitySpec) -> Column:
    """Whether a line, read as CSV, holds exactly the contract's names in order."""
    places = [f"c{k}" for k in range(len(spec.csv_columns) + 1)]
    read = F.from_csv(line, ", ".join(f"{p} string" for p in places), {"quote": '"', "escape": '"'})
    same = [read[p] == name for p, name in zip(places, spec.csv_columns, strict=False)]
    fits = F.lit(True)
    for one in same:
        fits = fits & F.coalesce(one, F.lit(False))
    # A further field is one too many, even an empty one.
    unquoted = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    return F.coalesce(fits & (commas == len(spec.csv_columns) - 1), F.lit(False))


def header_report(spark: SparkSession, directories: str | list[str]) -> DataFrame:
    """Each landed file's first line and whether it is the expected header; an empty file has none."""
    frames = [
        scan_files(spark, directories, spec).select(F.lit(name).alias("entity"), "file", "found", is_header(F.col("found"), spec).alias("is_expected"))
        for name, spec in ENTITIES.items()
    ]
    report = frames[0]
    for frame in frames[1:]:
        report = report.unionByName(frame)
    return report


def check_headers(spark: SparkSession, directory: str) -> None:
    """Names and order must equal the contract in every file of a batch; the first wrong file is named."""
    wrong = header_report(spark, directory).where("not is_expected").orderBy("file").limit(1).collect()
    if wrong:
        expected = ENTITIES[wrong[0]["entity"]].csv_columns
        raise ValueError(f"{wrong[0]['file']} begins with {wrong[0]['found']!r} instead of {expected}")


def read_entity_csv(spark: SparkSession, directories: str | list[str], spec: EntitySpec) -> DataFrame:
    """All columns of one or more batches as text, missing values empty, operation normalised.

    Files are split between tasks, except those in which a quoted field spans lines: these are
    read whole, as a split could start inside a field. Only where a delivery has files of both kinds are
    they named one by one; else two flags come back and Spark lists the directories itself.
    """
    scanned = scan_files(spark, directories, spec)
    kinds = {r["spans_lines"] for r in scanned.select("spans_lines").distinct().collect()}
    if len(kinds) < 2:
        files = {whole: landed_paths(spark, directories, spec) for whole in kinds}
    else:
        named = scanned.select("file", "spans_lines").collect()
        files = {whole: [r["file"] for r in named if r["spans_lines"] is whole] for whole in kinds}
    reader = spark.read.options(**CSV_OPTIONS).schema(spec.csv_schema)
    parts = [reader.option("multiLine", whole).csv(files[whole]) for whole in sorted(kinds)] or [spark.createDataFrame([], spec.csv_schema)]
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in spec.columns]
    shaped = [
        raw.select(
            *texts,
            normalise_operation(F.col("operation")).alias("operation"),
            F.coalesce("source_updated_at", F.lit("")).alias("source_updated_at"),
            F.coalesce("business_date", F.lit("")).alias("business_date"),
            F.col("_metadata.file_path").alias("_file") if kinds else F.lit("").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block") if kinds else F.lit(0).cast("bigint").alias("_block"),
            F.monotonically_increasing_id().alias("_at"),
        )
        for raw in parts
    ]
    return shaped[0] if len(shaped) == 1 else shaped[0].unionByName(shaped[1])


def arrival_date(file_path: Column) -> Column:
    """The logical date in a landed file's path."""
    return F.to_date(F.regexp_extract(file_path, ARRIVAL_DATE, 1))


def with_row_number(read: DataFrame) -> DataFrame:
    """Number rows as in the file (the part files of one batch being one), the first data row being 2.

    Inside a split the reader's order is file order. Counts per split, summed over earlier
    splits, give each split's start; that table has one row per split, not per record.
    """
    splits = read.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole_file = F.regexp_extract("_file", r"^(.*?\.csv)", 1)
    order = W.partitionBy(whole_file).orderBy("_file", "_block")
    earlier = F.sum("_rows").over(order.rowsBetween(W.unboundedPreceding, -1))
    starts = splits.select(
        "_file", "_block", (F.coalesce(earlier, F.lit(0)) + FIRST_DATA_ROW - F.col("_first")).alias("_shift")
    )
    # A file has one split per block of it, so files and tasks bound the number of splits.
    splits_at_most = 2 * len(read.inputFiles()) + read.rdd.getNumPartitions()
    if splits_at_most <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    numbered = read.join(starts, ["_file", "_block"])
    return numbered.withColumn("source_row_number", (F.col("_at") + F.col("_shift")).cast("bigint")).drop(
        "_block", "_at", "_shift"
    )


def entity_checksum(spark: SparkSession, directory: str, spec: EntitySpec) -> DataFrame:
    """entity and file_checksum: a fold of the digests of all lines and their numbers.

    Every line is hashed in its task together with its number in the delivery; the four quarters of the digests are
    summed per task and then over tasks, and the sums, the number of lines and whether the last one is ended
    are hashed. So no row holds a file, files of any size are cut into splits, and neither the splits nor the
    part files of a delivery matter: parts in name order are one file, with the first part's header.
    """
    lines = spark.read.option("lineSep", "\n").text(entity_path(directory, spec)).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_at"))
    split = lines.groupBy("_file", "_block").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_lines"), F.sum(F.octet_length("value") + 1).alias("_bytes"), F.max("_size").alias("_size"))
    order = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    has_header = (F.col("_block") == 0).cast("int")
    earlier = F.coalesce(F.sum(F.col("_lines") - has_header).over(order), F.lit(0))
    # One row per split; the lines after a header count from 2.
    starts = split.select("_file", "_block", "_first", (earlier + FIRST_DATA_ROW - has_header - F.col("_first")).alias("_shift"), earlier.alias("_earlier"))
    numbered = lines.join(starts, ["_file", "_block"])
    is_header_line = (F.col("_block") == 0) & (F.col("_at") == F.col("_first"))
    numbered = numbered.where(~is_header_line | (F.col("_earlier") == 0)).withColumn("_number", F.col("_at") + F.col("_shift"))
    digest = F.sha2(F.concat(F.col("_number").cast("string"), F.lit(":"), F.col("value")).cast("binary"), 256)
    quarters = [F.conv(F.substring(digest, 16 * k + 1, 16), 16, 10).cast("decimal(20,0)") for k in range(4)]
    sums = numbered.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(q), F.lit(0)).cast("string").alias(f"q{k}") for k, q in enumerate(quarters)])
    ended = split.groupBy("_file").agg((F.sum("_bytes") - F.max("_size")).alias("open")).agg(F.coalesce(F.max_by("open", "_file"), F.lit(0)).alias("open"))
    both = sums.withColumn("one", F.lit(1)).join(ended.withColumn("one", F.lit(1)), "one")
    folded = F.sha2(F.concat_ws(":", "q0", "q1", "q2", "q3", F.col("n").cast("string"), F.col("open").cast("string")), 256)
    return both.select(F.lit(spec.name).alias("entity"), folded.alias("file_checksum"))


def file_checksums(spark: SparkSession, directory: str) -> DataFrame:
    """The checksum of each entity's file or part files."""
    frames = [entity_checksum(spark, directory, spec) for spec in ENTITIES.values()]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def manifest_checksum(checksums: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One checksum over a batch's sorted file checksums (four per batch)."""
    joined = F.array_join(F.sort_array(F.collect_list("file_checksum")), "")
    return checksums.groupBy(*(keys or [])).agg(F.sha2(joined, 256).alias("manifest_checksum"))
