"""Streaming the landing directory into the raw layer, under the same contract as a batch load.

The stream watches for files; the file source's checkpoint remembers which it has seen. Whenever files
of a dated directory arrive and all four entities are there, the date is loaded: header,
row and reference rules are checked, versions that are known already are left out, and rows become
visible together through the date's batch row. A batch that breaks a rule is refused as a whole; its
errors are kept with the attempt and its state says failed, and the stream goes on with other dates.

A replayed micro-batch or a re-delivered directory loads nothing twice: the batch state makes it a no-op.
Rows delivered again under a later date break the rule that a row's time lies on its date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans.control import ControlError
from ledgerloom.plans.pipeline import Pipeline
from ledgerloom.plans.validate import BatchRejected
from ledgerloom.sources.landing import arrival_date, missing_files

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
# What refuses a batch; anything else stops the stream.
REFUSALS = (BatchRejected, ControlError, ValueError)


def arrivals(pipeline: Pipeline, directory: str, files_at_once: int | None = None) -> DataFrame:
    """Paths of files that arrive in dated directories; their bytes are not read here."""
    reader = pipeline.spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.load(directory).select("path")


def load_dates(pipeline: Pipeline, directory: str, paths: DataFrame) -> dict[str, str]:
    """Load every date that some of ``paths`` belong to and that is complete; what became of each."""
    outcome = {}
    dates = paths.select(arrival_date(F.col("path")).alias("day")).where("day is not null").distinct().orderBy("day")
    for day in [row["day"] for row in dates.collect()]:  # one row per delivered date
        place = f"{directory.rstrip('/')}/{day}"
        if missing_files(pipeline.spark, place):
            outcome[str(day)] = "incomplete"
            continue
        try:
            result = pipeline.load(day, place)
            outcome[str(day)] = "known" if result["idempotent_noop"] else "loaded"
        except REFUSALS as refusal:
            outcome[str(day)] = f"refused: {refusal}"
    return outcome


def start_ingest(pipeline: Pipeline, directory: str, checkpoint: str, outcomes: dict[str, str] | None = None,
                 files_at_once: int | None = None) -> StreamingQuery:
    """Load everything that has arrived since the last run, then stop; ``outcomes`` collects what became of dates."""
    def load(paths: DataFrame, _: int) -> None:
        found = load_dates(pipeline, directory, paths)
        if outcomes is not None:
            outcomes.update(found)

    return (
        arrivals(pipeline, directory, files_at_once).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def ingest_all(pipeline: Pipeline, directory: str, checkpoint: str, files_at_once: int | None = None) -> dict[str, str]:
    """Run the stream to the end of what has arrived; gives what became of each date."""
    outcomes: dict[str, str] = {}
    start_ingest(pipeline, directory, checkpoint, outcomes, files_at_once).awaitTermination()
    return outcomes
