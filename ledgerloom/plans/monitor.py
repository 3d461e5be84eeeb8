"""Monitoring queries over control state and run history, as of an explicit moment.

The tables may hold several pipelines and jobs; every query looks at one of them. Queries that a
dashboard shows for a time range take ``span``, a pair of moments with both ends included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions.keys import age_hours, duration_seconds, rounded
from ledgerloom.operators.joins import lookup, presence
from ledgerloom.plans.control import COUNTS

TABLE_ROWS = 100
PIPELINE = specs.DEFAULT_PIPELINE
Span = tuple[str, str] | None
RUN_STATE_CODES = {"success": 1, "running": 2, "queued": 3, "failed": 4}
OTHER_STATE, NO_RUN = 9, 0
WATERMARK_LIMIT_HOURS = 36
TROUBLED = ["failed", "upstream_failed", "up_for_retry"]


def moment(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def within(df: DataFrame, column: str, since: str, until: str) -> DataFrame:
    """Rows of a dashboard's time range, both ends included."""
    return df.where(F.col(column).between(moment(since), moment(until)))


def of_pipeline(df: DataFrame, pipeline: str) -> DataFrame:
    return df.where(F.col("pipeline_name") == pipeline)


def of_job(df: DataFrame, job: str) -> DataFrame:
    return df.where(F.col("dag_id") == job)


def batches_of(batches: DataFrame, pipeline: str, span: Span) -> DataFrame:
    mine = of_pipeline(batches, pipeline)
    return mine if span is None else mine.where(F.col("logical_date").cast("timestamp").between(*map(moment, span)))


def runs_of(runs: DataFrame, job: str, span: Span) -> DataFrame:
    mine = of_job(runs, job)
    return mine if span is None else within(mine, "execution_date", *span)


def newest(df: DataFrame, column: str, n: int = TABLE_ROWS, *ties: str) -> DataFrame:
    """Top rows by a column, newest first."""
    return df.orderBy(F.col(column).desc(), *ties).limit(n)


# --- batches -----------------------------------------------------------------

def in_trouble(as_of: str) -> Column:
    """Failed, or started or ingested more than an hour ago and not completed."""
    overdue = F.col("started_at") < moment(as_of) - F.expr("interval 60 minutes")
    return (F.col("status") == "failed") | (F.col("status").isin("started", "ingested") & overdue)


def batches_stale(batches: DataFrame, as_of: str, pipeline: str = PIPELINE) -> DataFrame:
    return of_pipeline(batches, pipeline).agg(F.count_if(in_trouble(as_of)).alias("batches"))


def latest_completed(batches: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    return of_pipeline(batches, pipeline).where("status = 'completed'").agg(F.max("logical_date").alias("logical_date"))


def batch_history(batches: DataFrame, as_of: str, span: Span = None, pipeline: str = PIPELINE) -> DataFrame:
    seconds = rounded(duration_seconds(F.col("started_at"), F.col("completed_at"), moment(as_of)))
    rows = batches_of(batches, pipeline, span).select(
        "logical_date", "status", "started_at", "completed_at", seconds.alias("duration_s"), *COUNTS, "error_message"
    )
    return newest(rows, "logical_date")


def batches_unfinished(batches: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    rows = of_pipeline(batches, pipeline).where("status <> 'completed'")
    return newest(rows, "logical_date").select("batch_id", "logical_date", "status", "started_at", "error_message")


def batch_row_metrics(batches: DataFrame, span: Span = None, pipeline: str = PIPELINE) -> DataFrame:
    return batches_of(batches, pipeline, span).select("logical_date", *[F.col(c).cast("double").alias(c) for c in COUNTS]).orderBy("logical_date")


def volume_vs_trailing(batches: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    """Newest completed volume as a percentage of the average of the seven before it.

    Only the eight newest dates are ranked; with fewer than seven predecessors it is NULL.
    """
    recent = newest(of_pipeline(batches, pipeline).where("status = 'completed'"), "logical_date", 8)
    ranked = recent.withColumn("_rank", F.row_number().over(W.orderBy(F.col("logical_date").desc())))
    earlier = F.when(F.col("_rank") > 1, F.col("rows_received"))
    both = ranked.agg(
        F.max(F.when(F.col("_rank") == 1, F.col("rows_received"))).alias("_latest"),
        F.sum(earlier).cast("decimal(19,0)").alias("_sum"), F.count(earlier).alias("_n"),
    ).where("_latest is not null")
    ratio = F.lit(700).cast("decimal(5,0)") * F.col("_latest").cast("decimal(19,0)") / F.col("_sum")
    percent = F.when((F.col("_n") == 7) & (F.col("_sum") != 0), rounded(ratio))
    return both.select(percent.alias("percent"))


def latest_files(files: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    rows = newest(of_pipeline(files, pipeline), "logical_date", TABLE_ROWS, "source_file")
    return rows.select(
        "logical_date", "source_file", F.substring("file_checksum", 1, 12).alias("checksum"), "status", *COUNTS,
        "completed_at",
    )


# --- watermark ---------------------------------------------------------------

def watermark_age(watermarks: DataFrame, as_of: str, pipeline: str = PIPELINE) -> DataFrame:
    """Age in hours; a missing watermark gives a very large age. A pipeline has one watermark."""
    one = presence(of_pipeline(watermarks, pipeline).agg(F.max("updated_at").alias("updated_at")))
    return one.select(F.coalesce(age_hours(F.col("updated_at"), moment(as_of)), F.lit(specs.MISSING_AGE)).cast(
        "decimal(26,6)").alias("hours"))


def watermark_state(watermarks: DataFrame, as_of: str, pipeline: str = PIPELINE) -> DataFrame:
    return of_pipeline(watermarks, pipeline).select(
        "pipeline_name", "last_logical_date", "batch_id", "last_source_updated_at", "updated_at",
        rounded(age_hours(F.col("updated_at"), moment(as_of))).alias("age_hours"),
    )


# --- run history -------------------------------------------------------------

def latest_run_state(runs: DataFrame, job: str = PIPELINE) -> DataFrame:
    """A code for the newest run's state; no run at all has its own code."""
    code = F.lit(OTHER_STATE)
    for state, number in RUN_STATE_CODES.items():
        code = F.when(F.col("state") == state, number).otherwise(code)
    top = newest(of_job(runs, job), "execution_date", 1).select(code.alias("code"))
    return presence(top).select(F.coalesce("code", F.lit(NO_RUN)).cast("double").alias("state"))


def latest_run_duration(runs: DataFrame, as_of: str, job: str = PIPELINE) -> DataFrame:
    """Seconds of the newest run; one that has not started yet has taken none."""
    seconds = duration_seconds(F.col("start_date"), F.col("end_date"), moment(as_of))
    nothing = F.lit(0).cast("decimal(26,6)")
    return newest(of_job(runs, job), "execution_date", 1).select(F.coalesce(seconds, nothing).alias("seconds"))


def run_success_rate(runs: DataFrame, as_of: str, job: str = PIPELINE) -> DataFrame:
    recent = of_job(runs, job).where(F.col("execution_date") >= moment(as_of) - F.expr("interval 7 days"))
    share = F.lit(100).cast("decimal(5,0)") * F.count_if(F.col("state") == "success").cast("decimal(19,0)") / F.nullif(
        F.count("*").cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return recent.agg(F.coalesce(rounded(share), F.lit(0).cast("decimal(18,1)")).alias("percent"))


def run_daily_counts(runs: DataFrame, span: Span = None, job: str = PIPELINE) -> DataFrame:
    return runs_of(runs, job, span).groupBy(F.date_trunc("day", "execution_date").alias("day")).agg(
        F.count_if(F.col("state") == "success").cast("double").alias("success"),
        F.count_if(F.col("state") == "failed").cast("double").alias("failed"),
    ).orderBy("day")


def run_history(runs: DataFrame, as_of: str, span: Span = None, job: str = PIPELINE) -> DataFrame:
    seconds = rounded(duration_seconds(F.col("start_date"), F.col("end_date"), moment(as_of)))
    return newest(runs_of(runs, job, span), "execution_date").select(
        "execution_date", "run_id", "run_type", "state", "queued_at", "start_date", "end_date", seconds.alias("duration_s")
    )


def run_durations(runs: DataFrame, as_of: str, span: Span = None, job: str = PIPELINE) -> DataFrame:
    seconds = duration_seconds(F.col("start_date"), F.col("end_date"), moment(as_of))
    return runs_of(runs, job, span).where("start_date is not null").select(
        "execution_date", seconds.alias("seconds")
    ).orderBy("execution_date")


def run_failures(runs: DataFrame, span: Span = None, job: str = PIPELINE) -> DataFrame:
    return newest(runs_of(runs, job, span).where("state = 'failed'"), "execution_date").select(
        "execution_date", "run_id", "state", "start_date", "end_date"
    )


# --- task history ------------------------------------------------------------

def with_run(tasks: DataFrame, runs: DataFrame, span: Span, job: str) -> DataFrame:
    """Task rows of one job's known runs with the run's date, balanced when one run has most tasks."""
    dated = runs_of(runs, job, span).select("dag_id", "run_id", "execution_date")
    keys, tasks = ["dag_id", "run_id"], of_job(tasks, job)
    return lookup(tasks, dated, keys).where("execution_date is not null")


def latest_run_tasks(tasks: DataFrame, runs: DataFrame, job: str = PIPELINE) -> DataFrame:
    """Tasks of the newest run, by name. The run side is one row."""
    run = F.broadcast(newest(of_job(runs, job), "execution_date", 1).select("dag_id", "run_id"))
    seconds = rounded(F.col("duration").cast("decimal(18,6)"))
    return tasks.join(run, ["dag_id", "run_id"], "left_semi").select(
        "task_id", "state", "try_number", "start_date", "end_date", seconds.alias("duration_s")
    ).orderBy("task_id", "start_date").limit(TABLE_ROWS)


def task_durations(tasks: DataFrame, runs: DataFrame, span: Span = None, job: str = PIPELINE) -> DataFrame:
    return with_run(tasks.where("duration is not null"), runs, span, job).select(
        "execution_date", F.col("duration").alias("value"), F.col("task_id").alias("metric")
    ).orderBy("execution_date")


def task_runs(tasks: DataFrame, runs: DataFrame, span: Span = None, job: str = PIPELINE) -> DataFrame:
    return with_run(tasks, runs, span, job).select(
        "execution_date", "run_id", "task_id", "state", "try_number", "start_date", "end_date"
    )


def task_failures(tasks: DataFrame, runs: DataFrame, span: Span = None, job: str = PIPELINE) -> DataFrame:
    troubled = task_runs(tasks.where(F.col("state").isin(TROUBLED)), runs, span, job)
    return newest(troubled, "execution_date", TABLE_ROWS, "task_id", "start_date")


def task_retries(tasks: DataFrame, runs: DataFrame, span: Span = None, job: str = PIPELINE) -> DataFrame:
    """Retries per task, summed per run and task before the join to runs."""
    retries = F.greatest(F.col("try_number") - 1, F.lit(0)).cast("bigint")
    summed = of_job(tasks, job).groupBy("dag_id", "run_id", "task_id").agg(F.sum(retries).alias("retries"))
    known = summed.join(runs_of(runs, job, span).select("dag_id", "run_id"), ["dag_id", "run_id"], "left_semi")
    return known.groupBy(F.col("task_id").alias("task")).agg(F.sum("retries").alias("retries")).orderBy(
        F.col("retries").desc(), "task")


# --- alerts: one row each, with the value and whether it fires -----------------

def _alert(df: DataFrame, value: Column, fires: Column, *labels: Column) -> DataFrame:
    return df.select(value.cast("double").alias("value"), fires.alias("fires"), *labels)


def alert_latest_run_failed(runs: DataFrame, job: str = PIPELINE) -> DataFrame:
    top = presence(newest(of_job(runs, job), "execution_date", 1).select("state"))
    failed = F.coalesce(F.col("state") == "failed", F.lit(False))
    return _alert(top, failed.cast("int"), failed)


def alert_watermark_stale(watermarks: DataFrame, as_of: str, pipeline: str = PIPELINE) -> DataFrame:
    age = watermark_age(watermarks, as_of, pipeline)
    return _alert(age, F.col("hours"), F.col("hours") > WATERMARK_LIMIT_HOURS)


def alert_batch_stuck(batches: DataFrame, as_of: str, pipeline: str = PIPELINE) -> DataFrame:
    """The newest failed or stuck batch with its labels, or a healthy row."""
    worst = newest(of_pipeline(batches, pipeline).where(in_trouble(as_of)), "logical_date", 1).select(
        "pipeline_name", "batch_id", F.col("logical_date").cast("string").alias("logical_date"), "status"
    )
    bad = F.col("batch_id").isNotNull()
    defaults = {"pipeline_name": pipeline, "batch_id": "none", "logical_date": "none", "status": "healthy"}
    labels = [F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()]
    return _alert(presence(worst), bad.cast("int"), bad, *labels)


def alert_high_severity(report: DataFrame) -> DataFrame:
    total = report.where("severity = 'high'").agg(F.sum("affected_row_count").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return _alert(total, n, n > 0)


def alert_rejected_rows(batches: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    top = presence(newest(of_pipeline(batches, pipeline), "logical_date", 1).select("rows_rejected"))
    n = F.coalesce("rows_rejected", F.lit(0))
    return _alert(top, n, n > 0)
