from __future__ import annotations

import datetime as dt

import pytest

from ledgerloom.plans import control, monitor

AS_OF = "2026-09-10 00:00:00"
RUNS = ("dag_id string, run_id string, execution_date timestamp, run_type string, state string, queued_at timestamp, "
        "start_date timestamp, end_date timestamp")


def batch(day, status="completed", received=100, started=None, rejected=0):
    at = started or dt.datetime(2026, 9, day, 22)
    return (f"p:{day}", "retail_daily", dt.date(2026, 9, day), "multiple", "c", at, None, status, received, 0, 0, 0, rejected, None, None, "a")


def batches(spark, rows):
    return spark.createDataFrame(rows, control.BATCHES)


def run(hour, state):
    at = dt.datetime(2026, 9, 9, hour)
    return ("retail_daily", f"r{hour}", at, "scheduled", state, at, at, None)


def test_missing_state_still_gives_one_row(spark):
    none = spark.createDataFrame([], control.WATERMARKS)
    assert float(monitor.watermark_age(none, AS_OF).collect()[0].hours) == 999999
    alert = monitor.alert_watermark_stale(none, AS_OF).collect()[0]
    assert alert.fires and alert.value == 999999
    no_runs = spark.createDataFrame([], RUNS)
    assert monitor.latest_run_state(no_runs).collect()[0].state == 0
    assert not monitor.alert_latest_run_failed(no_runs).collect()[0].fires
    assert float(monitor.run_success_rate(no_runs, AS_OF).collect()[0].percent) == 0
    healthy = monitor.alert_batch_stuck(batches(spark, []), AS_OF).collect()[0]
    assert (healthy.fires, healthy.batch_id, healthy.status, healthy.pipeline_name) == (False, "none", "healthy", "retail_daily")
    assert not monitor.alert_rejected_rows(batches(spark, [])).collect()[0].fires


@pytest.mark.parametrize("states, code", [(["failed", "success"], 1), (["success", "failed"], 4), (["skipped"], 9), (["queued"], 3)])
def test_newest_run_decides_the_state(spark, states, code):
    runs = spark.createDataFrame([run(h, s) for h, s in enumerate(states)], RUNS)
    assert monitor.latest_run_state(runs).collect()[0].state == code
    assert monitor.alert_latest_run_failed(runs).collect()[0].fires is (code == 4)


def test_watermark_alert_uses_thirty_six_hours(spark):
    for hours, fires in ((36, False), (37, True)):
        at = dt.datetime(2026, 9, 10) - dt.timedelta(hours=hours)
        mark = spark.createDataFrame([("retail_daily", dt.date(2026, 9, 8), "b", at, at)], control.WATERMARKS)
        assert monitor.alert_watermark_stale(mark, AS_OF).collect()[0].fires is fires


def test_only_batches_open_for_an_hour_are_stuck(spark):
    now = dt.datetime(2026, 9, 10)
    rows = [batch(1, "failed"), batch(2, "ingested", started=now - dt.timedelta(minutes=61)),
            batch(3, "started", started=now - dt.timedelta(minutes=60)), batch(4)]
    frame = batches(spark, rows)
    assert monitor.batches_stale(frame, AS_OF).collect()[0].batches == 2
    worst = monitor.alert_batch_stuck(frame, AS_OF).collect()[0]
    assert (worst.fires, worst.batch_id, worst.logical_date) == (True, "p:2", "2026-09-02")


def test_volume_needs_seven_predecessors(spark):
    def percent(rows):
        return [r.percent for r in monitor.volume_vs_trailing(batches(spark, rows)).collect()]

    seven = [batch(d, received=100) for d in range(1, 8)]
    assert [float(p) for p in percent([*seven, batch(8, received=125)])] == [125.0]
    assert percent(seven) == [None]
    assert percent([]) == []
    assert [float(p) for p in percent([batch(1, received=9999), *[batch(d) for d in range(2, 9)], batch(9, received=50)])] == [50.0]
    assert percent([*[batch(d, received=0) for d in range(1, 8)], batch(8)]) == [None]


def test_watermark_moves_forward_only(spark):
    def mark(day, batch_id):
        at = dt.datetime(2026, 9, 1)
        return ("p", None if day is None else dt.date(2026, 9, day), batch_id, at, at)

    for old, new, kept in ((1, 2, "new"), (2, 1, "old"), (2, 2, "new"), (None, 1, "new")):
        frames = [spark.createDataFrame([mark(d, b)], control.WATERMARKS) for d, b in ((old, "old"), (new, "new"))]
        assert [r.batch_id for r in control.advance_watermark(*frames).collect()] == [kept]


def test_failures_keep_a_short_message_and_count_a_rejection(spark):
    frame = batches(spark, [batch(1, "started"), batch(2, "started", rejected=7)])
    failures = spark.createDataFrame([("p:1", "x" * 5000, dt.datetime(2026, 9, 1)), ("p:2", "y", dt.datetime(2026, 9, 1))],
                                     "batch_id string, message string, failed_at timestamp")
    got = {r.batch_id: r for r in control.fail_batches(frame, failures).collect()}
    assert len(got["p:1"].error_message) == 4000 and got["p:1"].rows_rejected == 1 and got["p:2"].rows_rejected == 7
    assert {r.status for r in got.values()} == {"failed"}


def test_starting_resets_open_batches_and_leaves_published_ones(spark):
    frame = batches(spark, [batch(1, "failed", received=5), batch(2, "ingested", received=6)])
    starting = spark.createDataFrame(
        [("retail_daily", dt.date(2026, 9, d), "new", dt.datetime(2026, 9, 9), "b") for d in (1, 2, 3)],
        "pipeline_name string, logical_date date, file_checksum string, started_at timestamp, attempt_id string")
    frame = frame.withColumn("batch_id", control.batch_id(frame.pipeline_name, frame.logical_date))
    got = {r.logical_date.day: r for r in control.start_batches(frame, starting).collect()}
    assert [(got[d].status, got[d].rows_received, got[d].file_checksum) for d in (1, 2, 3)] == [
        ("started", 0, "new"), ("ingested", 6, "c"), ("started", 0, "new")]


def test_other_pipelines_and_jobs_do_not_show(spark):
    old, new = dt.datetime(2026, 9, 3), dt.datetime(2026, 9, 9, 23)
    marks = spark.createDataFrame([("other", old.date(), "o", old, old), ("retail_daily", new.date(), "m", new, new)], control.WATERMARKS)
    assert not monitor.alert_watermark_stale(marks, AS_OF).collect()[0].fires
    assert monitor.alert_watermark_stale(marks, AS_OF, "other").collect()[0].fires
    stuck = ("other", *batch(9, "failed")[1:])
    mixed = batches(spark, [batch(8), (stuck[0], "other", *stuck[2:])])
    assert not monitor.alert_batch_stuck(mixed, AS_OF).collect()[0].fires
    assert monitor.alert_batch_stuck(mixed, AS_OF, "other").collect()[0].batch_id == "other"
    runs = spark.createDataFrame([run(1, "success"), ("other", *run(1, "failed")[1:]), ("other", *run(2, "queued")[1:6], None, None)], RUNS)
    at = dt.datetime(2026, 9, 9, 1)
    tasks = spark.createDataFrame([(j, "r1", t, "success", 1, at, at, 1.0) for j, t in (("retail_daily", "mine"), ("other", "theirs"))],
                                  "dag_id string, run_id string, task_id string, state string, try_number int, start_date timestamp, end_date timestamp, duration double")
    assert [r.task_id for r in monitor.latest_run_tasks(tasks, runs).collect()] == ["mine"]
    assert float(monitor.latest_run_duration(runs, AS_OF, "other").collect()[0].seconds) == 0
    assert monitor.run_history(runs, AS_OF, ("2026-09-09 02:00:00", "2026-09-10 00:00:00")).count() == 0
