"""The stream loads complete, valid dates through the pipeline and refuses the rest."""

from __future__ import annotations

from test_pipeline import DAY1, DAY2, DAY3, deliver, first_day, row, status

from ledgerloom.plans.pipeline import Pipeline
from ledgerloom.streaming import ingest


def test_dates_are_loaded_whole_refused_whole_or_left(spark, tmp_path):
    incoming, checkpoint = tmp_path / "incoming", str(tmp_path / "checkpoint")
    pipeline = Pipeline(spark, str(tmp_path / "warehouse"))
    rows = first_day()
    rows["customers"][0]["last_name"] = "two\nlines"
    deliver(incoming, DAY1, rows)
    deliver(incoming, DAY2, rows)  # delivered again under a later date
    swapped = incoming / str(DAY3)
    deliver(incoming, DAY3, {"customers": [row("customers", "9", DAY3)]})
    text = (swapped / "orders.csv").read_text()
    (swapped / "orders.csv").write_text(text.replace("order_id,customer_id", "customer_id,order_id", 1))

    outcome = ingest.ingest_all(pipeline, str(incoming), checkpoint)
    assert outcome[str(DAY1)] == "loaded"
    assert outcome[str(DAY2)].startswith("refused") and "outside the batch date" in outcome[str(DAY2)]
    assert outcome[str(DAY3)].startswith("refused") and "begins with" in outcome[str(DAY3)]
    published = pipeline.bronze("customers").orderBy("customer_id").collect()
    assert [(r.customer_id, r.last_name, r.source_row_number, r.logical_date) for r in published] == [("1", "two\nlines", 2, DAY1), ("2", None, 3, DAY1)]
    assert [status(pipeline, d) for d in (DAY1, DAY2)] == ["ingested", "failed"]

    # Nothing new for this stream; a new one finds the loaded date known.
    assert ingest.ingest_all(pipeline, str(incoming), checkpoint) == {}
    assert ingest.ingest_all(pipeline, str(incoming), f"{checkpoint}-2", files_at_once=1)[str(DAY1)] == "known"
    assert pipeline.bronze("customers").count() == 2


def test_a_date_waits_for_its_last_file(spark, tmp_path):
    incoming, checkpoint = tmp_path / "incoming", str(tmp_path / "checkpoint")
    pipeline = Pipeline(spark, str(tmp_path / "warehouse"))
    place = tmp_path / "ready"
    deliver(place, DAY1, first_day())
    target = incoming / str(DAY1)
    target.mkdir(parents=True)
    for name in ("customers.csv", "promotions.csv", "orders.csv"):
        (target / name).write_bytes((place / str(DAY1) / name).read_bytes())
    assert ingest.ingest_all(pipeline, str(incoming), checkpoint) == {str(DAY1): "incomplete"}
    (target / "order_items.csv").write_bytes((place / str(DAY1) / "order_items.csv").read_bytes())
    assert ingest.ingest_all(pipeline, str(incoming), checkpoint) == {str(DAY1): "loaded"}
    assert pipeline.bronze("order_items").count() == 2
