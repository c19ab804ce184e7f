"""Whole runs, stored and repeated."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from apptflow.operators import survey as su
from apptflow.plans import registry, runs
from apptflow.plans.clinic import AS_OF, SURVEY_AFTERNOON, Clinic
from apptflow.session import run_scope
from apptflow.sources import sinks


def marked(messages, as_of):
    return messages.select("kind", "key").withColumn("sent_at", F.lit(as_of).cast("timestamp_ntz"))


def test_appointment_run_twice_sends_nothing_new(spark, sf, tmp_path):
    c = Clinic(spark, sf)
    outbox, ledger = str(tmp_path / "outbox"), str(tmp_path / "ledger")

    def run(i):
        messages = runs.appointment_run(c.appointment_tables, sinks.read_ledger(spark, ledger), AS_OF, c.online_services)
        n = messages.count()
        runs.store_run(messages, outbox, i, lambda m: marked(m, AS_OF), ledger)
        return n

    first = run(1)
    assert first > 0
    assert run(2) == 0
    # lost after the messages: the repeat writes the same folder and then the marks
    other = str(tmp_path / "other")
    with run_scope(spark):
        messages = runs.appointment_run(c.appointment_tables, sinks.read_ledger(spark, other), AS_OF, c.online_services)
        sinks.write_run(messages, outbox, 1)
        runs.store_run(messages, outbox, 1, lambda m: marked(m, AS_OF), other)
    assert sinks.read_ledger(spark, other).count() == first
    stored = spark.read.parquet(outbox)
    assert stored.count() == stored.select("kind", "key").distinct().count() == sinks.read_ledger(spark, ledger).count()


def test_survey_run_hours_and_repeat(spark, sf):
    c = Clinic(spark, sf)
    empty = spark.createDataFrame([], sinks.LEDGER_SCHEMA)
    args = (registry.BRANCH_LINKS, registry.SURVEY_RULES)
    assert runs.survey_run(c.survey_tables, empty, datetime(2024, 1, 15, 10, 59), *args) is None
    messages, coded = runs.survey_run(c.survey_tables, empty, SURVEY_AFTERNOON, *args)
    sent = marked(messages, SURVEY_AFTERNOON)
    marks = su.survey_checked_marks(coded, messages, messages.selectExpr("kind", "key", "true AS ok"), SURVEY_AFTERNOON)
    assert messages.count() > 0
    again, _ = runs.survey_run(c.survey_tables, sent.unionByName(marks), SURVEY_AFTERNOON, *args)
    assert again.count() == 0
    # the day after, both marks are forgotten
    late = su.of_day(sent.unionByName(marks), datetime(2024, 1, 16, 11))
    assert late.count() == 0
