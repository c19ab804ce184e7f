"""Every registered query against its SQL on the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from apptflow.plans.registry import QUERIES
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, sf, name):
    ok, note = compare(spark, con, sf, name)
    assert ok, note


@pytest.mark.parametrize(
    "name", ["new_appointments", "doctor_reminders", "payment_due_soon", "online_user_load", "survey_candidates"]
)
def test_same_rows_when_nothing_is_broadcast(spark, con, sf, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ok, note = compare(spark, con, sf, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["kind", "key", "recipient", "msisdn", "text", "send_time"]
    assert df.count() >= 1
