"""Plan shapes that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from apptflow.operators import appointments as ap
from apptflow.operators import ledger as lg
from apptflow.operators import monitoring as mo
from apptflow.operators import payments as pa
from apptflow.operators import services as sv
from apptflow.plans.clinic import AS_OF, Clinic
from apptflow.plans.registry import QUERIES
from apptflow.sources import sinks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_rows(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups)", plan)


def test_poll_reads_one_day_of_a_partitioned_schedule(spark, sf, tmp_path):
    path = str(tmp_path / "schedule")
    c = Clinic(spark, sf)
    c.schedule.write.partitionBy("workdate").parquet(path)
    stored = spark.read.parquet(path)
    online = ap.online_appointments(stored)
    plan = plan_of(online.where(ap.starts_within(AS_OF, 360)))
    scan = [line for line in plan.split("\n") if "FileScan" in line and "onlinetype" in line][0]
    assert "PartitionFilters: [isnotnull(workdate" in scan and "2024-01-15" in scan
    new = plan_of(online.where(ap.created_within(AS_OF, 600)))
    scan = [line for line in new.split("\n") if "FileScan" in line and "onlinetype" in line][0]
    assert "GreaterThanOrEqual(createdate" in scan and "EqualTo(onlinetype,1)" in scan
    due = plan_of(pa.due_appointments(stored, AS_OF).select("schedid"))
    scans = [line for line in due.split("\n") if "FileScan" in line]
    assert "GreaterThanOrEqual(createdate" in scans[0]
    assert "PartitionFilters: [isnotnull(workdate" in scans[1]


@pytest.mark.parametrize("broadcast", [True, False])
def test_history_is_filtered_by_picked_keys_before_it_is_summed(spark, sf, broadcast):
    c = Clinic(spark, sf)
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(pa.payment_candidates(c.payment_tables, [10], pa.due_appointments(c.schedule, AS_OF)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # payments meet the picked keys before they are summed
    assert plan.count("LeftSemi") >= 6
    # the picked rows were written once; no branch scans the schedule for them again
    assert "/picked-" in plan and "createdate >=" not in plan


def test_a_few_candidates_do_not_move_the_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    marks = spark.range(2000).selectExpr(
        "'new' AS kind", "cast(id AS string) AS key", "timestamp_ntz'2024-01-15 09:00:00' AS sent_at"
    )
    sinks.append_ledger(marks, path, 1)
    cands = spark.createDataFrame([("new", "1"), ("new", "x")], "kind string, key string")
    unsent = lg.unsent_notifications(cands, sinks.read_ledger(spark, path), AS_OF.replace(hour=0))
    assert [r.key for r in unsent.collect()] == ["x"]
    plan = plan_of(unsent)
    ledger_side = [line for line in plan.split("\n") if "FileScan" in line and "sent_day" in line]
    assert ledger_side and all("PartitionFilters: [isnotnull(sent_day" in line for line in ledger_side)
    # the ledger is read next to the keys: no exchange between its scan and the semi join
    lines = plan.split("\n")
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    scan = next(i for i, line in enumerate(lines) if i > semi and "FileScan" in line and "sent_day" in line)
    assert "BroadcastHashJoin" in lines[semi]
    assert not any("Exchange hashpartitioning" in line for line in lines[semi:scan])
    day = plan_of(lg.of_day(sinks.read_ledger(spark, path), AS_OF))
    assert "PartitionFilters: [isnotnull(sent_day" in day


def test_ledger_rank_is_limited_before_the_shuffle(spark, sf):
    c = Clinic(spark, sf)
    plan = plan_of(lg.ledger_rollover(c.ledger))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_failure_runs_never_order_a_whole_source(spark, sf):
    c = Clinic(spark, sf)
    events = c.raw("events")
    plan = plan_of(mo.failure_runs(events, "user_id", "ts", F.col("event_type") == "error", {}, 3, "event_id"))
    # windows by source alone run on chunk summaries only, after an aggregate
    by_source = [m for m in re.findall(r"Window \[(.*)", plan) if "ts#" in m and "chunk#" not in m]
    assert not by_source


def test_null_keys_are_spread_in_a_shuffled_join(spark, sf):
    c = Clinic(spark, sf)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        flagged = sv.with_service_flag(c.schedule, c.plan_detail, c.sched_detail, [10])
        assert re.search(r"hashpartitioning\(planid#\d+L?, _null_spread", plan_of(flagged))
        assert flagged.count() == c.schedule.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
