from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from apptflow.operators import ledger as lg
from apptflow.operators import outbox as ob
from apptflow.sources import ledgers, sinks
from apptflow.sources.ledgers import append_ledger, close_days, compact_day, read_ledger, vacuum_day

DAY = date(2024, 1, 15)
NOON = datetime(2024, 1, 15, 12)


def marks(spark, *rows):
    """Rows of (kind, key, hours after noon of the 15th)."""
    data = [(k, str(key), NOON + timedelta(hours=h)) for k, key, h in rows]
    return spark.createDataFrame(data, ledgers.LEDGER_SCHEMA)


def held(spark, path, since=None):
    return sorted((r.kind, r.key, r.sent_at.day) for r in read_ledger(spark, path, since).collect())


@pytest.fixture
def ledger(spark, tmp_path):
    """Two days; run 2 left marks on both."""
    path = str(tmp_path / "ledger")
    append_ledger(marks(spark, ("new", 1, -24), ("new", 2, -24)), path, 1)
    append_ledger(marks(spark, ("new", 3, -24), ("new", 4, 0)), path, 2)
    append_ledger(marks(spark, ("soon", 4, 1)), path, 3)
    return path


ALL = [("new", "1", 14), ("new", "2", 14), ("new", "3", 14), ("new", "4", 15), ("soon", "4", 15)]


def test_a_poll_lists_no_file_of_other_days(spark, ledger):
    assert held(spark, ledger) == ALL
    today = read_ledger(spark, ledger, NOON)
    assert all("sent_day=2024-01-15" in f for f in today.inputFiles()) and today.inputFiles()
    assert held(spark, ledger, NOON) == ALL[3:]


def test_a_repeated_run_replaces_its_marks_on_every_day(spark, ledger):
    append_ledger(marks(spark, ("new", 5, 0)), ledger, 2)
    assert held(spark, ledger) == sorted([*ALL[:2], ("new", "5", 15), ALL[4]])
    append_ledger(marks(spark).limit(0), ledger, 2)
    assert held(spark, ledger) == [*ALL[:2], ALL[4]]
    append_ledger(marks(spark, ("new", 3, -24), ("new", 4, 0)), ledger, 2)
    assert held(spark, ledger) == ALL


def test_compaction_changes_no_row(spark, ledger):
    before = read_ledger(spark, ledger).inputFiles()
    assert compact_day(spark, ledger, date(2024, 1, 14))
    assert held(spark, ledger) == ALL
    assert not compact_day(spark, ledger, date(2024, 1, 14))
    files = [f for f in read_ledger(spark, ledger).inputFiles() if "sent_day=2024-01-14" in f]
    assert len(files) == 1 and files[0] not in before
    vacuum_day(spark, ledger, date(2024, 1, 14))
    vacuum_day(spark, ledger, date(2024, 1, 14))
    vacuum_day(spark, ledger, DAY)  # never compacted: nothing to remove
    assert held(spark, ledger) == ALL
    assert not compact_day(spark, ledger, date(2024, 1, 14))


def test_a_crash_leaves_the_old_rows_or_the_new(spark, ledger, monkeypatch):
    def lost(folder, day):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(ledgers, "_publish", lost)
        with pytest.raises(RuntimeError):
            compact_day(spark, ledger, date(2024, 1, 14))
    assert held(spark, ledger) == ALL  # the new base is there, but nothing names it
    assert compact_day(spark, ledger, date(2024, 1, 14))
    assert held(spark, ledger) == ALL


def test_two_compactions_do_not_both_publish(spark, ledger, monkeypatch):
    publish = ledgers._publish

    def second(folder, day):
        monkeypatch.setattr(ledgers, "_publish", publish)
        compact_day(spark, ledger, DAY)
        publish(folder, day)

    monkeypatch.setattr(ledgers, "_publish", second)
    with pytest.raises(RuntimeError, match="published by another"):
        compact_day(spark, ledger, DAY)
    assert held(spark, ledger) == ALL


@pytest.mark.parametrize("vacuumed", [False, True])
def test_a_run_repeated_after_compaction(spark, ledger, vacuumed):
    for d in (date(2024, 1, 14), DAY):
        compact_day(spark, ledger, d)
        if vacuumed:
            vacuum_day(spark, ledger, d)
    append_ledger(marks(spark, ("new", 6, -24), ("new", 4, 0)), ledger, 2)
    want = [*ALL[:2], ("new", "4", 15), ("new", "6", 14), ALL[4]]
    assert held(spark, ledger) == sorted(want)
    append_ledger(marks(spark, ("new", 6, -24), ("new", 4, 0)), ledger, 2)
    assert held(spark, ledger) == sorted(want)
    assert compact_day(spark, ledger, date(2024, 1, 14)) and compact_day(spark, ledger, DAY)
    assert held(spark, ledger) == sorted(want)
    append_ledger(marks(spark).limit(0), ledger, 2)
    append_ledger(marks(spark, ("soon", 9, 2)), ledger, 4)
    assert held(spark, ledger) == sorted([*ALL[:2], ALL[4], ("soon", "9", 15)])


def test_days_that_are_over_are_closed_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for run, back in enumerate((5, 4, 1, 0)):
        rows = [("new", f"{back}{i}", -24 * back + i / 10) for i in range(6)]
        append_ledger(marks(spark, *rows, ("soon", back, -24 * back)), path, run)
    assert close_days(spark, path, NOON, keep=2) == [date(2024, 1, d) for d in (10, 11, 14)]
    got = held(spark, path)
    # the newest two of a kind stay of days that no poll asks for any more
    assert [k for _, k, day in got if day == 10] == ["54", "55", "5"]
    assert sum(day in (14, 15) for _, _, day in got) == 14
    assert close_days(spark, path, NOON, keep=2) == []
    assert held(spark, path) == got
    append_ledger(marks(spark, ("new", "x", -24 * 5)), path, 9)  # a mark that comes late opens its day
    assert close_days(spark, path, NOON, keep=2) == [date(2024, 1, 10)]
    assert [k for kind, k, day in held(spark, path) if day == 10 and kind == "new"] == ["54", "55"]


def test_marks_need_a_time_and_runs_a_plain_name(spark, tmp_path):
    timeless = spark.createDataFrame([("new", "1", None)], ledgers.LEDGER_SCHEMA)
    with pytest.raises(Exception, match="without a time"):
        append_ledger(timeless, str(tmp_path / "a"), 1)
    with pytest.raises(ValueError):
        append_ledger(marks(spark, ("new", 1, 0)), str(tmp_path / "a"), "a/b")
    assert held(spark, str(tmp_path / "nothing")) == []


def test_a_bucketed_ledger_is_joined_where_it_lies(spark, tmp_path):
    known = spark.range(0, 3000, 3).selectExpr("'new' AS kind", "cast(id AS string) AS key", "timestamp_ntz'2024-01-15 09:00:00' AS sent_at")
    table = sinks.bucket_ledger(known, "bulk_ledger", str(tmp_path / "ledger"), buckets=8)
    cands = spark.range(3000).selectExpr("'new' AS kind", "cast(id AS string) AS key", "id AS n")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = lg.unsent_in_bulk(cands, table)
        assert left.count() == 2000
        plan = left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE bulk_ledger")
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1  # the candidates alone
    assert "Bucketed: true" in plan


def test_outbox_in_bulk_equals_the_outbox(spark):
    people = [(i, f"0{i}.01.2024", 9, 0, "8 (912) 555-01-01") for i in range(1, 9)]
    cands = spark.createDataFrame(people, "schedid long, data string, bhour int, bmin int, phone3 string")
    known = spark.createDataFrame([("new", "3", NOON)], ledgers.LEDGER_SCHEMA)
    one = ob.outbox_messages({"new": cands}, known).collect()
    assert sorted(ob.outbox_messages({"new": cands}, known, bulk=True).collect()) == sorted(one)
    assert len(one) == 7
