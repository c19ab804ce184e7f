from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from apptflow.operators.conferences import conference_snapshot, page_chain_gaps
from apptflow.sources import files, sinks, tables

NOON = datetime(2024, 1, 15, 12)
LEDGER = "kind string, key string, sent_at timestamp_ntz"


def test_missing_table_fails_the_job(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_read_table_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    path = str(tmp_path / fmt)
    df.write.format(fmt).save(path)
    assert tables.read_table(spark, path, fmt, schema=df.schema).collect() == df.collect()


def test_query_binds_only_named_parameters(spark):
    t = spark.createDataFrame([(1,), (2,)], "id long")
    got = tables.query(spark, "SELECT id FROM {t} WHERE id = :wanted", {"wanted": 2, "unused": 3}, t=t)
    assert [r.id for r in got.collect()] == [2]
    assert tables.query(spark, "SELECT id FROM {t}", None, t=t).count() == 2


def test_new_files_by_age_and_ledger(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    now = datetime(2024, 1, 15, 12)
    for name, minutes in (("new", 119), ("edge", 120), ("old", 121), ("known", 5)):
        path = folder / f"{name}.txt"
        path.write_text(name)
        stamp = (now - timedelta(minutes=minutes) - datetime(1970, 1, 1)).total_seconds()
        os.utime(path, (stamp, stamp))
    listed = files.list_files(spark, str(folder), "*.txt")
    known = listed.where("file LIKE '%known%'").first().file
    ledger = spark.createDataFrame([("file", known, NOON)], LEDGER)
    got = files.new_files(spark, str(folder), ledger, now)
    assert sorted(r.file.rsplit("/", 1)[1] for r in got.collect()) == ["edge.txt", "new.txt"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_pages_from_a_folder(spark, tmp_path):
    for i, nxt in ((1, 2), (3, -1)):
        body = {"cnt": 2, "next_page_id": nxt, "conferences": [{"id": str(i), "owner": "a@b", "type": 3}]}
        (tmp_path / f"{i}.json").write_text(json.dumps(body))
    pages = files.read_pages(spark, str(tmp_path))
    assert sorted((r.id, r.owner, r.type) for r in conference_snapshot(pages).collect()) == [
        ("1", "a", "role-based"),
        ("3", "a", "role-based"),
    ]
    assert [r.missing_page for r in page_chain_gaps(pages).collect()] == [2]


def test_ledger_table_by_day(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert sinks.read_ledger(spark, path).count() == 0
    for d in (14, 15):
        marks = spark.createDataFrame([("new", str(d), datetime(2024, 1, d, 9))], LEDGER)
        sinks.append_ledger(marks, path, d)
    assert sinks.read_ledger(spark, path).count() == 2
    today = sinks.read_ledger(spark, path, since=NOON)
    assert [r.key for r in today.collect()] == ["15"]
    plan = today._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sent_day" in plan


def test_an_empty_repeat_leaves_nothing(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    df = spark.createDataFrame([("k", "1", NOON)], LEDGER)
    for rows, left in ((df, 1), (df.limit(0), 0), (df, 1)):
        sinks.write_run(rows, out, 1)
        sinks.append_ledger(rows, ledger, 1)
        assert spark.read.schema(LEDGER + ", run_id int").parquet(out).count() == left
        assert sinks.read_ledger(spark, ledger).count() == left


def test_repeated_run_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("k", "1"), ("k", "2")], "kind string, key string")
    for run in (1, 2, 1):
        outbox = sinks.read_or_empty(spark, path, "kind string, key string, run_id int")
        sinks.write_run(sinks.unsent_in_outbox(df, outbox, run), path, run)
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(path).where(F.col("run_id") == 2).count() == 0
