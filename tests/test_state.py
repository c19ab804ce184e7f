"""Streams with state: failure latch, once a day, late rows."""

from __future__ import annotations

import random
import shutil
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from apptflow.operators import monitoring as mo
from apptflow.streaming import appointments as st
from apptflow.streaming.daily import start_once_a_day
from apptflow.streaming.failures import start_failure_alerts
from apptflow.streaming.latch import start_failure_latch
from apptflow.streaming.late import PROGRESS, catch_up, start_with_late_rows
from tests.test_streaming import land_events, rows

def failed():
    return F.col("event_type") == "error"



def done(query) -> None:
    ended = query.awaitTermination(100)
    if not ended:
        query.stop()
    assert ended


def run_latch(spark, events, folder, out, checkpoint, late="1 minute"):
    stream = st.read_stream(spark, folder, events.schema, files_per_trigger=1)
    done(start_failure_latch(stream, out, checkpoint, "user_id", "ts", failed(), {}, 2, tie_col="event_id", late=late))


def alerts_of(spark, events):
    runs = mo.failure_runs(events, "user_id", "ts", failed(), {}, 2, tie_col="event_id")
    return rows(runs.where("alert_at IS NOT NULL").select("source", "alert_at"))


def test_latch_equals_batch_over_a_restart(spark, sf, tmp_path):
    landed, folder, out = str(tmp_path / "landed"), str(tmp_path / "events"), str(tmp_path / "out")
    events = land_events(spark, sf, landed)
    # an event of nobody a minute after the last one lets the watermark pass it
    last = events.selectExpr("-1L AS event_id", "max(ts) OVER () + INTERVAL '2' MINUTE AS ts", "-1L AS user_id", "'x' AS event_type").limit(1)
    spark.read.parquet(landed).where("dayofmonth(ts) <= 10").coalesce(1).write.parquet(folder)
    run_latch(spark, events, folder, out, str(tmp_path / "cp"))
    before = rows(spark.read.parquet(out).select("source", "alert_at"))
    spark.read.parquet(landed).where("dayofmonth(ts) BETWEEN 11 AND 20").coalesce(1).write.mode("append").parquet(folder)
    spark.read.parquet(landed).where("dayofmonth(ts) > 20").coalesce(1).write.mode("append").parquet(folder)
    last.coalesce(1).write.mode("append").parquet(folder)
    run_latch(spark, events, folder, out, str(tmp_path / "cp"))
    got = rows(spark.read.parquet(out).select("source", "alert_at"))
    assert got == alerts_of(spark, events) and len(got) > len(before) > 0


def test_latch_orders_what_comes_out_of_order(spark, tmp_path):
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    at = lambda m: datetime(2024, 1, 15, 12) + timedelta(minutes=m)
    story = [(i, at(i), 1, "error" if i % 7 else "ok") for i in range(40)] + [(90, at(41), None, "error"), (91, None, 1, "error")]
    events = spark.createDataFrame(story, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    order = sorted(story, key=lambda r: random.Random(r[0]).random() + (r[1].minute // 10 if r[1] else 0))
    for k in range(0, len(order), 12):
        spark.createDataFrame(order[k : k + 12], events.schema).coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([(99, at(120), 2, "ok")], events.schema).coalesce(1).write.mode("append").parquet(folder)
    run_latch(spark, events, folder, out, str(tmp_path / "cp"), late="30 minutes")
    got = rows(spark.read.parquet(out).select("source", "alert_at"))
    assert got == alerts_of(spark, events) and len(got) == 6


def test_latch_without_its_state_is_an_error(spark, sf, tmp_path):
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    events = land_events(spark, sf, folder)
    run_latch(spark, events, folder, out, str(tmp_path / "cp"))
    shutil.copytree(tmp_path / "cp", tmp_path / "lost", ignore=shutil.ignore_patterns("state"))
    events.limit(5).coalesce(1).write.mode("append").parquet(folder)
    with pytest.raises(PySparkException):
        run_latch(spark, events, folder, out, str(tmp_path / "lost"))


def test_alerts_in_batches_do_not_start_again_at_0(spark, sf, tmp_path):
    folder, out, empty = str(tmp_path / "events"), str(tmp_path / "out"), str(tmp_path / "elsewhere")
    events = land_events(spark, sf, folder)

    def run(path):
        stream = st.read_stream(spark, folder, events.schema, files_per_trigger=1)
        done(start_failure_alerts(stream, path, str(tmp_path / "cp"), "user_id", "ts", failed(), {}, 2, tie_col="event_id"))

    run(out)
    kept = spark.read.parquet(f"{out}/open").select("run_id").distinct()
    assert sorted(r.run_id for r in kept.collect()) == [1, 2]  # only what a repeat can ask for
    events.limit(5).coalesce(1).write.mode("append").parquet(folder)
    with pytest.raises(PySparkException):
        run(empty)


# ------------------------------------------------------------------------ once a day

ASKED = "pcode long, ts timestamp_ntz, schedid long"


def first_of_day(asked, known=()):
    best = {}
    for p, ts, s in asked:
        if p is not None and ts is not None and (p, ts.date()) not in known:
            key = (p, ts.date())
            best[key] = min(best.get(key, (ts, s)), (ts, s))
    return sorted((p, ts, s) for (p, _), (ts, s) in best.items())


def test_once_a_day_equals_batch_over_two_days(spark, tmp_path):
    rng = random.Random(8)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    begin = datetime(2024, 1, 15, 10)
    asked = sorted(
        ((rng.randrange(30), begin + timedelta(minutes=rng.randrange(60 * 34)), i) for i in range(300)),
        key=lambda r: r[1],
    )
    asked += [(None, begin, 900), (3, None, 901)]
    marks = [(su, str(p), begin - timedelta(hours=1 + 30 * old)) for su, p, old in (("survey", 1, 0), ("survey", 2, 1), ("other", 3, 0), ("survey", "x", 0), ("survey", 5, 0))]
    marks.append(("survey", "5", begin))
    ledger = spark.createDataFrame(marks, "kind string, key string, sent_at timestamp_ntz")

    def run(part):
        spark.createDataFrame(part, ASKED).coalesce(1).write.mode("append").parquet(folder)
        stream = st.read_stream(spark, folder, ASKED, files_per_trigger=1)
        done(start_once_a_day(stream, out, str(tmp_path / "cp"), "pcode", "ts", ledger, "survey", begin))

    for k in range(0, len(asked), 80):  # every start but the first goes on with its state
        run(asked[k : k + 80])
    known = {(1, date(2024, 1, 15)), (5, date(2024, 1, 15))}
    assert rows(spark.read.parquet(out).select("pcode", "ts", "schedid")) == first_of_day(asked, known)


def test_days_are_forgotten(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    noon = datetime(2024, 1, 15, 12)

    def run(schedid):
        spark.createDataFrame([(1, noon, schedid)], ASKED).coalesce(1).write.mode("append").parquet(folder)
        stream = st.read_stream(spark, folder, ASKED)
        done(start_once_a_day(stream, out, str(tmp_path / "cp"), "pcode", "ts", keep=timedelta(seconds=1)))
        return sorted(r.schedid for r in spark.read.parquet(out).collect())

    assert run(1) == [1]
    time.sleep(2)
    assert run(2) == [1, 2]


def test_a_ledger_to_start_from_needs_its_kind(spark, tmp_path):
    ledger = spark.createDataFrame([], "kind string, key string, sent_at timestamp_ntz")
    folder = str(tmp_path / "in")
    spark.createDataFrame([], ASKED).write.parquet(folder)
    with pytest.raises(ValueError):
        start_once_a_day(st.read_stream(spark, folder, ASKED), folder, folder, "pcode", "ts", ledger)


# -------------------------------------------------------------------------- late rows


def test_stream_and_catch_up_take_every_key_once(spark, tmp_path):
    rng = random.Random(3)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    noon = datetime(2024, 1, 15, 12)
    arrived = [(i, noon + timedelta(minutes=i / 4), i % 9) for i in range(400)]
    arrived += rng.sample(arrived, 150)  # seen by two polls
    arrived += [(1000 + i, None, 0) for i in range(3)]
    rng.shuffle(arrived)
    arrived.sort(key=lambda r: (r[0] // 60 if rng.random() < 0.8 else rng.randrange(8)))
    schema = "schedid long, createdate timestamp_ntz, pcode long"
    size = len(arrived) // 6 + 1
    for k in range(0, len(arrived), size):
        spark.createDataFrame(arrived[k : k + size], schema).coalesce(1).write.mode("append").parquet(folder)
    for checkpoint in ("cp1", "cp2"):  # the second pass repeats every batch
        stream = st.read_stream(spark, folder, schema, files_per_trigger=1)
        done(start_with_late_rows(stream, out, str(tmp_path / checkpoint), ["schedid"], "createdate"))
        progress = spark.read.schema(PROGRESS).parquet(f"{out}/progress").agg(
            *[F.sum(c) for c in ("taken", "repeated", "late", "undated")]
        ).first()
        assert sum(progress) == len(arrived)  # no row is lost uncounted
        assert progress[3] == 3 and progress[2] > 20 and progress[1] > 20
        taken = [r.schedid for r in spark.read.parquet(f"{out}/taken").collect()]
        assert len(taken) == len(set(taken)) == progress[0] < 400
        late = spark.read.parquet(f"{out}/late")
        assert late.count() == progress[2] + progress[3]
    for run in (1, 1, 2):
        n = catch_up(spark, out, ["schedid"], "createdate", run)
        caught = [r.schedid for r in spark.read.parquet(f"{out}/caught").collect()]
        assert sorted(taken + caught) == list(range(400))
        assert n == (400 - len(taken) if run == 1 else 0)
