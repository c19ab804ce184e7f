from __future__ import annotations

import os
import time
from datetime import datetime

from pyspark.sql import functions as F

from apptflow.operators import appointments as ap
from apptflow.operators import monitoring as mo
from apptflow.operators import outbox as ob
from apptflow.plans.clinic import AS_OF, Clinic
from apptflow.sources.sinks import LEDGER_SCHEMA
from apptflow.streaming import appointments as st
from apptflow.streaming.failures import start_failure_alerts
from apptflow.streaming.writers import start_outbox


def drain(df, tmp_path, name, mode="append"):
    query = (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", str(tmp_path / f"cp_{name}"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(180)
    return df.sparkSession.table(name)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def land_events(spark, sf, folder):
    """Three files in time order, one micro-batch each."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    for day in (1, 11, 21):
        part = events.where(F.dayofmonth("ts").between(day, day + 9 if day < 21 else 31))
        part.coalesce(1).write.mode("append").parquet(folder)
    return events


def test_failure_alert_job_equals_batch_runs(spark, sf, tmp_path):
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    events = land_events(spark, sf, folder)
    failed = F.col("event_type") == "error"
    want = mo.failure_runs(events, "user_id", "ts", failed, {}, 2, tie_col="event_id").where("alert_at IS NOT NULL")
    still = mo.open_failures(events, "user_id", "ts", failed, tie_col="event_id")
    for checkpoint in ("cp1", "cp2"):  # the second pass repeats every batch
        stream = st.read_stream(spark, folder, events.schema, files_per_trigger=1)
        query = start_failure_alerts(
            stream, out, str(tmp_path / checkpoint), "user_id", "ts", failed, {}, 2, tie_col="event_id"
        )
        assert query.awaitTermination(240)
        got = spark.read.parquet(f"{out}/alerts").select("source", "alert_at")
        assert rows(got) == rows(want.select("source", "alert_at"))
        last = spark.read.parquet(f"{out}/open").where("run_id = 2").select("source", "failures")
        assert rows(last) == rows(still)


def test_new_appointments_stream_equals_batch(spark, sf, tmp_path):
    c = Clinic(spark, sf)
    folder = str(tmp_path / "schedule")
    picked = c.schedule.where(ap.created_within(AS_OF, 3600))
    picked.unionByName(picked).write.parquet(folder)  # every booking seen twice
    stream = st.read_stream(spark, folder, picked.schema)
    got = drain(st.new_appointment_stream(stream, c.clients, "2 hours"), tmp_path, "new_rows")
    want = ap.new_appointments(c.schedule, c.clients, AS_OF, 3600)
    assert rows(got.drop("createdate").select(*want.columns)) == rows(want)
    assert got.count() > 0


def test_new_appointments_job_equals_batch(spark, sf, tmp_path):
    c = Clinic(spark, sf)
    folder, out = str(tmp_path / "schedule"), str(tmp_path / "out")
    picked = c.schedule.where(ap.created_within(AS_OF, 3600))
    picked.unionByName(picked).coalesce(1).write.parquet(folder)
    want = ap.new_appointments(c.schedule, c.clients, AS_OF, 3600)
    for checkpoint in ("cp1", "cp2"):  # the second pass repeats the batch
        stream = st.read_stream(spark, folder, picked.schema)
        query = st.start_new_appointments(stream, c.clients, out, str(tmp_path / checkpoint), "2 hours")
        assert query.awaitTermination(180)
        got = spark.read.parquet(out).select(*want.columns)
        assert rows(got) == rows(want) and got.count() > 0


def test_late_bookings_are_dropped(spark, tmp_path):
    schema = "schedid long, pcode long, createdate timestamp_ntz, emid long, onlinetype int, workdate date, bhour int, bmin int"
    day = datetime(2024, 1, 15).date()
    folder = str(tmp_path / "late")

    def land(schedid, minute, hour=12):
        spark.createDataFrame(
            [(schedid, 1, datetime(2024, 1, 15, hour, minute), None, 1, day, 9, 0)], schema
        ).coalesce(1).write.mode("append").parquet(folder)

    clients = spark.createDataFrame([(1, "a", "b", "c")], "pcode long, phone1 string, phone2 string, phone3 string")
    land(1, 0)
    land(2, 30)
    land(5, 31)  # late rows are judged by the watermark of the batch before
    land(3, 5)  # 26 minutes behind
    land(4, 25)
    out = st.new_appointment_stream(st.read_stream(spark, folder, schema, files_per_trigger=1), clients)
    names = set()
    query = (
        out.writeStream.foreachBatch(lambda df, i: names.update(r.schedid for r in df.collect()))
        .option("checkpointLocation", str(tmp_path / "cp_all"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(180)
    assert names == {1, 2, 4, 5}


def test_once_per_day(spark, tmp_path):
    folder = str(tmp_path / "asked")
    data = [(1, datetime(2024, 1, 15, 11)), (1, datetime(2024, 1, 15, 12)), (1, datetime(2024, 1, 16, 11)), (2, datetime(2024, 1, 15, 9))]
    spark.createDataFrame(data, "pcode long, ts timestamp_ntz").write.parquet(folder)
    stream = st.read_stream(spark, folder, "pcode long, ts timestamp_ntz")
    got = drain(st.once_per_day(stream, ["pcode"], "ts"), tmp_path, "asked")
    assert sorted((r.pcode, r.ts.day) for r in got.collect()) == [(1, 15), (1, 16), (2, 15)]


def test_poll_counts(spark, tmp_path):
    folder = str(tmp_path / "polls")
    data = [(datetime(2024, 1, 15, 12, m), "new") for m in (1, 3, 7)] + [(datetime(2024, 1, 15, 18), "new")]
    spark.createDataFrame(data, "ts timestamp_ntz, kind string").coalesce(1).write.parquet(folder)
    stream = st.read_stream(spark, folder, "ts timestamp_ntz, kind string")
    got = drain(st.poll_counts(stream, "ts", F.col("kind"), "10 minutes", "5 minutes"), tmp_path, "polls")
    by = {(r.window_start.hour, r.window_start.minute): r.n for r in got.collect()}
    assert by[(11, 55)] == 2 and by[(12, 0)] == 3 and by[(12, 5)] == 1


def test_file_arrivals(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "a.txt").write_text("x")
    (folder / "b.txt").write_text("y")
    (folder / "old.txt").write_text("z")
    long_ago = time.time() - 10 * 86400
    os.utime(folder / "old.txt", (long_ago, long_ago))
    got = drain(st.file_arrivals(spark, str(folder)), tmp_path, "files")
    assert sorted(r.file.rsplit("/", 1)[1] for r in got.collect()) == ["a.txt", "b.txt"]


def test_outbox_stream_is_idempotent(spark, sf, tmp_path):
    c = Clinic(spark, sf)
    folder, out = str(tmp_path / "in"), str(tmp_path / "outbox")
    cands = ap.with_date_text(ap.online_appointments(c.schedule)).join(
        c.clients.select("pcode", "phone1", "phone2", "phone3"), "pcode"
    )
    cands.coalesce(2).write.parquet(folder)
    empty = spark.createDataFrame([], LEDGER_SCHEMA)

    def run(checkpoint):
        stream = st.read_stream(spark, folder, cands.schema, files_per_trigger=1)
        ready = ob.with_skip_reason(ob.event_candidates({"new": stream})).where("skip_reason IS NULL")
        messages = ready.selectExpr(
            "kind", "cast(schedid AS string) AS key", "recipient", "mobile AS msisdn", "'hi' AS text", "cast(null AS string) AS send_time"
        )
        assert start_outbox(messages, out, str(tmp_path / checkpoint)).awaitTermination(180)

    run("cp1")
    first = rows(spark.read.parquet(out).select("kind", "key"))
    run("cp2")  # a lost checkpoint: every batch is repeated
    again = rows(spark.read.parquet(out).select("kind", "key"))
    assert first == again and len(first) == len(set(first)) > 0
    want = ob.outbox_messages({"new": cands}, empty)
    assert [k for _, k in first] == [r[0] for r in rows(want.select("key"))]
