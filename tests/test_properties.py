"""Properties that hold for any input."""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from apptflow.functions import contacts
from apptflow.operators import ledger as lg
from apptflow.operators import monitoring as mo
from apptflow.operators import survey as su
from apptflow.operators import workload as wl

NOON = datetime(2024, 1, 15, 12)
LEDGER = "kind string, key string, sent_at timestamp_ntz"
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@given(st.lists(st.text(max_size=20), min_size=1, max_size=60))
def test_mobile_is_empty_or_ten_digits_from_nine(spark, raw):
    df = spark.createDataFrame([(r,) for r in raw], "n string")
    for (m,) in df.select(contacts.mobile_number(F.col("n"))).collect():
        assert m is None or (m.startswith("9") and len(m) <= 10 and m.isdigit())


@few
@given(st.sets(st.integers(0, 30)), st.sets(st.integers(0, 30)))
def test_unsent_and_ledger_are_disjoint_and_runs_idempotent(spark, cands, sent):
    c = spark.createDataFrame([("k", str(i)) for i in cands], "kind string, key string")
    ledger = spark.createDataFrame([("k", str(i), NOON) for i in sent], LEDGER)
    out = lg.unsent_notifications(c, ledger)
    assert {int(r.key) for r in out.collect()} == cands - sent
    again = lg.unsent_notifications(c, ledger.unionByName(out.withColumn("sent_at", F.lit(NOON).cast("timestamp_ntz"))))
    assert again.count() == 0


@few
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.booleans(), st.sampled_from(["", "9"])), max_size=40))
def test_one_survey_per_patient(spark, visits):
    schema = (
        "schedid long, schedule_date timestamp_ntz, pcode long, patient string, phone string, phone2 string, "
        "phone3 string, link string, target_fil_shortname string, skip_code int, checked boolean"
    )
    rows = [(i, NOON, p, "P", ph, None, "", "L", "B", c, k) for i, (p, c, k, ph) in enumerate(visits)]
    df = spark.createDataFrame(rows, schema)
    got = su.survey_messages(df, spark.createDataFrame([], LEDGER), {}, NOON).collect()
    sendable = {p for (p, c, k, ph) in visits if c == 0 and not k and ph}
    assert sorted(r.pcode for r in got) == sorted(sendable)


@few
@given(st.lists(st.sampled_from([-2, 0, 1, 2, 5]), max_size=40), st.integers(0, 30))
def test_plan_size(spark, statuses, cap):
    users = spark.createDataFrame([(i, f"u{i}", s) for i, s in enumerate(statuses)], "list_pos long, userid string, status int")
    load = spark.createDataFrame([(f"u{i}", 1, 1) for i in range(0, 41, 3)], "userid string, last_pac_day long, last_pac_2hours long")
    online = [i for i, s in enumerate(statuses) if s in (1, 2, 5)]
    eligible = [i for i in online if i % 3]
    got = [r.list_pos for r in wl.disconnect_plan(users, load, cap).orderBy("plan_rank").collect()]
    assert got == eligible[: max(0, len(online) - cap)]


@few
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 50), st.booleans()), max_size=60), st.integers(1, 5))
def test_failure_runs_equal_a_loop(spark, events, threshold):
    rows = [(s, NOON + timedelta(minutes=m), i, f) for i, (s, m, f) in enumerate(events)]
    df = spark.createDataFrame(rows, "src long, ts timestamp_ntz, id int, bad boolean")
    want = {}
    for s in (0, 1):
        ok = 0
        for _, ts, _, bad in sorted((r for r in rows if r[0] == s), key=lambda r: (r[1], r[2])):
            if not bad:
                ok += 1
                continue
            n, at = want.get((s, ok), (0, None))
            want[s, ok] = (n + 1, ts if n + 1 == threshold else at)
    got = mo.failure_runs(df, "src", "ts", F.col("bad"), {}, threshold, tie_col="id", chunk="7 minutes")
    assert {(r.source, r.run_id): (r.failures, r.alert_at) for r in got.collect()} == want
