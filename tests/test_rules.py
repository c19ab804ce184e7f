"""Edge cases on hand-written rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from apptflow.functions import contacts, text, timeexpr
from apptflow.operators import appointments as ap
from apptflow.operators import conferences as cf
from apptflow.operators import ledger as lg
from apptflow.operators import monitoring as mo
from apptflow.operators import outbox as ob
from apptflow.operators import payments as pa
from apptflow.operators import services as sv
from apptflow.operators import survey as su
from apptflow.operators import workload as wl
from apptflow.operators.joins import Selection, left_lookup, smallest_per_key

NOON = datetime(2024, 1, 15, 12)
SCHEDULE = (
    "schedid long, schedident long, pcode long, dcode long, chid long, workdate date, bhour int, bmin int, "
    "createdate timestamp_ntz, emid long, onlinetype int, planid long, filial long"
)
CLIENTS = (
    "pcode long, fullname string, histnum string, bdate date, phone1 string, phone2 string, phone3 string, "
    "webpaytype int, webaccesstype int"
)
LEDGER = "kind string, key string, sent_at timestamp_ntz"


def appointment(schedid, **kw):
    row = dict(
        schedid=schedid,
        schedident=schedid,
        pcode=1,
        dcode=1,
        chid=1,
        workdate=date(2024, 1, 15),
        bhour=12,
        bmin=0,
        createdate=NOON,
        emid=None,
        onlinetype=1,
        planid=None,
        filial=1,
    )
    row.update(kw)
    return tuple(row.values())


def client(pcode=1, phone1="", phone2="", phone3="89001112233", pay=0, access=0):
    return (pcode, f"P{pcode}", f"H{pcode}", date(1990, 1, 1), phone1, phone2, phone3, pay, access)


def ids(df):
    return sorted(r.schedid for r in df.collect())


def ledger(spark, *rows):
    return spark.createDataFrame([(k, str(v), t) for k, v, t in rows], LEDGER)


# --- appointments ---------------------------------------------------------------------


def test_new_appointment_window_and_flags(spark):
    s = spark.createDataFrame(
        [
            appointment(1, createdate=datetime(2024, 1, 15, 11, 50)),
            appointment(2, createdate=datetime(2024, 1, 15, 11, 49, 59)),
            appointment(3, createdate=datetime(2024, 1, 15, 12, 0, 1)),
            appointment(4, emid=0),
            appointment(5, emid=5),
            appointment(6, onlinetype=0),
            appointment(7, pcode=99),
            appointment(8, pcode=None),
        ],
        SCHEDULE,
    )
    got = ap.new_appointments(s, spark.createDataFrame([client()], CLIENTS), NOON)
    assert ids(got) == [1, 4, 7, 8]
    assert {r.schedid: r.phone3 for r in got.collect()}[7] is None


@pytest.mark.parametrize(
    "h,m,as_of,hit",
    [
        (12, 6, NOON, True),
        (12, 7, NOON, False),
        (12, 6, datetime(2024, 1, 15, 11, 59, 59), False),
        (12, 0, NOON, True),
        (12, 0, datetime(2024, 1, 15, 12, 0, 1), False),
        (0, 3, datetime(2024, 1, 14, 23, 58), True),  # across midnight
    ],
)
def test_reminder_window_ends(spark, h, m, as_of, hit):
    s = spark.createDataFrame([appointment(1, bhour=h, bmin=m)], SCHEDULE)
    got = ap.patient_reminders(s, spark.createDataFrame([client()], CLIENTS), as_of)
    assert ids(got) == ([1] if hit else [])


def test_doctor_reminder_is_one_row_per_visit(spark):
    s = spark.createDataFrame(
        [
            appointment(1, bmin=5, planid=11, onlinetype=0),  # plan lists it
            appointment(2, bmin=5, planid=None),  # schedule lists it
            appointment(3, bmin=5, planid=13),  # neither
            appointment(4, bmin=5, planid=11, chid=9),  # no such chair
            appointment(5, bmin=5, planid=11, pcode=99),  # no such patient
        ],
        SCHEDULE,
    )
    frame = spark.createDataFrame
    roster = frame([(1, date(2024, 1, 15), 1, 5), (1, date(2024, 1, 15), 1, 6)], "dcode long, wdate date, chair long, depnum long")
    got = ap.doctor_reminders(
        s,
        frame([client()], CLIENTS),
        frame([(1, 1)], "chid long, rid long"),
        frame([(1,)], "rid long"),
        roster,
        frame([(1, "89005556677")], "dcode long, phoneint string"),
        frame([(11, 7), (11, 7), (13, 8)], "did long, schid long"),
        frame([(2, 7)], "schedid long, schid long"),
        [7],
        as_of=NOON,
    )
    assert ids(got) == [1, 2]


def test_service_flag_same_for_list_and_table(spark):
    s = spark.createDataFrame([appointment(1, planid=5), appointment(2), appointment(3, planid=6)], SCHEDULE)
    plan = spark.createDataFrame([(5, 7), (6, 8)], "did long, schid long")
    sched = spark.createDataFrame([(2, 7)], "schedid long, schid long")
    table = spark.createDataFrame([(7,)], "schid long")
    for services in ([7], table):
        got = sv.with_service_flag(s, plan, sched, services)
        assert {r.schedid: r.has_service for r in got.collect()} == {1: True, 2: True, 3: False}


def test_selection_narrows(spark):
    few = spark.createDataFrame([(1,), (None,), (1,)], "a long")
    big = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    assert [r.v for r in Selection(few).narrow(big, k="a").collect()] == ["x"]
    assert Selection(few.limit(0)).narrow(big, k="a").count() == 0


def test_left_lookup_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, 11)], "id long, k long")
    right = spark.createDataFrame([(10, "x")], "k long, v string")
    got = left_lookup(left, right, ["k"], "id").collect()
    assert sorted((r.id, r.k, r.v) for r in got) == [(1, 10, "x"), (2, None, None), (3, 11, None)]


# --- expressions ------------------------------------------------------------------------


@pytest.mark.parametrize(
    "raw,want,strict",
    [
        ("+7 (900) 111-22-33", "9001112233", "9001112233"),
        ("89001112233", "9001112233", "9001112233"),
        ("9123", "9123", None),  # short but begins with the prefix
        ("84951112233", None, None),
        ("abc", None, None),
        ("", None, None),
        (None, None, None),
        ("٩001112233", None, None),  # a digit, but not an ASCII nine
        ("9٠01112233", "9٠01112233", "9٠01112233"),
        ("\U0001d7d7001112233", None, None),  # mathematical digit: not counted
        ("19001112233 ext 5", None, None),
    ],
)
def test_mobile_number(spark, raw, want, strict):
    df = spark.createDataFrame([(raw,)], "n string")
    got = df.select(contacts.mobile_number(F.col("n")), contacts.mobile_number(F.col("n"), strict_length=True)).first()
    assert tuple(got) == (want, strict)


def test_contact_order_and_msisdn(spark):
    df = spark.createDataFrame([("89000000001", "89000000002", "n/a"), ("9123", "", None)], "phone1 string, phone2 string, phone3 string")
    got = contacts.contact_dimension(df).withColumn("m", contacts.msisdn(F.col("mobile")))
    assert [(r.mobile, r.m) for r in got.collect()] == [("9000000002", "79000000002"), ("9123", "9123")]


@pytest.mark.parametrize(
    "birth,on,age",
    [
        (date(2000, 2, 29), date(2018, 2, 28), 17),
        (date(2000, 2, 29), date(2018, 3, 1), 18),
        (date(2000, 1, 15), date(2024, 1, 15), 24),
        (date(2000, 1, 16), date(2024, 1, 15), 23),
    ],
)
def test_age(spark, birth, on, age):
    df = spark.createDataFrame([(birth, on)], "b date, o date")
    assert df.select(timeexpr.age_years(F.col("o"), F.col("b"))).first()[0] == age


def test_minute_difference_ignores_seconds(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 15, 12, 0, 59), datetime(2024, 1, 15, 12, 1, 0)), (NOON, datetime(2024, 1, 15, 11, 59, 59, 999999))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(timeexpr.minute_diff(F.col("a"), F.col("b"))).collect()] == [1, -1]


def test_parse_local_rejects_what_is_not_a_moment(spark):
    df = spark.createDataFrame(
        [("15.01.2024", 8, 5), ("31.02.2024", 8, 5), ("15.01.2024", 25, 0), (None, 1, 1), ("2024-01-15", 1, 1)],
        "d string, h int, m int",
    )
    got = [r[0] for r in df.select(timeexpr.parse_local(F.col("d"), F.col("h"), F.col("m"))).collect()]
    assert got == [datetime(2024, 1, 15, 8, 5), None, None, None, None]


def test_topic_phone_and_owner(spark):
    df = spark.createDataFrame(
        [("x9001112233", "a@b@c"), ("9001112233", "plain"), ("call\n9001112233", ""), ("x900111223a", None), (None, "@x")],
        "t string, o string",
    )
    got = [tuple(r) for r in df.select(text.topic_phone(F.col("t")), text.owner_name(F.col("o"))).collect()]
    assert got == [("9001112233", "a"), ("", "plain"), ("9001112233", ""), ("", ""), ("", "")]


def test_exclusions_drop_null_and_quote_patterns(spark):
    df = spark.createDataFrame([("A.B",), ("axb",), (None,), ("ok",)], "n string")
    assert [r.n for r in sv.name_exclusions(df, "n", ["a.b"]).collect()] == ["axb", "ok"]


# --- outbox and ledger --------------------------------------------------------------------


def test_skip_reasons_and_messages(spark):
    schema = "schedid long, data string, bhour int, bmin int, phone1 string, phone2 string, phone3 string"
    rows = [
        (None, "15.01.2024", 9, 5, "", "", "89001112233"),
        (2, "15.01.2024", 9, 5, "", "", "nope"),
        (3, "99.01.2024", 9, 5, "", "", "89001112233"),
        (4, "15.01.2024", 9, 5, "", "", "89001112233"),
        (4, "15.01.2024", 9, 5, "", "", "89001112234"),
        (5, "15.01.2024", 9, 5, "", "", "89001112233"),
    ]
    df = spark.createDataFrame(rows, schema)
    doctors = spark.createDataFrame([(4, "15.01.2024", 9, 5, "8(900)1112244")], "schedid long, data string, bhour int, bmin int, phoneint string")
    by_kind = {"new": df, "reminder_doctor": doctors}
    assert {(r.skip_reason, r.n) for r in ob.skip_reasons(by_kind).collect()} == {("no key", 1), ("no mobile", 1), ("no date", 1)}
    sent = ledger(spark, ("new", 5, NOON), ("reminder_doctor", 5, NOON))
    got = {(r.kind, r.key): r for r in ob.outbox_messages(by_kind, sent, send_at=F.col("start_at")).collect()}
    assert set(got) == {("new", "4"), ("reminder_doctor", "4")}
    assert got["new", "4"].text.endswith("09:05 15.01.2024") and got["new", "4"].msisdn == "79001112233"
    assert got["reminder_doctor", "4"].text.endswith(" 09:05")
    assert got["new", "4"].send_time == "20240115090500"


def test_ledger_rollover_keeps_newest(spark):
    rows = [("a", i, datetime(2024, 1, 15, 0, i)) for i in range(15)] + [("b", 1, NOON)]
    got = lg.ledger_rollover(ledger(spark, *rows), 10).collect()
    assert sorted(int(r.key) for r in got if r.kind == "a") == list(range(5, 15))
    assert [r.key for r in got if r.kind == "b"] == ["1"]


def test_send_marks_retry(spark):
    attempts = spark.createDataFrame([("new", "1"), ("new", "2"), ("survey", "3"), ("new", "4")], "kind string, key string")
    results = spark.createDataFrame([("new", "1", True), ("new", "2", False), ("survey", "3", False)], "kind string, key string, ok boolean")
    got = lg.send_marks(attempts, results, NOON, {"new": True, "survey": False}).collect()
    assert sorted(r.key for r in got) == ["1", "3"]


# --- payments -----------------------------------------------------------------------------


def test_movements_signs_and_null_references(spark):
    frame = spark.createDataFrame
    money = "pcode long, planid long, amountrub decimal(18,2)"
    one = Decimal("1.00")
    incom = frame(
        [(1, 1, one * 100, 1, None), (1, 1, one * 10, 5, 7), (1, 1, one * 1, 5, 10), (1, 1, one * 2, 5, None), (1, 1, one * 4, 2, 7)],
        money + ", paycode int, incref long",
    )
    lose = frame([(1, 1, one * 1000)], money)
    jp = frame([(1, 1, one * 5, 5, 1), (1, 1, one * 7, 5, 11), (1, 1, one * 9, 4, 1)], money + ", opertype int, incref long")
    adv = frame([(1, 1, one * 3, 102), (1, 1, one * 20, 1)], money + ", typeoper int")
    moves = pa.payment_movements(incom, lose, jp, adv)
    assert moves.count() == 6
    assert pa.payments_by_plan(moves).first().amountrub == Decimal("1102.00")


def tables(spark, schedule, plans=(), movements=(), clients=None):
    frame = spark.createDataFrame
    return pa.PaymentTables(
        schedule=schedule,
        filials=frame([(1, "BR1"), (9, "BR9")], "filid long, shortname string"),
        doctor=frame([(1, "D")], "dcode long, dname string"),
        clients=frame(clients or [client()], CLIENTS),
        roster=schedule.selectExpr("schedident", "1L AS depnum"),
        departments=frame([(1, "DEP")], "depnum long, depname string"),
        dailyplan=frame(list(plans), "did long, plantype int, summarub_disc decimal(18,2)"),
        plan_detail=frame([], "did long, schid long"),
        sched_detail=schedule.selectExpr("schedid", "7L AS schid"),
        agreements=frame([], "pcode long, agreement string, bdate date, fdate date, datecancel date, isdeleted int"),
        movements=frame(list(movements), "pcode long, typeoper int, planid long, amount decimal(18,2)"),
    )


def test_payment_windows_of_offset_branches(spark):
    at = lambda h, m, s=0: datetime(2024, 1, 15, h, m, s)
    later = dict(workdate=date(2024, 2, 1))
    s = spark.createDataFrame(
        [
            appointment(1, createdate=at(11, 30), **later),
            appointment(2, createdate=at(12, 30, 1), **later),
            appointment(3, createdate=at(13, 30), filial=9, **later),
            appointment(4, createdate=at(14, 30), filial=9, **later),
            appointment(5, createdate=at(12, 0), filial=9, **later),
            appointment(6, createdate=at(1, 0), bhour=12, bmin=30),
            appointment(7, createdate=at(1, 0), bhour=12, bmin=31),
            appointment(8, createdate=at(1, 0), bhour=14, bmin=0, filial=9),
            appointment(9, createdate=at(1, 0), bhour=12, bmin=10, filial=9),
            appointment(10, createdate=at(1, 0), bhour=14, bmin=30, filial=9),
            appointment(11, createdate=at(1, 0), filial=None),
        ],
        SCHEDULE,
    )
    as_of = at(12, 0, 45)
    # the seconds of as_of count for creation, not for the start
    assert ids(pa.due_appointments(s, as_of)) == [2, 4, 6, 8, 10]
    assert ids(pa.due_appointments(s, NOON)) == [1, 3, 4, 6, 8, 10]
    whole = pa.payment_due_soon(pa.payment_candidates(tables(spark, s), [7]), NOON)
    narrowed = pa.payment_candidates(tables(spark, s), [7], pa.due_appointments(s, NOON))
    assert ids(whole) == ids(narrowed) == [1, 3, 4, 6, 8, 10]


def test_plan_predicate_stays_in_the_join(spark):
    s = spark.createDataFrame([appointment(1, planid=5), appointment(2, planid=6), appointment(3)], SCHEDULE)
    got = pa.payment_candidates(
        tables(spark, s, plans=[(5, 204, Decimal("50.00")), (6, 100, Decimal("60.00"))], movements=[(1, 1, 5, Decimal("20.00"))]),
        [7],
    ).collect()
    assert {r.schedid: (r.paytype, r.amount_payable, r.paid_by_client) for r in got} == {
        1: ("pre-invoice", Decimal("50.00"), Decimal("20.00")),
        2: ("planned", Decimal("0.00"), Decimal("0.00")),
        3: ("planned", Decimal("0.00"), Decimal("0.00")),
    }


def test_payment_decisions_and_separate_ledgers(spark):
    late = dict(bhour=18, bmin=0)
    s = spark.createDataFrame(
        [
            appointment(1, planid=1, **late),  # paid in full
            appointment(2, planid=2, bhour=12, bmin=30),  # unpaid, soon
            appointment(3, planid=3, pcode=2, **late),  # invoice and account
            appointment(4, planid=4, **late),  # invoice, no account
            appointment(5, pcode=2, **late),  # planned, account
            appointment(6, **late),  # planned, no account
            appointment(7, **late),  # reported as new before
            appointment(8, bhour=8),  # past, reported as new before: still soon
        ],
        SCHEDULE,
    )
    ten = Decimal("10.00")
    t = tables(
        spark,
        s,
        plans=[(i, 204, ten) for i in (1, 2, 3, 4)],
        movements=[(1, 1, 1, ten)],
        clients=[client(1, "a", "", "c"), client(2, pay=1, access=3)],
    )
    sent = ledger(spark, (pa.NEW, 7, NOON), (pa.NEW, 8, NOON))
    got = pa.payment_decisions(pa.payment_candidates(t, [7]), sent, NOON)
    assert {r.schedid: r.decision for r in got.collect()} == {
        2: "starts_soon",
        4: "invoice_no_account",
        5: "planned_account",
        6: "planned_no_account",
        8: "starts_soon",
    }
    notices = {r.schedid: r for r in pa.payment_notices(got, {"BR1": ["x@e"]}, ["base@e"]).collect()}
    assert notices[4].contacts == "a; c" and notices[4].coverage == "cash"
    assert notices[4].recipients == "base@e;x@e"


def test_valid_agreements_by_day(spark):
    s = spark.createDataFrame([appointment(1), appointment(2, pcode=2), appointment(3, pcode=None)], SCHEDULE)
    d = date
    rows = [
        (1, "b", d(2024, 1, 15), d(2024, 1, 15), None, None),
        (1, "a", d(2020, 1, 1), d(2025, 1, 1), None, 0),
        (1, "cancelled", d(2020, 1, 1), d(2025, 1, 1), d(2024, 1, 14), None),
        (1, "deleted", d(2020, 1, 1), d(2025, 1, 1), None, 1),
        (2, "future", d(2024, 1, 16), d(2025, 1, 1), None, None),
    ]
    agreements = spark.createDataFrame(rows, "pcode long, agreement string, bdate date, fdate date, datecancel date, isdeleted int")
    got = pa.valid_agreements(s, agreements).collect()
    assert [(r.schedid, r.clhistinfo) for r in got] == [(1, "a; b")]


# --- survey ---------------------------------------------------------------------------------


def codes(spark, as_of, *visits):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(visits)], "i int, v timestamp_ntz")
    return [r[0] for r in df.orderBy("i").select(su.skip_code(F.col("v"), as_of)).collect()]


def test_skip_codes(spark):
    at = lambda d, h, m=0: datetime(2024, 1, d, h, m)
    visits = (at(15, 18), at(14, 19), at(14, 17), at(15, 8, 30), at(15, 8, 31), at(16, 9), at(13, 9))
    assert codes(spark, at(15, 11, 30), *visits) == [1, 0, 4, 0, 3, 0, 0]
    assert codes(spark, at(15, 12), *visits) == [1, 2, 2, 0, 0, 0, 0]
    # the first of a month: yesterday is the last day of the month before
    assert codes(spark, datetime(2024, 2, 1, 11), datetime(2024, 1, 31, 17), datetime(2024, 1, 31, 18)) == [4, 0]


def test_survey_hours():
    assert [su.survey_hours(datetime(2024, 1, 15, h)) for h in (10, 11, 20, 21)] == [False, True, True, False]


def coded_visits(spark, rows):
    schema = (
        "schedid long, schedule_date timestamp_ntz, pcode long, patient string, phone string, phone2 string, "
        "phone3 string, link string, target_fil_shortname string, skip_code int, checked boolean"
    )
    full = [(i, datetime(2024, 1, 15, h), p, f"P{p}", ph, "", "", f"L{i}", b, c, k) for i, h, p, ph, b, c, k in rows]
    return spark.createDataFrame(full, schema)


def test_survey_messages_one_per_patient_and_link_choice(spark):
    df = coded_visits(
        spark,
        [
            (1, 9, 1, "901", "B", 0, False),  # the only open visit: doctor link
            (2, 10, 1, "901", "B", 4, False),  # marked in this run: no sibling
            (3, 9, 2, "902", "B", 0, True),  # checked before: still open
            (4, 10, 2, "902", "B", 0, False),
            (5, 9, 3, "", "B", 0, False),  # no phone: the next visit is taken
            (6, 10, 3, "903", "X", 0, False),  # unknown branch: doctor link
            (7, 9, 4, "904", "B", 0, False),  # asked today
            (8, 9, 5, "905", "B", 3, False),  # too recent
            (9, 9, 6, "906", "B", 0, False),
            (10, 9, 6, "906", "B", 0, False),
        ],
    )
    sent = ledger(spark, (su.SENT, 4, NOON), (su.SENT, 1, datetime(2024, 1, 14, 12)))
    got = {r.pcode: r for r in su.survey_messages(df, sent, {"B": "branch"}, NOON).collect()}
    assert {p: r.schedid for p, r in got.items()} == {1: 1, 2: 4, 3: 6, 6: 9}
    assert got[1].text.endswith("doctor: L1")
    assert got[2].text.endswith("review: branch")
    assert got[3].text.endswith("review: L6")
    recent = {r.pcode for r in su.survey_messages(df, sent, {}, NOON, send_recent=True).collect()}
    assert recent == {1, 2, 3, 5, 6}
    messages = su.survey_messages(df, sent, {}, NOON)

    def marked(ok, recent=False):
        asked = su.survey_messages(df, sent, {}, NOON, send_recent=True) if recent else messages
        results = asked.selectExpr("kind", "key", f"{ok} AS ok")
        return {int(r.key) for r in su.survey_checked_marks(df, asked, results, NOON, recent).collect()}

    assert marked("true") == {1, 2, 4, 5, 6, 7, 9, 10}
    # after a failure only the visit that was tried: the next one is offered later
    assert marked("false") == marked("cast(null AS boolean)") == {1, 2, 4, 5, 6, 7, 9}
    # a recent visit that is sent is marked
    assert 8 not in marked("true") and 8 in marked("true", recent=True)


def test_first_visits_and_uncoded_treatments(spark):
    visits = spark.createDataFrame(
        [(i, i, 1, datetime(2024, 1, 15, 9)) for i in (1, 2, 3, 4)], "schedid long, pcode long, dcode long, schedule_date timestamp_ntz"
    )
    treats = spark.createDataFrame(
        [
            (100, 1, 1, datetime(2024, 1, 14, 23)),  # the day before
            (101, 2, 1, datetime(2024, 1, 15, 8)),  # same day: not earlier
            (None, 3, 1, datetime(2024, 1, 1)),  # earlier, without a code
            (103, 4, 2, datetime(2024, 1, 1)),  # another doctor
        ],
        "treatcode long, pcode long, dcode long, treatdate timestamp_ntz",
    )
    got = su.first_visits(visits, treats)
    outer = visits.alias("v").join(
        treats.alias("t"),
        F.expr("t.dcode = v.dcode AND t.pcode = v.pcode AND to_date(t.treatdate) < to_date(v.schedule_date)"),
        "left",
    ).where("t.treatcode IS NULL")
    assert ids(got) == ids(outer.select("schedid")) == [2, 3, 4]


# --- workload, monitoring, snapshots -----------------------------------------------------------


def test_disconnect_plan_takes_the_excess_in_order(spark):
    users = spark.createDataFrame(
        [(i, f"User{i}", s) for i, s in enumerate([1, 2, 5, 0, 1, 1, -1, 1])], "list_pos long, userid string, status int"
    )
    load = spark.createDataFrame([("user0", 1, 1), ("user1", 0, 0), ("USER2", 1, 0)], "userid string, last_pac_day long, last_pac_2hours long")
    got = wl.disconnect_plan(users, load, cap=3).orderBy("plan_rank").collect()
    assert [(r.list_pos, r.reason, r.plan_rank) for r in got] == [(1, "none today", 1), (2, "none in 2 hours", 2), (4, "absent", 3)]
    assert wl.disconnect_plan(users, load, cap=6).count() == 0
    assert wl.disconnect_plan(users, load, cap=0).count() == 5
    with pytest.raises(Exception, match="empty workload"):
        wl.disconnect_plan(users, load.where("false"), cap=3).collect()


def test_ranked_by_position_over_many_blocks(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "pos")
    got = wl.ranked_by_position(df, "pos", "rank", width=10)
    assert got.where(F.col("rank") != F.col("pos") / 7 + 1).count() == 0 and got.count() == df.count()


def test_slot_grid_overlap(spark):
    roster = spark.createDataFrame([(1, date(2024, 1, 15), 8, 0, 10, 0)], "dcode long, wdate date, beghour int, begmin int, endhour int, endmin int")
    s = spark.createDataFrame([appointment(1, bhour=8, bmin=10), appointment(2, bhour=9, bmin=0), appointment(3, bhour=12)], SCHEDULE)
    got = [(r.slot_begin.strftime("%H:%M"), r.schedid, r.isfree) for r in wl.slot_grid(roster, s).orderBy("slot_begin").collect()]
    assert got == [("08:00", 1, 0), ("08:30", 1, 0), ("09:00", 2, 0), ("09:30", None, 1)]


def run_rows(spark, text, threshold, chunk):
    """``text``: f failure, s success, one per minute; spaces skip a minute."""
    rows = [("a", datetime(2024, 1, 15, 10 + i // 60, i % 60), i, c == "f") for i, c in enumerate(text) if c != " "]
    df = spark.createDataFrame(rows, "src string, ts timestamp_ntz, id int, bad boolean")
    got = mo.failure_runs(df, "src", "ts", F.col("bad"), {"a": threshold}, tie_col="id", chunk=chunk)
    return sorted((r.run_id, r.failures, r.alert_at and r.alert_at.hour * 60 + r.alert_at.minute - 600) for r in got.collect())


@pytest.mark.parametrize("chunk", ["1 minute", "3 minutes", "1 day"])
def test_failure_runs_across_chunks(spark, chunk):
    assert run_rows(spark, "ffsfffsfs", 3, chunk) == [(0, 2, None), (1, 3, 5), (2, 1, None)]
    assert run_rows(spark, "ff   ff    f", 4, chunk) == [(0, 5, 6)]
    assert run_rows(spark, "sssffffffffff", 3, chunk) == [(3, 10, 5)]
    assert run_rows(spark, "sss", 3, chunk) == []


def test_arrival_digest_lines(spark):
    files = spark.createDataFrame(
        [("a", datetime(2024, 1, 15, 10, 0)), ("b", datetime(2024, 1, 15, 9, 59, 59)), ("c", datetime(2024, 1, 15, 11, 58)), ("d", datetime(2024, 1, 15, 11, 51)), ("e", datetime(2024, 1, 15, 11, 55))],
        "file string, created timestamp_ntz",
    )
    got = mo.arrival_digest(files, ledger(spark, ("file", "e", NOON)), NOON)
    assert sorted((r.file, r.digest_at.strftime("%H:%M"), r.n) for r in got.collect()) == [("a", "10:00", 1), ("c", "12:00", 2), ("d", "12:00", 2)]
    early = mo.arrival_digest(files, ledger(spark), datetime(2024, 1, 15, 11, 56)).collect()
    assert max(r.digest_at for r in early) == datetime(2024, 1, 15, 11, 56)


@pytest.mark.parametrize(
    "content,code,state,at",
    [
        ("3 202401151203", "3", "delivered", datetime(2024, 1, 15, 12, 3)),
        ("3 202401151203\r\n", "3", "delivered", datetime(2024, 1, 15, 12, 3)),
        ("-1", "-1", "queued", None),
        ("2 2024", "2", "sent, state unknown", None),
        ("1 202413151203", "1", "undelivered", None),
        ("0  202401151203", "0", "rejected", None),
        ("boom", "boom", "error", None),
        ("", "", "error", None),
    ],
)
def test_delivery_states(spark, content, code, state, at):
    df = spark.createDataFrame([("m", content)], "smsid string, content string")
    r = mo.delivery_states(df).first()
    assert (r.state_code, r.state, r.delivered_at) == (code, state, at)


def test_delivery_report_takes_the_latest(spark):
    rows = [("m", datetime(2024, 1, 15, 9), "2 202401150900"), ("m", datetime(2024, 1, 15, 10), "3 202401150955"), ("n", datetime(2024, 1, 15, 9), "0")]
    df = spark.createDataFrame(rows, "smsid string, reported_at timestamp_ntz, content string")
    assert {r.smsid: r.state for r in mo.delivery_report(df).collect()} == {"m": "delivered", "n": "rejected"}
    assert {(r.state, r.n, r.day_total) for r in mo.delivery_rates(df).collect()} == {("delivered", 1, 2), ("rejected", 1, 2)}


def test_conference_pages_parse_nested_fields(spark):
    body = (
        '{"cnt": 1, "conferences": [{"id": "c", "topic": "t", "owner": "o@x", "type": 1, "tags": ["a", "b"],'
        ' "invitations": [{"id": "u", "display_name": "U"}], "rights": {"u": {"chat_send": true}},'
        ' "schedule": {"type": 0, "start_time": 60, "days": ["monday"]}}]}'
    )
    pages = spark.createDataFrame([(1, body), (2, "broken")], "page_id long, body string")
    r = cf.conferences(pages).first()
    assert r.rights["u"].chat_send is True and r.rights["u"].chat_rcv is None
    assert r.tags == ["a", "b"] and r.invitations[0].display_name == "U" and r.schedule.days == ["monday"]
    snap = cf.conference_snapshot(pages).first()
    assert (snap.owner, snap.type, snap.starts_at) == ("o", "asymmetric", datetime(1970, 1, 1, 0, 1))
    assert tuple(cf.snapshot_completeness(pages).first()) == (1, 1, 1)


def test_user_pages_never_carry_a_password(spark):
    body = '{"next_page_id": 3, "users": [{"id": "a", "password": "p", "status": 1, "groups": [{"id": "g"}]}]}'
    pages = spark.createDataFrame([(1, body), (3, '{"next_page_id": -1, "users": []}')], "page_id long, body string")
    users = cf.user_snapshot(pages)
    assert "password" not in users.columns and users.first().list_pos == 1 << 32
    assert cf.page_chain_gaps(pages).count() == 0
    gap = cf.page_chain_gaps(pages.where("page_id = 1")).first()
    assert (gap.missing_page, gap.from_page) == (3, 1)


def test_run_counts(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "kind string")
    assert {(r.kind, r.n) for r in lg.run_counts(a, a.limit(0)).collect()} == {("x", 2), ("y", 1)}


def user_page(n, next_page, first):
    import json

    users = [{"id": f"u{first + i}", "status": 1} for i in range(n)]
    return json.dumps({"next_page_id": next_page, "users": users})


def test_user_pages_of_any_size_keep_their_order(spark):
    pages = [(0, user_page(250, 1, 0)), (1, user_page(50, 2, 250)), (2, user_page(10, -1, 300))]
    users = cf.user_snapshot(spark.createDataFrame(pages, "page_id long, body string"))
    users = users.withColumn("userid", F.col("id"))
    load = spark.createDataFrame([("nobody", 1, 1)], "userid string, last_pac_day long, last_pac_2hours long")
    got = wl.disconnect_plan(users, load, 0, cf.POSITIONS_PER_BLOCK).orderBy("plan_rank").collect()
    assert [r.userid for r in got] == [f"u{i}" for i in range(310)]
    assert [r.plan_rank for r in got] == list(range(1, 311))


def test_a_page_without_a_number_fails(spark):
    pages = spark.createDataFrame([(None, user_page(1, -1, 0))], "page_id long, body string")
    with pytest.raises(Exception, match="without a number"):
        cf.user_snapshot(pages).collect()


def test_a_null_position_comes_last(spark):
    df = spark.createDataFrame([(5, "a"), (None, "b"), (3, "c")], "pos long, v string")
    got = wl.ranked_by_position(df, "pos", "rank", width=2).orderBy("rank").collect()
    assert [(r.v, r.rank) for r in got] == [("c", 1), ("a", 2), ("b", 3)]


def test_user_snapshot_completeness(spark):
    def seen(rows):
        return tuple(cf.user_snapshot_completeness(spark.createDataFrame(rows, "page_id long, body string")).first())

    whole = [(0, user_page(2, 1, 0)), (1, user_page(2, -1, 2))]
    assert seen(whole) == (2, False, 0, 1, 0)
    assert seen(whole[:1]) == (1, False, 0, 0, 1)
    assert seen(whole[1:]) == (1, True, 0, 1, 0)
    assert seen([*whole, (None, user_page(1, 5, 9)), (7, "broken")]) == (4, False, 2, 1, 1)


def test_the_smallest_row_of_a_key_stays(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "x")], "k long, v string")
    for n in (1, 4):
        got = smallest_per_key(df.repartition(n), ["k"]).collect()
        assert sorted((r.k, r.v) for r in got) == [(1, "a"), (2, None)]


def test_delivery_error_keeps_its_text(spark):
    reports = spark.createDataFrame(
        [(1, NOON, "junk\r\n"), (1, datetime(2024, 1, 15, 11), "3 202401151100"), (2, NOON, "3 202401151200")],
        "smsid long, reported_at timestamp_ntz, content string",
    )
    got = {r.smsid: (r.state, r.detail) for r in mo.delivery_report(reports).collect()}
    assert got == {1: ("error", "junk"), 2: ("delivered", None)}
