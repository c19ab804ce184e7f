"""The registered queries: every job over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apptflow.functions import contacts
from apptflow.operators import appointments as ap
from apptflow.operators import conferences as cf
from apptflow.operators import ledger as lg
from apptflow.operators import monitoring as mo
from apptflow.operators import outbox as ob
from apptflow.operators import payments as pa
from apptflow.operators import services as sv
from apptflow.operators import survey as su
from apptflow.operators import workload as wl
from apptflow.operators.counts import RunCounts
from apptflow.plans import runs
from apptflow.plans.clinic import AS_OF, FIRST_SHUFFLED_PAGE, SURVEY_AFTERNOON, SURVEY_MORNING, Clinic, page_number
from apptflow.session import checkpoint_ready, written_once
from apptflow.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EXCLUDED_WORDS = ("widget", "hot")
BRANCH_LINKS = {f"BR{i}": f"https://example.org/BR{i}" for i in range(1, 10)}
ROUTES = {f"BR{i}": (f"desk{i}@example.org", f"cash{i}@example.org") for i in (1, 3, 5)}
USER_CAP = 50
DEPARTMENTS = (1, 2, 3)
SURVEY_RULES = su.SurveyRules(
    payer="cash",
    departments_excluded=("DEP1", "DEP4"),
    service_words_excluded=EXCLUDED_WORDS,
    staff_words_excluded=("nurse",),
)


def query(fn: Callable[[Clinic], DataFrame]) -> Query:
    """Registers ``fn`` under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Clinic(spark, sf_dir))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


# --- appointments -----------------------------------------------------------------


def _by_kind(c: Clinic) -> dict[str, DataFrame]:
    return runs.event_result_sets(c.appointment_tables, AS_OF, c.online_services)


@query
def new_appointments(c: Clinic) -> DataFrame:
    return ap.new_appointments(c.schedule, c.clients, AS_OF)


@query
def new_appointments_strict(c: Clinic) -> DataFrame:
    return ap.new_appointments_strict(
        c.schedule, c.clients, c.chairs, c.rooms, c.roster, c.doctor, DEPARTMENTS, as_of=AS_OF
    )


@query
def patient_reminders(c: Clinic) -> DataFrame:
    return ap.patient_reminders(c.schedule, c.clients, AS_OF)


@query
def patient_reminders_strict(c: Clinic) -> DataFrame:
    return ap.patient_reminders_strict(
        c.schedule, c.clients, c.chairs, c.rooms, c.roster, c.doctor, DEPARTMENTS, as_of=AS_OF
    )


@query
def doctor_reminders(c: Clinic) -> DataFrame:
    return ap.doctor_reminders(
        c.schedule,
        c.clients,
        c.chairs,
        c.rooms,
        c.roster,
        c.doctor,
        c.plan_detail,
        c.sched_detail,
        c.online_services,
        as_of=AS_OF,
    )


@query
def free_appointments(c: Clinic) -> DataFrame:
    return ap.free_appointments(c.schedule).select("schedid", "pcode", "emid")


@query
def valid_branches(c: Clinic) -> DataFrame:
    return pa.valid_branches(c.schedule, (9, 15), keep=False).select("schedid", "filial")


@query
def listed_service_appointments(c: Clinic) -> DataFrame:
    flagged = sv.with_service_flag(c.schedule, c.plan_detail, c.sched_detail, c.online_services)
    return flagged.select("schedid", "planid", "has_service")


@query
def name_exclusions(c: Clinic) -> DataFrame:
    return sv.name_exclusions(c.wschema, "schname", EXCLUDED_WORDS).select("schid", "schname")


@query
def staff_exclusions(c: Clinic) -> DataFrame:
    name = F.concat("profname", "doctpost")
    return sv.name_exclusions(c.doctor_dim, name, ("nurse", "prof3")).select("uid", "profname", "doctpost")


@query
def appointment_times(c: Clinic) -> DataFrame:
    return ap.appointment_times(c.schedule, AS_OF)


@query
def account_flags(c: Clinic) -> DataFrame:
    plans = c.dailyplan.where("plantype = 204").select(F.col("did").alias("planid"), "did")
    booked = c.schedule.join(c.clients, "pcode").join(plans, "planid", "left")
    return pa.account_flags(booked).select("schedid", "online_account", "paytype")


@query
def client_ages(c: Clinic) -> DataFrame:
    return su.client_ages(c.clients, AS_OF).select("pcode", "bdate", "age_in_years")


@query
def contact_dimension(c: Clinic) -> DataFrame:
    return contacts.contact_dimension(c.clients).select("pcode", "mobile")


# --- outbox and ledger ---------------------------------------------------------------


@query
def outbox_messages(c: Clinic) -> DataFrame:
    return runs.appointment_run(c.appointment_tables, c.sent("new"), AS_OF, c.online_services)


def _delayed(c: Clinic, ledger: DataFrame, bulk: bool = False) -> DataFrame:
    whole = ap.online_appointments(c.schedule).join(c.clients, "pcode", "left")
    by_kind = {"new": ap.with_date_text(whole).withColumnRenamed("fullname", "recipient")}
    return ob.outbox_messages(by_kind, ledger, send_at=F.expr("start_at - INTERVAL '1' HOUR"), bulk=bulk)


@query
def outbox_all_appointments(c: Clinic) -> DataFrame:
    """Every online appointment as a delayed message one hour before its start."""
    return _delayed(c, c.sent("new"))


@query
def outbox_all_appointments_bulk(c: Clinic) -> DataFrame:
    """The same with a ledger that lies in buckets of its key and is joined there."""
    if not checkpoint_ready(c.spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    name = f"ledger_{uuid.uuid4().hex}"
    folder = f"{c.spark.sparkContext.getCheckpointDir()}/{name}"
    return _delayed(c, sinks.bucket_ledger(c.sent("new"), name, folder), bulk=True)


@query
def observed_run_counts(c: Clinic) -> DataFrame:
    """What a poll counts while its messages are written: candidates, and why some are skipped."""
    counts = RunCounts()
    poll = runs.appointment_run(c.appointment_tables, c.sent("new"), AS_OF, c.online_services, counts=counts)
    written_once(poll, "outbox")
    return counts.table(c.spark).where("counter <> 'rows'").selectExpr(
        "split_part(counter, ': ', 1) AS kind", "split_part(counter, ': ', 2) AS reason", "n"
    )


@query
def skip_reasons(c: Clinic) -> DataFrame:
    whole = ap.with_date_text(c.schedule.join(c.clients, "pcode", "left"))
    online = whole.where("onlinetype = 1")
    return ob.skip_reasons({"new": whole, "reminder_patient": online})


@query
def run_counts(c: Clinic) -> DataFrame:
    return lg.run_counts(*[df.withColumn("kind", F.lit(k)) for k, df in _by_kind(c).items()])


@query
def unsent_notifications(c: Clinic) -> DataFrame:
    cands = c.schedule.selectExpr("'k' || (schedid % 5) AS kind", "cast(schedid AS string) AS key", "pcode")
    return lg.unsent_notifications(cands, c.ledger)


@query
def ledger_rollover(c: Clinic) -> DataFrame:
    return lg.ledger_rollover(c.ledger)


def _results(messages: DataFrame) -> DataFrame:
    """Gateway answers: every fifth visit's message fails."""
    return messages.selectExpr(
        "kind", "key", "'sms' || key AS smsid", "schedid % 5 <> 0 AS ok"
    )


@query
def send_log(c: Clinic) -> DataFrame:
    people = c.clients.selectExpr("pcode", "fullname AS recipient", "phone3")
    cands = ob.event_candidates({"survey": c.schedule.join(people, "pcode")})
    outbox = (
        contacts.contact_dimension(cands)
        .where("mobile IS NOT NULL")
        .selectExpr(
            "kind",
            "schedid",
            "cast(schedid AS string) AS key",
            "recipient",
            "mobile AS msisdn",
            "'hello ' || recipient AS text",
        )
    )
    return lg.send_log(outbox, _results(outbox), AS_OF, "host", "user")


@query
def send_marks(c: Clinic) -> DataFrame:
    attempts = c.schedule.selectExpr(
        "schedid",
        "cast(schedid AS string) AS key",
        f"CASE WHEN onlinetype = 1 THEN 'new' ELSE '{su.CHECKED}' END AS kind",
    )
    return lg.send_marks(attempts, _results(attempts), AS_OF, {"new": True, su.CHECKED: False})


# --- payments ---------------------------------------------------------------------------


@query
def payment_movements(c: Clinic) -> DataFrame:
    return c.movements


@query
def payments_by_plan(c: Clinic) -> DataFrame:
    return pa.payments_by_plan(c.movements)


@query
def valid_agreements(c: Clinic) -> DataFrame:
    return pa.valid_agreements(c.schedule, c.agreements)


@query
def payment_candidates(c: Clinic) -> DataFrame:
    return pa.payment_candidates(c.payment_tables, c.online_services)


@query
def payment_due_soon(c: Clinic) -> DataFrame:
    picked = pa.due_appointments(c.schedule, AS_OF)
    cands = pa.payment_candidates(c.payment_tables, c.online_services, picked)
    return pa.payment_due_soon(cands, AS_OF)


@query
def payment_decisions(c: Clinic) -> DataFrame:
    cands = pa.payment_candidates(c.payment_tables, c.online_services)
    return pa.payment_decisions(cands, c.sent(pa.NEW), AS_OF).select("schedid", "kind", "decision", "amount_payable", "paid_by_client")


@query
def payment_notices(c: Clinic) -> DataFrame:
    notices = runs.payment_run(
        c.payment_tables, c.sent(pa.NEW), AS_OF, ROUTES, ("payments@example.org",), c.online_services
    )
    return notices.select("schedid", "kind", "decision", "body", "contacts", "coverage", "recipients")


# --- workload ----------------------------------------------------------------------------


@query
def slot_grid(c: Clinic) -> DataFrame:
    return wl.slot_grid(c.roster, c.schedule)


@query
def free_gaps(c: Clinic) -> DataFrame:
    return wl.free_gaps(c.roster, c.schedule)


@query
def busy_intervals(c: Clinic) -> DataFrame:
    return wl.busy_intervals(c.roster, c.schedule, AS_OF)


def _load(c: Clinic) -> DataFrame:
    return runs.workload_run(c.workload_tables, AS_OF, c.workload_services)


@query
def online_user_load(c: Clinic) -> DataFrame:
    return _load(c)


@query
def user_status_summary(c: Clinic) -> DataFrame:
    return wl.user_status_summary(c.users)


@query
def user_eligibility(c: Clinic) -> DataFrame:
    return wl.user_eligibility(c.users, _load(c))


@query
def disconnect_plan(c: Clinic) -> DataFrame:
    return runs.release_run(c.users, c.workload_tables, AS_OF, USER_CAP, c.workload_services)


# --- survey --------------------------------------------------------------------------------


@query
def first_visits(c: Clinic) -> DataFrame:
    return su.first_visits(c.visits, c.treats).select("schedid", "dcode", "pcode", "schedule_date")


@query
def survey_candidates(c: Clinic) -> DataFrame:
    return su.survey_candidates(
        c.visits,
        c.warehouse_clients,
        c.doctor_dim,
        c.doctor_links,
        c.orderdet,
        c.wschema,
        c.treats,
        SURVEY_RULES,
        as_of=SURVEY_AFTERNOON,
    )


@query
def survey_hours(c: Clinic) -> DataFrame:
    return c.schedule.select(
        "schedid", "createdate", su.survey_hours(F.col("createdate")).alias("in_hours")
    )


@query
def survey_skip_codes(c: Clinic) -> DataFrame:
    coded = su.survey_skip_codes(c.visits, c.sent(su.CHECKED), SURVEY_MORNING)
    return coded.select("schedid", "skip_code", "checked")


@query
def survey_skip_codes_afternoon(c: Clinic) -> DataFrame:
    coded = su.survey_skip_codes(c.visits, c.sent(su.CHECKED), SURVEY_AFTERNOON)
    return coded.select("schedid", "skip_code", "checked")


def _survey_ledger(c: Clinic) -> DataFrame:
    """Visits checked and patients asked earlier in the day."""
    checked = c.sent(su.CHECKED).where(F.col("sent_at") <= F.lit("2024-01-15 11:00:00").cast("timestamp_ntz"))
    asked = c.schedule.where("schedid % 97 = 0").selectExpr(
        f"'{su.SENT}' AS kind", "cast(pcode AS string) AS key", "createdate AS sent_at"
    )
    return checked.unionByName(asked)


@query
def survey_messages(c: Clinic) -> DataFrame:
    messages, _ = runs.survey_run(
        c.survey_tables, _survey_ledger(c), SURVEY_AFTERNOON, BRANCH_LINKS, SURVEY_RULES
    )
    return messages


@query
def survey_messages_recent(c: Clinic) -> DataFrame:
    messages, _ = runs.survey_run(
        c.survey_tables, _survey_ledger(c), SURVEY_MORNING, BRANCH_LINKS, SURVEY_RULES, send_recent=True
    )
    return messages


@query
def survey_checked_marks(c: Clinic) -> DataFrame:
    """Marks after a pass in which the request about every third visit failed."""
    messages, coded = runs.survey_run(
        c.survey_tables, _survey_ledger(c), SURVEY_AFTERNOON, BRANCH_LINKS, SURVEY_RULES
    )
    results = messages.selectExpr("kind", "key", "schedid % 3 <> 0 AS ok")
    return su.survey_checked_marks(coded, messages, results, SURVEY_AFTERNOON)


# --- monitoring and snapshots -------------------------------------------------------------------


@query
def failure_runs(c: Clinic) -> DataFrame:
    failed = F.col("event_type") == "error"
    return mo.failure_runs(c.raw("events"), "user_id", "ts", failed, {}, 3, tie_col="event_id")


@query
def failure_runs_by_size(c: Clinic) -> DataFrame:
    """The same runs, from pieces of equal numbers of events."""
    failed = F.col("event_type") == "error"
    return mo.failure_runs(c.raw("events"), "user_id", "ts", failed, {}, 3, tie_col="event_id", pieces=64)


@query
def arrival_digest(c: Clinic) -> DataFrame:
    return mo.arrival_digest(c.arrivals, c.arrivals_known, AS_OF)


@query
def poll_windows(c: Clinic) -> DataFrame:
    return mo.poll_windows(c.schedule, "schedid", "createdate")


@query
def delivery_report(c: Clinic) -> DataFrame:
    return mo.delivery_report(c.delivery)


@query
def delivery_rejects(c: Clinic) -> DataFrame:
    """What is counted while the report is written: reports, and those that cannot be read."""
    counts = RunCounts()
    written_once(mo.delivery_report(c.delivery, counts=counts), "report")
    return counts.table(c.spark).select("counter", "n")


@query
def delivery_rates(c: Clinic) -> DataFrame:
    return mo.delivery_rates(c.delivery)


@query
def conference_snapshot(c: Clinic) -> DataFrame:
    return cf.conference_snapshot(c.conference_pages)


@query
def snapshot_completeness(c: Clinic) -> DataFrame:
    return cf.snapshot_completeness(c.conference_pages)


@query
def user_snapshot(c: Clinic) -> DataFrame:
    return cf.user_snapshot(c.user_pages).select("list_pos", "id", "uid", "status")


@query
def page_chain_gaps(c: Clinic) -> DataFrame:
    """The chain with one page that never arrived."""
    return cf.page_chain_gaps(c.user_pages.where("page_id <> 2"))


@query
def user_snapshot_completeness(c: Clinic) -> DataFrame:
    """The first page and another one never arrived, one is not readable."""
    landed = c.user_pages.where("page_id NOT IN (0, 2)").selectExpr(
        "page_id", "CASE WHEN page_id = 1 THEN 'oops' ELSE body END AS body"
    )
    return cf.user_snapshot_completeness(landed)


@query
def disconnect_plan_from_pages(c: Clinic) -> DataFrame:
    """The release plan for users as they are listed page by page."""
    users = cf.user_chain_positions(c.user_pages).withColumn("userid", F.col("id"))
    return wl.disconnect_plan(users, _load(c), USER_CAP, cf.POSITIONS_PER_BLOCK)


def _relinked(pages: DataFrame, at: Column, to: Column) -> DataFrame:
    """``pages`` whose row ``at`` names page ``to`` as the next one."""
    body = F.when(
        at, F.regexp_replace("body", F.lit('"next_page_id":-?[0-9]+'), F.concat(F.lit('"next_page_id":'), to))
    ).otherwise(F.col("body"))
    return pages.withColumn("body", body)


@query
def user_chain_positions(c: Clinic) -> DataFrame:
    """Users of pages whose numbers say nothing about their order."""
    users = cf.user_chain_positions(c.shuffled_user_pages, FIRST_SHUFFLED_PAGE)
    return users.select("list_pos", "id", "uid", "status")


@query
def page_chain_cycle(c: Clinic) -> DataFrame:
    """The last page names page 1 again."""
    pages = c.shuffled_user_pages
    last = F.col("body").contains('"next_page_id":-1,')
    return cf.page_chain(_relinked(pages, last, page_number(F.lit(1))), FIRST_SHUFFLED_PAGE)


@query
def page_chain_parts(c: Clinic) -> DataFrame:
    """Every tenth page from page 3 on never arrived, and the last page names itself."""
    pages = c.shuffled_user_pages
    lost = c.user_pages.where("page_id % 10 = 3").select(page_number(F.col("page_id")).alias("page_id"))
    landed = pages.join(lost, "page_id", "left_anti")
    last = F.col("body").contains('"next_page_id":-1,')
    return cf.page_chain(_relinked(landed, last, F.col("page_id")), FIRST_SHUFFLED_PAGE)


@query
def disconnect_plan_shuffled_pages(c: Clinic) -> DataFrame:
    """The release plan in list order, whatever the numbers of the pages are."""
    users = cf.user_chain_positions(c.shuffled_user_pages, FIRST_SHUFFLED_PAGE).withColumn("userid", F.col("id"))
    return wl.disconnect_plan(users, _load(c), USER_CAP, cf.POSITIONS_PER_BLOCK)
