"""Whole runs: selection, rules, ledger and messages as one plan each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from apptflow import config
from apptflow.operators import appointments as ap
from apptflow.operators import outbox as ob
from apptflow.operators import payments as pa
from apptflow.operators import survey as su
from apptflow.operators import workload as wl
from apptflow.operators.counts import RunCounts
from apptflow.operators.services import ServiceList
from apptflow.session import written_once
from apptflow.sources.sinks import append_ledger, write_run


def _since(as_of: datetime) -> datetime:
    """Marks before this cannot concern what a run picks."""
    return as_of - timedelta(days=config.LEDGER_DAYS)


@dataclass(frozen=True)
class AppointmentTables:
    schedule: DataFrame
    clients: DataFrame
    chairs: DataFrame
    rooms: DataFrame
    roster: DataFrame
    doctor: DataFrame
    plan_detail: DataFrame
    sched_detail: DataFrame


def event_result_sets(
    t: AppointmentTables, as_of: datetime, services: ServiceList = config.ONLINE_SERVICES
) -> dict[str, DataFrame]:
    """New bookings, patient reminders and doctor reminders of one poll.

    One scan of the schedule and one of the clients serve all three.
    """
    picked = ap.poll_selection(t.schedule, as_of)
    contacts = written_once(ap.contacts_of(picked, t.clients), "contacts")
    return {
        "new": ap.with_contacts(picked.rows.where("is_new"), contacts),
        "reminder_patient": ap.with_contacts(picked.rows.where("is_soon AND is_online"), contacts),
        "reminder_doctor": ap.doctors_of(
            picked,
            picked.rows.where("is_soon"),
            contacts.select("pcode"),
            t.chairs,
            t.rooms,
            t.roster,
            t.doctor,
            t.plan_detail,
            t.sched_detail,
            services,
        ),
    }


def appointment_run(
    t: AppointmentTables,
    ledger: DataFrame,
    as_of: datetime,
    services: ServiceList = config.ONLINE_SERVICES,
    templates: Mapping[str, str] = config.TEMPLATES,
    counts: RunCounts | None = None,
) -> DataFrame:
    """The outbox of one poll of the schedule; ``counts`` is filled when it is stored."""
    by_kind = event_result_sets(t, as_of, services)
    return ob.outbox_messages(by_kind, ledger, templates, since=_since(as_of), counts=counts)


def payment_run(
    t: pa.PaymentTables,
    ledger: DataFrame,
    as_of: datetime,
    routes: Mapping[str, Sequence[str]],
    base_recipients: Sequence[str] = (),
    services: ServiceList = config.ONLINE_SERVICES,
) -> DataFrame:
    """Notices about visits that are new or start soon and are not paid."""
    picked = pa.due_appointments(t.schedule, as_of)
    due = pa.payment_due_soon(pa.payment_candidates(t, services, picked), as_of)
    decisions = pa.payment_decisions(due, ledger, as_of, _since(as_of))
    return pa.payment_notices(decisions, routes, base_recipients)


@dataclass(frozen=True)
class SurveyTables:
    visits: DataFrame
    clients: DataFrame
    doctors: DataFrame
    links: DataFrame
    orderdet: DataFrame
    wschema: DataFrame
    treats: DataFrame


def survey_coded(
    t: SurveyTables, ledger: DataFrame, as_of: datetime, rules: su.SurveyRules = su.SurveyRules()
) -> DataFrame:
    """Candidates of one run with their skip codes."""
    cands = su.survey_candidates(
        t.visits, t.clients, t.doctors, t.links, t.orderdet, t.wschema, t.treats, rules, as_of=as_of
    )
    return su.survey_skip_codes(cands, ledger, as_of)


def survey_run(
    t: SurveyTables,
    ledger: DataFrame,
    as_of: datetime,
    branch_links: Mapping[str, str],
    rules: su.SurveyRules = su.SurveyRules(),
    send_recent: bool = False,
) -> tuple[DataFrame, DataFrame] | None:
    """Messages of one run and the coded visits they come from; nothing outside
    sending hours.  The marks follow from both and the send results, see
    ``survey.survey_checked_marks``."""
    if not su.survey_hours(as_of):
        return None
    coded = written_once(survey_coded(t, ledger, as_of, rules), "coded")
    return su.survey_messages(coded, ledger, branch_links, as_of, send_recent), coded


@dataclass(frozen=True)
class WorkloadTables:
    schedule: DataFrame
    roster: DataFrame
    departments: DataFrame
    dailyplan: DataFrame
    plan_detail: DataFrame
    sched_detail: DataFrame
    doctor: DataFrame


def workload_run(
    t: WorkloadTables, as_of: datetime, services: ServiceList = config.WORKLOAD_SERVICES
) -> DataFrame:
    """Online load per user for today."""
    return wl.online_user_load(
        wl.busy_intervals(t.roster, t.schedule, as_of),
        t.departments,
        t.dailyplan,
        t.plan_detail,
        t.sched_detail,
        t.doctor,
        services,
        as_of=as_of,
    )


def release_run(
    users: DataFrame,
    t: WorkloadTables,
    as_of: datetime,
    cap: int,
    services: ServiceList = config.WORKLOAD_SERVICES,
) -> DataFrame:
    """Users to release so that at most ``cap`` stay online."""
    return wl.disconnect_plan(users, workload_run(t, as_of, services), cap)


def store_run(
    messages: DataFrame,
    outbox: str,
    run: int,
    marks: Callable[[DataFrame], DataFrame] | None = None,
    ledger: str | None = None,
) -> None:
    """Writes a run's messages, then its marks; a repeated run replaces both.

    ``marks`` makes the ledger rows from the messages as they were written, so both
    speak of the same rows.  Messages come first: a job lost in between repeats the run
    and writes the same folder again, while marks without messages would silence it.
    Build and store a run inside ``session.run_scope``, which removes what it stored on
    the way.
    """
    spark = messages.sparkSession
    write_run(messages, outbox, run)
    if marks is not None and ledger is not None:
        stored = spark.read.schema(messages.schema).parquet(f"{outbox}/run_id={run}")
        append_ledger(marks(stored), ledger, run)
