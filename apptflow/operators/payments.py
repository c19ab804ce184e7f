"""Payment reconciliation and notices about unpaid visits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow import config
from apptflow.functions.text import blank_to_null, label
from apptflow.functions.timeexpr import minute_floor, ntz, shift_minutes, start_ts, time_text
from apptflow.operators.joins import Everything, Selection, left_lookup, smallest_per_key
from apptflow.operators.ledger import unsent_notifications
from apptflow.operators.ranges import points_in_ranges
from apptflow.operators.services import ServiceList, with_listed_service

MONEY = "decimal(18,2)"
PAYMENT_KEY = ["pcode", "planid"]


# --- Money ----------------------------------------------------------------------


def payment_movements(
    incom: DataFrame, losecredit: DataFrame, jppayments: DataFrame, clavans: DataFrame
) -> DataFrame:
    """The four payment sources in one shape: pcode, typeoper, planid, amount."""

    def shape(df: DataFrame, typeoper: Column) -> DataFrame:
        return df.select(
            "pcode",
            typeoper.cast("int").alias("typeoper"),
            "planid",
            F.col("amountrub").cast(MONEY).alias("amount"),
        )

    counted_ref = ~F.col("incref").isin(list(config.EXCLUDED_INCOME_REFS))  # null ref: not counted
    paycode, opertype = F.col("paycode"), F.col("opertype")
    refund = (paycode == 5) & counted_ref
    return (
        shape(incom.where(paycode.isin(1, 3) | refund), F.when(paycode == 5, 2).otherwise(1))
        .unionByName(shape(losecredit, F.lit(1)))
        .unionByName(shape(jppayments.where((opertype == 5) & counted_ref), F.lit(2)))
        .unionByName(shape(clavans, F.col("typeoper")))
    )


def payments_by_plan(movements: DataFrame) -> DataFrame:
    """Signed balance per patient and plan; summed per task before the shuffle."""
    outgoing = F.col("typeoper").isin(list(config.OUTGOING_MOVEMENT_TYPES))
    signed = F.when(outgoing, -F.col("amount")).otherwise(F.col("amount"))
    return movements.groupBy(*PAYMENT_KEY).agg(F.sum(signed).cast(MONEY).alias("amountrub"))


# --- Insurance ------------------------------------------------------------------


def agreement_lines(
    clhistnum: DataFrame, jpersons: DataFrame, jplists: DataFrame, jpagreement: DataFrame
) -> DataFrame:
    """A patient's contracts with their wording, one row each."""
    return (
        clhistnum.join(jpersons.select("jid", "jname"), "jid")
        .join(jplists.select(F.col("lid").alias("lstid"), "shortname"), "lstid")
        .join(jpagreement.select("agrid", "agnum"), "agrid")
        .select(
            "pcode",
            F.concat("jname", F.lit(" "), "agnum", F.lit(" "), "shortname").alias("agreement"),
            "bdate",
            "fdate",
            "datecancel",
            "isdeleted",
        )
    )


def valid_agreements(
    schedule: DataFrame, agreements: DataFrame, separator: str = "; ", selection=Everything
) -> DataFrame:
    """Contracts valid on the visit day as one sorted text per appointment.

    A patient's list for a day is built once per (patient, day), not once per
    appointment, so a patient with many appointments does not multiply the
    contracts.  Days meet only contracts that are valid on them, and a patient with very
    many of both is spread over blocks of days (``ranges``).  The list of a patient and
    day is one cell of the result.  Appointments without a valid contract have no row.
    """
    days = schedule.select("pcode", "workdate").dropna().distinct()
    live = agreements.where(F.coalesce(F.col("isdeleted"), F.lit(0)) == 0).select(
        "pcode",
        "agreement",
        F.unix_date(F.col("bdate").cast("date")).alias("from_day"),
        F.unix_date(F.coalesce("datecancel", "fdate").cast("date")).alias("to_day"),
    )
    valid = points_in_ranges(
        days.withColumn("day", F.unix_date("workdate")),
        selection.narrow(live, pcode="pcode"),
        ["pcode"],
        "day",
        "from_day",
        "to_day",
        stored=selection is Everything,  # the rows a poll picks are few
    )
    lists = (
        valid.where(F.col("agreement").isNotNull())
        .groupBy("pcode", "workdate")
        .agg(F.array_join(F.sort_array(F.collect_list("agreement")), separator).alias("clhistinfo"))
    )
    return schedule.select("schedid", "pcode", "workdate").join(lists, ["pcode", "workdate"]).select(
        "schedid", "clhistinfo"
    )


# --- Candidates -----------------------------------------------------------------


@dataclass(frozen=True)
class PaymentTables:
    schedule: DataFrame
    filials: DataFrame
    doctor: DataFrame
    clients: DataFrame
    roster: DataFrame  # by schedident
    departments: DataFrame
    dailyplan: DataFrame
    plan_detail: DataFrame
    sched_detail: DataFrame
    agreements: DataFrame
    movements: DataFrame


def account_flags(appointments: DataFrame) -> DataFrame:
    """Adds online_account (may the patient pay online) and paytype."""
    may_pay = (F.coalesce("webpaytype", F.lit(0)) == 1) & (F.coalesce("webaccesstype", F.lit(0)) == 3)
    return appointments.withColumn("online_account", F.when(may_pay, "yes").otherwise("no")).withColumn(
        "paytype", F.when(F.col("did").isNull(), "planned").otherwise("pre-invoice")
    )


def valid_branches(schedule: DataFrame, branches: Sequence[int], keep: bool = True) -> DataFrame:
    """Rows of the listed branches (or of all others); a null branch is in neither."""
    inside = F.col("filial").isin(list(branches))
    return schedule.where(inside if keep else ~inside)


def payment_candidates(
    tables: PaymentTables,
    services: ServiceList = config.ONLINE_SERVICES,
    picked: DataFrame | None = None,
    separator: str = "; ",
) -> DataFrame:
    """Appointments with a listed service and what was billed and paid for them.

    ``picked`` is a part of the schedule (see ``due_appointments``); payments,
    contracts and details are then read for those appointments alone.
    """
    t = tables
    chosen = Everything if picked is None else Selection(picked)
    base = t.schedule if picked is None else chosen.rows
    plans = (
        t.dailyplan.where(F.col("plantype") == config.PREINVOICE_PLAN_TYPE)
        .select(F.col("did").alias("planid"), "summarub_disc")
        .where(F.col("planid").isNotNull())
        .withColumn("did", F.col("planid"))
    )
    s = left_lookup(base, chosen.narrow(plans, planid="planid"), ["planid"], "schedid")
    s = with_listed_service(
        s,
        chosen.narrow(t.plan_detail, did="planid"),
        chosen.narrow(t.sched_detail, schedid="schedid"),
        services,
        plan_key="did",
    )
    # one department per appointment: a roster row repeated elsewhere adds no candidate
    seats = chosen.narrow(t.roster.select("schedident", "depnum"), schedident="schedident")
    seats = smallest_per_key(seats.join(t.departments.select("depnum", "depname"), "depnum"), ["schedident"])
    s = (
        s.join(t.filials.select(F.col("filid").alias("filial"), "shortname"), "filial")
        .join(t.doctor.select("dcode", "dname"), "dcode")
        .join(seats, "schedident")
    )
    people = t.clients.select(
        "pcode", "fullname", "histnum", "bdate", "phone1", "phone2", "phone3", "webpaytype", "webaccesstype"
    )
    s = s.join(chosen.narrow(people, pcode="pcode"), "pcode")
    paid = payments_by_plan(chosen.narrow(t.movements, pcode="pcode", planid="planid"))
    s = left_lookup(s, paid.dropna(subset=PAYMENT_KEY), PAYMENT_KEY, "schedid")
    s = s.join(valid_agreements(base, t.agreements, separator, chosen), "schedid", "left")
    zero = F.lit(0).cast(MONEY)
    return account_flags(s).select(
        "schedid",
        "filial",
        "shortname",
        "dname",
        "workdate",
        time_text(start_ts(F.col("workdate"), F.col("bhour"), F.col("bmin"))).alias("worktime"),
        "bhour",
        "bmin",
        "fullname",
        "histnum",
        F.col("bdate"),
        "phone1",
        "phone2",
        "phone3",
        "createdate",
        F.coalesce(F.col("summarub_disc").cast(MONEY), zero).alias("amount_payable"),
        F.coalesce("amountrub", zero).alias("paid_by_client"),
        "online_account",
        "paytype",
        "clhistinfo",
        "depname",
    )


def _branch_offset(offsets: Mapping[int, int]) -> Column:
    return label(F.col("filial"), offsets, F.lit(0)).cast("int")


def created_window(
    as_of: datetime, offsets: Mapping[int, int] = config.OFFSET_BRANCHES, minutes: int = config.PAYMENT_CREATED_MIN
) -> Column:
    """Created within ``minutes`` of now on the branch's own clock."""
    now = shift_minutes(ntz(as_of), _branch_offset(offsets))
    widest = max([0, *offsets.values()]) + minutes
    coarse = F.col("createdate").between(
        ntz(as_of - timedelta(minutes=minutes)), ntz(as_of + timedelta(minutes=widest))
    )
    exact = F.col("createdate").between(shift_minutes(now, -minutes), shift_minutes(now, minutes))
    return coarse & F.col("filial").isNotNull() & exact


def start_window(
    as_of: datetime, offsets: Mapping[int, int] = config.OFFSET_BRANCHES, minutes: int = config.PAYMENT_START_MIN
) -> Column:
    """Starts today, 0 to ``minutes`` whole minutes from now on the branch's clock."""
    today = F.col("workdate") == F.lit(as_of.date())
    now = minute_floor(shift_minutes(ntz(as_of), _branch_offset(offsets)))
    start = start_ts(F.col("workdate"), F.col("bhour"), F.col("bmin"))
    return today & F.col("filial").isNotNull() & start.between(now, shift_minutes(now, minutes))


def due_appointments(
    schedule: DataFrame, as_of: datetime, offsets: Mapping[int, int] = config.OFFSET_BRANCHES
) -> DataFrame:
    """Appointments in any of the four payment windows.

    Two scans rather than one with an OR: the creation window skips row groups
    by ``createdate``, the start window reads one day's partition.
    """
    created = created_window(as_of, offsets)
    only_starting = start_window(as_of, offsets) & ~F.coalesce(created, F.lit(False))
    return schedule.where(created).unionByName(schedule.where(only_starting))


def payment_due_soon(
    cands: DataFrame,
    as_of: datetime,
    branch_offsets: Mapping[int, int] = config.OFFSET_BRANCHES,
) -> DataFrame:
    """Candidates in any of the four payment windows, each appointment once.

    Candidates built with ``picked=due_appointments(...)`` pass unchanged.
    """
    due = created_window(as_of, branch_offsets) | start_window(as_of, branch_offsets)
    return smallest_per_key(cands.where(due), ["schedid"])


# --- Decisions ------------------------------------------------------------------

SOON, NEW = "payment_soon", "payment_new"


def payment_decisions(
    cands: DataFrame, ledger: DataFrame, as_of: datetime, since: datetime | None = None
) -> DataFrame:
    """Adds ``decision``; keeps rows that need a notice not given before.

    The two events have separate ledgers: a visit reported as new may be
    reported again when it is about to start unpaid.
    """
    start = start_ts(F.col("workdate"), F.col("bhour"), F.col("bmin"))
    invoiced = F.col("paytype") == "pre-invoice"
    account = F.col("online_account") == "yes"
    soon = start <= shift_minutes(ntz(as_of), config.PAYMENT_START_MIN)
    decision = (
        F.when(invoiced & (F.col("paid_by_client") == F.col("amount_payable")), "paid")
        .when(soon, "starts_soon")
        .when(invoiced & account, "pays_online")
        .when(invoiced, "invoice_no_account")
        .when(account, "planned_account")
        .otherwise("planned_no_account")
    )
    due = (
        cands.withColumn("decision", decision)
        .where(~F.col("decision").isin("paid", "pays_online"))
        .withColumn("kind", F.when(F.col("decision") == "starts_soon", SOON).otherwise(NEW))
        .withColumn("key", F.col("schedid").cast("string"))
    )
    return unsent_notifications(due, ledger, since)


def payment_notices(
    decisions: DataFrame,
    routes: Mapping[str, Sequence[str]],
    base_recipients: Sequence[str] = (),
    texts: Mapping[str, str] = config.PAYMENT_TEXTS,
) -> DataFrame:
    """Decisions with everything a person needs to act on them.

    ``routes`` maps a branch short name to extra recipients (a settings list,
    folded into the expression).
    """
    always = F.array(*[F.lit(r) for r in base_recipients]).cast("array<string>")
    extra = F.array().cast("array<string>")
    for branch, people in routes.items():
        own = F.array(*[F.lit(p) for p in people]).cast("array<string>")
        extra = F.when(F.col("shortname") == branch, own).otherwise(extra)
    phones = [blank_to_null(F.col(c)) for c in ("phone1", "phone2", "phone3")]
    listed = F.when(F.trim("clhistinfo") != "", F.col("clhistinfo"))
    coverage = F.concat(F.lit(config.COVERAGE_PREFIX), listed)
    return (
        decisions.withColumn("body", label(F.col("decision"), texts, F.lit(None).cast("string")))
        .withColumn("contacts", F.concat_ws("; ", *phones))
        .withColumn("coverage", F.coalesce(coverage, F.lit(config.COVERAGE_CASH)))
        .withColumn("recipients", F.array_join(F.concat(always, extra), ";"))
    )
