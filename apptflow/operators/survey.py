"""First-visit review requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow import config
from apptflow.functions.text import blank_to_null, contains_any, is_free, label
from apptflow.functions.timeexpr import age_years, ntz
from apptflow.operators.joins import Selection, left_lookup
from apptflow.operators.ledger import keys_of, of_day, unsent_notifications
from apptflow.operators.services import name_exclusions

SENT, CHECKED = "survey", "survey_checked"
SURVEY_COLUMNS = (
    "schedid",
    "schedule_date",
    "pcode",
    "patient",
    "age_in_years",
    "phone",
    "phone2",
    "phone3",
    "dcode",
    "doctor",
    "link",
    "profname",
    "doctpost",
    "target_fil_shortname",
    "department",
    "docname",
    "accepted_to_send",
)


def client_ages(clients: DataFrame, as_of: datetime) -> DataFrame:
    return clients.withColumn("age_in_years", age_years(F.lit(as_of.date()), F.col("bdate")))


def first_visits(visits: DataFrame, treats: DataFrame) -> DataFrame:
    """Visits without an earlier treatment by the same doctor.

    "No earlier treatment" needs only the earliest day per doctor and patient,
    which is computed before the join: however long a history is, it meets a
    visit as one row.  A treatment row without a code does not count as proof of
    an earlier visit when it is the one found, as in the outer join it replaces.
    """
    day = F.to_date("treatdate")
    earliest = treats.groupBy("dcode", "pcode").agg(
        F.min(day).alias("_first"),
        F.min(F.when(F.col("treatcode").isNull(), day)).alias("_first_uncoded"),
    )
    on = F.to_date("schedule_date")
    earlier = F.coalesce(F.col("_first") < on, F.lit(False))
    uncoded = F.coalesce(F.col("_first_uncoded") < on, F.lit(False))
    return (
        left_lookup(visits, earliest, ["dcode", "pcode"], "schedid")
        .where(~earlier | uncoded)
        .select(*visits.columns)
    )


@dataclass(frozen=True)
class SurveyRules:
    """What makes a visit worth a review request."""

    branches: Sequence[int] = config.SURVEY_BRANCHES
    ages: tuple[int, int] = config.SURVEY_AGE
    payer: str = config.SURVEY_PAYER
    departments_excluded: Sequence[str] = config.SURVEY_DEPARTMENTS_EXCLUDED
    service_words_excluded: Sequence[str] = config.SURVEY_SERVICE_WORDS_EXCLUDED
    staff_words_excluded: Sequence[str] = config.SURVEY_STAFF_WORDS_EXCLUDED


def survey_candidates(
    visits: DataFrame,
    clients: DataFrame,
    doctors: DataFrame,
    links: DataFrame,
    orderdet: DataFrame,
    wschema: DataFrame,
    treats: DataFrame,
    rules: SurveyRules = SurveyRules(),
    *,
    as_of: datetime,
) -> DataFrame:
    """Paid first visits since yesterday that qualify for a review request."""
    since = datetime.combine(as_of.date() - timedelta(days=1), datetime.min.time())
    recent = visits.where(
        (F.col("schedule_date") >= ntz(since))
        & F.col("treatcode").isNotNull()
        & F.col("target_filid").isin(list(rules.branches))
        & ~F.col("department").isin(list(rules.departments_excluded))
    ).select(
        "schedid",
        "schedule_date",
        "pcode",
        "dcode",
        "treatcode",
        "target_fil_shortname",
        "department",
    )
    picked = Selection(recent)

    # an order line is only asked about, never shown: one row per visit and payer
    services = name_exclusions(wschema.select("schid", "schname"), "schname", rules.service_words_excluded)
    lines = (
        picked.narrow(orderdet, treatcode="treatcode")
        .where(F.col("is_nal") & (F.col("docname") == rules.payer) & (F.col("schamount") > 0))
        .join(services.select("schid"), "schid", "left_semi")
        .select("treatcode", "docname")
        .distinct()
    )
    low, high = rules.ages
    people = client_ages(picked.narrow(clients, pcode="pcode"), as_of).where(
        F.col("age_in_years").between(low, high) & is_free(F.col("refusesms"))
    )
    staff = doctors.where(
        ~contains_any(F.concat("profname", "doctpost"), rules.staff_words_excluded)
    ).select(F.col("uid").alias("dcode"), F.col("fullname").alias("doctor"), "profname", "doctpost")
    linked = links.where(F.col("link").isNotNull()).select("dcode", "link")
    history = picked.narrow(treats, dcode="dcode", pcode="pcode")

    return (
        first_visits(picked.rows, history)
        .join(lines, "treatcode")
        .join(
            people.select(
                "pcode", F.col("fullname").alias("patient"), "age_in_years", "phone", "phone2", "phone3"
            ),
            "pcode",
        )
        .join(staff, "dcode")
        .join(linked, "dcode")
        .withColumn("accepted_to_send", F.lit(""))
        .select(*SURVEY_COLUMNS)
        .distinct()
    )


# --- When and to whom -----------------------------------------------------------


def survey_hours(as_of: datetime | Column) -> bool | Column:
    """Whether review requests go out at this hour.

    A run asks about its own ``as_of``; a replay passes a timestamp column.
    """
    first, end = config.SURVEY_HOURS
    if isinstance(as_of, datetime):
        return first <= as_of.hour < end
    hour = F.hour(as_of)
    return (hour >= first) & (hour < end)


def skip_code(visit: Column, as_of: datetime) -> Column:
    """0 send, 1 evening visit (tomorrow), 2 yesterday's outside the morning run,
    3 too recent (later today), 4 yesterday's daytime visit (already handled)."""
    days_ago = F.date_diff(F.lit(as_of.date()), F.to_date(visit))
    evening = F.hour(visit) >= config.SURVEY_EVENING_HOUR
    morning_run = F.lit(as_of.hour == config.SURVEY_HOURS[0])
    recent = visit > ntz(as_of - timedelta(hours=config.SURVEY_DELAY_H))
    return (
        F.when((days_ago == 0) & evening, 1)
        .when((days_ago == 1) & ~morning_run, 2)
        .when((days_ago == 0) & recent, 3)
        .when((days_ago == 1) & ~evening, 4)
        .otherwise(0)
    )


def survey_skip_codes(cands: DataFrame, ledger: DataFrame, as_of: datetime) -> DataFrame:
    """Adds ``skip_code`` and ``checked`` (dealt with in an earlier run today)."""
    checked = keys_of(of_day(ledger, as_of), CHECKED, "schedid").withColumn("_checked", F.lit(True))
    coded = cands.withColumn("skip_code", skip_code(F.col("schedule_date"), as_of))
    return (
        left_lookup(coded, checked, ["schedid"], "schedule_date")
        .withColumn("checked", F.coalesce("_checked", F.lit(False)))
        .drop("_checked")
    )


def survey_messages(
    coded: DataFrame,
    ledger: DataFrame,
    branch_links: Mapping[str, str],
    as_of: datetime,
    send_recent: bool = False,
) -> DataFrame:
    """At most one request per patient and day, for the earliest open visit.

    ``coded`` is the output of ``survey_skip_codes``.  A patient with further
    open visits gets the branch's link instead of the doctor's; visits checked
    in an earlier run still count as open, visits skipped in this run do not.
    Phones are used as stored.

    Visits younger than three hours wait for a later run.  ``send_recent`` sends
    them now, without counting them as open: the behaviour of a sending pass that
    does not look at the skip code again.

    One aggregate per patient does both the count and the choice, so a patient
    with very many visits is reduced inside each task before the shuffle.
    """
    phone = F.coalesce(*[blank_to_null(F.col(c)) for c in ("phone", "phone2", "phone3")])
    unmarked = (F.col("skip_code") == 0) | F.col("checked")
    sendable_codes = [0, 3] if send_recent else [0]
    visits = coded.withColumn("_phone", phone).withColumn("_open", unmarked)
    choice = F.struct(
        "schedule_date", "schedid", "patient", "_phone", "link", "target_fil_shortname", "_open"
    )
    sendable = (
        F.col("skip_code").isin(sendable_codes) & ~F.col("checked") & F.col("_phone").isNotNull()
    )
    per_patient = visits.groupBy("pcode").agg(
        F.min(F.when(sendable, choice)).alias("first"),
        F.count_distinct(F.when(F.col("_open"), F.col("schedid"))).alias("open"),
    )
    siblings = F.col("open") - F.col("first._open").cast("int")
    branch = label(F.col("first.target_fil_shortname"), branch_links, F.col("first.link"))
    text = F.when(
        siblings == 0, F.concat(F.lit(config.SURVEY_TEXT_DOCTOR), F.col("first.link"))
    ).otherwise(F.concat(F.lit(config.SURVEY_TEXT_BRANCH), branch))
    messages = per_patient.where(F.col("first").isNotNull()).select(
        F.lit(SENT).alias("kind"),
        F.col("pcode").cast("string").alias("key"),
        "pcode",
        F.col("first.schedid").alias("schedid"),
        F.col("first.patient").alias("recipient"),
        F.col("first._phone").alias("phone"),
        text.alias("text"),
    )
    return unsent_notifications(messages, of_day(ledger, as_of))


def survey_checked_marks(
    coded: DataFrame,
    messages: DataFrame,
    results: DataFrame,
    as_of: datetime,
    send_recent: bool = False,
) -> DataFrame:
    """Ledger rows for visits this run dealt with.

    ``messages`` are the run's requests (with ``schedid``) and ``results`` what became
    of them (``kind``, ``key``, ``ok``).  Marked are visits that the rules skip for
    good, the visit each request was about, visits without a phone, and all visits of
    a patient who was asked with success, in this run or before it today.  After a
    failure the patient's other open visits stay unmarked: the next run offers the
    next of them.  Visits that only wait (code 3) are marked if they were sent.
    """
    phone = F.coalesce(*[blank_to_null(F.col(c)) for c in ("phone", "phone2", "phone3")])
    outcome = results.where(F.col("kind") == SENT).select("key", "ok")
    asked = messages.select("key", F.col("schedid").alias("_tried")).join(outcome, "key", "left")
    asked = asked.groupBy(F.col("key").try_cast("bigint").alias("pcode")).agg(
        F.min("_tried").alias("_tried"), F.bool_or(F.coalesce("ok", F.lit(False))).alias("_ok")
    )
    visits = left_lookup(coded.withColumn("_phone", phone), asked, ["pcode"], "schedid")
    dealt_with = (
        F.col("_tried").isNull() | F.col("_ok") | F.col("_phone").isNull() | (F.col("schedid") == F.col("_tried"))
    )
    sendable = F.col("skip_code").isin([0, 3] if send_recent else [0])
    mark = F.when(sendable, dealt_with).otherwise(F.col("skip_code") != 3)
    return (
        visits.where(~F.col("checked") & mark)
        .select(F.lit(CHECKED).alias("kind"), F.col("schedid").cast("string").alias("key"))
        .distinct()
        .withColumn("sent_at", ntz(as_of))
    )
