"""New bookings and upcoming-visit reminders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.config import (
    NEW_LOOKBACK_S,
    NEW_LOOKBACK_STRICT_S,
    ONLINE_SERVICES,
    REMINDER_LEAD_S,
    STRICT_DEPARTMENTS,
)
from apptflow.functions import timeexpr as t
from apptflow.functions.text import is_free
from apptflow.functions.timeexpr import date_text, day, ntz, shift_seconds, start_ts
from apptflow.operators.joins import Selection, left_lookup, smallest_per_key
from apptflow.operators.services import ServiceList, with_listed_service

PHONES = ("phone1", "phone2", "phone3")
EVENT_COLUMNS = ("schedid", "pcode", *PHONES, "data", "bhour", "bmin")


def free_appointments(schedule: DataFrame) -> DataFrame:
    """Appointments nobody has taken over yet."""
    return schedule.where(is_free(F.col("emid")))


def online_appointments(schedule: DataFrame) -> DataFrame:
    return free_appointments(schedule).where(F.col("onlinetype") == 1)


def created_within(as_of: datetime, lookback_s: float) -> Column:
    """Creation window with an upper end, so that a replay sees what a run saw."""
    return F.col("createdate").between(shift_seconds(ntz(as_of), -lookback_s), ntz(as_of))


def starts_within(as_of: datetime, lead_s: float) -> Column:
    """Start between now and ``lead_s`` from now, both ends included.

    The date range is stated on the bare column as well: it prunes partitions
    and row groups, which a computed start time cannot.
    """
    begin, end = ntz(as_of), shift_seconds(ntz(as_of), lead_s)
    start = start_ts(F.col("workdate"), F.col("bhour"), F.col("bmin"))
    dates = F.col("workdate").between(begin.cast("date"), end.cast("date"))
    return dates & start.between(begin, end)


def with_date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("data", date_text(F.col("workdate")))


def contacts_of(picked: Selection, clients: DataFrame) -> DataFrame:
    """Phones of the picked appointments' patients."""
    contacts = clients.select("pcode", *PHONES).where(F.col("pcode").isNotNull())
    return picked.narrow(contacts, pcode="pcode")


def with_contacts(appointments: DataFrame, contacts: DataFrame) -> DataFrame:
    """Appointments with their patient's phones; unknown patients have none."""
    joined = left_lookup(appointments, contacts, ["pcode"], "schedid")
    return with_date_text(joined).select(*EVENT_COLUMNS)


def new_appointments(
    schedule: DataFrame, clients: DataFrame, as_of: datetime, lookback_s: float = NEW_LOOKBACK_S
) -> DataFrame:
    """Online bookings made in the lookback window, with the patient's phones."""
    picked = Selection(online_appointments(schedule).where(created_within(as_of, lookback_s)))
    return with_contacts(picked.rows, contacts_of(picked, clients))


def patient_reminders(
    schedule: DataFrame, clients: DataFrame, as_of: datetime, lead_s: float = REMINDER_LEAD_S
) -> DataFrame:
    """Online visits about to start, with the patient's phones."""
    picked = Selection(online_appointments(schedule).where(starts_within(as_of, lead_s)))
    return with_contacts(picked.rows, contacts_of(picked, clients))


def on_roster(
    appointments: DataFrame,
    chairs: DataFrame,
    rooms: DataFrame,
    roster: DataFrame,
    depnums: Sequence[int] | None = None,
) -> DataFrame:
    """Appointments in an existing chair and room on the doctor's roster.

    Only existence matters, so these are semi joins: an appointment that meets
    two roster rows is still one appointment.
    """
    seated = chairs.join(rooms.select("rid"), "rid", "left_semi").select("chid")
    if depnums is not None:
        roster = roster.where(F.col("depnum").isin(list(depnums)))
    shifts = roster.select("dcode", F.col("wdate").alias("workdate"), F.col("chair").alias("chid"))
    return appointments.join(seated, "chid", "left_semi").join(
        shifts, ["dcode", "workdate", "chid"], "left_semi"
    )


def doctor_reminders(
    schedule: DataFrame,
    clients: DataFrame,
    chairs: DataFrame,
    rooms: DataFrame,
    roster: DataFrame,
    doctor: DataFrame,
    plan_detail: DataFrame,
    sched_detail: DataFrame,
    services: ServiceList = ONLINE_SERVICES,
    *,
    as_of: datetime,
    lead_s: float = REMINDER_LEAD_S,
) -> DataFrame:
    """Visits with a listed service about to start, with the doctor's phone.

    The booking channel does not matter here, unlike for patients.
    """
    picked = Selection(free_appointments(schedule).where(starts_within(as_of, lead_s)))
    known = picked.narrow(clients.select("pcode"), pcode="pcode")
    return doctors_of(
        picked, picked.rows, known, chairs, rooms, roster, doctor, plan_detail, sched_detail, services
    )


def doctors_of(
    picked: Selection,
    appointments: DataFrame,
    known: DataFrame,
    chairs: DataFrame,
    rooms: DataFrame,
    roster: DataFrame,
    doctor: DataFrame,
    plan_detail: DataFrame,
    sched_detail: DataFrame,
    services: ServiceList,
) -> DataFrame:
    """The doctor's phone for ``appointments``, a part of the picked rows.

    Appointments need a listed service, a place on the roster and a patient among
    ``known``.  Of several phones of a doctor the smallest counts.
    """
    listed = with_listed_service(
        on_roster(appointments, chairs, rooms, roster).join(known, "pcode", "left_semi"),
        picked.narrow(plan_detail, did="planid"),
        picked.narrow(sched_detail, schedid="schedid"),
        services,
    )
    phones = doctor.select("dcode", "phoneint")
    rows = with_date_text(listed.join(phones, "dcode")).select("schedid", "data", "bhour", "bmin", "phoneint")
    return smallest_per_key(rows, ["schedid"])


def poll_selection(
    schedule: DataFrame,
    as_of: datetime,
    lookback_s: float = NEW_LOOKBACK_S,
    lead_s: float = REMINDER_LEAD_S,
) -> Selection:
    """What one poll looks at, in one scan: flags ``is_new``, ``is_soon``, ``is_online``."""
    online = F.coalesce(F.col("onlinetype") == 1, F.lit(False))
    new = online & F.coalesce(created_within(as_of, lookback_s), F.lit(False))
    soon = F.coalesce(starts_within(as_of, lead_s), F.lit(False))
    flagged = free_appointments(schedule).withColumns({"is_new": new, "is_soon": soon, "is_online": online})
    return Selection(flagged.where(F.col("is_new") | F.col("is_soon")))


def _strict(
    picked: DataFrame,
    clients: DataFrame,
    chairs: DataFrame,
    rooms: DataFrame,
    roster: DataFrame,
    doctor: DataFrame,
    depnums: Sequence[int],
) -> DataFrame:
    selection = Selection(picked)
    seated = on_roster(selection.rows, chairs, rooms, roster, depnums).join(
        doctor.select("dcode"), "dcode", "left_semi"
    )
    people = selection.narrow(
        clients.select("pcode", *PHONES, "fullname", "histnum"), pcode="pcode"
    )
    return with_date_text(seated.join(people, "pcode")).select(*EVENT_COLUMNS, "fullname", "histnum")


def new_appointments_strict(
    schedule: DataFrame,
    clients: DataFrame,
    chairs: DataFrame,
    rooms: DataFrame,
    roster: DataFrame,
    doctor: DataFrame,
    depnums: Sequence[int] = STRICT_DEPARTMENTS,
    *,
    as_of: datetime,
    lookback_s: float = NEW_LOOKBACK_STRICT_S,
) -> DataFrame:
    """Bookings of today, for today or later, with a known patient, chair, room,
    roster row in a listed department, and doctor."""
    today = as_of.date()
    recent = online_appointments(schedule).where(
        created_within(as_of, lookback_s)
        & (F.to_date("createdate") == day(today))
        & (F.col("workdate") >= day(today))
    )
    return _strict(recent, clients, chairs, rooms, roster, doctor, depnums)


def patient_reminders_strict(
    schedule: DataFrame,
    clients: DataFrame,
    chairs: DataFrame,
    rooms: DataFrame,
    roster: DataFrame,
    doctor: DataFrame,
    depnums: Sequence[int] = STRICT_DEPARTMENTS,
    *,
    as_of: datetime,
    lead_s: float = REMINDER_LEAD_S,
) -> DataFrame:
    soon = online_appointments(schedule).where(starts_within(as_of, lead_s))
    return _strict(soon, clients, chairs, rooms, roster, doctor, depnums)


def appointment_times(schedule: DataFrame, as_of: datetime) -> DataFrame:
    """The time expressions of one appointment side by side."""
    start = start_ts(F.col("workdate"), F.col("bhour"), F.col("bmin"))
    return with_date_text(schedule.withColumn("start_at", start)).select(
        "schedid",
        "data",
        t.time_text(F.col("start_at")).alias("worktime"),
        "start_at",
        t.shift_seconds(F.col("start_at"), -REMINDER_LEAD_S).alias("remind_from"),
        t.minute_diff(ntz(as_of), F.col("start_at")).alias("minutes_to_start"),
        t.minute_diff(F.col("createdate"), ntz(as_of)).alias("minutes_since_created"),
        t.parse_local(F.col("data"), F.col("bhour"), F.col("bmin")).alias("parsed_at"),
        t.datetime_text(F.col("start_at")).alias("spoken"),
        t.send_time_text(F.col("start_at")).alias("send_time"),
    )
