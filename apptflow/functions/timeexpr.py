"""Date and time expressions.

Everything is zone-free (``timestamp_ntz``).  An appointment's date, hour and
minute become one timestamp first, so windows that cross midnight keep working.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day(d: date) -> Column:
    return F.lit(d)


def start_ts(workdate: Column, hour: Column, minute: Column) -> Column:
    """The moment an appointment begins."""
    zero = F.lit(0)
    return workdate.cast("timestamp_ntz") + F.make_dt_interval(zero, hour, minute, zero)


def shift_seconds(ts: Column, seconds: float | int | Column) -> Column:
    zero = F.lit(0)
    secs = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return ts + F.make_dt_interval(zero, zero, zero, secs.cast("decimal(18,6)"))


def shift_minutes(ts: Column, minutes: int | Column) -> Column:
    zero = F.lit(0)
    mins = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return ts + F.make_dt_interval(zero, zero, mins.cast("int"), zero)


def minute_floor(ts: Column) -> Column:
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, F.date_part(F.lit("SECOND"), ts))


def minute_diff(a: Column, b: Column) -> Column:
    """Minutes from ``a`` to ``b``, seconds ignored on both sides."""
    return (minute_floor(b) - minute_floor(a)).cast("interval minute").cast("bigint")


def date_text(d: Column) -> Column:
    return F.date_format(d, "dd.MM.yyyy")


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def datetime_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm dd.MM.yyyy")


def send_time_text(ts: Column) -> Column:
    """Gateway format of a delayed send: minutes, then literal zero seconds."""
    return F.concat(F.date_format(ts, "yyyyMMddHHmm"), F.lit("00"))


def parse_local(date_dmy: Column, hour: Column, minute: Column) -> Column:
    """``dd.mm.yyyy`` text plus hour and minute; null when it is not a moment."""
    on_clock = hour.between(0, 23) & minute.between(0, 59)
    return F.when(on_clock, start_ts(F.try_to_date(date_dmy, "d.M.yyyy"), hour, minute))


def age_years(on: Column, birth: Column) -> Column:
    """Full calendar years; a 29 February birthday counts from 1 March."""
    before = (F.month(on) * 100 + F.dayofmonth(on)) < (F.month(birth) * 100 + F.dayofmonth(birth))
    return F.year(on) - F.year(birth) - before.cast("int")
