"""Doctors' online workload and the plan of users to release."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from apptflow import config
from apptflow.functions.text import label
from apptflow.functions.timeexpr import ntz, shift_minutes, shift_seconds, start_ts
from apptflow.operators.joins import Selection, left_lookup
from apptflow.operators.services import ServiceList, with_service_flag
from apptflow.session import written_once

SLOT_KEY = ["dcode", "wdate", "slot_begin"]


def with_shift(roster: DataFrame) -> DataFrame:
    """Roster rows with the shift as two timestamps."""
    return roster.withColumn(
        "shift_begin", start_ts(F.col("wdate"), F.col("beghour"), F.col("begmin"))
    ).withColumn("shift_end", start_ts(F.col("wdate"), F.col("endhour"), F.col("endmin")))


def slot_grid(roster: DataFrame, schedule: DataFrame, slot_min: int = 30, visit_min: int = 30) -> DataFrame:
    """Every shift cut into slots of ``slot_min``; busy where a visit covers them.

    Visits are cut to the same grid, so the range test becomes an equality on
    (doctor, day, slot): no pair of a visit and a slot it does not touch exists.
    A slot touched by several visits has a row for each.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(slot_min), F.lit(0))
    shifts = with_shift(roster).select("dcode", "wdate", "shift_begin", "shift_end").distinct()
    last = F.col("shift_end") - step
    slots = (
        shifts.where(F.col("shift_begin") <= last)
        .withColumn("slot_begin", F.explode(F.sequence("shift_begin", last, step)))
        .select(*SLOT_KEY)
        .distinct()
    )
    visits = schedule.select(
        "dcode",
        F.col("workdate").alias("wdate"),
        "schedid",
        start_ts(F.col("workdate"), F.col("bhour"), F.col("bmin")).alias("begin"),
    )
    # slots are counted from the shift begin, which visits must know; a doctor's
    # day has one row per distinct shift begin
    begins = shifts.select("dcode", "wdate", "shift_begin").distinct()
    placed = visits.join(begins, ["dcode", "wdate"])
    offset = ((F.col("begin") - F.col("shift_begin")).cast("interval minute")).cast("int")
    first = F.floor(offset / F.lit(slot_min)).cast("int")
    past = F.ceil((offset + F.lit(visit_min)) / F.lit(slot_min)).cast("int") - 1
    covered = (
        placed.withColumn("n", F.explode(F.sequence(first, past)))
        .withColumn("slot_begin", shift_minutes(F.col("shift_begin"), F.col("n") * slot_min))
        .select(*SLOT_KEY, "schedid")
        .distinct()
    )
    # two one-sided joins, not an outer one: a slot that holds very many visits can
    # be split between tasks, and meets the grid as one key
    busy = covered.join(slots, SLOT_KEY, "left_semi").withColumn("isfree", F.lit(0))
    free = (
        slots.join(covered.select(*SLOT_KEY).distinct(), SLOT_KEY, "left_anti")
        .withColumn("schedid", F.lit(None).cast("bigint"))
        .withColumn("isfree", F.lit(1))
    )
    return busy.unionByName(free).select(
        "dcode", "wdate", "slot_begin", (F.col("slot_begin") + step).alias("slot_end"), "schedid", "isfree"
    )


def free_gaps(roster: DataFrame, schedule: DataFrame, visit_min: int = 30) -> DataFrame:
    """The stretches of every shift that no visit covers, whatever their length.

    Visits may overlap, touch and reach over the ends of a shift. Equal visits of a doctor's
    day count once before they are ordered, so a day's task has at most as many rows as the
    day has minutes. Each distinct shift of a doctor's day has its own gaps; a shift without
    visits is one gap, one that ends before it begins has none.
    """
    begin = start_ts(F.col("workdate"), F.col("bhour"), F.col("bmin"))
    visits = schedule.select("dcode", F.col("workdate").alias("wdate"), begin.alias("begin")).dropna().distinct()
    visits = visits.withColumn("end", shift_minutes(F.col("begin"), visit_min))
    in_day = W.partitionBy("dcode", "wdate").orderBy("begin")
    # what is covered reaches to the latest end so far, and the next visit may begin within it
    visits = visits.select(
        "dcode",
        "wdate",
        "begin",
        F.row_number().over(in_day).alias("n"),
        F.max("end").over(in_day.rowsBetween(W.unboundedPreceding, 0)).alias("reach"),
        F.lead("begin").over(in_day).alias("next"),
    )
    moment = F.lit(None).cast("timestamp_ntz")
    before = F.when(F.col("n") == 1, F.struct(moment.alias("open"), F.col("begin").alias("shut")))
    open_after = F.col("next").isNull() | (F.col("next") > F.col("reach"))
    after = F.when(open_after, F.struct(F.col("reach").alias("open"), F.col("next").alias("shut")))
    gaps = visits.select("dcode", "wdate", F.inline(F.array_compact(F.array(before, after))))
    shifts = with_shift(roster).select("dcode", "wdate", "shift_begin", "shift_end").distinct()
    # null ends of a gap are open: the shift's own ends count
    return (
        shifts.join(gaps, ["dcode", "wdate"], "left")
        .withColumn("gap_begin", F.greatest("shift_begin", "open"))
        .withColumn("gap_end", F.least("shift_end", "shut"))
        .where(F.col("gap_begin") < F.col("gap_end"))
        .select("dcode", "wdate", "shift_begin", "gap_begin", "gap_end")
    )


#: the same rule for SQL, as a table function to be called laterally
FREE_GAPS_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION free_gaps(
    shift_begin TIMESTAMP_NTZ, shift_end TIMESTAMP_NTZ,
    visits ARRAY<STRUCT<begin: TIMESTAMP_NTZ, end: TIMESTAMP_NTZ>>)
RETURNS TABLE (gap_begin TIMESTAMP_NTZ, gap_end TIMESTAMP_NTZ)
RETURN SELECT g.gap_begin, g.gap_end FROM (SELECT explode(filter(
    transform(sequence(0, size(visits)), i -> named_struct(
        'gap_begin', greatest(shift_begin, array_max(transform(slice(array_sort(visits), 1, i), v -> v.end))),
        'gap_end', least(shift_end, get(array_sort(visits), i).begin))),
    g -> g.gap_begin < g.gap_end)) AS g)
"""


def register_free_gaps(spark: SparkSession) -> None:
    """Makes ``free_gaps(shift_begin, shift_end, visits)`` known to the session's SQL.

    ``SELECT s.*, g.* FROM shifts s, LATERAL free_gaps(s.shift_begin, s.shift_end, s.visits) g``
    gives the gaps of shifts that carry their visits in a column (null counts as none).
    """
    spark.sql(FREE_GAPS_SQL)


def busy_intervals(roster: DataFrame, schedule: DataFrame, as_of: datetime, visit_min: int = 30) -> DataFrame:
    """Today's visits on working roster rows, one interval each."""
    today = F.lit(as_of.date())
    shifts = (
        roster.where((F.col("wdate") == today) & (F.col("daytype") == 1))
        .select("dcode", "chair", "depnum")
        .distinct()
    )
    begin = start_ts(F.col("workdate"), F.col("bhour"), F.col("bmin"))
    visits = schedule.where(F.col("workdate") == today).select(
        "schedid",
        "planid",
        "dcode",
        F.col("chid").alias("chair"),
        begin.alias("beg_time"),
        shift_minutes(begin, visit_min).alias("end_time"),
    )
    return visits.join(shifts, ["dcode", "chair"])


def online_user_load(
    intervals: DataFrame,
    departments: DataFrame,
    dailyplan: DataFrame,
    plan_detail: DataFrame,
    sched_detail: DataFrame,
    doctor: DataFrame,
    services: ServiceList = config.WORKLOAD_SERVICES,
    *,
    as_of: datetime,
) -> DataFrame:
    """Per online user: listed visits still to end today, and those near now.

    Users with visits but no listed one stay in the result with zeros.
    """
    now = ntz(as_of)
    plans = (
        dailyplan.where(F.col("plantype") == config.PREINVOICE_PLAN_TYPE)
        .select(F.col("did").alias("planid"))
        .where(F.col("planid").isNotNull())
        .withColumn("did", F.col("planid"))
    )
    known = intervals.join(departments.select("depnum"), "depnum", "left_semi")
    picked = Selection(known)
    planned = left_lookup(picked.rows, picked.narrow(plans, planid="planid"), ["planid"], "schedid")
    flagged = with_service_flag(
        planned,
        picked.narrow(plan_detail, did="planid"),
        picked.narrow(sched_detail, schedid="schedid"),
        services,
        plan_key="did",
    )
    users = doctor.where(F.char_length("onlineuserid") > 3).select(
        "dcode", F.lower("onlineuserid").alias("userid")
    )
    listed = F.col("has_service")
    later = listed & (F.col("end_time") >= now)
    near = (
        listed
        & (F.col("end_time") >= shift_minutes(now, -30))
        & (F.col("beg_time") <= shift_seconds(now, 7200))
    )
    return (
        flagged.join(users, "dcode")
        .groupBy("userid")
        .agg(
            F.count_if(later).alias("last_pac_day"),
            F.count_if(near).alias("last_pac_2hours"),
        )
    )


# --- Users ----------------------------------------------------------------------


def online_users(users: DataFrame) -> DataFrame:
    return users.where(F.col("status").isin(list(config.ONLINE_STATUSES)))


def user_status_summary(users: DataFrame) -> DataFrame:
    """Users by status with the status name."""
    counts = users.groupBy("status").agg(F.count("*").alias("n"))
    return counts.withColumn("label", label(F.col("status"), config.USER_STATUSES, "unknown"))


def user_eligibility(users: DataFrame, load: DataFrame) -> DataFrame:
    """Why an online user may be released, or ``keep``.

    Planning without any load row is refused: it would release everybody.
    """
    # one row per doctor, used twice: for the join and for the guard
    load = written_once(load.select(F.lower("userid").alias("_user"), "last_pac_day", "last_pac_2hours"), "load")
    per_user = load.withColumn("_known", F.lit(True))
    loads = load.agg(F.count("*").alias("n")).scalar()
    guard = F.when(loads == 0, F.raise_error("empty workload table")).otherwise(F.lit(True)).cast("boolean")
    reason = (
        F.when(F.col("_known").isNull(), "absent")
        .when(F.col("last_pac_day") == 0, "none today")
        .when(F.col("last_pac_2hours") == 0, "none in 2 hours")
        .otherwise("keep")
    )
    return (
        online_users(users)
        .where(guard)
        .withColumn("_user", F.lower("userid"))
        .join(per_user, "_user", "left")
        .select("list_pos", "userid", reason.alias("reason"))
    )


def ranked_by_position(df: DataFrame, pos: str, rank: str, width: int = 100_000) -> DataFrame:
    """``df`` plus the 1-based rank of a unique integer position; null comes last.

    No task sorts the whole list.  Positions fall into blocks of ``width``; rows
    are ranked inside their block and shifted by the number of rows in earlier
    blocks.  Only the block sizes, one row per ``width`` positions, meet in one
    window.
    """
    last = F.lit((1 << 63) - 1)
    block = F.col(pos).cast("bigint") - F.pmod(F.col(pos).cast("bigint"), F.lit(width).cast("bigint"))
    blocked = df.withColumn("_block", F.coalesce(block, last))
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("_block")
        .agg(F.count("*").alias("_n"))
        .select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = W.partitionBy("_block").orderBy(F.col(pos).asc_nulls_last())
    return (
        blocked.withColumn("_in", F.row_number().over(inside))
        .join(offsets, "_block")
        .withColumn(rank, F.col("_in") + F.col("_before"))
        .drop("_block", "_in", "_before")
    )


def disconnect_plan(users: DataFrame, load: DataFrame, cap: int, width: int = 100_000) -> DataFrame:
    """The first ``online - cap`` releasable users in list order.

    ``width`` is the span of positions ranked together; users from ``user_snapshot``
    take ``conferences.POSITIONS_PER_BLOCK``.
    """
    excess = online_users(users).agg(F.count("*").alias("n")).scalar() - F.lit(cap)
    eligible = written_once(user_eligibility(users, load).where(F.col("reason") != "keep"), "eligible")
    ranked = ranked_by_position(eligible, "list_pos", "plan_rank", width)
    return ranked.where(F.col("plan_rank") <= excess)
