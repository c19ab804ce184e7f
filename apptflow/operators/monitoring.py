"""Failure alerts, file arrivals, poll replays and delivery reports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from apptflow import config
from apptflow.functions.text import delivery_code, delivery_time, label
from apptflow.functions.timeexpr import ntz
from apptflow.operators.counts import RunCounts
from apptflow.session import written_once

# --- Consecutive failures ---------------------------------------------------------


def alert_ordinal(
    source: Column, thresholds: Mapping = config.ALERT_ORDINALS, default: int = config.DEFAULT_ALERT_ORDINAL
) -> Column:
    return label(source, thresholds, F.lit(default)).cast("bigint")


def _numbered(
    events: DataFrame,
    source_col: str,
    ts_col: str,
    is_failure: Column,
    tie_col: str | None,
    chunk: str,
    pieces: int | None = None,
) -> DataFrame:
    """Events with their place inside a chunk of their source's time line.

    A chunk is a stretch of time, or with ``pieces`` one of so many pieces of about equal
    numbers of rows. ``piece`` counts the successes so far, ``nth`` the failures since the
    last. Events without a source or a time belong to no run.
    """
    order = ["ts", "tie"] if tie_col else ["ts"]
    rows = events.select(
        F.col(source_col).alias("source"),
        F.col(ts_col).alias("ts"),
        *([F.col(tie_col).alias("tie")] if tie_col else []),
        F.coalesce(is_failure, F.lit(False)).alias("failed"),
    ).where(F.col("source").isNotNull() & F.col("ts").isNotNull())
    if pieces is None:
        rows = rows.withColumn("chunk", F.window("ts", chunk)["start"])
    else:
        # stored: a row must be in the same piece wherever it is used
        dealt = rows.repartitionByRange(pieces, "source", *order)
        rows = written_once(dealt.withColumn("chunk", F.spark_partition_id()), "pieces")
    in_chunk = W.partitionBy("source", "chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    # one sort serves all three: the place of the last success gives ``nth``
    placed = rows.withColumn("piece", F.count_if(~F.col("failed")).over(in_chunk)).withColumn(
        "n", F.count("*").over(in_chunk)
    )
    last_success = F.max(F.when(~F.col("failed"), F.col("n"))).over(in_chunk)
    return placed.withColumn("nth", F.col("n") - F.coalesce(last_success, F.lit(0))).drop("n")


def _chunks(numbered: DataFrame, carry: DataFrame | None) -> DataFrame:
    """One row per source and chunk: what is open before and after it.

    ``carry`` (source, failures) stands for everything earlier, as a chunk
    without a time, which sorts first.
    """
    chunks = numbered.groupBy("source", "chunk").agg(
        F.max("piece").alias("successes"),
        F.max(F.struct("piece", "nth"))["nth"].alias("trailing"),
    )
    if carry is not None:
        earlier = carry.select(
            F.col("source").cast(chunks.schema["source"].dataType).alias("source"),
            F.lit(None).cast(chunks.schema["chunk"].dataType).alias("chunk"),
            F.lit(0).cast("bigint").alias("successes"),
            F.col("failures").cast("bigint").alias("trailing"),
        )
        chunks = chunks.unionByName(earlier)
    by_source = W.partitionBy("source").orderBy("chunk")
    before = by_source.rowsBetween(W.unboundedPreceding, -1)
    upto = by_source.rowsBetween(W.unboundedPreceding, 0)
    in_stretch = W.partitionBy("source", "stretch").orderBy("chunk").rowsBetween(W.unboundedPreceding, 0)
    return (
        chunks.withColumn("base", F.coalesce(F.sum("successes").over(before), F.lit(0)))
        .withColumn("stretch", F.count_if(F.col("successes") > 0).over(upto))
        .withColumn("open_after", F.sum("trailing").over(in_stretch))
        .withColumn("carried", F.coalesce(F.lag("open_after").over(by_source), F.lit(0)))
    )


def failure_runs(
    events: DataFrame,
    source_col: str,
    ts_col: str,
    is_failure: Column,
    thresholds: Mapping = config.ALERT_ORDINALS,
    default_threshold: int = config.DEFAULT_ALERT_ORDINAL,
    tie_col: str | None = None,
    chunk: str = "10 minutes",
    carry: DataFrame | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Runs of consecutive failures per source, with the moment of the alert.

    ``run_id`` is the number of successes of the source before the run;
    ``alert_at`` is the time of the failure that reaches the source's threshold
    (null in other runs), so a run alerts once and a success re-arms it.
    ``carry`` holds the failures open at the start (see ``open_failures``); they
    count towards the threshold.

    A source is never ordered as a whole.  Its time line is cut into chunks that
    are ordered on their own; per chunk only the success count and the failures
    after the last success are carried forward, one row per source and chunk.
    Chunks are ``chunk`` long. A source that sends millions of events in that time needs
    ``pieces``: all rows are then cut into so many pieces of equal size along their sources
    and times, so no source and no moment makes a large one, for one more pass over them.
    """
    numbered = _numbered(events, source_col, ts_col, is_failure, tie_col, chunk, pieces)
    chunks = _chunks(numbered, carry).select("source", "chunk", "base", "carried")
    ordinal = alert_ordinal(F.col("source"), thresholds, default_threshold)
    total = F.when(F.col("piece") == 0, F.col("carried")).otherwise(0) + F.col("nth")
    return (
        numbered.where(F.col("nth") > 0)  # failures; asks for no column the summary lacks
        .join(chunks, ["source", "chunk"])
        .groupBy("source", (F.col("base") + F.col("piece")).alias("run_id"))
        .agg(
            F.count("*").alias("failures"),
            F.min(F.when(total == ordinal, F.col("ts"))).alias("alert_at"),
        )
    )


def open_failures(
    events: DataFrame,
    source_col: str,
    ts_col: str,
    is_failure: Column,
    tie_col: str | None = None,
    chunk: str = "10 minutes",
    carry: DataFrame | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Failures since the last success per source, after ``events``."""
    numbered = _numbered(events, source_col, ts_col, is_failure, tie_col, chunk, pieces)
    chunks = _chunks(numbered, carry)
    last = F.max(F.struct("chunk", "open_after"))["open_after"]
    return chunks.groupBy("source").agg(last.alias("failures"))


# --- File arrivals and poll replays -----------------------------------------------


def arrival_digest(
    files: DataFrame,
    ledger: DataFrame,
    as_of: datetime,
    max_age_min: int = config.FILE_AGE_MIN,
    cadence: str = "10 minutes",
) -> DataFrame:
    """Files not announced before, by the tick that first sees them.

    ``files`` has ``file`` and ``created``.  A digest is given as its lines, each
    with the digest's size, not as one nested cell: a digest may hold a large
    part of all files.
    """
    oldest = as_of - timedelta(minutes=max_age_min)
    fresh = files.where(F.col("created").between(ntz(oldest), ntz(as_of)))
    known = ledger.select(F.col("key").alias("file"))
    window = F.window("created", cadence)
    # a file created at a tick is seen by that tick; this run is the latest tick
    tick = F.when(window["start"] == F.col("created"), F.col("created")).otherwise(window["end"])
    lines = fresh.join(known, "file", "left_anti").select(
        F.least(tick, ntz(as_of)).alias("digest_at"), "file", "created"
    )
    sizes = lines.groupBy("digest_at").agg(F.count("*").alias("n"))
    return lines.join(sizes, "digest_at")


def poll_windows(
    records: DataFrame, key: str, ts_col: str, lookback: str = "10 minutes", period: str = "5 minutes"
) -> DataFrame:
    """Replay of overlapping polls: the first window that sees each key."""
    seen = records.select(key, F.window(ts_col, lookback, period)["start"].alias("w"))
    return seen.groupBy(key).agg(F.min("w").alias("window_start"), F.count("*").alias("windows"))


# --- Delivery reports ---------------------------------------------------------------


def delivery_states(
    reports: DataFrame, states: Mapping[str, str] = config.DELIVERY_STATES
) -> DataFrame:
    """Adds state_code, state and delivered_at, read from the report text."""
    content = F.replace("content", F.lit("\r\n"), F.lit(""))
    return (
        reports.withColumn("_content", content)
        .withColumn("state_code", delivery_code(F.col("_content")))
        .withColumn("state", label(F.col("state_code"), states, "error"))
        .withColumn("delivered_at", delivery_time(F.col("_content")))
        .withColumn("detail", F.when(F.col("state") == "error", F.col("_content")))
        .drop("_content")
    )


def delivery_report(
    reports: DataFrame, states: Mapping[str, str] = config.DELIVERY_STATES, counts: RunCounts | None = None
) -> DataFrame:
    """The latest state per message (``smsid``, ``reported_at``, ``content``).

    ``counts`` counts reports that cannot be read (``no code``, ``unknown code``) and those
    whose time is given but cannot be read (``bad time``) as the report is written.
    """
    parsed = delivery_states(reports, states)
    if counts is not None:
        code, known = F.col("state_code"), F.col("state") != "error"
        blank = code.isNull() | (code == "")
        stamp = F.split_part(F.replace("content", F.lit("\r\n"), F.lit("")), F.lit(" "), F.lit(2))
        parsed = counts.watch(
            parsed,
            "delivery",
            **{
                "no code": blank,
                "unknown code": ~blank & ~known,
                "bad time": known & (stamp != "") & F.col("delivered_at").isNull(),
            },
        )
    last = parsed.groupBy("smsid").agg(
        F.max(F.struct("reported_at", "state_code", "state", "delivered_at", "detail")).alias("r")
    )
    return last.select("smsid", "r.state_code", "r.state", "r.delivered_at", "r.detail")


def delivery_rates(reports: DataFrame, states: Mapping[str, str] = config.DELIVERY_STATES) -> DataFrame:
    """Messages by day of their last report and state, with the day's total."""
    last = (
        delivery_states(reports, states)
        .groupBy("smsid")
        .agg(F.max(F.struct("reported_at", "state")).alias("r"))
    )
    daily = last.groupBy(F.to_date("r.reported_at").alias("report_day"), F.col("r.state").alias("state")).agg(
        F.count("*").alias("n")
    )
    return daily.withColumn("day_total", F.sum("n").over(W.partitionBy("report_day")))
