"""The sent ledger: ``kind``, ``key``, ``sent_at``.

A key is notified once per kind.  Keys are strings so that one ledger serves
appointments, patients and files.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from apptflow.config import LEDGER_KEEP
from apptflow.functions.timeexpr import ntz
from apptflow.session import written_once

LEDGER_KEY = ["kind", "key"]


def unsent_notifications(cands: DataFrame, ledger: DataFrame, since: datetime | None = None) -> DataFrame:
    """Candidates not in the ledger.

    The candidates are written once, and the ledger is narrowed to their keys where it
    is read: a few candidates do not move a ledger of years.  ``since`` limits it to
    the days that can still matter as well (see ``since_day``).
    """
    if since is not None:
        ledger = since_day(ledger, since)
    few = written_once(cands, "candidates")
    known = ledger.select(*LEDGER_KEY).join(few.select(*LEDGER_KEY), LEDGER_KEY, "left_semi")
    return few.join(known, LEDGER_KEY, "left_anti")


def with_mark(df: DataFrame) -> DataFrame:
    """Adds ``mark``, kind and key as one text.

    A run's kind is often a constant, which the planner takes out of a join on two columns;
    what is left of it no longer fits buckets of both.
    """
    return df.withColumn("mark", F.concat("kind", F.lit("\n"), "key"))


def unsent_in_bulk(cands: DataFrame, ledger: DataFrame, since: datetime | None = None) -> DataFrame:
    """Candidates not in the ledger, when there are about as many as marks.

    Nothing is stored and nothing narrowed. A ledger in buckets (``sinks.bucket_ledger``)
    stays where it lies: only the candidates move, to its buckets.
    """
    if since is not None:
        ledger = since_day(ledger, since)
    if "mark" not in ledger.columns:
        ledger = with_mark(ledger)
    return with_mark(cands).join(ledger.select("mark"), "mark", "left_anti").select(*cands.columns)


def since_day(ledger: DataFrame, since: datetime) -> DataFrame:
    """Marks from ``since`` on; where there is a day column, earlier folders are skipped."""
    if "sent_day" in ledger.columns:
        ledger = ledger.where(F.col("sent_day") >= F.lit(since.date()))
    return ledger.where(F.col("sent_at") >= ntz(since))


def of_day(ledger: DataFrame, as_of: datetime) -> DataFrame:
    """Marks of the current day only: survey marks are forgotten overnight."""
    today = F.lit(as_of.date())
    if "sent_day" in ledger.columns:
        ledger = ledger.where(F.col("sent_day") == today)
    return ledger.where(F.to_date("sent_at") == today)


def keys_of(ledger: DataFrame, kind: str, name: str, dtype: str = "bigint") -> DataFrame:
    """Distinct keys of one kind under their own column name."""
    return (
        ledger.where(F.col("kind") == kind)
        .select(F.col("key").try_cast(dtype).alias(name))
        .dropna()
        .distinct()
    )


def ledger_rollover(ledger: DataFrame, keep: int = LEDGER_KEEP) -> DataFrame:
    """The newest ``keep`` keys per kind.

    There are only a few kinds.  The rank filter is applied inside every input
    partition before the shuffle, so a task receives at most ``keep`` rows per
    kind and partition however large a kind is.
    """
    newest = W.partitionBy("kind").orderBy(F.col("sent_at").desc(), F.col("key"))
    return ledger.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= keep)


def send_log(
    outbox: DataFrame,
    results: DataFrame,
    as_of: datetime,
    hostname: str = "",
    username: str = "",
) -> DataFrame:
    """One log row per message the gateway accepted."""
    accepted = results.where("ok").select(*LEDGER_KEY, "smsid")
    return outbox.join(accepted, LEDGER_KEY).select(
        "smsid",
        ntz(as_of).alias("senddate"),
        F.lit(hostname).alias("hostname"),
        F.lit(username).alias("username"),
        F.col("recipient").alias("recipientname"),
        F.col("msisdn").alias("recipientphone"),
        F.col("text").alias("smstext"),
        F.lit(True).alias("isrightnow"),
        F.lit(False).alias("isdelayed"),
        F.lit(None).cast("timestamp_ntz").alias("delayedtime"),
    )


def send_marks(
    attempts: DataFrame, results: DataFrame, as_of: datetime, retry: Mapping[str, bool]
) -> DataFrame:
    """Ledger rows of a run.

    A kind with ``retry`` is marked only after success, so a failed message is
    tried again: appointment events, and the patient key of a survey.  Any other
    kind is marked once it was attempted: checked visits and announced files.
    """
    outcome = attempts.select(*LEDGER_KEY).join(results.select(*LEDGER_KEY, "ok"), LEDGER_KEY, "left")
    again = [k for k, v in retry.items() if v]
    mark: Column = F.coalesce(F.col("ok"), F.lit(False)) | ~F.col("kind").isin(again)
    return outcome.where(mark).select(*LEDGER_KEY, ntz(as_of).alias("sent_at"))


def run_counts(*results: DataFrame) -> DataFrame:
    """Rows per kind over the result sets of a run."""
    tagged = results[0].select("kind")
    for r in results[1:]:
        tagged = tagged.unionByName(r.select("kind"))
    return tagged.groupBy("kind").agg(F.count("*").alias("n"))
