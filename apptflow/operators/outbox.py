"""From candidate rows to messages."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.config import TEMPLATES
from apptflow.functions.contacts import contact_dimension, msisdn
from apptflow.functions.timeexpr import datetime_text, parse_local, send_time_text, time_text
from apptflow.operators.counts import RunCounts
from apptflow.operators.joins import smallest_per_key
from apptflow.operators.ledger import LEDGER_KEY, unsent_in_bulk, unsent_notifications

CANDIDATE_COLUMNS = {
    "schedid": "bigint",
    "recipient": "string",
    "data": "string",
    "bhour": "int",
    "bmin": "int",
    "phone1": "string",
    "phone2": "string",
    "phone3": "string",
    "phoneint": "string",
}
SKIP_REASONS = ("no key", "no mobile", "no date")


def event_candidates(by_kind: Mapping[str, DataFrame]) -> DataFrame:
    """One table of all result sets, tagged with their kind.

    A result set lacks the phone columns that do not apply to it; they are null.
    """
    out = None
    for kind, df in by_kind.items():
        cols = [
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
            for c, t in CANDIDATE_COLUMNS.items()
        ]
        tagged = df.select(F.lit(kind).alias("kind"), *cols)
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("no result sets")
    return out


def with_skip_reason(cands: DataFrame) -> DataFrame:
    """Adds ``mobile``, ``start_at`` and why a row cannot be sent (null if it can)."""
    no_key, no_mobile, no_date = SKIP_REASONS
    ready = contact_dimension(cands).withColumn(
        "start_at", parse_local(F.col("data"), F.col("bhour"), F.col("bmin"))
    )
    return ready.withColumn(
        "skip_reason",
        F.when(F.col("schedid").isNull(), no_key)
        .when(F.col("mobile").isNull(), no_mobile)
        .when(F.col("start_at").isNull(), no_date),
    )


def skip_reasons(by_kind: Mapping[str, DataFrame]) -> DataFrame:
    """Counts of unsendable rows per kind and reason, in one pass of counters."""
    counters = [F.count_if(F.col("skip_reason") == r).alias(r) for r in SKIP_REASONS]
    wide = with_skip_reason(event_candidates(by_kind)).groupBy("kind").agg(*counters)
    return wide.unpivot("kind", list(SKIP_REASONS), "skip_reason", "n").where(F.col("n") > 0)


def render(kind: Column, start_at: Column, templates: Mapping[str, str]) -> Column:
    """The text of a kind with its time placeholders filled."""
    fillers = {"@dateTime": datetime_text(start_at), "@time": time_text(start_at)}
    chosen = F.lit(None).cast("string")
    for name, template in templates.items():
        text = F.lit(template)
        for mark, value in fillers.items():
            if mark in template:
                text = F.replace(text, F.lit(mark), value)
        chosen = F.when(kind == name, text).otherwise(chosen)
    return chosen


def first_per_key(messages: DataFrame) -> DataFrame:
    """One message per kind and key, the smallest when a key has several."""
    return smallest_per_key(messages, LEDGER_KEY)


def outbox_messages(
    by_kind: Mapping[str, DataFrame],
    ledger: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    send_at: Column | None = None,
    since: datetime | None = None,
    counts: RunCounts | None = None,
    bulk: bool = False,
) -> DataFrame:
    """Sendable, not yet notified candidates as messages.

    ``send_at`` delays delivery (an expression over the candidate columns and
    ``start_at``); without it messages go out at once and ``send_time`` is null.
    ``counts`` counts each kind's candidates and those that cannot be sent, by reason, as
    they are written. With ``bulk`` there are as many candidates as marks: the ledger is
    joined where it lies (``ledger.unsent_in_bulk``).
    """
    ready = with_skip_reason(event_candidates(by_kind))
    if counts is not None:
        own = {kind: F.col("kind") == kind for kind in by_kind}
        counters = {f"{k}: candidates": c for k, c in own.items()}
        for reason in SKIP_REASONS:
            counters |= {f"{k}: {reason}": c & (F.col("skip_reason") == reason) for k, c in own.items()}
        ready = counts.watch(ready, "outbox", **counters)
    ready = ready.where(F.col("skip_reason").isNull())
    delayed = F.lit(None).cast("string") if send_at is None else send_time_text(send_at)
    messages = ready.select(
        "kind",
        F.col("schedid").cast("string").alias("key"),
        "recipient",
        msisdn(F.col("mobile")).alias("msisdn"),
        render(F.col("kind"), F.col("start_at"), templates).alias("text"),
        delayed.alias("send_time"),
    )
    if bulk:
        return first_per_key(unsent_in_bulk(messages, ledger, since))
    return first_per_key(unsent_notifications(messages, ledger, since))
