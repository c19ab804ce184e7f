"""Consecutive-failure alerts with the state of each source in the state store."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from apptflow import config
from apptflow.operators.monitoring import alert_ordinal
from apptflow.sources.sinks import write_run
from apptflow.streaming.appointments import with_event_time

_EPOCH = datetime(1970, 1, 1)
_MICRO = timedelta(microseconds=1)


class FailureLatch(StatefulProcessor):
    """Counts a source's failures since its last success and alerts once per run.

    Events wait until the watermark has passed them and then count in their order, so the
    order in which they arrive within the allowed lateness does not matter. State of a
    source: the open run, and the events that wait, by time and tie.
    """

    def __init__(self, tie_type: str):
        self.tie_type = tie_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "failures bigint, latched boolean")
        self.waiting = handle.getMapState(
            "waiting", f"at bigint, tie {self.tie_type}", "failed boolean, ordinal bigint, n bigint"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        for r in rows:
            at = (r.event_at - _EPOCH) // _MICRO
            place = (at, r.tie)
            # equal events (same time and tie) are one place; a success among them wins
            known = self.waiting.getValue(place) if self.waiting.containsKey(place) else None
            failed = r.failed and (known is None or known[0])
            n = 1 + (known[2] if known is not None and known[0] and failed else 0)
            self.waiting.updateValue(place, (failed, r.ordinal, n))
            first = at if first is None else min(first, at)
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted((tuple(k), tuple(v)) for k, v in self.waiting.iterator())
        due = [(k, v) for k, v in waiting if k[0] <= until]
        failures, latched = tuple(self.run.get()) if self.run.exists() else (0, False)
        alerts = []
        for (at, tie), (failed, ordinal, n) in due:
            self.waiting.removeKey((at, tie))
            if not failed:
                failures, latched = 0, False
                continue
            failures += n
            if failures >= ordinal and not latched:
                latched = True
                alerts.append(Row(source=key[0], alert_at=_EPOCH + at * _MICRO))
        if failures:
            self.run.update((failures, latched))
        else:
            self.run.clear()
        left = [k[0] for k, _ in waiting[len(due) :]]
        if left:
            self._wake(left[0])
        return iter(alerts)

    def _wake(self, at: int) -> None:
        """Asks to be called once the watermark has passed a time (timers are in milliseconds)."""
        self.handle.registerTimer(-(-at // 1000))

    def close(self) -> None:
        pass


def failure_alerts(
    events: DataFrame,
    source_col: str,
    ts_col: str,
    is_failure: Column,
    thresholds: Mapping = config.ALERT_ORDINALS,
    default_threshold: int = config.DEFAULT_ALERT_ORDINAL,
    tie_col: str | None = None,
    late: str = "1 minute",
) -> DataFrame:
    """(source, alert_at): one row when a source's run of failures reaches its threshold.

    The same alerts as ``monitoring.failure_runs`` gives for all events, each once the
    watermark (``late`` behind the newest event) has passed it. Events that come later than
    that are dropped; events without a source or a time belong to no run. Events with equal
    time and tie count together, and a success among them ends the run. A source's state is one task's: for sources that send
    millions of events a batch use ``failures.start_failure_alerts``, which splits them.
    """
    source = F.col(source_col)
    rows = with_event_time(events, ts_col, late).where(source.isNotNull() & F.col(ts_col).isNotNull())
    rows = rows.select(
        source.alias("source"),
        "event_time",
        F.col(ts_col).alias("event_at"),
        (F.col(tie_col) if tie_col else F.lit(0)).alias("tie"),
        F.coalesce(is_failure, F.lit(False)).alias("failed"),
        alert_ordinal(source, thresholds, default_threshold).alias("ordinal"),
    )
    tie_type = rows.schema["tie"].dataType.simpleString()
    source_type = events.schema[source_col].dataType.simpleString()
    return rows.groupBy("source").transformWithState(
        statefulProcessor=FailureLatch(tie_type),
        outputStructType=f"source {source_type}, alert_at timestamp_ntz",
        outputMode="Append",
        timeMode="EventTime",
    )


def start_failure_latch(
    events: DataFrame,
    path: str,
    checkpoint: str,
    source_col: str,
    ts_col: str,
    is_failure: Column,
    thresholds: Mapping = config.ALERT_ORDINALS,
    default_threshold: int = config.DEFAULT_ALERT_ORDINAL,
    tie_col: str | None = None,
    late: str = "1 minute",
    period: str | None = None,
) -> StreamingQuery:
    """Writes the alerts of ``failure_alerts``, one folder per batch.

    Counts and latches live in the checkpoint's state store and survive a restart. A
    checkpoint that has batches but not their state fails the query: counts never start
    again at 0 unnoticed.
    """
    alerts = failure_alerts(
        events, source_col, ts_col, is_failure, thresholds, default_threshold, tie_col, late
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        write_run(batch, path, batch_id)

    writer = alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)
    return writer.start()
