"""Keys that count once a day, kept as state that expires and can start from the ledger."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from apptflow.operators.ledger import of_day
from apptflow.sources.sinks import write_run

KEEP = timedelta(days=2)
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


class OncePerDay(StatefulProcessor):
    """Lets through the first row of a key on each day.

    State of a key: the days it was seen on, each with the time of its first row. An
    entry expires ``keep`` after it was written, so yesterday's keys go by themselves.
    """

    def __init__(self, columns: list[str], at: int, day: int, keep: timedelta):
        self.columns, self.at, self.day, self.keep = columns, at, day, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState(
            "days", "day date", "first_at timestamp_ntz", int(self.keep.total_seconds() * 1000)
        )

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._see(initialState.day, initialState.sent_at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first: dict = {}
        for r in rows:
            values = tuple(r)[: len(self.columns)]
            day = r[self.day]
            if day not in first or self._order(values) < self._order(first[day]):
                first[day] = values
        for day in sorted(first):
            if not self.days.containsKey((day,)):
                self._see(day, first[day][self.at])
                yield Row(**dict(zip(self.columns, first[day], strict=True)))

    def _see(self, day, at) -> None:
        self.days.updateValue((day,), (at,))

    def _order(self, values: tuple) -> tuple:
        """Earliest first; rows of one time in the order of their columns, nulls first."""
        return (values[self.at], *((v is not None, v) for v in values))

    def close(self) -> None:
        pass


def once_a_day(
    stream: DataFrame, key: str, ts_col: str, ledger: DataFrame | None = None, kind: str | None = None,
    as_of: datetime | None = None, keep: timedelta = KEEP,
) -> DataFrame:
    """Rows of ``stream`` that are the first of their key on the day of ``ts_col``.

    Days of a key are forgotten ``keep`` after they were first seen, by the clock of the
    machine: a stream that is replayed faster sees the same rows. With a ``ledger`` the
    state of a new checkpoint begins with the keys of ``kind`` that it marks on the day of
    ``as_of``; later starts have the state they left. In a batch the earliest row counts.
    Rows without a key or a time are dropped.
    """
    key_type = stream.schema[key].dataType.simpleString()
    rows = stream.where(F.col(key).isNotNull() & F.col(ts_col).isNotNull())
    rows = rows.withColumn("_day", F.to_date(ts_col))
    columns = stream.columns
    initial = None
    if ledger is not None:
        if kind is None or as_of is None:
            raise ValueError("a ledger needs a kind and the day to start with")
        marks = of_day(ledger, as_of).where((F.col("kind") == kind) & F.col("key").isNotNull())
        marks = marks.groupBy(F.col("key").try_cast(key_type).alias(key)).agg(F.min("sent_at").alias("sent_at"))
        marks = marks.dropna().withColumn("day", F.to_date("sent_at"))
        initial = marks.groupBy(key)
    return rows.groupBy(key).transformWithState(
        statefulProcessor=OncePerDay(columns, columns.index(ts_col), len(columns), keep),
        outputStructType=stream.schema,
        outputMode="Append",
        timeMode="ProcessingTime",
        initialState=initial,
    )


def start_once_a_day(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    ts_col: str,
    ledger: DataFrame | None = None,
    kind: str | None = None,
    as_of: datetime | None = None,
    keep: timedelta = KEEP,
    period: str | None = None,
) -> StreamingQuery:
    """Writes the rows of ``once_a_day``, one folder per batch: the requests to send.

    For surveys ``key`` is the patient and ``ledger`` holds who was asked earlier today.
    """
    rows = once_a_day(stream, key, ts_col, ledger, kind, as_of, keep)
    conf = stream.sparkSession.conf

    def write(batch: DataFrame, batch_id: int) -> None:
        write_run(batch, path, batch_id)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if period:
        return writer.trigger(processingTime=period).start()
    # state that expires by the clock asks for another batch after each, also without rows:
    # a pass over what is there now would never end. A query keeps the setting it starts with.
    before = conf.get(_EMPTY_BATCHES)
    conf.set(_EMPTY_BATCHES, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.set(_EMPTY_BATCHES, before)
