"""Booking, survey and file streams with event-time bounds on their state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apptflow.config import FILE_AGE_MIN
from apptflow.operators.appointments import (
    EVENT_COLUMNS,
    PHONES,
    contacts_of,
    online_appointments,
    with_contacts,
    with_date_text,
)
from apptflow.operators.joins import Selection
from apptflow.session import run_scope
from apptflow.sources.files import FILE_SCHEMA
from apptflow.sources.sinks import write_run


def read_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def with_event_time(stream: DataFrame, ts_col: str, late: str) -> DataFrame:
    """Watermark over a zone-free column (watermarks take zoned timestamps only)."""
    return stream.withColumn("event_time", F.col(ts_col).cast("timestamp")).withWatermark("event_time", late)


def new_appointment_stream(schedule: DataFrame, clients: DataFrame, lookback: str = "10 minutes") -> DataFrame:
    """Online bookings as they arrive, each once, with the patient's phones.

    Rows later than ``lookback`` are dropped by the watermark, as a poll that
    looks back that far would miss them.  State is kept for the lookback only;
    the ledger stays the lasting guard against a second message.
    """
    joined = fresh_bookings(schedule, lookback).join(clients.select("pcode", *PHONES), "pcode", "left")
    return with_date_text(joined).select("createdate", *EVENT_COLUMNS)


def fresh_bookings(schedule: DataFrame, lookback: str = "10 minutes") -> DataFrame:
    """Online bookings as they arrive, each once within ``lookback``."""
    timed = with_event_time(online_appointments(schedule), "createdate", lookback)
    return timed.dropDuplicatesWithinWatermark(["schedid"])


def start_new_appointments(
    schedule: DataFrame,
    clients: DataFrame,
    path: str,
    checkpoint: str,
    lookback: str = "10 minutes",
    period: str | None = None,
) -> StreamingQuery:
    """Writes new bookings with their phones, one folder per batch.

    Clients are narrowed to each batch's patients where they are read, so a batch of
    minutes does not shuffle all clients; bookings without a patient are spread.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with run_scope(batch.sparkSession):
            picked = Selection(batch.drop("event_time"))
            write_run(with_contacts(picked.rows, contacts_of(picked, clients)), path, batch_id)

    writer = fresh_bookings(schedule, lookback).writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)
    return writer.start()


def once_per_day(stream: DataFrame, keys: Sequence[str], ts_col: str, late: str = "1 day") -> DataFrame:
    """First row per key and calendar day; a day's keys are forgotten after it."""
    timed = with_event_time(stream.withColumn("day", F.to_date(ts_col)), ts_col, late)
    return timed.dropDuplicatesWithinWatermark([*keys, "day"]).drop("day", "event_time")


def poll_counts(stream: DataFrame, ts_col: str, by: Column, lookback: str, period: str) -> DataFrame:
    """Rows per overlapping poll window, emitted once a window is complete."""
    return (
        with_event_time(stream, ts_col, lookback)
        .groupBy(F.window("event_time", lookback, period).alias("w"), by.alias("kind"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "kind", "n")
    )


def file_arrivals(spark: SparkSession, folder: str, max_age_min: int = FILE_AGE_MIN) -> DataFrame:
    """New files of a folder; the source remembers what it has seen and contents are
    not read.  Files older than ``max_age_min`` when a batch starts are left out, in the
    first batch too; ``maxFileAge`` only spares the source from listing them again."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFileAge", f"{max_age_min}m")
        .load(folder)
    )
    oldest = F.current_timestamp() - F.make_dt_interval(mins=F.lit(max_age_min))
    return files.where(F.col("modificationTime") >= oldest).select(
        F.col("path").alias("file"), F.col("modificationTime").cast("timestamp_ntz").alias("created")
    )
