"""Consecutive-failure alerts with the state of a batch in a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apptflow import config
from apptflow.operators.monitoring import failure_runs, open_failures
from apptflow.session import remove_folder
from apptflow.sources.sinks import write_run


def start_failure_alerts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    source_col: str,
    ts_col: str,
    is_failure: Column,
    thresholds: Mapping = config.ALERT_ORDINALS,
    default_threshold: int = config.DEFAULT_ALERT_ORDINAL,
    tie_col: str | None = None,
    period: str | None = None,
) -> StreamingQuery:
    """One row when a source's run of failures reaches its threshold.

    A success re-arms the alert.  Each micro-batch runs the batch job, so no source is
    one task; the failures open before it come from the batch before it, the only
    state that is read.  A batch should hold later rows than the one before.  Writes
    ``path``/alerts and ``path``/open (failures open after each batch).
    A repeated batch starts from the state before it and replaces its folders. Only the
    first batch may be without a state before it: a folder that was lost fails the batch
    instead of counting from 0. States that no repeat can ask for are removed.
    """
    source_type = events.schema[source_col].dataType.simpleString()
    state_schema = f"source {source_type}, failures bigint"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry = None
        if batch_id > 0:
            carry = spark.read.schema(state_schema).parquet(f"{path}/open/run_id={batch_id - 1}")
        runs = failure_runs(
            batch, source_col, ts_col, is_failure, thresholds, default_threshold, tie_col, carry=carry
        )
        alerts = runs.where(F.col("alert_at").isNotNull()).select("source", "alert_at")
        write_run(alerts, f"{path}/alerts", batch_id)
        still_open = open_failures(batch, source_col, ts_col, is_failure, tie_col, carry=carry)
        write_run(still_open, f"{path}/open", batch_id)
        # a restart repeats the last batch at most, which reads the state before it
        remove_folder(spark, f"{path}/open/run_id={batch_id - 2}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)
    return writer.start()
