"""Stream outputs that stay right when a batch is repeated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from apptflow.session import run_scope
from apptflow.sources.sinks import read_or_empty, unsent_in_outbox, write_run

OUTBOX_SCHEMA = (
    "kind string, key string, recipient string, msisdn string, text string, send_time string, run_id bigint"
)


def outbox_batch(
    path: str, schema: str = OUTBOX_SCHEMA, horizon: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: new keys only, one folder per batch.

    A repeated batch replaces its folder, and keys it wrote the first time are
    not mistaken for keys of earlier batches.  ``horizon`` is the number of batches in
    which a key can come again; older folders are then not read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with run_scope(batch.sparkSession):
            outbox = read_or_empty(batch.sparkSession, path, schema)
            write_run(unsent_in_outbox(batch, outbox, batch_id, horizon=horizon), path, batch_id)

    return write


def start_outbox(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    period: str | None = None,
    schema: str = OUTBOX_SCHEMA,
    horizon: int | None = None,
) -> StreamingQuery:
    """Starts a poll every ``period``, or one pass over what is there now."""
    writer = messages.writeStream.foreachBatch(outbox_batch(path, schema, horizon)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)
    return writer.start()
