"""Outbox and log tables on a shared file system, and the ledger's (``ledgers``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptflow.operators.joins import smallest_per_key
from apptflow.operators.ledger import LEDGER_KEY, with_mark
from apptflow.session import written_once
from apptflow.sources.ledgers import LEDGER_SCHEMA, append_ledger, read_ledger

__all__ = [
    "LEDGER_SCHEMA",
    "append_ledger",
    "bucket_ledger",
    "read_ledger",
    "read_or_empty",
    "unsent_in_outbox",
    "write_run",
]


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet (its first run).

    Only a missing path counts as empty; any other failure is raised.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def write_run(df: DataFrame, path: str, run: str | int, run_col: str = "run_id") -> None:
    """Writes one run's rows to its own folder and replaces it when repeated.

    A run that is restarted after a lost driver therefore leaves one copy, and one
    that yields nothing this time leaves nothing of the time before.
    """
    df.write.mode("overwrite").parquet(f"{path}/{run_col}={run}")


def bucket_ledger(ledger: DataFrame, table: str, path: str, buckets: int = 64) -> DataFrame:
    """The ledger as an external table in sorted buckets of its marks, read back.

    ``ledger.unsent_in_bulk`` joins it without an exchange of its rows. They are dealt to
    their buckets first, so there is one file per bucket, not one per task and bucket. Take
    as many buckets as the jobs that join it have shuffle partitions, or more.
    """
    rows = with_mark(ledger).repartition(buckets, "mark")
    rows.write.bucketBy(buckets, "mark").sortBy("mark").mode("overwrite").option("path", path).saveAsTable(table)
    return ledger.sparkSession.table(table)


def unsent_in_outbox(
    messages: DataFrame,
    outbox: DataFrame,
    run: int,
    keys: Sequence[str] = LEDGER_KEY,
    run_col: str = "run_id",
    horizon: int | None = None,
) -> DataFrame:
    """Messages no earlier run has written; the run's own rows do not count.

    ``horizon`` limits the look back to so many runs, whose folders alone are read.
    Of several messages for a key the smallest stays.
    """
    earlier = outbox.where(F.col(run_col) < run)
    if horizon is not None:
        earlier = earlier.where(F.col(run_col) >= run - horizon)
    few = written_once(smallest_per_key(messages, list(keys)), "messages")
    known = earlier.select(*keys).join(few.select(*keys), list(keys), "left_semi")
    return few.join(known, list(keys), "left_anti")
