"""Rows that come behind the watermark: kept, counted and caught up with."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apptflow.functions.timeexpr import ntz
from apptflow.operators.joins import smallest_per_key
from apptflow.session import run_scope, written_once
from apptflow.sources.sinks import read_or_empty, write_run

LOOKBACK = timedelta(minutes=10)
PROGRESS = "newest timestamp_ntz, since_run bigint, taken bigint, repeated bigint, late bigint, undated bigint"


def _counted(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), seen


def _earlier(spark: SparkSession, path: str, batch_id: int, lookback: timedelta) -> tuple[datetime | None, int]:
    """The newest time before a batch, and the first batch with rows that the lookback reaches."""
    if batch_id == 0:
        return None, 0
    read = spark.read.schema(PROGRESS + ", run_id bigint").option("basePath", f"{path}/progress")
    last = read.parquet(f"{path}/progress/run_id={batch_id - 1}").first()
    if last.newest is None:
        return None, last.since_run
    folders = [f"{path}/progress/run_id={i}" for i in range(last.since_run, batch_id)]
    runs = read.parquet(*folders).where(F.col("newest") >= ntz(last.newest - lookback))
    return last.newest, runs.agg(F.min("run_id").alias("run")).first().run


def start_with_late_rows(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    ts_col: str,
    lookback: timedelta = LOOKBACK,
    period: str | None = None,
) -> StreamingQuery:
    """Each key's first row as it arrives; rows too late for that go to a side table.

    Writes per batch ``path``/taken, ``path``/late and ``path``/progress: the newest time so
    far and how many rows were taken, repeated a key (in the batch or within the lookback),
    were older than the newest time of earlier batches less ``lookback``, or had no time
    (those two kinds lie in ``late``). So every row of the stream is in one of four counts,
    and ``catch_up`` takes what came late. A repeated batch starts from the progress of the
    batch before it and replaces its folders; a lost progress folder fails it. Batches that
    the lookback cannot reach are not read again.
    """
    keys = list(keys)
    taken_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema) + ", run_id bigint"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with run_scope(spark):
            before, since = _earlier(spark, path, batch_id, lookback)
            dated = F.col(ts_col).isNotNull()
            on_time = dated if before is None else dated & (F.col(ts_col) >= ntz(before - lookback))
            rows, seen = _counted(
                batch, newest=F.max(ts_col), on_time=F.count_if(on_time), late=F.count_if(dated & ~on_time),
                undated=F.count_if(~dated),
            )
            rows = written_once(rows, "batch")
            folders = [f"{path}/taken/run_id={i}" for i in range(since, batch_id)]
            fresh = smallest_per_key(rows.where(on_time), keys)
            if folders:
                known = spark.read.schema(taken_schema).option("basePath", f"{path}/taken").parquet(*folders)
                fresh = fresh.join(known.select(*keys), keys, "left_anti")
            fresh, taken = _counted(fresh, n=F.count(F.lit(1)))
            write_run(fresh, f"{path}/taken", batch_id)
            write_run(rows.where(F.coalesce(~on_time, F.lit(True))), f"{path}/late", batch_id)
            found, n = seen.get, taken.get["n"]
            times = [t for t in (before, found["newest"]) if t is not None]
            progress = (
                max(times) if times else None, since, n, found["on_time"] - n, found["late"], found["undated"]
            )
            write_run(spark.createDataFrame([progress], PROGRESS), f"{path}/progress", batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)
    return writer.start()


def catch_up(spark: SparkSession, path: str, keys: Sequence[str], ts_col: str, run: int) -> int:
    """Takes the late rows whose key was taken neither in time nor by an earlier catch-up.

    Writes them to ``path``/caught under the number ``run`` and gives their number; repeating
    a run replaces its folder. Rows without a time stay in ``late``. The taken keys are
    narrowed to the late ones where they are read.
    """
    keys = list(keys)
    with run_scope(spark):
        late = spark.read.parquet(f"{path}/late")
        schema = late.schema
        few = written_once(smallest_per_key(late.drop("run_id").where(F.col(ts_col).isNotNull()), keys), "late")
        caught = read_or_empty(spark, f"{path}/caught", schema).where(F.col("run_id") < run)
        known = spark.read.schema(schema).parquet(f"{path}/taken").select(*keys).unionByName(caught.select(*keys))
        known = known.join(few.select(*keys), keys, "left_semi")
        rows, seen = _counted(few.join(known, keys, "left_anti"), n=F.count(F.lit(1)))
        write_run(rows, f"{path}/caught", run)
        return seen.get["n"]
