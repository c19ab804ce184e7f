"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "apptflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC wall-clock formatting.

    Shuffle partitions are left to the cluster unless given: adaptive execution
    coalesces them, so a large start value is safe on small inputs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # joins followed by an aggregate on the same key may still split a hot key
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_ready(spark: SparkSession) -> bool:
    """Whether ``checkpoint()`` has a folder to write to.

    The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a
    local (test) session without one gets a folder of its own: on a cluster a
    machine-local folder is lost with the machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and context.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="apptflow-")
        if folder is None:
            return False
        context.setCheckpointDir(folder)
    return True


_scopes = threading.local()


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what ``written_once`` stored inside, in this thread.

    Wrap a run that ends with its results written: a poll every minute would
    otherwise leave its files until the driver ends.
    """
    outer, _scopes.folders = getattr(_scopes, "folders", None), []
    try:
        yield
    finally:
        for folder in _scopes.folders:
            fs, path = _located(spark, folder)
            fs.delete(path, True)
            fs.cancelDeleteOnExit(path)
        _scopes.folders = outer


def written_once(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` stored as a table in the shared folder and read back.

    Later uses read those rows instead of computing them again, all see the same
    ones, and the planner knows their size.  The files go at the end of a ``run_scope``
    around it, or when the driver ends.  Without a shared folder this fails: the
    rows would be computed anew, and perhaps differently, at each use.
    """
    spark = df.sparkSession
    if not checkpoint_ready(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    fs, path = _located(spark, folder)
    fs.deleteOnExit(path)
    if getattr(_scopes, "folders", None) is not None:
        _scopes.folders.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Removes a folder and what is in it, if it is there."""
    fs, path = _located(spark, folder)
    fs.delete(path, True)


def _located(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
