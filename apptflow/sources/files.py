"""Folder listings and landed JSON pages."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptflow.config import FILE_AGE_MIN
from apptflow.functions.timeexpr import ntz

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """``file`` and ``created`` of a folder.  Contents are not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select(
        F.col("path").alias("file"), F.col("modificationTime").cast("timestamp_ntz").alias("created")
    )


def new_files(
    spark: SparkSession, folder: str, ledger: DataFrame, as_of: datetime, max_age_min: int = FILE_AGE_MIN
) -> DataFrame:
    """Files at most ``max_age_min`` old that the ledger does not know."""
    files = list_files(spark, folder)
    recent = files.where(F.col("created") >= ntz(as_of - timedelta(minutes=max_age_min)))
    return recent.join(ledger.select(F.col("key").alias("file")), "file", "left_anti")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Landed pages, one JSON document per file named ``<page id>.json``."""
    return spark.read.text(folder, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1).try_cast("bigint").alias("page_id"),
        F.col("value").alias("body"),
    )
