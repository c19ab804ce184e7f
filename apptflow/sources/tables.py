"""Table scans.  A failed read fails the job: it never becomes an empty input."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options: Any) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[int | str, int | str],
    partitions: int,
    **options: Any,
) -> DataFrame:
    """A database table read by many tasks, each with its own key range.

    The bounds only place the cuts; rows outside of them are read as well.
    """
    low, high = bounds
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .option("partitionColumn", partition_column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .load()
    )


def query(spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None, **tables: DataFrame) -> DataFrame:
    """Runs SQL over named DataFrames; binds only parameters the text names."""
    named = set(re.findall(r":([A-Za-z_]\w*)", sql))
    used = {k: v for k, v in (params or {}).items() if k in named}
    return spark.sql(sql, args=used, **tables)
