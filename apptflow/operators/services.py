"""Listed services and name exclusions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.functions.text import contains_any
from apptflow.operators.joins import left_lookup

ServiceList = DataFrame | Sequence[int]


def only_listed(detail: DataFrame, services: ServiceList) -> DataFrame:
    """Detail rows for listed services: an id list is pushed to the scan."""
    if isinstance(services, DataFrame):
        return detail.join(services.select("schid"), "schid", "left_semi")
    return detail.where(F.col("schid").isin(list(services)))


def with_service_flag(
    df: DataFrame,
    plan_detail: DataFrame,
    sched_detail: DataFrame,
    services: ServiceList,
    plan_key: str = "planid",
    sched_key: str = "schedid",
) -> DataFrame:
    """``df`` plus ``has_service``: a listed service in the plan or the schedule.

    The two existence tests become left joins to distinct keys, so neither can
    multiply rows, and appointments without a plan are spread over the cluster.
    """
    planned = (
        only_listed(plan_detail, services)
        .select(F.col("did").alias(plan_key))
        .where(F.col(plan_key).isNotNull())
        .distinct()
        .withColumn("_in_plan", F.lit(True))
    )
    scheduled = (
        only_listed(sched_detail, services)
        .select(F.col("schedid").alias(sched_key))
        .where(F.col(sched_key).isNotNull())
        .distinct()
        .withColumn("_in_schedule", F.lit(True))
    )
    flagged = left_lookup(df, planned, [plan_key], spread=sched_key)
    return flagged.join(scheduled, sched_key, "left").withColumn(
        "has_service", F.col("_in_plan").isNotNull() | F.col("_in_schedule").isNotNull()
    ).drop("_in_plan", "_in_schedule")


def with_listed_service(df: DataFrame, *args, **kwargs) -> DataFrame:
    return with_service_flag(df, *args, **kwargs).where("has_service").drop("has_service")


def name_exclusions(df: DataFrame, name: str | Column, words: Sequence[str]) -> DataFrame:
    """Rows whose name holds none of ``words``; a null name is dropped too."""
    text = F.col(name) if isinstance(name, str) else name
    return df.where(~contains_any(text, words))
