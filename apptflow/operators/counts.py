"""Counters of a run, taken from the rows as they pass and read after they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RunCounts:
    """Counts rows where a run writes them: no scan, shuffle or second computation.

    ``watch`` adds counters to a plan and ``read`` gives them once that plan was written;
    before, it waits. A counter sits in the plan that is written, so rows are counted as the
    tasks that wrote them saw them. Watch a plan that is written once: of several writes the
    first counts.
    """

    def __init__(self) -> None:
        self._watched: dict[str, tuple[Observation, list[str]]] = {}

    def watch(self, df: DataFrame, name: str, **conditions: Column) -> DataFrame:
        """``df``, counting its ``rows`` and those that meet each condition."""
        if name in self._watched:
            raise ValueError(f"watched already: {name}")
        seen = Observation()
        counters = {"rows": F.count(F.lit(1)), **{k: F.count_if(c) for k, c in conditions.items()}}
        # positions as names: a condition's name may hold any characters
        named = [c.alias(f"n{i}") for i, c in enumerate(counters.values())]
        self._watched[name] = seen, list(counters)
        return df.observe(seen, *named)

    def read(self) -> dict[str, dict[str, int]]:
        """Counter values by watched name."""
        return {
            name: {counter: seen.get[f"n{i}"] for i, counter in enumerate(counters)}
            for name, (seen, counters) in self._watched.items()
        }

    def table(self, spark: SparkSession) -> DataFrame:
        """(name, counter, n): one row per counter, to be stored with the run."""
        rows = [(name, c, n) for name, found in self.read().items() for c, n in found.items()]
        return spark.createDataFrame(rows, "name string, counter string, n bigint")
