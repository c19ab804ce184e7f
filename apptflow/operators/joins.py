"""Join helpers for inputs of very different size and for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.session import written_once

class Selection:
    """The rows a run picked, used to read only matching history.

    A poll selects minutes of appointments out of years of history.  The picked rows
    are written once to the shared folder: every later use, ``rows`` included, reads
    those instead of scanning the source again.  History is semi-joined with their keys
    before it meets any aggregate.  Spark knows the size of the written rows: few keys
    it sends to where history is read, many it joins by shuffle.
    """

    def __init__(self, picked: DataFrame):
        self.rows = written_once(picked, "picked")

    def narrow(self, history: DataFrame, **keys: str) -> DataFrame:
        """Rows of ``history`` whose columns match picked rows.

        Keys are given as ``history_column="picked_column"``.
        """
        wanted = self.rows.select(*[F.col(mine).alias(theirs) for theirs, mine in keys.items()])
        return history.join(wanted.dropna(), list(keys), "left_semi")


class Everything:
    """Stands in for a ``Selection`` when the run takes whole tables."""

    @staticmethod
    def narrow(history: DataFrame, **keys: str) -> DataFrame:
        return history


def left_lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Column | str
) -> DataFrame:
    """Left join on ``keys`` that does not pile null keys onto one task.

    Rows of ``left`` with a null key match nothing; they get a second join key
    hashed from ``spread`` and so land on many partitions.  All other rows have 0
    there.  So has ``right``, written as a hash modulo one: a plain literal would
    be folded into the join condition and no longer take part in partitioning.
    """
    salt = "_null_spread"
    value = F.col(spread) if isinstance(spread, str) else spread
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    spread_over = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    somewhere = F.pmod(F.xxhash64(value), F.lit(spread_over)) + 1
    salted = left.withColumn(salt, F.when(missing, somewhere).otherwise(0).cast("int"))
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    return salted.join(right.withColumn(salt, zero), [*keys, salt], "left").drop(salt)


def smallest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by all other columns.

    An aggregate rather than a window: duplicates collapse before the shuffle, and
    which row stays does not depend on the order of tasks.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    chosen = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
