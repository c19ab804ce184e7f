"""Points joined with the ranges that hold them, as an equality join.

A range of whole numbers is cut into blocks of 1, 2, 4, ... numbers that begin at a
multiple of their size, as large as fit: at most two of each size. A point lies in one
block of each size. So a point and a range that holds it share exactly one block, and a
point and a range that does not share none: the join on (key, size, block) makes the
pairs of the result and no others, and a key with very many of both is spread over its
blocks. Sizes stop at the span of a key's points, which for a poll is a day or two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.session import written_once


def _block(n: Column, level: Column) -> Column:
    """The block of 2**level numbers that ``n`` lies in."""
    return F.call_function("shiftright", n, level)


def _blocks(low: Column, high: Column, levels: Column) -> Column:
    """(level, block) of the blocks that make up low..high, both included."""

    def inside(level: Column) -> tuple[Column, Column]:
        return -_block(-low, level), _block(high + 1, level) - 1

    def of_level(level: Column) -> Column:
        first, last = inside(level)
        parent_first, parent_last = inside(level + 1)
        ends = F.when(first == last, F.array(first)).when(first < last, F.array(first, last))
        # a block whose larger one fits as well is part of that one, unless that size is not used
        kept = F.filter(
            F.coalesce(ends, F.array().cast("array<long>")),
            lambda b: ~_block(b, F.lit(1)).between(parent_first, parent_last),
        )
        top = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<long>"))
        return F.transform(
            F.when(level == levels, top).otherwise(kept), lambda b: F.struct(level.alias("level"), b.alias("block"))
        )

    return F.flatten(F.transform(F.sequence(F.lit(0), levels), of_level))


def points_in_ranges(
    points: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    point: str,
    low: str,
    high: str,
    stored: bool = True,
) -> DataFrame:
    """Inner join of ``points`` and ``ranges`` on ``keys`` and low <= point <= high.

    ``point``, ``low`` and ``high`` are whole numbers; columns of the two tables other than
    ``keys`` have different names. Rows with a null in these columns match nothing, a range
    that ends before it begins holds nothing. Ranges are cut to the span of their key's
    points first, and keys without points drop out. ``stored`` writes the spans down, so
    that a key with a large part of all ranges can be split when it meets them.
    """
    keys = list(keys)
    span = points.groupBy(*keys).agg(F.min(point).alias("_least"), F.max(point).alias("_most"))
    width = F.col("_most") - F.col("_least") + 1
    # no larger block than this lies inside the span
    levels = F.floor(F.log2(width)).cast("int").alias("_levels")
    span = span.where(F.col("_least").isNotNull()).select(*keys, "_least", "_most", levels)
    if stored:
        span = written_once(span, "spans")
    held = ranges.join(span, keys).withColumns(
        {"_low": F.greatest(low, "_least").cast("long"), "_high": F.least(high, "_most").cast("long")}
    )
    held = held.where(F.col(low).isNotNull() & F.col(high).isNotNull() & (F.col("_low") <= F.col("_high")))
    held = held.withColumn("_at", F.explode(_blocks(F.col("_low"), F.col("_high"), F.col("_levels"))))
    placed = points.join(span.select(*keys, "_levels"), keys).where(F.col(point).isNotNull())
    own = F.transform(
        F.sequence(F.lit(0), F.col("_levels")),
        lambda l: F.struct(l.alias("level"), _block(F.col(point).cast("long"), l).alias("block")),
    )
    placed = placed.withColumn("_at", F.explode(own))
    placed = placed.withColumns({"_level": F.col("_at.level"), "_block": F.col("_at.block")}).drop("_at", "_levels")
    held = held.withColumns({"_level": F.col("_at.level"), "_block": F.col("_at.block")})
    held = held.drop("_at", "_levels", "_least", "_most", "_low", "_high")
    return placed.join(held, [*keys, "_level", "_block"]).drop("_level", "_block")
