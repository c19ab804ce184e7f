"""Places in linked lists: rows that each name the next one.

A list of n links is ranked in log2(n) rounds instead of n steps. Round k knows for each
link the one 2^k places on (its jump); those reached so far, places 0 to 2^k - 1, find the
next 2^k places by one join, and jumps double by another. Each round is stored, so a
lost executor costs its tasks and a plan never holds more than one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptflow.operators.joins import smallest_per_key
from apptflow.session import written_once

LISTED, HEAD, CUT_OFF = "listed", "second head", "cut off"


def chain_positions(links: DataFrame, first: int, end: int = -1) -> DataFrame:
    """(id, next_id, place, part, on_cycle) of ``links`` (``id``, ``next_id``).

    ``place`` counts from 0 along ``next_id`` from the link ``first``; links that are not
    reached have none. ``part`` is ``listed``, ``second head`` (not reached, and nothing
    names it) or ``cut off`` (not reached, behind such a head or on a closed cycle).
    A cycle that is reached is listed once, in the order it is first entered;
    ``on_cycle`` marks the links of every cycle. ``next_id`` is ``end`` at the end of the
    list; null, or a link that is not there, ends it too. Of several rows with an id the
    one with the smallest ``next_id`` counts; rows without an id have no place and are
    left out. Without ``first`` nothing is listed.
    """
    known = smallest_per_key(
        links.select(F.col("id").cast("long").alias("id"), F.col("next_id").cast("long").alias("next_id")).where(
            F.col("id").isNotNull()
        ),
        ["id"],
    )
    known = written_once(known, "links")
    count = known.count()
    named = known.where(F.col("next_id").isNotNull() & (F.col("next_id") != end))
    jumps = written_once(
        named.join(known.select(F.col("id").alias("next_id")), "next_id", "left_semi").select(
            "id", F.col("next_id").alias("jump")
        ),
        "jumps",
    )
    reached = known.where(F.col("id") == first).select("id", F.lit(0).cast("long").alias("place"))
    reached = written_once(reached, "reached")
    step, open_end = 1, True
    while step < 2 * count:
        if open_end:
            moved = reached.join(jumps, "id").select(F.col("jump").alias("id"), F.col("place") + step)
            found = reached.union(moved).groupBy("id").agg(F.min("place").alias("place"))
            found = written_once(found, "reached")
            # a round that finds no new link has found them all
            open_end = found.count() > reached.count()
            reached = found
        then = jumps.select(F.col("id").alias("jump"), F.col("jump").alias("_then"))
        jumps = written_once(jumps.join(then, "jump").select("id", F.col("_then").alias("jump")), "jumps")
        step *= 2
        if not open_end and jumps.isEmpty():
            break
    # whoever still has a link ahead after as many steps as there are links runs in a cycle,
    # and the links met there are all of its links
    cycle = jumps.select(F.col("jump").alias("id")).distinct()
    places = known.join(reached, "id", "left").join(cycle.withColumn("on_cycle", F.lit(True)), "id", "left")
    pointed = named.select(F.col("next_id").alias("id")).distinct().withColumn("_pointed", F.lit(True))
    part = (
        F.when(F.col("place").isNotNull(), LISTED).when(F.col("_pointed").isNull(), HEAD).otherwise(CUT_OFF)
    )
    return places.join(pointed, "id", "left").select(
        "id", "next_id", "place", part.alias("part"), F.coalesce("on_cycle", F.lit(False)).alias("on_cycle")
    )
