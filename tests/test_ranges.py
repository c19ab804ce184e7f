from __future__ import annotations

import random
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from apptflow.operators import payments as pa
from apptflow.operators import workload as wl
from apptflow.operators.counts import RunCounts
from apptflow.operators.ranges import _blocks, points_in_ranges
from apptflow.session import written_once


@pytest.mark.parametrize("stored", [True, False])
def test_points_in_ranges_equal_a_plain_join(spark, stored):
    rng = random.Random(4)
    points = [(rng.randrange(5), rng.choice([None, rng.randrange(-40, 40)])) for _ in range(300)]
    ranges = []
    for i in range(300):
        low = rng.randrange(-60, 50)
        ranges.append((rng.choice([None, 0, 1, 2, 3, 9]), i, low, rng.choice([None, low + rng.randrange(-3, 90)])))
    p = spark.createDataFrame(points, "k long, at int").distinct()
    r = spark.createDataFrame(ranges, "k long, name long, low int, high int")
    got = points_in_ranges(p, r, ["k"], "at", "low", "high", stored)
    assert set(got.columns) == {"k", "at", "name", "low", "high"}
    want = p.join(r, "k").where("at BETWEEN low AND high")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 100


def test_a_range_has_two_blocks_of_a_size_at_most(spark):
    rng = random.Random(5)
    rows = [(a := rng.randrange(-5000, 5000), a + rng.randrange(9000)) for _ in range(300)] + [(7, 7), (0, 1023), (-8, -1)]
    table = spark.createDataFrame(rows, "low long, high long")
    blocks = table.withColumn("b", _blocks(F.col("low"), F.col("high"), F.lit(14)))
    for r in blocks.collect():
        covered = []
        sizes = [x.level for x in r.b]
        assert max(sizes.count(s) for s in set(sizes)) <= 2
        for x in r.b:
            covered += range(x.block << x.level, (x.block + 1) << x.level)
        assert sorted(covered) == list(range(r.low, r.high + 1))


def test_one_patient_with_very_many_contracts_and_days(spark):
    """20,000 contracts of two days and 4,000 days: 80 million pairs, of which 40,000 are right."""
    days = spark.range(4000).selectExpr("1L AS pcode", "cast(id AS int) AS day")
    contracts = spark.range(20000).selectExpr(
        "1L AS pcode", "id AS agreement", "cast(id % 3999 AS int) AS low", "cast(id % 3999 + 1 AS int) AS high"
    )
    counts = RunCounts()
    pairs = counts.watch(points_in_ranges(days, contracts, ["pcode"], "day", "low", "high"), "pairs")
    begin = time.time()
    written = written_once(pairs, "pairs")
    assert counts.read() == {"pairs": {"rows": 40000}}
    assert written.where("day NOT BETWEEN low AND high").count() == 0
    assert time.time() - begin < 60


def test_valid_agreements_of_awkward_contracts(spark):
    schedule = spark.createDataFrame(
        [(1, 1, date(2024, 1, 15)), (2, 1, date(2024, 1, 20)), (3, 2, date(2024, 1, 15)), (4, None, date(2024, 1, 15)), (5, 1, None)],
        "schedid long, pcode long, workdate date",
    )
    day = lambda d: datetime(2024, 1, d)
    contracts = [
        (1, "b", day(1), day(31), None, None),
        (1, "a", day(15), day(15), None, 0),
        (1, "cancelled", day(1), day(31), day(10), None),
        (1, "deleted", day(1), day(31), None, 1),
        (1, "backwards", day(20), day(15), None, None),
        (1, "open", day(1), None, None, None),
        (1, None, day(1), day(31), None, None),
        (2, "late", day(16), day(31), None, None),
    ]
    table = spark.createDataFrame(
        contracts, "pcode long, agreement string, bdate timestamp_ntz, fdate timestamp_ntz, datecancel timestamp_ntz, isdeleted int"
    )
    got = {r.schedid: r.clhistinfo for r in pa.valid_agreements(schedule, table).collect()}
    assert got == {1: "a; b", 2: "b"}


# ---------------------------------------------------------------------------- gaps

DAY = date(2024, 1, 15)


def at(hour, minute=0):
    return datetime(2024, 1, 15, hour, minute)


ROSTER = "dcode long, wdate date, beghour int, begmin int, endhour int, endmin int"
VISITS = "schedid long, dcode long, workdate date, bhour int, bmin int"


def gaps_of(spark, visits, shifts=((1, 9, 0, 12, 0),)):
    roster = spark.createDataFrame([(d, DAY, *rest) for d, *rest in shifts], ROSTER)
    booked = spark.createDataFrame([(i, d, DAY, h, m) for i, (d, h, m) in enumerate(visits)], VISITS)
    return roster, booked, sorted(
        (r.dcode, r.gap_begin, r.gap_end) for r in wl.free_gaps(roster, booked).collect()
    )


@pytest.mark.parametrize(
    ("visits", "gaps"),
    [
        ([], [(at(9), at(12))]),
        ([(1, 10, 0)], [(at(9), at(10)), (at(10, 30), at(12))]),
        ([(1, 10, 0), (1, 10, 0), (1, 10, 10), (1, 10, 40)], [(at(9), at(10)), (at(11, 10), at(12))]),
        ([(1, 8, 45), (1, 11, 50)], [(at(9, 15), at(11, 50))]),
        ([(1, 9, 0), (1, 9, 30), (1, 10, 7), (1, 13, 0)], [(at(10), at(10, 7)), (at(10, 37), at(12))]),
        ([(1, 7, 0), (2, 10, 0), (None, 10, 0)], [(at(9), at(12))]),
    ],
)
def test_free_gaps(spark, visits, gaps):
    assert gaps_of(spark, visits)[2] == [(1, *g) for g in gaps]


def test_free_gaps_of_each_shift(spark):
    shifts = ((1, 9, 0, 10, 0), (1, 9, 30, 11, 0), (2, 9, 0, 9, 0), (3, 12, 0, 11, 0))
    assert gaps_of(spark, [(1, 9, 40)], shifts)[2] == [
        (1, at(9), at(9, 40)), (1, at(9, 30), at(9, 40)), (1, at(10, 10), at(11)),
    ]


def test_free_gaps_as_a_table_function(spark):
    rng = random.Random(2)
    visits = [(rng.randrange(3), rng.randrange(8, 13), rng.randrange(60)) for _ in range(14)]
    roster, booked, want = gaps_of(spark, visits, [(d, 9, 0, 12, 0) for d in range(4)])
    wl.register_free_gaps(spark)
    begin = "cast(workdate AS timestamp_ntz) + make_dt_interval(0, bhour, bmin, 0)"
    booked.selectExpr("dcode", f"{begin} AS b").createOrReplaceTempView("gap_visits")
    roster.createOrReplaceTempView("gap_roster")
    got = spark.sql("""
        SELECT s.dcode, g.gap_begin, g.gap_end
        FROM (SELECT r.dcode, timestamp_ntz'2024-01-15 09:00:00' AS lo, timestamp_ntz'2024-01-15 12:00:00' AS hi,
                     collect_list(CASE WHEN b IS NOT NULL
                                  THEN named_struct('begin', b, 'end', b + INTERVAL '30' MINUTE) END) AS visits
              FROM gap_roster r LEFT JOIN gap_visits v ON v.dcode = r.dcode GROUP BY r.dcode) s,
             LATERAL free_gaps(s.lo, s.hi, s.visits) g""")
    assert sorted(tuple(r) for r in got.collect()) == want


# -------------------------------------------------------------------------- counters


def test_counters_are_read_after_the_write(spark):
    counts = RunCounts()
    df = counts.watch(spark.range(10), "ids", even=F.col("id") % 2 == 0, **{"no such: id": F.col("id") > 99})
    with pytest.raises(ValueError):
        counts.watch(df, "ids")
    assert written_once(df.where("id > 3"), "ids").count() == 6
    assert counts.read() == {"ids": {"rows": 10, "even": 5, "no such: id": 0}}
    assert counts.table(spark).count() == 3


def test_counters_need_no_scan_of_their_own(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).write.parquet(path)
    counts = RunCounts()
    df = counts.watch(spark.read.parquet(path), "rows")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    written_once(df, "out")
    assert counts.read()["rows"]["rows"] == 100


def test_gap_days_are_independent(spark):
    roster = spark.createDataFrame([(1, DAY + timedelta(days=i), 9, 0, 12, 0) for i in range(2)], ROSTER)
    booked = spark.createDataFrame([(1, 1, DAY, 9, 0)], VISITS)
    got = sorted((r.wdate.day, r.gap_begin.hour) for r in wl.free_gaps(roster, booked).collect())
    assert got == [(15, 9), (16, 9)]


# ------------------------------------------------------------------- pieces by size


def test_failure_runs_of_one_hot_source_in_pieces(spark):
    from apptflow.operators import monitoring as mo

    rng = random.Random(6)
    # almost all events are of one source and one minute
    rows = [(i, at(12, 0) + timedelta(microseconds=i // 3), 1, rng.random() < 0.7) for i in range(4000)]
    rows += [(5000 + i, at(8) + timedelta(minutes=i), i % 5, rng.random() < 0.5) for i in range(300)]
    rows += [(9000, None, 1, True), (9001, at(9), None, True)]
    events = spark.createDataFrame(rows, "id long, ts timestamp_ntz, source long, bad boolean")
    bad = F.col("bad")
    want = sorted(map(tuple, mo.failure_runs(events, "source", "ts", bad, {}, 3, tie_col="id").collect()))
    for pieces in (1, 7, 40):
        got = mo.failure_runs(events, "source", "ts", bad, {}, 3, tie_col="id", pieces=pieces)
        assert sorted(map(tuple, got.collect())) == want
    numbered = mo._numbered(events, "source", "ts", bad, "id", "10 minutes", 40)
    assert numbered.groupBy("source", "chunk").count().agg(F.max("count")).first()[0] < 400
    still = mo.open_failures(events, "source", "ts", bad, tie_col="id")
    cut = mo.open_failures(events, "source", "ts", bad, tie_col="id", pieces=9)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, still.collect()))
