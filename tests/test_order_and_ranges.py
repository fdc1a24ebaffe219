"""Operators with an exact brute-force answer."""

import datetime
import random

import pytest

from lanternstats.operators import intervals, ip_ranges
from lanternstats.plans import summaries


def brute_quartiles(values):
    n = len(values)
    s = sorted(values)
    return (s[n // 4 - 1], s[n // 2 - 1], s[n * 3 // 4 - 1]) if n > 4 else None


def test_timing_quartiles(spark):
    rng = random.Random(1)
    rows, expected = [], {}
    for source, n, span in [
        ("four", 4, 100), ("five", 5, 100), ("seven", 7, 3), ("many", 400, 10_000_000), ("same", 300, 1), ("wide", 50, 2**40),
    ]:
        values = [rng.randrange(span) - span // 5 for _ in range(n)]
        rows += [(source, datetime.datetime(2010, 2, 1), v) for v in values]
        expected[source] = brute_quartiles(values)
    frame = spark.createDataFrame(rows, "source string, started timestamp_ntz, completemillis bigint")
    got = {r.source: (r.q1, r.md, r.q3) for r in summaries.timing_quartiles(frame).collect()}
    assert got == {k: v for k, v in expected.items() if v}


def test_completion_millis(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(
        summaries.completion_millis(*[F.lit(x).cast("bigint") for x in (10, 2500, 12, 7999)]).alias("kept"),
        summaries.completion_millis(*[F.lit(x).cast("bigint") for x in (10, 2500, 12, 7999)], corrected=True).alias("fixed"),
        summaries.repair_overflow(F.lit(-5)).alias("repaired"),
    ).first()
    assert tuple(row) == (2009, 2005, 99_999_995)


def make_ranges(rng):
    """Disjoint ranges of three versions, some within a block, some over several."""
    rows = []
    for version in ("20100101", "20100110", "20100201"):
        at = rng.randrange(1000)
        for _ in range(60):
            at += rng.choice([0, 1, 50, 70_000])
            size = rng.choice([1, 2, 300, 65_536, 200_000])
            rows.append((version, at, at + size - 1, rng.choice(["DE", "US", "EU", "FR"])))
            at += size
    return rows


@pytest.mark.parametrize("fill_gaps", [False, True])
def test_lookup(spark, fill_gaps):
    rng = random.Random(2)
    rows = make_ranges(rng)
    top = max(r[2] for r in rows)
    asked = [(i, rng.choice([rng.randrange(top + 1000), rng.choice(rows)[1], rng.choice(rows)[2]]),
              rng.choice(["20091201", "20100101", "20100105", "20100115", "20110101"])) for i in range(400)]
    asked += [(1000 + i, asked[0][1], asked[0][2]) for i in range(200)]
    ranges = spark.createDataFrame(rows, "version string, from_ip bigint, to_ip bigint, country string")
    lookups = spark.createDataFrame(asked, "id int, ip bigint, day string")
    versions = sorted({r[0] for r in rows})
    borders = sorted({b for r in rows for b in (r[1], r[2] + 1)})
    starts = [b for b in borders if any(r[1] <= b <= r[2] for r in rows)]

    def expected(ip, day):
        version = max([v for v in versions if v <= day], default=versions[0])
        if fill_gaps:
            ip = max([s for s in starts if s <= ip], default=-1)
        holding = [r for r in rows if r[0] == version and r[1] <= ip <= r[2]]
        return max(holding, key=lambda r: r[1])[3] if holding else "ZZ"

    want = {i: expected(ip, day) for i, ip, day in asked}
    chosen = ip_ranges.choose_version(lookups, ranges, "day")
    found = ip_ranges.lookup_country(chosen, ranges, fill_gaps)
    assert {r.id: r.country for r in found.collect()} == want


def test_gap_before_another_version(spark):
    """An address that only another version's range covers, and one between ranges."""
    ranges = spark.sql("SELECT * FROM VALUES ('a', 0L, 9L, 'DE'), ('b', 20L, 29L, 'US') AS t(version, from_ip, to_ip, country)")
    asked = spark.sql("SELECT * FROM VALUES ('a', 25L), ('a', 12L), ('b', 12L), ('b', 99999L) AS t(version, ip)")
    found = {(r.version, r.ip): r.country for r in ip_ranges.lookup_country(asked, ranges, fill_gaps=True).collect()}
    assert found == {("a", 25): "ZZ", ("a", 12): "DE", ("b", 12): "ZZ", ("b", 99999): "US"}


def test_codes_of_no_country(spark):
    ranges = spark.sql("SELECT * FROM VALUES ('a', 0L, 9L, 'EU'), ('a', 10L, 19L, 'eu') AS t(version, from_ip, to_ip, country)")
    asked = spark.sql("SELECT * FROM VALUES ('a', 5L), ('a', 15L) AS t(version, ip)")
    look = lambda **k: {r.ip: r.country for r in ip_ranges.lookup_country(asked, ranges, **k).collect()}
    assert look() == {5: "EU", 15: "ZZ"} and look(any_case=True) == {5: "ZZ", 15: "ZZ"}


def test_overlay(spark):
    rng = random.Random(3)
    rows = make_ranges(rng)
    ranges = spark.createDataFrame(rows, "version string, from_ip bigint, to_ip bigint, country string")
    versions = sorted({r[0] for r in rows})
    got = {(r[0], r[1]): tuple(r)[2:] for r in ip_ranges.overlay_table(ranges).collect()}
    borders = sorted({b for r in rows for b in (r[1], r[2] + 1)})
    want = {}
    for a, b in zip(borders, borders[1:]):
        cells = tuple(
            next((r[3] for r in rows if r[0] == v and r[1] <= a <= r[2]), "ZZ") for v in versions
        )
        if set(cells) != {"ZZ"}:
            want[(a, b - 1)] = cells
    assert got == want


def test_ip_number(spark):
    row = spark.sql("SELECT '1.2.3.4' AS a, '1.2' AS b").select(
        ip_ranges.ip_number("a").alias("a"), ip_ranges.ip_number("b").alias("b")
    ).first()
    assert tuple(row) == (16909060, None)


def test_statuses_to_rewrite(spark):
    rng = random.Random(4)
    start = datetime.datetime(2010, 2, 1)
    changed = [start + datetime.timedelta(seconds=rng.randrange(20 * 86400)) for _ in range(6)] + [start]
    times = [start + datetime.timedelta(minutes=30 * i) for i in range(-10, 48 * 22)]
    statuses = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, validafter timestamp_ntz")
    frame = spark.createDataFrame([(t,) for t in changed], "published timestamp_ntz")
    got = {r.id for r in intervals.statuses_to_rewrite(statuses, frame).collect()}
    day = datetime.timedelta(hours=24)
    assert got == {i for i, t in enumerate(times) if any(p <= t <= p + day for p in changed)}
