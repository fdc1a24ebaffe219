"""Statistics over several batches equal those of one batch with all documents."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from lanternstats.plans import bridge_history, measurements, summaries, warehouse

DAY = datetime.datetime(2010, 2, 1)
OBSERVATIONS = "bridge string, date date, seen timestamp_ntz, country string, users double"


def rows(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=str)


@pytest.fixture
def made(spark):
    def make(observed=(), relays=(), broken=()):
        seen = [(b, (DAY + datetime.timedelta(hours=h)).date(), DAY + datetime.timedelta(hours=h), c, float(u)) for b, h, c, u in observed]
        return (
            spark.createDataFrame([(r,) for r in relays], "hashed_relay string"),
            spark.createDataFrame([(b, DAY + datetime.timedelta(hours=h)) for b, h in broken], "bridge string, seen timestamp_ntz"),
            spark.createDataFrame(seen, OBSERVATIONS),
        )

    return make


def test_history_of_random_batches(spark, made, tmp_path):
    rng = random.Random(9)
    names = [f"B{i}" for i in range(12)]
    observed = {(rng.choice(names), rng.randrange(96), rng.choice(["de", "us"])): rng.randrange(9) for _ in range(150)}
    observed = [(*k, u) for k, u in observed.items()]
    relays, broken = names[:4], [(b, h) for b, h, _, _ in observed if h % 7 == 0]
    root, parts = str(tmp_path), 3
    for k in range(parts):
        part = lambda x: [v for i, v in enumerate(x) if i % parts == k]
        bridge_history.update(spark, root, k + 1, *made(part(observed), part(relays), part(broken)))
    all_relays, all_broken, all_observed = made(observed, relays, broken)
    want = summaries.bridge_users_by_day(all_observed, all_relays, all_broken)
    assert rows(bridge_history.read_stats(spark, root, all_observed)) == rows(want)


def test_late_relay_and_untouched_dates(spark, made, tmp_path):
    root = str(tmp_path)
    first = made([("A", 1, "de", 3), ("B", 2, "de", 5), ("B", 50, "us", 1), ("C", 30, "fr", 2)])
    assert len(bridge_history.update(spark, root, 1, *first)) == 3
    late = made(relays=["B", "unseen"])
    assert [d.day for d in bridge_history.update(spark, root, 2, *late)] == [1, 3]
    stats = {(r.date.day, r.country): r.users for r in bridge_history.read_stats(spark, root, first[2]).collect()}
    # The date of which nothing is left is empty, not old.
    assert stats == {(1, "de"): 3.0, (2, "fr"): 2.0}
    # Relays of earlier batches keep later observations out; nothing new changes nothing.
    assert len(bridge_history.update(spark, root, 3, *made([("B", 3, "de", 7)]))) == 1
    assert bridge_history.update(spark, root, 4, *made()) == []
    assert len(rows(bridge_history.read_stats(spark, root, first[2]))) == 2


def test_failed_history_batch(spark, made, tmp_path, monkeypatch):
    root = str(tmp_path)
    first = made([("A", 1, "de", 3), ("B", 2, "de", 5)])
    bridge_history.update(spark, root, 1, *first)
    before = rows(bridge_history.read_stats(spark, root, first[2]))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(summaries, "bridge_users_by_day", fail)
        with pytest.raises(RuntimeError):
            bridge_history.update(spark, root, 2, *made(relays=["B"]))
    assert rows(bridge_history.read_stats(spark, root, first[2])) == before
    bridge_history.update(spark, root, 2, *made(relays=["B"]))
    assert [r.users for r in bridge_history.read_stats(spark, root, first[2]).collect()] == [3.0]


def test_filter_never_misses(spark):
    relays = spark.range(3_000).select(F.sha1(F.col("id").cast("string")).alias("hashed_relay"))
    rows_ = spark.range(6_000).select(F.sha1(F.col("id").cast("string")).alias("bridge"), "id")
    tested = bridge_history.maybe_known(rows_, bridge_history.filter_bits(relays))
    counts = {r[0]: r["count"] for r in tested.groupBy(F.struct(F.col("id") < 3_000, "_maybe").alias("k")).count().collect()}
    assert counts[(True, True)] == 3_000 and counts.get((False, True), 0) < 10
    left = bridge_history.without_known_relays(rows_, relays, bridge_history.filter_bits(relays))
    assert left.agg(F.min("id"), F.count("*")).first() == (3_000, 3_000)


def test_timings_of_two_batches(spark, tmp_path):
    rng = random.Random(4)
    data = [(rng.choice("xy"), DAY + datetime.timedelta(minutes=17 * i), rng.randrange(10_000)) for i in range(300)]
    frame = lambda part: spark.createDataFrame(part, measurements.TIMINGS)
    root = str(tmp_path)
    measurements.update_timings(spark, root, frame(data[:140]))
    day = lambda d: (DAY + datetime.timedelta(days=d)).date()
    actions = {r.action: r.n for r in measurements.update_timings(spark, root, frame(data[140:] + data[:1])).collect()}
    stored = warehouse.keyed_table(spark, root, "timing_stats")
    want = summaries.timing_quartiles(frame(data))
    assert rows(stored) == rows(want.select(stored.columns))
    # The day of the split is renewed, and the day of the repeated timing looked at; the others are new.
    assert actions.get("update") == 2 and actions.get("unchanged", 0) + actions.get("kept", 0) == 2
    # The timing stored first counts, and the batch can be run again.
    again = [(s, t, v + 1) for s, t, v in data[:5]]
    measurements.update_timings(spark, root, frame(again))
    assert measurements.raw_timings(spark, root).count() == 300
    assert rows(warehouse.keyed_table(spark, root, "timing_stats")) == rows(want.select(stored.columns))
    assert warehouse.keyed_table(spark, root, "timing_stats").where(F.col("date") == F.lit(day(0))).count() == 2


def test_packages(spark, tmp_path):
    frame = lambda *r: spark.createDataFrame(r, "date date, bundle string, downloads bigint")
    one, two = DAY.date(), (DAY + datetime.timedelta(days=1)).date()
    measurements.update_packages(spark, str(tmp_path), frame((one, "a", 1), (one, "b", 2), (two, "a", 3)))
    actions = {r.action: r.n for r in measurements.update_packages(spark, str(tmp_path), frame((one, "a", 1), (one, "b", 5), (one, "c", 6))).collect()}
    assert actions == {"unchanged": 1, "update": 1, "insert": 1}
    found = {(r.date, r.bundle): r.downloads for r in warehouse.keyed_table(spark, str(tmp_path), "package_stats").collect()}
    assert found == {(one, "a"): 1, (one, "b"): 5, (one, "c"): 6, (two, "a"): 3}
