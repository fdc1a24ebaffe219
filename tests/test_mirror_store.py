"""The stored mirror over several batches equals the mirror of all facts."""

import datetime
import random

import pytest

from lanternstats.plans import keyed_tables, mirror_store

DAY = datetime.datetime(2010, 2, 1)
STATUS = "validafter timestamp_ntz, fingerprint string, descriptor string, published timestamp_ntz, dirport int"
DESCRIPTOR = "descriptor string, published timestamp_ntz, platform string"


def at(hours):
    return None if hours is None else DAY + datetime.timedelta(hours=hours)


def rows(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=str)


@pytest.fixture
def made(spark):
    def make(entries=(), descriptors=()):
        return (
            spark.createDataFrame([(at(h), f, d, at(p), n) for h, f, d, p, n in entries], STATUS),
            spark.createDataFrame([(d, at(p), w) for d, p, w in descriptors], DESCRIPTOR),
        )

    return make


def test_random_batches(spark, made, tmp_path):
    rng = random.Random(4)
    hours = [*range(0, 96, 5), None]
    descriptors = [(f"d{i}", rng.choice(hours), rng.choice(["x", None])) for i in range(30)]
    # d0 is listed by a third of the entries; d30 to d39 never come; some entries list none.
    names = [*["d0"] * 20, *[f"d{i}" for i in range(40)], None]
    entries = [(rng.choice(hours), f"f{i}", rng.choice(names), rng.choice(hours), i) for i in range(120)]
    root, parts = str(tmp_path), 4
    rng.shuffle(descriptors)
    for k in range(parts):
        mirror_store.update(spark, root, k + 1, *made(entries[k::parts], descriptors[k::parts]))
    everything = made(entries, descriptors)
    assert rows(mirror_store.read_mirror(spark, root, *everything)) == rows(keyed_tables.denormalised_mirror(*everything))


def test_only_dates_that_list_a_descriptor(spark, made, tmp_path):
    root = str(tmp_path)
    types = made()
    assert mirror_store.update(spark, root, 1, *types) == []
    first = made([(1, "a", "x", 0, 1), (30, "a", "x", 0, 2), (60, "b", "y", 0, 3)], [("y", 5, "w"), ("z", 80, "w")])
    assert [d.day for d in mirror_store.update(spark, root, 1, *first)] == [1, 2, 3, 4]
    # Late: x is listed on the first two days and was published on the second.
    assert [d.day for d in mirror_store.update(spark, root, 2, *made(descriptors=[("x", 30, "v")]))] == [1, 2]
    # The entry of the third day lists z, which until then stood alone on the fourth.
    again = made([(61, "c", "z", 0, 4)])
    assert [d.day for d in mirror_store.update(spark, root, 3, *again)] == [3, 4]
    found = {(r.fingerprint, r.descriptor, r.platform) for r in mirror_store.read_mirror(spark, root, *types).collect()}
    assert found == {("a", "x", "v"), ("b", "y", "w"), ("c", "z", "w")}


def test_a_failed_batch_is_run_again(spark, made, tmp_path, monkeypatch):
    root = str(tmp_path)
    facts = made([(1, "a", "x", 0, 1)], [("x", 0, "v"), ("u", 50, None)])
    with monkeypatch.context() as patch:
        patch.setattr(mirror_store.DatedStore, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            mirror_store.update(spark, root, 1, *facts)
    assert rows(mirror_store.read_mirror(spark, root, *facts)) == []
    mirror_store.update(spark, root, 1, *facts)
    assert rows(mirror_store.read_mirror(spark, root, *facts)) == rows(keyed_tables.denormalised_mirror(*facts))
