"""Versions added to the stored overlay one by one give the overlay of all."""

import random

import pytest

from lanternstats.operators import ip_ranges
from lanternstats.plans import overlay_store

from test_order_and_ranges import make_ranges

SCHEMA = "version string, from_ip bigint, to_ip bigint, country string"


def rows(frame):
    return sorted(tuple(r[c] for c in sorted(frame.columns)) for r in frame.collect())


@pytest.mark.parametrize("seed", [3, 8])
def test_one_by_one(spark, tmp_path, seed):
    rng = random.Random(seed)
    data = make_ranges(rng)
    ranges = spark.createDataFrame(data, SCHEMA)
    versions = sorted({r[0] for r in data})
    for v in versions:
        assert overlay_store.add_version(spark, str(tmp_path), ranges.where(f"version = '{v}'"))
    assert not overlay_store.add_version(spark, str(tmp_path), ranges.where(f"version = '{versions[0]}'"))
    assert overlay_store.known_versions(spark, str(tmp_path)) == versions
    assert rows(overlay_store.overlay_table(spark, str(tmp_path))) == rows(ip_ranges.overlay_table(ranges))
    top = max(r[2] for r in data)
    edges = [x for r in data for x in (r[1], r[2])]
    asked = [(i, rng.choice([rng.randrange(top + 1000), rng.choice(edges)]), rng.choice(versions)) for i in range(300)]
    lookups = spark.createDataFrame(asked, "id int, ip bigint, version string")
    marks = overlay_store.read_marks(spark, str(tmp_path))
    for gaps in (False, True):
        found = overlay_store.lookup_country(lookups, marks, fill_gaps=gaps)
        assert rows(found) == rows(ip_ranges.lookup_country(lookups, ranges, fill_gaps=gaps))


def test_long_ranges_and_borders_of_blocks(spark, tmp_path):
    block = ip_ranges.BLOCK
    data = [
        ("a", 100, block - 1, "DE"),  # ends with its block, inside the next version's range
        ("b", 0, 3 * block + 5, "US"),
        ("b", 3 * block + 6, 4 * block - 1, "FR"),
        ("c", 2 * block, 2 * block + 9, "NL"),  # starts with a block
        ("c", (1 << 24) - 5, (1 << 24) + 5, "SE"),  # in two parts
    ]
    ranges = spark.createDataFrame(data, SCHEMA)
    assert overlay_store.add_versions(spark, str(tmp_path), ranges) == ["a", "b", "c"]
    got = rows(overlay_store.overlay_table(spark, str(tmp_path)))
    assert got == rows(ip_ranges.overlay_table(ranges))
    assert (0, 99, "ZZ", "US", "ZZ") in {(r[0], r[1], *r[2:]) for r in got}


def test_only_touched_parts(spark, tmp_path):
    root, part = str(tmp_path), 1 << 24
    version = lambda name, *at: spark.createDataFrame([(name, p * part + 10, p * part + 99, name) for p in at], SCHEMA)
    overlay_store.add_version(spark, root, version("a", 0, 1, 2, 200))
    overlay_store.add_version(spark, root, version("b", 1))
    overlay_store.add_version(spark, root, version("c", 2, 7))
    written = {(r.batch, r.part) for r in spark.read.parquet(f"{root}/commits").collect()}
    assert written == {(1, 0), (1, 1), (1, 2), (1, 200), (2, 1), (3, 2), (3, 7)}
    assert {p.name for p in (tmp_path / "marks" / "batch=3").glob("part=*")} == {"part=2", "part=7"}
    # What an add reads is chosen by folder.
    plan = overlay_store.read_marks(spark, root, [2, 7])._jdf.queryExecution().toString()
    assert "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert overlay_store.read_marks(spark, root, [2]).count() == 2


def test_failed_add(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    make = lambda name: spark.createDataFrame([(name, 5, 9, name)], SCHEMA)
    overlay_store.add_version(spark, root, make("a"))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(overlay_store, "merge_marks", fail)
        with pytest.raises(RuntimeError):
            overlay_store.add_version(spark, root, make("b"))
    assert rows(overlay_store.overlay_table(spark, root)) == [(5, 9, "a")]
    assert overlay_store.add_version(spark, root, make("b"))
    assert rows(overlay_store.overlay_table(spark, root)) == [(5, 9, "a", "b")]


def test_nothing_stored(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert not overlay_store.add_version(spark, str(tmp_path), empty)
    assert overlay_store.overlay_table(spark, str(tmp_path)).count() == 0
    asked = spark.createDataFrame([(1, "a")], "ip bigint, version string")
    assert [r.country for r in overlay_store.lookup_country(asked, overlay_store.read_marks(spark, str(tmp_path))).collect()] == ["ZZ"]
    with pytest.raises(ValueError):
        overlay_store.add_version(spark, str(tmp_path), spark.createDataFrame([("a", 1, 2, "x"), ("b", 1, 2, "x")], SCHEMA))
