"""Late documents change what is stored, as if all had come at once."""

import datetime

import pytest
from pyspark.sql import functions as F

from lanternstats.operators import pseudonymise as ps
from lanternstats.plans import bridge_store as store, dated_store

from test_pseudonymise import EXTRA, IDENTITY, SERVER, STATUS, TIME

OTHER = "CD" * 20
LATER = "2010-02-03 09:00:00"


def moved(text):
    """The same document of another bridge, two days later."""
    grouped = lambda i: " ".join(i[k : k + 4] for k in range(0, 40, 4))
    return text.replace(grouped(IDENTITY), grouped(OTHER)).replace(IDENTITY, OTHER).replace(TIME, LATER)


@pytest.fixture
def raw(spark):
    texts = lambda *rows: spark.createDataFrame([(r,) for r in rows], "text string")
    status = lambda *rows: spark.createDataFrame([(n, datetime.datetime(2010, 2, *at), t) for n, at, t in rows], "status string, validafter timestamp_ntz, text string")
    return texts, status


STATUSES = [("near", (1, 12), STATUS), ("next", (2, 9), STATUS), ("far", (2, 11), STATUS), ("before", (1, 9), STATUS)]


def tables(spark, root):
    return {n: sorted(map(tuple, store.read_table(spark, root, n).drop("date").collect())) for n in store.TABLES}


def test_late_extra_info(spark, raw, tmp_path):
    texts, status = raw
    servers = texts(SERVER, moved(SERVER))
    two, one = f"{tmp_path}/two", f"{tmp_path}/one"
    store.apply_batch(spark, two, 1, status(*STATUSES), servers)
    first = tables(spark, two)
    assert {r[3] for r in first["servers"]} == {ps.NO_REFERENCE}
    store.apply_batch(spark, two, 2, extras=texts(EXTRA))
    store.apply_batch(spark, one, 1, status(*STATUSES), servers, texts(EXTRA))
    late, together = tables(spark, two), tables(spark, one)
    for name in ("extras", "servers", "mapping"):
        assert late[name] == together[name]
    # Only statuses of the 24 hours after the changed server are written anew.
    old, new, all_new = ({r[0]: r[2] for r in t["statuses"]} for t in (first, late, together))
    assert {n for n in new if new[n] != old[n]} == {"near", "next"}
    assert all(new[n] == all_new[n] for n in ("near", "next"))
    # The dates of the other bridge were neither read nor written again.
    batches = spark.read.parquet(f"{two}/commits").where("date = DATE'2010-02-03'").select("batch").distinct()
    assert [r.batch for r in batches.collect()] == [1]


def test_late_server_and_repeats(spark, raw, tmp_path):
    texts, status = raw
    two, one = f"{tmp_path}/two", f"{tmp_path}/one"
    store.apply_batch(spark, two, 1, status(STATUSES[0]), extras=texts(EXTRA))
    store.apply_batch(spark, two, 2, servers=texts(SERVER, SERVER), extras=texts(EXTRA))
    store.apply_batch(spark, two, 3, status(STATUSES[0]), texts(SERVER))
    store.apply_batch(spark, one, 1, status(STATUSES[0]), texts(SERVER), texts(EXTRA))
    assert tables(spark, two) == tables(spark, one)


def test_larger_digest_counts_in_any_order(spark, raw, tmp_path):
    texts, _ = raw
    other = EXTRA.replace("de=8", "de=16")
    results = []
    for k, order in enumerate([(EXTRA, other), (other, EXTRA)]):
        root = f"{tmp_path}/{k}"
        store.apply_batch(spark, root, 1, servers=texts(SERVER), extras=texts(order[0]))
        store.apply_batch(spark, root, 2, extras=texts(order[1]))
        results.append(tables(spark, root)["mapping"])
    assert results[0] == results[1]


def test_failed_batch_is_not_seen_and_runs_again(spark, raw, tmp_path, monkeypatch):
    texts, status = raw
    root = str(tmp_path)
    store.apply_batch(spark, root, 1, status(*STATUSES), texts(SERVER))
    before = tables(spark, root)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "statuses_to_rewrite", fail)
        with pytest.raises(RuntimeError):
            store.apply_batch(spark, root, 2, extras=texts(EXTRA))
    assert tables(spark, root) == before
    store.apply_batch(spark, root, 2, extras=texts(EXTRA))
    after = tables(spark, root)
    assert after["mapping"] != before["mapping"]
    # A batch that is run once more after its commit changes nothing.
    store.apply_batch(spark, root, 2, extras=texts(EXTRA))
    assert tables(spark, root) == after


def test_empty_batch_and_undated(spark, raw, tmp_path):
    texts, _ = raw
    store.apply_batch(spark, str(tmp_path), 1)
    assert all(not rows for rows in tables(spark, str(tmp_path)).values())
    store.apply_batch(spark, str(tmp_path), 2, servers=texts(SERVER.replace(TIME, "yesterday")))
    assert [r.date for r in store.read_table(spark, str(tmp_path), "servers").select(F.col("date").cast("string").alias("date")).collect()] == [dated_store.UNDATED]
