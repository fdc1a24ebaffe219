"""Incremental work gives the same tables as work on everything."""

import bz2
import datetime
import re

import pytest
from pyspark.sql import functions as F

from lanternstats.fixtures import view
from lanternstats.plans import daily, keyed_tables, warehouse
from lanternstats.streaming import file_stream

FOLDER = "/root/testdata/sf0.001"


def rows(frame, columns=None):
    frame = frame.select(*(columns or sorted(frame.columns)))
    return sorted(map(str, frame.collect()))


@pytest.fixture(scope="module")
def facts(spark):
    frames = {n: view(spark, FOLDER, n).cache() for n in ("v_status", "v_descriptor", "v_bwhist", "v_dirreq")}
    yield frames
    for f in frames.values():
        f.unpersist()


def test_refresh_in_slices_equals_refresh_of_all(spark, facts, tmp_path):
    status, desc, hist, dirreq = facts.values()
    dates = daily.relay_statuses_per_day(status).select("date")
    whole = warehouse.aggregates(status, desc, hist, dirreq)
    whole["relay_statuses_per_day"] = daily.relay_statuses_per_day(status)
    root = str(tmp_path)
    for batch, half in enumerate(["dayofmonth(date) < 9", "dayofmonth(date) >= 9"]):
        updates = dates.where(half)
        warehouse.refresh(spark, root, batch, status, desc, hist, dirreq, updates)
    for name, frame in whole.items():
        assert rows(warehouse.read_aggregate(spark, root, name)) == rows(frame), name


def test_uncommitted_batch_is_not_read(spark, facts, tmp_path):
    root = str(tmp_path)
    sizes = daily.network_size(facts["v_status"])
    warehouse.write_table(spark, root, 0, "network_size", sizes)
    warehouse.commit(spark, root, 0, sizes)
    warehouse.write_table(spark, root, 1, "network_size", sizes.limit(1))
    assert warehouse.read_aggregate(spark, root, "network_size").count() == sizes.count()
    warehouse.commit(spark, root, 1, sizes.limit(2))
    assert warehouse.read_aggregate(spark, root, "network_size").count() == sizes.count() - 1


def test_facts_physically_partitioned_by_date(spark, facts, tmp_path):
    """Dirty dates prune partitions of a stored fact table."""
    path = str(tmp_path / "status")
    keyed_tables.with_date(facts["v_status"], "validafter").write.partitionBy("date").parquet(path)
    stored = spark.read.parquet(path)
    updates = spark.createDataFrame([(datetime.date(2024, 1, 5),)], "date date")
    result = daily.network_size(stored, updates=updates)
    assert rows(result) == rows(daily.network_size(facts["v_status"]).where("date = DATE'2024-01-05'"))
    plan = result._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()


def test_insert_twice_equals_once(spark, facts):
    key = ["validafter", "fingerprint"]
    status = facts["v_status"]
    once = keyed_tables.insert_if_absent(status, None, key)
    assert rows(once) == rows(status)
    assert keyed_tables.insert_if_absent(status, once, key).count() == 0


def test_only_dates_of_the_batch_are_looked_up(spark, tmp_path):
    """The stored side of a load is pruned to the batch's dates, and documents known are not loaded again."""
    root = str(tmp_path)

    def files(*days):
        texts = [HEAD.format(time=f"2010-02-0{d} 00:00:00") + ENTRY.format(n="a") + ENTRY.format(n="b") for d in days]
        return spark.createDataFrame([(f"p{d}", bytearray(t.encode())) for d, t in zip(days, texts)], "path string, content binary")

    load = lambda batch, *days: warehouse.load_facts(
        spark, root, batch, warehouse.relay_facts(warehouse.stage_documents(spark, root, files(*days)))
    )
    load(0, 1, 2, 3)
    load(1, 2, 4)
    assert warehouse.fact_table(spark, root, "statusentry").count() == 8
    docs = warehouse.stage_documents(spark, root, files(2))
    new = warehouse.relay_facts(docs)["statusentry"]
    stored = warehouse.fact_table(spark, root, "statusentry").where(F.col("date").isin([datetime.date(2010, 2, 2)]))
    plan = keyed_tables.insert_if_absent(new, stored, ["validafter", "fingerprint"], order=["path"])._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan)


def test_first_arrival_wins(spark):
    new = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y")], "k string, n int, v string")
    assert keyed_tables.insert_if_absent(new, None, ["k"], order=["n"]).first().v == "y"


def test_whole_document_is_skipped(spark):
    stored = spark.createDataFrame([("d", 1)], "extrainfo string, intervalend int")
    new = spark.createDataFrame([("d", 2), ("e", 1)], "extrainfo string, intervalend int")
    kept = keyed_tables.insert_if_absent(new, stored, ["extrainfo", "intervalend"], absent_key=["extrainfo"])
    assert rows(kept) == ["Row(extrainfo='e', intervalend=1)"]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", None), ("d", 4)], "k string, v int")
    merged = keyed_tables.upsert(new, old, ["k"], ["v"])
    assert {(r.k, r.v, r.action) for r in merged.collect()} == {
        ("a", 1, "kept"), ("b", 3, "update"), ("c", None, "unchanged"), ("d", 4, "insert"),
    }
    again = keyed_tables.upsert(new, merged.drop("action"), ["k"], ["v"])
    assert {r.action for r in again.collect()} == {"kept", "unchanged"}
    assert rows(again.drop("action")) == rows(merged.drop("action"))


def test_round_half_away_and_empty_days(spark):
    status = spark.sql(
        "SELECT TIMESTAMP_NTZ'2010-02-01 00:00:00' + make_interval(0,0,0,d,h) AS validafter, 'f' || h AS fingerprint,"
        " 'd' || d AS descriptor, true AS isrunning, false AS isexit, false AS isguard, false AS isfast, false AS isstable"
        " FROM VALUES (0, 0), (0, 1), (1, 0) AS t(d, h)"
    )
    desc = spark.sql("SELECT 'd0' AS descriptor, 'x' AS platform, 5L AS bandwidthavg, 3L AS bandwidthburst, 4L AS bandwidthobserved")
    half = spark.sql("SELECT DATE'2010-02-01' AS date, 4L AS count UNION ALL SELECT DATE'2010-02-02', 1L")
    got = {str(r.date): tuple(r)[1:] for r in daily.total_bandwidth(status, desc, half).collect()}
    assert got == {"2010-02-01": (3, 2, 2, 2), "2010-02-02": (None, None, None, None)}
    platforms = {str(r.date): r.avg_other for r in daily.relay_platforms(status, desc, half).collect()}
    assert platforms == {"2010-02-01": 0, "2010-02-02": 0}


@pytest.mark.parametrize(
    "end, seconds, expected",
    [
        ("2010-02-02 06:00:00", 86400, {"2010-02-02": 25, "2010-02-01": 75}),
        ("2010-02-02 00:00:00", 86400, {"2010-02-02": 0, "2010-02-01": 100}),
        ("2010-02-02 23:00:00", 3600, {"2010-02-02": 100}),
        ("2010-02-02 08:00:00", 86400, {"2010-02-02": 33, "2010-02-01": 66}),
    ],
)
def test_requests_are_split_at_midnight(spark, end, seconds, expected):
    frame = spark.sql(f"SELECT 'A' AS source, TIMESTAMP_NTZ'{end}' AS statsend, {seconds} AS seconds, 'de' AS country, 100L AS requests")
    assert {str(r.date): r.requests for r in daily.dirreq_split(frame).collect()} == expected


def test_equal_parts_merge(spark):
    frame = spark.sql(
        "SELECT 'A' AS source, TIMESTAMP_NTZ'2010-02-02 12:00:00' + make_interval(0,0,0,0,h) AS statsend, 3600 AS seconds, 'de' AS country, n AS requests"
        " FROM VALUES (0, 7L), (1, 7L), (2, 8L) AS t(h, n)"
    )
    assert daily.dirreq_split(frame).first().requests == 15


HEAD = "network-status-version 3\nvalid-after {time}\n"
ENTRY = "r n{n} {n}AAAAAAAAAAAAAAAAAAAAAAAAAA BBBBBBBBBBBBBBBBBBBBBBBBBBB 2010-02-01 00:00:00 1.1.1.1 9 0\ns Exit Running\n"
EXTRA = (
    "extra-info n AABB\npublished 2010-02-02 00:00:00\nwrite-history 2010-02-01 12:00:00 (900 s) 1,2\n"
    "read-history 2010-02-01 12:00:00 (900 s) 3\ndirreq-stats-end 2010-02-01 06:00:00 (86400 s)\n"
    "dirreq-v3-reqs de=12\nrouter-signature\n"
)


def test_stream_of_files(spark, tmp_path):
    """New files update facts and daily tables; files seen before are not read again."""
    inbox, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    (tmp_path / "in").mkdir()

    def consensus(time, *names):
        text = HEAD.format(time=time) + "".join(ENTRY.format(n=n) for n in names)
        (tmp_path / "in" / time.replace(" ", "-").replace(":", "")).write_text(text)

    def sizes():
        return {str(r.date): r.avg_running for r in warehouse.read_aggregate(spark, root, "network_size").collect()}

    consensus("2010-02-01 00:00:00", "a", "b")
    (tmp_path / "in" / "extra").write_text(EXTRA)
    file_stream.start(spark, inbox, root, checkpoint).awaitTermination()
    assert sizes() == {"2010-02-01": 2}
    row = warehouse.read_aggregate(spark, root, "total_bwhist").first()
    assert (row.read, row.written, row.dirread) == (3, 3, None)
    assert warehouse.fact_table(spark, root, "dirreq_stats").count() == 2
    consensus("2010-02-01 01:00:00", "a", "b", "c", "d")
    consensus("2010-02-02 00:00:00", "a")
    packed = HEAD.format(time="2010-02-03 00:00:00") + "".join(ENTRY.format(n=n) for n in "abcde")
    (tmp_path / "in" / "packed.bz2").write_bytes(bz2.compress(packed.encode()))
    file_stream.start(spark, inbox, root, checkpoint).awaitTermination()
    assert sizes() == {"2010-02-01": 3, "2010-02-02": 1, "2010-02-03": 5}
    assert warehouse.fact_table(spark, root, "statusentry").count() == 12


def test_stream_knows_base_names(spark, tmp_path):
    """Files of known names in another folder add nothing, also after a restart; of one batch the first path counts."""
    inbox, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def put(folder, name, time, *nodes):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / folder / name).write_text(HEAD.format(time=time) + "".join(ENTRY.format(n=n) for n in nodes))

    def listed():
        return {(str(r.validafter), r.nickname) for r in warehouse.fact_table(spark, root, "statusentry").collect()}

    put("a", "one", "2010-02-01 00:00:00", "a")
    put("b", "one", "2010-02-01 00:00:00", "x")
    file_stream.start(spark, inbox, root, checkpoint).awaitTermination()
    assert listed() == {("2010-02-01 00:00:00", "na")}
    put("c", "one", "2010-02-01 00:00:00", "b", "c")
    put("c", "two", "2010-02-01 01:00:00", "d")
    file_stream.start(spark, inbox, root, checkpoint).awaitTermination()
    assert listed() == {("2010-02-01 00:00:00", "na"), ("2010-02-01 01:00:00", "nd")}
    # A batch that is run again has its own names still before it.
    files = spark.createDataFrame([("in/c/two", "two"), ("in/c/one", "one")], "path string, name string")
    assert [r.name for r in file_stream.new_names(spark, root, 1, files).collect()] == ["two"]
    assert file_stream.new_names(spark, root, 2, files).count() == 0


def test_removal_of_superseded_batches(spark, tmp_path):
    root = str(tmp_path)

    def write(batch, users):
        rows = spark.sql(f"SELECT DATE'2010-02-01' AS date, {users} AS avg_running")
        for name, time in warehouse.AGGREGATES.items():
            warehouse.write_table(spark, root, batch, name, rows.withColumnRenamed("date", time))
        warehouse.commit(spark, root, batch, rows)

    read = lambda: [r.avg_running for r in warehouse.read_aggregate(spark, root, "network_size").collect()]
    write(1, 5)
    write(2, 6)
    assert warehouse.remove_superseded(spark, root) == []
    warehouse.drop_superseded(spark, root, 3)
    assert warehouse.remove_superseded(spark, root) == [] and read() == [6]
    # A reader from between the gatherings reads on during and after the removal.
    reader = warehouse.read_aggregate(spark, root, "network_size")
    write(4, 7)
    warehouse.drop_superseded(spark, root, 5)
    removed = warehouse.remove_superseded(spark, root)
    assert {r.partition("=")[2] for r in removed} == {"1", "2"} and len(removed) == 2 * len(warehouse.AGGREGATES)
    assert [r.avg_running for r in reader.collect()] == [6] and read() == [7]
    assert warehouse.remove_superseded(spark, root) == []


def test_failed_batch_keeps_its_dirty_dates(spark, tmp_path):
    """A batch that stops after the facts are appended still refreshes their dates later."""
    root = str(tmp_path)
    files = spark.createDataFrame(
        [("p", bytearray((HEAD.format(time="2010-02-01 00:00:00") + ENTRY.format(n="a")).encode()))], "path string, content binary"
    )
    load = lambda: warehouse.load_facts(
        spark, root, 0, warehouse.relay_facts(warehouse.stage_documents(spark, root, files))
    )
    load()
    load()
    assert [str(r.date) for r in warehouse.pending_updates(spark, root).collect()] == ["2010-02-01"]
    assert warehouse.fact_table(spark, root, "statusentry").count() == 1


def test_upsert_table_rewrites_only_its_dates(spark, tmp_path):
    root, key = str(tmp_path), ["date", "country"]
    make = lambda *rows: spark.createDataFrame([(datetime.date(2010, 2, d), c, u) for d, c, u in rows], "date date, country string, users bigint")
    first = warehouse.upsert_table(spark, root, "bridge_stats", make((1, "de", 5), (2, "de", 6)), key, "date")
    assert {r.action: r.n for r in first.collect()} == {"insert": 2}
    before = {p for p in (tmp_path / "tables" / "bridge_stats" / "date=2010-02-01").iterdir()}
    second = warehouse.upsert_table(spark, root, "bridge_stats", make((2, "de", 7), (2, "us", 1)), key, "date")
    assert {r.action: r.n for r in second.collect()} == {"update": 1, "insert": 1}
    assert {p for p in (tmp_path / "tables" / "bridge_stats" / "date=2010-02-01").iterdir()} == before
    stored = warehouse.keyed_table(spark, root, "bridge_stats")
    assert {(r.date.day, r.country, r.users) for r in stored.collect()} == {(1, "de", 5), (2, "de", 7), (2, "us", 1)}


def test_bridge_statistics(spark):
    """Statuses give daily averages, extra-infos give users; relays and broken versions are left out."""
    from pyspark.sql import functions as F

    from lanternstats.operators import bridges

    def extra(identity, time):
        return (
            f"extra-info n {identity}\npublished 2010-02-01 {time}\ngeoip-start-time 2010-01-31 {time}\n"
            "geoip-client-origins de=12,us=4\n"
        )

    good, relay, broken = "AA" * 20, "BB" * 20, "CC" * 20
    texts = [extra(good, "10:00:00"), extra(good, "12:00:00").replace("de=12", "de=20"), extra(relay, "10:00:00"), extra(broken, "10:00:00")]
    texts.append(f"router n 1 2 3 4\nplatform {bridges.BROKEN_PLATFORM}.1\npublished 2010-02-01 10:00:00\nopt fingerprint {broken}\n")
    rows = [("server" if t.startswith("router") else "extra", t, None) for t in texts]
    rows += [("status", "r a\ns Running\n" * (1 + i % 2), datetime.datetime(2010, 2, 1, i)) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_type string, text string, snapshot timestamp_ntz")
    known = spark.sql(f"SELECT upper(sha1(unhex('{relay}'))) AS hashed_relay")
    tables = warehouse.bridge_statistics(docs, known)
    assert [tuple(r) for r in tables["bridge_network_size"].collect()] == [(datetime.date(2010, 2, 1), 1)]
    assert {(r.country, r.users) for r in tables["bridge_stats"].collect()} == {("de", 16), ("zy", 16)}


def test_completeness_and_missing_references(spark):
    from lanternstats.operators import completeness

    headers = spark.sql(
        "SELECT TIMESTAMP_NTZ'2010-02-01 00:00:00' + make_interval(0,0,0,0,h) AS validafter, true AS is_consensus,"
        " 'X' AS dirsource, array('A', 'B') AS vote_sources, CAST(NULL AS STRING) AS digest,"
        " array(named_struct('dirsource', 'A', 'digest', 'D1'), named_struct('dirsource', 'B', 'digest', 'D2')) AS vote_references FROM range(5) AS t(h)"
        " UNION ALL SELECT TIMESTAMP_NTZ'2010-02-01 04:00:00', false, 'A', array(), 'D1', array()"
        # A vote of a named authority and time, but not the one that is named.
        " UNION ALL SELECT TIMESTAMP_NTZ'2010-02-01 03:00:00', false, 'A', array(), 'D9', array()"
    )
    entries = headers.selectExpr("validafter", "is_consensus", "dirsource", "digest", "explode(array('d1', 'd2', 'd3')) AS descriptor")
    servers = spark.sql("SELECT * FROM VALUES ('d1', 'x1'), ('d2', 'x2'), ('d9', NULL) AS t(descriptor, extrainfo)")
    extras = spark.sql("SELECT 'x1' AS extrainfo")
    report = completeness.archive_report(headers, entries, servers, extras).collect()
    assert len(report) == 4
    for r in report:
        assert (r.found_servers, r.all_servers, r.servers_pct) == (2, 3, 66.7)
        assert (r.found_extras, r.all_extras, r.extras_pct) == (1, 2, 50.0)
    assert {(r.kind, r.validafter.hour, r.found_votes, r.all_votes) for r in report} == {
        ("C", 4, 1, 2), ("C", 3, 0, 2), ("C", 2, 0, 2), ("V", 4, None, None),
    }

    time = "TIMESTAMP_NTZ'2010-02-01 00:00:00'"
    seen = completeness.references_seen(
        headers.where("is_consensus"),
        spark.sql(f"SELECT {time} AS published, 'AB' AS relay, 'd1' AS descriptor UNION ALL SELECT {time}, 'AB', 'd2'"),
        spark.sql(f"SELECT {time} AS published, 'ab' AS fingerprint, 'd1' AS descriptor, 'x1' AS extrainfo"),
    )
    have = completeness.documents_at_hand(
        headers.where("is_consensus"),
        headers.where("NOT is_consensus"),
        spark.sql(f"SELECT {time} AS published, 'ab' AS fingerprint, 'd1' AS descriptor"),
        spark.sql(f"SELECT {time} AS published, 'ab' AS fingerprint, 'x9' AS extrainfo"),
    )
    missing = lambda now: {
        (r.type, r.relay, r.digest)
        for r in completeness.missing_references(seen, have, now, "2010-02-01 04:00:00").collect()
    }
    assert missing("2010-02-02 00:00:00") == {("vote", "B", None), ("server", "ab", "d2"), ("extra", "ab", "x1")}
    assert missing("2010-02-02 00:00:01") == {("vote", "B", None)}


def test_missing_references_are_carried_over(spark, tmp_path):
    """The current consensus is wanted until it is seen; descriptors stay wanted for a day."""
    schema = "type string, published timestamp_ntz, relay string, digest string"
    at = lambda h, d=1: datetime.datetime(2010, 2, d, h)
    make = lambda *rows: spark.createDataFrame(list(rows), schema)

    def run(batch, seen, have, now):
        rows = warehouse.update_missing(spark, str(tmp_path), batch, make(*seen), make(*have), now, now).collect()
        return {(r.type, r.published.hour, r.digest) for r in rows}

    server, consensus = ("server", at(1), "r", "d1"), lambda h: ("consensus", at(h), None, None)
    assert run(0, [server], [], at(2)) == {("server", 1, "d1"), ("consensus", 2, None)}
    assert run(1, [], [consensus(3)], at(3)) == {("server", 1, "d1")}
    assert run(1, [], [consensus(3)], at(3)) == {("server", 1, "d1")}
    assert run(2, [], [server], at(4)) == {("consensus", 4, None)}
    assert run(3, [server], [], at(2, 2)) == {("consensus", 2, None)}
