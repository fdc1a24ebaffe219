"""Network-status documents written out by hand."""

import base64
import datetime
import hashlib

from lanternstats.operators import documents, health, statuses
from lanternstats.plans import health_report

ID = base64.b64encode(bytes(range(20))).decode().rstrip("=")
DIGEST = base64.b64encode(bytes(range(20, 40))).decode().rstrip("=")


def entry(name, flags="Running Valid", version="0.2.1", extra=""):
    return (
        f"r {name} {ID} {DIGEST} 2010-02-01 00:10:00 10.0.0.1 9001 9030\ns {flags}\nv {version}\n"
        f"w Bandwidth=12\np accept 80\n{extra}"
    )


HEAD = "network-status-version 3\nvalid-after 2010-02-01 01:00:00\n"


def test_entries(docs):
    text = HEAD + entry("one") + entry("two", "Exit Guard") + "directory-signature x\n"
    rows = statuses.status_entries(docs(text), keep=["doc"]).orderBy("nickname").collect()
    assert [r.nickname for r in rows] == ["one", "two"]
    one, two = rows
    assert one.fingerprint == bytes(range(20)).hex()
    assert one.descriptor == bytes(range(20, 40)).hex()
    assert one.published == datetime.datetime(2010, 2, 1, 0, 10)
    assert (one.orport, one.dirport, one.bandwidth, one.ports, one.version) == (9001, 9030, 12, "accept 80", "0.2.1")
    assert one.isrunning and not one.isexit
    assert two.isexit and two.isguard and not two.isrunning
    assert bytes(one.rawdesc).decode() == entry("one")


def test_last_line_of_a_kind_counts(docs):
    text = HEAD + entry("one", extra="s Exit\nw Bandwidth=1 Bandwidth=77\nv 9\n")
    row = statuses.status_entries(docs(text)).first()
    assert row.isexit and not row.isrunning
    assert (row.bandwidth, row.version) == (77, "9")


def test_flags_are_whole_words(docs):
    row = statuses.status_entries(docs(HEAD + entry("one", "BadExit"))).first()
    assert row.isbadexit and not row.isexit


def test_broken_entry_ends_the_document(docs):
    broken = "r short line\ns Running\n"
    text = HEAD + entry("one") + broken + entry("three")
    assert [r.nickname for r in statuses.status_entries(docs(text)).collect()] == ["one"]
    bad_time = entry("two").replace("00:10:00", "later")
    assert [r.nickname for r in statuses.status_entries(docs(HEAD + entry("one") + bad_time)).collect()] == ["one"]


def test_entry_without_flag_line(docs):
    text = HEAD + f"r a {ID} {DIGEST} 2010-02-01 00:10:00 10.0.0.1 9001 0\n"
    row = statuses.status_entries(docs(text)).first()
    assert not row.isrunning and row.version is None and row.bandwidth is None
    empty = statuses.status_entries(docs(text + "s\n")).first()
    assert not empty.isrunning and bytes(empty.rawdesc).decode().endswith("\ns\n")


def test_votes_give_no_entries(docs):
    vote = HEAD.replace("3\n", "3\nvote-status vote\n") + entry("one")
    assert statuses.status_entries(docs(vote)).count() == 0
    assert statuses.vote_entries(docs(vote)).count() == 1


def test_windows_line_ends(docs):
    text = (HEAD + entry("one") + entry("two")).replace("\n", "\r\n")
    assert statuses.status_entries(docs(text)).count() == 2


def test_headers(docs):
    consensus = HEAD + (
        "dir-source a FA 1.1.1.1 80 443\ncontact x\nvote-digest D1\n"
        "dir-source b FB 1.1.1.1 80 443\ncontact y\n"
        "dir-source c FC 1.1.1.1 80 443\nvote-digest D3\n"
    ) + entry("one")
    vote = HEAD.replace("3\n", "3\nvote-status vote\n") + "dir-source a FA 1.1.1.1 80 443\nfingerprint F1 x\n"
    a, b = statuses.status_headers(docs(consensus, vote).drop("content")).orderBy("doc").collect()
    assert a.is_consensus and a.vote_sources == ["FA", "FC"] and a.dirsource == "FC"
    assert a.validafter == datetime.datetime(2010, 2, 1, 1)
    assert not b.is_consensus and (b.dirname, b.dirsource, b.fingerprint) == ("a", "FA", "F1")


def test_flag_counts_use_substrings(docs):
    text = HEAD + entry("one", "BadExit Running") + entry("two", "Exit Running Fast") + entry("x", "Exit")
    row = statuses.flag_counts(docs(text)).first()
    assert (row.exit, row.fast, row.running) == (1, 1, 2)


def test_hashed_relays(docs):
    rows = statuses.hashed_relays(statuses.status_entries(docs(HEAD + entry("a") + entry("b")))).collect()
    assert [r.hashed_relay for r in rows] == [hashlib.sha1(bytes(range(20))).hexdigest().upper()]


def test_classification(docs):
    kinds = documents.classify_relay_documents(
        docs(HEAD, "router a\n", "extra-info a b\n", "", "@type x\nrouter a\n", "network-status-version 2\n")
        .drop("text")
    )
    assert {r.doc: r.doc_type for r in kinds.collect()} == {0: "status", 1: "server", 2: "extra"}
    bridge = documents.classify_bridge_documents(docs("published x\nr a\n", "@purpose bridge\nrouter a\n", "x\n").drop("text"))
    assert {r.doc: r.doc_type for r in bridge.collect()} == {0: "status", 1: "server"}


def test_stale(docs):
    rows = documents.stale_consensus(
        docs(HEAD, HEAD.replace("01:00", "09:00")), "2010-02-01 08:00:00"
    ).orderBy("doc").collect()
    assert [r.is_stale for r in rows] == [True, False]


def test_split_then_join_is_identity(docs, spark):
    one = "router a\nbody\nrouter-signature\n-----BEGIN SIGNATURE-----\nx\n-----END SIGNATURE-----\n"
    two = one.replace("router a", "router b")
    split = documents.split_documents(docs(one + two + one[:30]).drop("text"), "router ").orderBy("doc_no").collect()
    assert "".join(bytes(r.content).decode() for r in split) == one + two
    noise = documents.split_documents(docs("noise\n" + one + "between\n" + two).drop("text"), "router ")
    assert noise.count() == 2


def test_health_of_documents(docs):
    consensus = HEAD + "known-flags Exit Running\nconsensus-method 1\nparams circwindow=1\n" + entry("one", "Authority Running")
    vote = HEAD.replace("3\n", "3\nvote-status vote\n") + (
        "consensus-methods 10 11\nknown-flags Exit Running\nparams circwindow=1 odd=2\nclient-versions 1\n"
        "dir-key-expires 2010-02-10 00:00:00\ndir-source moria1 F 1.1.1.1 80 443\n"
    ) + entry("one", "Exit Running")
    headers = health.health_headers(docs(consensus, vote), keep=["doc"])
    votes, cons = headers.where("NOT is_consensus"), headers.where("is_consensus")
    method = health.method_support(votes, cons).first()
    assert method.supported and not method.supported_exactly
    assert health.parameter_conflicts(votes, cons).first().conflicting
    agreement = health.version_agreement(votes, cons).first()
    assert agreement.client_agrees is False and agreement.server_agrees is None
    assert health.expiring_keys(votes, "2010-02-01 00:00:00").first().expires_soon
    assert not health.expiring_keys(votes, "2010-01-01 00:00:00").first().expires_soon
    listed = statuses.vote_entries(docs(consensus, vote), keep=["doc"])
    assert health.authority_versions(listed.where("doc = 0")).first().version == "0.2.1"
    expected = votes.sparkSession.createDataFrame([(d,) for d in health.EXPECTED_AUTHORITIES], "dir string")
    assert {r.dir for r in health.missing_votes(votes, expected).collect()} == set(health.EXPECTED_AUTHORITIES) - {"moria1"}


def test_parameter_within_another(spark):
    votes = spark.sql("SELECT 1 AS validafter, 'a' AS dir, array('circwindow=1') AS params")
    cons = spark.sql("SELECT 1 AS validafter, array('circwindow=10') AS params")
    row = health.parameter_conflicts(votes, cons).first()
    assert (row.conflicting, row.conflicting_exactly) == (False, True)
    row = health.parameter_conflicts(cons.selectExpr("validafter", "'a' AS dir", "params"), votes).first()
    assert (row.conflicting, row.conflicting_exactly) == (True, True)


def test_references_name_digests(docs):
    named = "dir-source a FP 1.1.1.1 80 443\ncontact x\nvote-digest D1\ndir-source b GP 1.1.1.2 80 443\ndir-source c HP 1.1.1.3 80 443\nvote-digest D3\nvote-digest D4\n"
    row = statuses.status_headers(docs(HEAD + named + entry("one", "Running")).select("doc", "text")).first()
    assert [tuple(r) for r in row.vote_references] == [("FP", "D1"), ("HP", "D3"), ("HP", "D4")]
    assert row.vote_sources == ["FP", "HP"]


def test_report_has_rows_of_the_consensus(docs, tmp_path):
    consensus = HEAD + "known-flags Exit Running\nconsensus-method 1\n" + entry("one", "Running") + entry("two", "Exit")
    vote = HEAD.replace("3\n", "3\nvote-status vote\n") + "known-flags Running\ndir-source moria1 F 1.1.1.1 80 443\n" + entry("one", "Running")
    later = HEAD.replace("01:00", "09:00")
    texts = docs(consensus, vote, later).withColumnRenamed("doc", "doc_id")
    tables = health_report.health_report(texts, "2010-02-01 00:00:00", str(tmp_path), with_votes=True)
    rows = {(r.table, r.key, r.value) for r in health_report.report_rows(tables).collect()}
    of = lambda name: {r[1:] for r in rows if r[0] == name}
    assert {(k, v.split("|")[0]) for k, v in of("known_flags")} == {("moria1", "Running"), ("consensus", "Exit"), ("consensus", "Running")}
    assert of("relay_counts") == {("moria1", "1|1"), ("consensus", "1|2")}
    assert len(of("missing_votes")) == len(health.EXPECTED_AUTHORITIES) - 1
    assert set(tables) == {r[0] for r in rows} | {"expiring_keys", "bandwidth_scanners", "authority_versions"} - {r[0] for r in rows}
    # Without the choice the latest time counts, which has no vote.
    latest = health_report.health_report(texts, "2010-02-01 00:00:00", f"{tmp_path}/latest")
    assert [r.dir for r in latest["known_flags"].collect()] == [] and latest["relay_counts"].count() == 0


def test_no_consensus_parameters_means_conflict(spark):
    votes = spark.sql("SELECT 1 AS validafter, 'a' AS dir, array('circwindow=1') AS params")
    cons = spark.sql("SELECT 1 AS validafter, CAST(NULL AS ARRAY<STRING>) AS params")
    assert health.parameter_conflicts(votes, cons).first().conflicting
    none = votes.selectExpr("validafter", "dir", "CAST(NULL AS ARRAY<STRING>) AS params")
    assert not health.parameter_conflicts(none, cons).first().conflicting


def test_counting_ends_at_a_broken_line(docs):
    entry = "r a AAAAAAAAAAAAAAAAAAAAAAAAAAA BBBBBBBBBBBBBBBBBBBBBBBBBBB 2010-02-01 00:00:00 1.1.1.1 9 0\ns Exit Running\n"
    text = "network-status-version 3\nvalid-after 2010-02-01 00:00:00\n" + entry + "r broken\ns Running\ns Running\n"
    row = statuses.flag_counts(docs(text)).first()
    assert (row.running, row.exit) == (1, 1)


def test_votes_with_any_line_ends(docs):
    text = "network-status-version 3\nvote-status vote\nvalid-after 2010-02-01 00:00:00\n" + (
        "r a AAAAAAAAAAAAAAAAAAAAAAAAAAA BBBBBBBBBBBBBBBBBBBBBBBBBBB 2010-02-01 00:00:00 1.1.1.1 9 0\ns Running\n"
    )
    votes = docs(text, text.replace("\n", "\r\n"), text.replace("\n", "\r"))
    assert statuses.status_entries(votes).count() == 0 and statuses.flag_counts(votes).count() == 0
    assert not any(r.is_consensus for r in statuses.status_headers(votes).collect())


def test_unknown_version_comes_last_in_its_date(spark):
    from lanternstats.plans import daily

    status = spark.sql(
        "SELECT TIMESTAMP_NTZ'2010-02-01 00:00:00' + make_interval(0, 0, 0, d) AS validafter, concat('x', i) AS descriptor"
        " FROM VALUES (0), (1) AS t(d) CROSS JOIN VALUES (1), (2), (3) AS u(i)"
    )
    known = spark.sql("SELECT * FROM VALUES ('x1', 'Rly 0.2.2 on x'), ('x2', 'Rly 0.2.1 on x') AS t(descriptor, platform)")
    got = [(r.date.day, r.version) for r in daily.tutorial_versions(status, known).collect()]
    assert got == [(1, "0.2.1"), (1, "0.2.2"), (1, None), (2, "0.2.1"), (2, "0.2.2"), (2, None)]
