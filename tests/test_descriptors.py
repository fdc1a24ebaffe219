"""Server, extra-info and bridge descriptors written out by hand."""

import datetime
import hashlib

from lanternstats.operators import bridges, descriptors

SIGNATURE = "router-signature\n-----BEGIN SIGNATURE-----\nx\n-----END SIGNATURE-----\n"
SERVER = (
    "router nick 10.0.0.1 9001 7 9030\nplatform Rly 0.2.1.19 on Linux\npublished 2010-02-01 00:00:00\n"
    "opt fingerprint ABCD EF01\nuptime 12\nbandwidth 1 2 3\nopt extra-info-digest AB12\n"
)
TIME = datetime.datetime


def test_server_descriptor(docs):
    row = descriptors.server_descriptors(docs(SERVER + SIGNATURE)).first()
    assert row.descriptor == hashlib.sha1((SERVER + "router-signature\n").encode()).hexdigest()
    assert (row.nickname, row.address, row.orport, row.dirport) == ("nick", "10.0.0.1", 9001, 9030)
    assert (row.fingerprint, row.extrainfo, row.uptime) == ("abcdef01", "ab12", 12)
    assert (row.bandwidthavg, row.bandwidthburst, row.bandwidthobserved) == (1, 2, 3)
    assert descriptors.server_descriptors(docs(SERVER + SIGNATURE), old_dirport=True).first().dirport == 7


def test_server_descriptor_without_optional_lines(docs):
    text = "router nick 10.0.0.1 9001 0 0\npublished 2010-02-01 00:00:00\nfingerprint AB CD\nextra-info-digest EE\n"
    row = descriptors.server_descriptors(docs(text + SIGNATURE)).first()
    assert (row.fingerprint, row.extrainfo, row.platform, row.uptime) == ("abcd", "ee", None, None)
    assert descriptors.server_descriptors(docs(text)).count() == 0


def test_digest_counts_bytes(docs):
    text = "router n 1.1.1.1 1 1 1\ncontact \xe9\xff\n"
    row = descriptors.server_descriptors(docs("\xe9\xe9" + text + SIGNATURE)).first()
    assert row.descriptor == hashlib.sha1((text + "router-signature\n").encode("latin-1")).hexdigest()


def extra(*lines):
    return "extra-info nick AABB\n" + "".join(line + "\n" for line in lines) + SIGNATURE


def history(docs, *lines):
    values = descriptors.history_values(docs(extra(*lines)))
    return sorted((r.type, r.intervalend, r.value) for r in values.collect())


PUBLISHED = "published 2010-02-02 00:00:00"


def test_history_steps_back_from_the_end(docs):
    assert history(docs, PUBLISHED, "write-history 2010-02-01 12:00:00 (900 s) 1,2,3") == [
        ("write-history", TIME(2010, 2, 1, 11, 30), 1),
        ("write-history", TIME(2010, 2, 1, 11, 45), 2),
        ("write-history", TIME(2010, 2, 1, 12, 0), 3),
    ]


def test_history_limits(docs):
    line = "write-history 2010-01-26 00:00:00 (900 s) 1"
    assert len(history(docs, PUBLISHED, line)) == 1
    assert history(docs, PUBLISHED, line.replace("26 00:00:00", "25 23:59:59")) == []
    assert history(docs, line, PUBLISHED) == []
    assert history(docs, PUBLISHED, "write-history 2010-02-01 12:00:00 (900 s)") == []


def test_bad_number_keeps_what_is_right_of_it_and_ends_the_document(docs):
    lines = [PUBLISHED, "write-history 2010-02-01 12:00:00 (900 s) 1,x,3,4", "read-history 2010-02-01 12:00:00 (900 s) 9"]
    assert [(t, v) for t, _, v in history(docs, *lines)] == [("write-history", 3), ("write-history", 4)]
    bad_length = [PUBLISHED, "write-history 2010-02-01 12:00:00 (x s) 1", "read-history 2010-02-01 12:00:00 (900 s) 9"]
    assert history(docs, *bad_length) == []
    too_old = [PUBLISHED, "write-history 2009-02-01 12:00:00 (900 s) x", "read-history 2010-02-01 12:00:00 (900 s) 9"]
    assert [v for _, _, v in history(docs, *too_old)] == [9]


def test_history_rows_take_the_later_line(docs):
    values = descriptors.history_values(
        docs(
            extra(
                PUBLISHED,
                "write-history 2010-02-01 12:00:00 (900 s) 1,2",
                "write-history 2010-02-01 12:00:00 (900 s) 5",
                "dirreq-read-history 2010-02-01 12:00:00 (900 s) 7",
            )
        )
    )
    rows = {r.intervalend: (r.read, r.written, r.dirread, r.dirwritten) for r in descriptors.history_rows(values).collect()}
    assert rows == {TIME(2010, 2, 1, 11, 45): (None, 1, None, None), TIME(2010, 2, 1, 12): (None, 5, 7, None)}


def requests(docs, *lines):
    return {r.country: r.requests for r in descriptors.directory_requests(docs(extra(*lines))).collect()}


def test_directory_requests(docs):
    end = "dirreq-stats-end 2010-02-01 00:00:00 (86400 s)"
    assert requests(docs, end, "dirreq-v3-reqs de=12,us=20") == {"de": 8, "us": 16, "zy": 24}
    assert requests(docs, end, "dirreq-v3-reqs de=12,de=20") == {"de": 16, "zy": 24}
    assert requests(docs, end, "dirreq-v3-reqs ") == {}
    assert requests(docs, end, "dirreq-v3-reqs de=x", "dirreq-v3-reqs us=8") == {}
    assert requests(docs, "dirreq-stats-end 2010-02-01 00:00:00", end, "dirreq-v3-reqs us=8") == {}


IDENTITY = "AB" * 20
BRIDGE = hashlib.sha1(bytes.fromhex(IDENTITY)).hexdigest().upper()


def users(docs, *lines):
    text = f"extra-info nick {IDENTITY}\n" + "".join(line + "\n" for line in lines)
    rows = bridges.bridge_users(bridges.with_identity(docs(text))).collect()
    assert all(r.bridge == BRIDGE for r in rows)
    return {(r.kind, r.country): r.users for r in rows}


def test_bridge_users(docs):
    start = "geoip-start-time 2010-02-01 12:00:00"
    got = users(docs, PUBLISHED, start, "geoip-client-origins de=12,us=4", "bridge-stats-end 2010-02-01 00:00:00 (86400 s)", "bridge-ips fr=8")
    assert got == {
        ("geoip", "de"): 16.0, ("geoip", "us"): 0.0, ("geoip", "zy"): 16.0, ("ips", "fr"): 4.0, ("ips", "zy"): 4.0,
    }
    assert users(docs, start, "geoip-client-origins de=12", "bridge-stats-end 2010-02-01 00:00:00 (1 s)", "bridge-ips fr=8") == {}
    assert users(docs, PUBLISHED, start, "geoip-client-origins", "bridge-ips") == {}
    assert users(docs, PUBLISHED, "geoip-start-time 2010-02-02 00:00:00", "geoip-client-origins de=8") == {}


def test_known_relays_are_left_out(docs, spark):
    text = f"extra-info nick {IDENTITY}\n"
    known = spark.createDataFrame([(BRIDGE,)], "hashed_relay string")
    found = bridges.with_identity(docs(text, text.replace("AB", "CD")))
    assert bridges.without_known_relays(found, known).count() == 1


def test_sanitized_identity_is_kept(docs):
    assert bridges.with_identity(docs("extra-info Unnamed abcd\n"), sanitized=True).first().bridge == "ABCD"


def test_running_bridges(docs):
    assert bridges.running_bridges(docs("s x Running\nr a\ns x Running\nr b\ns Valid\n")).first().running == 1


def test_broken_versions(docs):
    text = f"router a 1 2 3 4\nplatform {bridges.BROKEN_PLATFORM}.9 on x\npublished 2010-02-01 00:00:00\nopt fingerprint {IDENTITY}\n"
    rows = bridges.broken_versions(bridges.with_identity(docs(text, text.replace("0.2.2", "0.2.1")))).collect()
    assert [(r.bridge, r.seen) for r in rows] == [(BRIDGE, TIME(2010, 2, 1))]
