"""Scrubbing fails closed and references stay whole."""

import base64
import hashlib

from pyspark.sql import functions as F

from lanternstats.operators import pseudonymise as ps

IDENTITY = "AB" * 20
HASHED = hashlib.sha1(bytes.fromhex(IDENTITY)).hexdigest()
TIME = "2010-02-01 10:00:00"
SERVER = (
    "@purpose bridge\nrouter alice 1.2.3.4 443 5 80\nplatform x\nopt protocols Link 1\n"
    f"published {TIME}\nopt fingerprint {' '.join(IDENTITY[i:i + 4] for i in range(0, 40, 4))}\n"
    "uptime 1\nbandwidth 1 2 3\nopt extra-info-digest FFFF\nonion-key\n-----BEGIN RSA PUBLIC KEY-----\nsecret\n"
    "-----END RSA PUBLIC KEY-----\nsigning-key\n-----BEGIN RSA PUBLIC KEY-----\nsecret\n-----END RSA PUBLIC KEY-----\n"
    f"family ${IDENTITY} friend\ncontact me\nreject *:*\nopt hidden-service-dir\n"
    "router-signature\n-----BEGIN SIGNATURE-----\nx\n-----END SIGNATURE-----\n"
)
SCRUBBED = (
    "router Unnamed 127.0.0.1 443 5 80\nplatform x\nopt protocols Link 1\n"
    f"published {TIME}\nopt fingerprint {' '.join(HASHED.upper()[i:i + 4] for i in range(0, 40, 4))}\n"
    "uptime 1\nbandwidth 1 2 3\nopt extra-info-digest {digest}\n"
    f"family ${HASHED.upper()} Unnamed\ncontact somebody\nreject *:*\nopt hidden-service-dir\n"
)
EXTRA = (
    f"extra-info alice {IDENTITY}\npublished {TIME}\nwrite-history x\ndirreq-stats-end y\ncell-x\nbridge-ips de=8\n"
    "router-signature\n"
)
SCRUBBED_EXTRA = f"extra-info Unnamed {HASHED.upper()}\npublished {TIME}\nwrite-history x\nbridge-ips de=8\n"
B64 = lambda data: base64.b64encode(data).decode()[:27]
STATUS = f"r alice {B64(bytes.fromhex(IDENTITY))} {B64(bytes(20))} {TIME} 1.2.3.4 443 80\ns Running Valid\n"


def test_server(docs):
    row = ps.scrub_servers(docs(SERVER)).first()
    assert row.scrubbed == SCRUBBED.format(digest="0" * 40)
    assert (row.bridge, row.published) == (HASHED, TIME)


def test_server_fails_closed(docs):
    bad = [
        SERVER.replace("contact me", "unknown line"),
        SERVER.replace("router-signature", "other"),
        SERVER.replace("opt fingerprint", "fingerprint"),
        SERVER.replace(f"published {TIME}\n", ""),
        SERVER.replace(f"${IDENTITY}", "$XYZ"),
        SERVER.replace("-----END RSA PUBLIC KEY-----\n", ""),
        SERVER.replace(f"published {TIME}\n", "").replace("onion-key", f"published {TIME}\nonion-key"),
        SERVER.replace("opt extra-info-digest FFFF\n", "").replace("platform x", "opt extra-info-digest FFFF"),
    ]
    assert ps.scrub_servers(docs(*bad)).count() == 0


def test_extra(docs):
    row = ps.scrub_extras(docs(EXTRA)).first()
    assert row.scrubbed == SCRUBBED_EXTRA
    assert row.extra_digest == hashlib.sha1(SCRUBBED_EXTRA.encode()).hexdigest()
    assert ps.scrub_extras(docs(EXTRA + "", EXTRA.replace("cell-x", "other"), EXTRA.replace(IDENTITY, "XY"))).count() == 1


def test_no_secret_survives(docs):
    out = ps.pseudonymise_batch(docs(STATUS), docs(SERVER), docs(EXTRA), ["doc"])
    for table in ("servers", "extras", "statuses"):
        for row in out[table].select("scrubbed").collect():
            for secret in ("1.2.3.4", IDENTITY, "secret", "alice", B64(bytes.fromhex(IDENTITY))):
                assert secret not in row.scrubbed


def expected_server():
    extra = hashlib.sha1(SCRUBBED_EXTRA.encode()).hexdigest()
    text = SCRUBBED.format(digest=extra.upper())
    return extra, text, hashlib.sha1(text.encode()).hexdigest()


def status_line(digest):
    return f"r Unnamed {B64(bytes.fromhex(HASHED))} {B64(bytes.fromhex(digest))} {TIME} 127.0.0.1 443 80\ns Running Valid\n"


def test_references(docs):
    extra, text, server = expected_server()
    out = ps.pseudonymise_batch(docs(STATUS), docs(SERVER), docs(EXTRA), ["doc"])
    assert out["servers"].first().scrubbed == text
    assert out["statuses"].first().scrubbed == status_line(server)
    assert [tuple(r) for r in out["mapping"].collect()] == [(HASHED, TIME, server, extra)]


def test_unknown_references_are_zeros(docs):
    out = ps.pseudonymise_batch(docs(STATUS), docs(), docs(), ["doc"])
    assert out["statuses"].first().scrubbed == status_line("0" * 40)
    assert tuple(out["mapping"].first()) == (HASHED, TIME, "0" * 40, "0" * 40)


def test_status_with_another_line_is_dropped(docs):
    lines = ps.scrub_statuses(docs(STATUS + "v 1\n", STATUS), keep=["doc"])
    assert {r.doc for r in lines.select("doc").distinct().collect()} == {1}


def test_late_documents_give_the_same_result(docs):
    """Status first, server next, extra-info last; each batch repairs the references before it."""
    extra, text, server = expected_server()
    first = ps.pseudonymise_batch(docs(STATUS), docs(), docs(), ["doc"])
    second = ps.pseudonymise_batch(docs(), docs(SERVER), docs(), ["doc"], first["mapping"])
    third = ps.pseudonymise_batch(docs(), docs(), docs(EXTRA), ["doc"], second["mapping"])
    stored = ps.sanitized_servers(second["servers"].drop("bridge", "published").withColumnRenamed("scrubbed", "text"))
    linked = ps.link_servers(stored, third["extras"], third["mapping"])
    assert linked.first().scrubbed == text
    mapping = ps.reference_mapping(linked, third["extras"], third["mapping"])
    again = ps.sanitized_statuses(first["statuses"].withColumnRenamed("scrubbed", "text"), keep=["doc"])
    assert ps.link_statuses(again, mapping, ["doc"]).first().scrubbed == status_line(server)
    assert tuple(mapping.first()) == (HASHED, TIME, server, extra)


def test_sanitized_status_keeps_what_it_knew(docs, spark):
    text = status_line("cd" * 20)
    lines = ps.sanitized_statuses(docs(text), keep=["doc"])
    empty = spark.createDataFrame([], "bridge string, published string, server_digest string, extra_digest string")
    mapping = ps.mapping_with_read_digests(empty, lines)
    assert ps.link_statuses(lines, mapping, ["doc"]).first().scrubbed == text


def test_sanitized_extra(docs):
    row = ps.sanitized_extras(docs(SCRUBBED_EXTRA)).first()
    assert (row.bridge, row.scrubbed) == (HASHED, SCRUBBED_EXTRA)


def test_only_affected_statuses_are_rewritten(spark):
    import datetime

    extra, _, server = expected_server()
    start = datetime.datetime(2010, 2, 1, 10)
    rows = [(h, start + datetime.timedelta(hours=h), status_line("0" * 40)) for h in (-1, 0, 24, 25)]
    stored = spark.createDataFrame(rows, "doc int, validafter timestamp_ntz, text string")
    changed = spark.createDataFrame([(start,)], "published timestamp_ntz")
    mapping = spark.createDataFrame([(HASHED, TIME, server, extra)], "bridge string, published string, server_digest string, extra_digest string")
    got = {r.doc: r.scrubbed for r in ps.rewrite_statuses(stored, changed, mapping, ["doc"]).collect()}
    assert got == {0: status_line(server), 24: status_line(server)}


def test_long_members_drop_the_document(docs):
    """Fingerprints and family members are hashed whole or not at all."""
    assert ps.scrub_servers(docs(SERVER.replace(f"family ${IDENTITY}", "family $" + "A" * 300))).count() == 0
    assert ps.scrub_servers(docs(SERVER.replace(f"family ${IDENTITY}", "family $AB"))).count() == 0
    many = " ".join([f"${IDENTITY}"] * 40)
    row = ps.scrub_servers(docs(SERVER.replace(f"family ${IDENTITY}", f"family {many}"))).first()
    assert row.scrubbed.count("$" + HASHED.upper()) == 40


def test_written_batch(docs, spark, tmp_path):
    """The job that writes its tables gives what the batch in one plan gives."""
    args = (docs(STATUS), docs(SERVER), docs(EXTRA), ["doc"])
    plain, written = ps.pseudonymise_batch(*args), ps.write_batch(spark, str(tmp_path), 1, *args)
    for name, frame in plain.items():
        assert sorted(map(str, written[name].select(frame.columns).collect())) == sorted(map(str, frame.collect())), name


def test_entries_travel_once_and_as_bytes(docs, spark):
    """A status is one row per ``r`` line until it is put together, and no text is shuffled."""
    lines = ps.scrub_statuses(docs(STATUS * 3, STATUS), keep=["doc"])
    assert sorted((r.doc, r.line_no) for r in lines.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0)]
    _, _, server = expected_server()
    out = ps.pseudonymise_batch(docs(), docs(SERVER), docs(EXTRA), ["doc"])
    linked = ps.link_statuses(lines, ps.server_digests(out["servers"]), ["doc"], near=F.col("doc") % 2)
    assert {r.doc: r.scrubbed for r in linked.collect()} == {0: status_line(server) * 3, 1: status_line(server)}
    plan = linked._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "_bridge" in join and "RepartitionByExpression" in plan


def test_odd_lines_of_scrubbed_statuses_stay(docs, spark):
    """Lines before the first entry, short ones, empty ones and identities in another form."""
    entry = status_line("cd" * 20)
    texts = ["s Valid\n" + entry, "r short\n" + entry + "w x\n\np y\n", "\n", entry, entry.replace("Unnamed ", "Unnamed AAAA"), entry.replace("Unnamed ", "Unnamed !")]
    lines = ps.sanitized_statuses(docs(*texts), keep=["doc"])
    empty = spark.createDataFrame([], "bridge string, published string, server_digest string, extra_digest string")
    got = {r.doc: r.scrubbed for r in ps.link_statuses(lines, ps.mapping_with_read_digests(empty, lines), ["doc"]).collect()}
    nothing = B64(bytes(20))
    assert got == {**dict(enumerate(texts)), 5: texts[5].replace(B64(bytes.fromhex("cd" * 20)), nothing)}


def test_rewriting_and_keeping_are_complements(spark):
    import datetime

    from lanternstats.operators import intervals

    start = datetime.datetime(2010, 2, 1, 10)
    rows = [(h, start + datetime.timedelta(hours=h)) for h in range(-30, 60)] + [(99, None)]
    statuses = spark.createDataFrame(rows, "id int, validafter timestamp_ntz")
    changed = spark.createDataFrame([(start,), (start + datetime.timedelta(hours=30),), (None,)], "published timestamp_ntz")
    hit, kept = ({r.id for r in f(statuses, changed).collect()} for f in (intervals.statuses_to_rewrite, intervals.statuses_to_keep))
    assert hit == {*range(0, 25), *range(30, 55)} and not hit & kept and len(hit) + len(kept) == len(rows)


def test_scrubbed_statuses_are_parsed_once(spark):
    """Rows of the second form are stored: the result is made of them, not of the stored texts."""
    from lanternstats.queries import QUERIES

    found = QUERIES["resanitized_statuses"](spark, "/root/testdata/sf0.001")
    files = found.inputFiles()
    assert any("/again/" in f for f in files) and not any("/statuses/" in f for f in files)
