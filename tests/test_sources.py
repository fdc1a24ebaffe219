"""Readers and writers on files in temporary folders."""

import bz2
import datetime
import gzip
import io
import tarfile

from pyspark.sql import functions as F

from lanternstats.operators import documents
from lanternstats.sources import archive, logs, sinks, tables

SIGNED = "router-signature\n-----BEGIN SIGNATURE-----\nx\n-----END SIGNATURE-----\n"


def put(folder, name, data):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode("latin-1"))


def test_archive(spark, tmp_path):
    put(tmp_path, "a/one", "router a\xe9\n")
    put(tmp_path, "b/c/two.bz2", bz2.compress(b"extra-info b c\n"))
    put(tmp_path, "b/three.tar.bz2", b"junk")
    found = archive.scan_archive(spark, str(tmp_path))
    assert {r.name: bytes(r.content) for r in found.collect()} == {
        "one": b"router a\xe9\n", "two.bz2": b"extra-info b c\n",
    }
    history = spark.createDataFrame([("one",)], "name string")
    rest = archive.scan_archive(spark, str(tmp_path), history)
    assert [r.name for r in rest.collect()] == ["two.bz2"]
    again = history.union(archive.imported_names(rest))
    assert archive.scan_archive(spark, str(tmp_path), again).count() == 0


def test_first_file_of_a_name(spark, tmp_path):
    """Two files of one base name in the same run: only the first is parsed; odd names are found."""
    put(tmp_path, "a/same", "router a\n")
    put(tmp_path, "b/same", "router b\n")
    put(tmp_path, "c/odd [1] {x}*", "router c\n")
    found = archive.scan_archive(spark, str(tmp_path))
    assert sorted(bytes(r.content) for r in found.collect()) == [b"router a\n", b"router c\n"]


def test_cached_files(spark, tmp_path):
    put(tmp_path, "cached-consensus", "network-status-version 3\nvalid-after 2010-02-01 00:00:00\n")
    put(tmp_path, "cached-descriptors.new", "@x\nrouter a\n" + SIGNED + "router b\n" + SIGNED + "router c\n")
    put(tmp_path, "cached-extrainfo", "extra-info a b\n" + SIGNED)
    put(tmp_path, "other", "router z\n" + SIGNED)
    rows = archive.scan_cached(spark, str(tmp_path))
    kinds = documents.classify_relay_documents(rows).groupBy("doc_type").count().collect()
    assert {r.doc_type: r["count"] for r in kinds} == {"status": 1, "server": 2, "extra": 1}


def test_bridge_snapshots(spark, tmp_path):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as tar:
        for name, text in [
            ("statuses", "@type x\nr a\ns Running\n"),
            ("descriptors", "@purpose bridge\nrouter a\n" + SIGNED + "router b\n" + SIGNED),
            ("extras", "extra-info a b\n" + SIGNED),
            ("empty", ""),
        ]:
            info = tarfile.TarInfo("from/" + name)
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text.encode()))
    put(tmp_path, "from-abcde-2010-02-01T013000Z.tar.gz", gzip.compress(buffer.getvalue()))
    rows = archive.scan_bridge_snapshots(spark, str(tmp_path)).collect()
    assert len(rows) == 4
    assert {r.snapshot for r in rows} == {datetime.datetime(2010, 2, 1, 1, 30)}
    assert sorted(bytes(r.content)[:8] for r in rows) == [b"@type x\n", b"extra-in", b"router a", b"router b"]
    history = spark.createDataFrame([("from-abcde-2010-02-01T013000Z.tar.gz",)], "name string")
    assert archive.scan_bridge_snapshots(spark, str(tmp_path), history).count() == 0


def test_sanitized_bridges(spark, tmp_path):
    put(tmp_path, "20100201-013000-ABC", "r a\n")
    put(tmp_path, "odd", "router a\n")
    rows = {r.name: r.snapshot for r in archive.scan_sanitized_bridges(spark, str(tmp_path)).collect()}
    assert rows == {"20100201-013000-ABC": datetime.datetime(2010, 2, 1, 1, 30), "odd": None}


def timing(start, end, size, start_us=0, end_us=0):
    fields = ["0"] * 20
    fields[0], fields[1], fields[16], fields[17], fields[19] = map(str, (start, start_us, end, end_us, size))
    return " ".join(fields) + "\n"


def test_timings(spark, tmp_path):
    text = (
        timing(1264982400, 1264982405, 60000, 3000, 9000)
        + timing(1264982400, 1264982499, 60000)  # same second: the first line counts
        + timing(1264982401, 0, 60000)
        + timing(1264982402, 1264982405, 51200)
        + timing(12649824, 1264982405, 60000)
        + "1 2 3\n"
    )
    put(tmp_path, "deep/siv.x-50kb.data", text)
    put(tmp_path, "moria.x-1mb.data", timing(1264982400, 1264982410, 1048577))
    rows = {(r.source, r.completemillis) for r in logs.scan_timings(spark, str(tmp_path)).collect()}
    assert rows == {("siv", 5012), ("moria", 10000)}


def test_packages(spark, tmp_path):
    put(tmp_path, "log", "2010-02-01 - Bundle:12 other:3\n2010-02-02 - none:0\n2010-02-01 - bundle:5 bundle:6\n")
    rows = {(str(r.date), r.bundle, r.downloads) for r in logs.scan_packages(spark, str(tmp_path)).collect()}
    assert rows == {("2010-02-01", "bundle", 6), ("2010-02-02", "none", 0)}


def test_ip_ranges(spark, tmp_path):
    text = 'Copyright x\n"beginIp","endIp"\n"1.0.0.0","1.0.0.255","16777216","16777471","AU","Australia"\n'
    put(tmp_path, "GeoIP-108_20100101.csv", text)
    put(tmp_path, "GeoIP-108_20100201.csv", text)
    put(tmp_path, "other.csv", text)
    known = spark.createDataFrame([("20100101",)], "version string")
    rows = logs.scan_ip_ranges(spark, str(tmp_path), known).collect()
    assert [tuple(r) for r in rows] == [("20100201", 16777216, 16777471, "AU")]


def test_fixed_csv(spark, tmp_path):
    put(tmp_path, "counts.csv", "date,exit,fast,guard,running,stable,brunning\n2010-02-01,1,2,3,4,5,NA\n2010-02-02,NA,NA,NA,NA,NA,7\n2010-02-03,1\n")
    relays, bridges = tables.read_daily_counts(spark, str(tmp_path / "counts.csv"))
    assert [tuple(r)[1:] for r in relays.collect()] == [(1, 2, 3, 4, 5)]
    assert [r.brunning for r in bridges.collect()] == [7]
    put(tmp_path, "raw.csv", "datetime,brunning\n2010-02-01 00:30:00,5\n")
    row = tables.read_fixed_csv(spark, str(tmp_path / "raw.csv"), tables.BRIDGE_COUNTS).first()
    assert tuple(row) == (datetime.datetime(2010, 2, 1, 0, 30), 5)
    put(tmp_path, "timings.csv", "source,date,start,completemillis\na,2010-02-01,00:00:05,-5\n")
    row = tables.read_raw_timings(spark, str(tmp_path / "timings.csv")).first()
    assert tuple(row) == ("a", datetime.datetime(2010, 2, 1, 0, 0, 5), 99_999_995)


def test_wide_csv_round_trip(spark, tmp_path):
    rows = [("d1", "2010-02-01 00:00:00", 86400, "de", 5), ("d1", "2010-02-01 00:00:00", 86400, "zy", 9), ("d2", "2010-02-01 00:00:00", 86400, "us", 2)]
    frame = spark.createDataFrame(rows, "directory string, statsend string, seconds int, country string, requests int")
    path = str(tmp_path / "wide")
    sinks.write_wide_csv(frame, path, ["directory", "statsend", "seconds"], "country", "requests")
    header = spark.read.text(path).where("value LIKE 'directory%'").first().value
    assert header == "directory,statsend,seconds,de,us,all"
    assert spark.read.text(path).where("value LIKE 'd2%'").first().value == "d2,2010-02-01 00:00:00,86400,NA,2,NA"
    back = tables.read_wide_csv(spark, path, ["directory", "statsend", "seconds"], "requests")
    assert {(r.directory, r.country, r.requests) for r in back.collect()} == {("d1", "de", "5"), ("d1", "zy", "9"), ("d2", "us", "2")}


def test_bulk_export(spark, tmp_path):
    frame = spark.sql(
        "SELECT true AS a, CAST(NULL AS STRING) AS b, X'00ff' AS c, TIMESTAMP_NTZ'2010-02-01 00:00:00' AS d,"
        " concat('x', chr(9), 'y', chr(10), chr(92)) AS e"
    )
    path = str(tmp_path / "out")
    sinks.write_bulk_export(frame, path)
    rows = [r.value for r in spark.read.text(path).collect()]
    assert rows == ["t\t\\N\t\\\\x00ff\t2010-02-01 00:00:00\tx\\ty\\n\\\\"]


def test_archive_sink_stores_once(spark, tmp_path):
    docs = spark.createDataFrame(
        [("d1", datetime.datetime(2010, 2, 1), bytearray(b"x")), ("d1", datetime.datetime(2010, 2, 1), bytearray(b"x"))],
        "digest string, published timestamp_ntz, content binary",
    )
    path = str(tmp_path / "store")
    rows = sinks.archive_rows(docs, "server", "digest", "published")
    sinks.store_documents(rows, None, path)
    sinks.store_documents(rows, spark.read.parquet(path), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 1
    assert stored.where("type = 'server' AND year = 2010 AND month = 2").count() == 1


def test_doubles_round_half_up_at_the_sink(spark):
    row = sinks.as_text(spark.sql("SELECT CAST(0.125 AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b")).first()
    assert tuple(row) == ("0.13", "NA")


def test_read_table_with_schema(spark, tmp_path):
    path = str(tmp_path / "updates")
    spark.sql("SELECT DATE'2010-02-01' AS date").write.parquet(path)
    assert tables.read_table(spark, path, "updates").first().date == datetime.date(2010, 2, 1)
    assert tables.read_table(spark, path).where(F.col("date").isNotNull()).count() == 1
