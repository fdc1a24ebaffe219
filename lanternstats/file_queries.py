"""Registered queries of sources and sinks: each writes files from the given tables and reads them back."""

import bz2
import io
import os
import sys
import tarfile
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanternstats.fixtures import SERVER_TEXT, SIGNATURE_TEXT, oracle_views, tables, view
from lanternstats.operators import ip_ranges
from lanternstats.plans import daily
from lanternstats.sources import archive, logs, sinks
from lanternstats.sources import tables as csv_tables

#: Rows of a table that go into one file.
PER_FILE = 50


def scratch(spark):
    """A new folder for the files of a query: in the shared folder of the cluster, or local in a local session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lanternstats-")
    return f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"


def write_files(rows, folder):
    """Write each row (name, content) as a file; names ending in ``.bz2`` are packed.

    The folder must be mounted by all executors.  A file appears under its
    name when it is whole.
    """
    root = folder.removeprefix("file://") if folder.startswith("file:///") else folder.removeprefix("file:")
    if "://" in root:
        raise ValueError(f"files with given names can only be written to a mounted folder, not {folder}")

    def write(batches):
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                path = f"{root}/{name}"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                part = f"{os.path.dirname(path)}/.{os.path.basename(path)}-{os.getpid()}"
                with open(part, "wb") as f:
                    f.write(bz2.compress(content) if name.endswith(".bz2") else content)
                os.replace(part, path)
            yield batch[["name"]]

    rows.select("name", "content").mapInPandas(write, "name string").count()


def packed_tar(rows):
    """Rows (name, entries) as gzip tar files (name, content)."""
    def pack(batches):
        for batch in batches:
            contents = []
            for entries in batch["entries"]:
                buffer = io.BytesIO()
                with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
                    for entry in entries:
                        info = tarfile.TarInfo(entry["name"])
                        data = entry["text"].encode("latin-1")
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
                contents.append(buffer.getvalue())
            yield batch[["name"]].assign(content=contents)

    return rows.select("name", "entries").mapInPandas(pack, "name string, content binary")


def _lines(spark, sf_dir):
    """A line per customer, and the file it goes to."""
    tables(spark, sf_dir, "customer")
    return spark.sql(
        f"SELECT c_custkey AS k, c_custkey DIV {PER_FILE} AS g, concat('router nick', c_custkey, ' ', c_nationkey) AS line FROM customer"
    )


def _as_files(lines, name):
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("g").agg(F.encode(text, "UTF-8").alias("content")).withColumn("name", name)


def _name(g="g"):
    return F.concat(F.lit("f"), F.col(g), F.when(F.col(g) % 2 == 0, ".bz2").otherwise(""))


def scan_archive(spark, sf_dir):
    folder = scratch(spark)
    write_files(_as_files(_lines(spark, sf_dir), _name()), folder)
    found = archive.scan_archive(spark, folder)
    return found.select("name", F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line"))


def archive_history(spark, sf_dir):
    """Two folders with files of the same names, every third of which is known already."""
    folder, lines = scratch(spark), _lines(spark, sf_dir)
    write_files(_as_files(lines, F.concat(F.lit("a/"), _name())), folder)
    write_files(_as_files(lines.withColumn("line", F.lit("second")), F.concat(F.lit("b/"), _name())), folder)
    history = lines.where("g % 3 = 0").select(_name().alias("name"))
    found = archive.scan_archive(spark, folder, history)
    text = F.decode("content", "UTF-8")
    return found.select("name", F.sha1("content").alias("digest"), F.size(F.split(text, "\n")).cast("bigint").alias("lines"))


def bridge_snapshots(spark, sf_dir):
    folder = scratch(spark)
    tables(spark, sf_dir, "customer")
    docs = spark.sql(
        f"SELECT k, k DIV {PER_FILE} AS g, concat({SERVER_TEXT.format(k='k')}, {SIGNATURE_TEXT}) AS line"
        " FROM (SELECT c_custkey AS k FROM customer) c"
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "")
    entry = lambda name, text: F.struct(F.lit(name).alias("name"), text.alias("text"))
    tars = docs.groupBy("g").agg(
        F.array(
            entry("from/statuses", F.concat(F.lit("@type x\nr a"), F.col("g"), F.lit("\ns Running\n"))),
            entry("from/descriptors", F.concat(F.lit("@purpose bridge\n"), text)),
            entry("from/empty", F.lit("")),
        ).alias("entries")
    )
    stamp = F.concat(F.lit("2010-02-"), F.lpad(1 + F.col("g") % 28, 2, "0"), F.lit("T"), F.lpad(F.col("g") % 24, 2, "0"), F.lit("3000"))
    name = F.concat(F.lit("from-"), F.lpad(F.col("g").cast("string"), 5, "0"), F.lit("-"), stamp, F.lit("Z.tar.gz"))
    write_files(packed_tar(tars.withColumn("name", name)), folder)
    return archive.scan_bridge_snapshots(spark, folder).select(
        "name", "entry", "snapshot", F.col("doc_no").cast("bigint").alias("doc_no"), F.sha1("content").alias("digest")
    )


def sanitized_scan(spark, sf_dir):
    folder, lines = scratch(spark), _lines(spark, sf_dir)
    name = F.concat(F.lit("201002"), F.lpad(1 + F.col("g") % 28, 2, "0"), F.lit("-"), F.lpad(F.col("g") % 24, 2, "0"), F.lit("3000-"), F.col("g"))
    write_files(_as_files(lines, F.when(F.col("g") % 5 == 3, F.concat(F.lit("odd"), F.col("g"))).otherwise(name)), folder)
    return archive.scan_sanitized_bridges(spark, folder).select("name", "snapshot", F.sha1("content").alias("digest"))


def ip_range_files(spark, sf_dir):
    folder = scratch(spark)
    tables(spark, sf_dir, "supplier")
    dotted = "concat_ws('.', {x} DIV 16777216, {x} DIV 65536 % 256, {x} DIV 256 % 256, {x} % 256)"
    lines = spark.sql(
        "SELECT k, g, concat('\"', {a}, '\",\"', {b}, '\",\"', f, '\",\"', t, '\",\"C', k % 10, '\",\"Somewhere\"') AS line FROM"
        " (SELECT s_suppkey AS k, s_suppkey DIV 50 AS g, s_suppkey * 1000 AS f, s_suppkey * 1000 + 599 AS t FROM supplier) s".format(
            a=dotted.format(x="f"), b=dotted.format(x="t")
        )
    )
    files = _as_files(lines, F.concat(F.lit("GeoIP-108_2010"), F.lpad(F.col("g").cast("string"), 4, "0"), F.lit(".csv")))
    head = F.encode(F.lit('Copyright x\n"beginIp","endIp"\n'), "UTF-8")
    write_files(files.withColumn("content", F.concat(head, "content")), folder)
    known = lines.where("g % 3 = 2").select(F.concat(F.lit("2010"), F.lpad(F.col("g").cast("string"), 4, "0")).alias("version"))
    return logs.scan_ip_ranges(spark, folder, known)


def wide_csv(spark, sf_dir):
    path = scratch(spark)
    sinks.write_wide_csv(view(spark, sf_dir, "v_packages"), path, ["date"], "bundle", "downloads")
    return csv_tables.read_wide_csv(spark, path, ["date"], "downloads", column="bundle")


def daily_counts_csv(spark, sf_dir):
    from lanternstats.queries import daily_spine

    path = scratch(spark)
    sinks.write_csv(daily_spine(view(spark, sf_dir, "v_status"), view(spark, sf_dir, "v_bridge_obs")), path, order=["date"])
    relays, bridges = csv_tables.read_daily_counts(spark, path)
    return relays.join(bridges, "date", "full")


def raw_timings_csv(spark, sf_dir):
    """Stored times of which those of one source have overflowed."""
    path = scratch(spark)
    stored = view(spark, sf_dir, "v_timing").select(
        "source",
        F.to_date("started").alias("date"),
        F.date_format("started", "HH:mm:ss").alias("start"),
        (F.col("completemillis") - F.when(F.col("source") == "click", 100_000_000).otherwise(0)).alias("completemillis"),
    )
    sinks.write_csv(stored, path)
    return csv_tables.read_raw_timings(spark, path)


def sorted_csv(spark, sf_dir):
    """Place of every date in the files, read in name order."""
    path = scratch(spark)
    sinks.write_csv(daily.network_size(view(spark, sf_dir, "v_status")), path, order=["date"])
    lines = spark.read.text(path).where("NOT value LIKE 'date,%'").select(
        "value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line")
    )
    place = F.row_number().over(Window.orderBy("file", "line")).cast("bigint")
    return lines.select(place.alias("place"), F.substring_index("value", ",", 1).alias("date"))


def bulk_export(spark, sf_dir):
    path = scratch(spark)
    sinks.write_bulk_export(view(spark, sf_dir, "v_status"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def archive_sink(spark, sf_dir):
    """Whole texts stored twice; copies are kept once, under their first date."""
    path = scratch(spark)
    tables(spark, sf_dir, "documents")
    docs = spark.sql(
        "SELECT sha1(text) AS digest, CAST(date_add(DATE'2010-01-01', CAST(doc_id % 60 AS INT)) AS TIMESTAMP_NTZ) AS published,"
        " encode(text, 'UTF-8') AS content FROM documents"
    )
    rows = sinks.archive_rows(docs, "server", "digest", "published")
    sinks.store_documents(rows.where("CAST(day AS INT) % 2 = 0"), None, path)
    sinks.store_documents(rows, spark.read.parquet(path), path)
    return spark.read.parquet(path).groupBy("type", "month").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length("content")).alias("bytes"), F.countDistinct("digest").alias("digests")
    ).withColumn("month", F.col("month").cast("int"))


_DOTTED = "concat_ws('.', {k} % 256, {k} {div} 256 % 256, {k} {div} 7 % 256, {k} % 251)"


def ip_number(spark, sf_dir):
    tables(spark, sf_dir, "orders")
    rows = spark.sql(
        f"SELECT o_orderkey AS k, CASE WHEN o_orderkey % 97 = 0 THEN '1.2' ELSE {_DOTTED.format(k='o_orderkey', div='DIV')} END AS address FROM orders"
    )
    return rows.select("k", ip_ranges.ip_number(F.col("address")).alias("ip"))


def text_columns(spark, sf_dir):
    tables(spark, sf_dir, "events")
    return sinks.as_text(
        spark.sql("SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, floor(value * 4) / 4.0D AS value FROM events")
    )


FILE_QUERIES = {
    f.__name__: f
    for f in (
        scan_archive, archive_history, bridge_snapshots, sanitized_scan, ip_range_files, wide_csv, daily_counts_csv,
        raw_timings_csv, sorted_csv, bulk_export, archive_sink, ip_number, text_columns,
    )
}


def _with(sql):
    used = oracle_views(sql)
    return f"WITH {', '.join(used)} {sql}" if used else sql


_FILE = f"concat('f', g, CASE WHEN g % 2 = 0 THEN '.bz2' ELSE '' END)"
_LINES = f"(SELECT c_custkey AS k, c_custkey // {PER_FILE} AS g, concat('router nick', c_custkey, ' ', c_nationkey) AS line FROM customer) l"
_STAMP = "TIMESTAMP '2010-02-01' + to_days(CAST(g % 28 AS INTEGER)) + to_hours(CAST(g % 24 AS INTEGER)) + INTERVAL 30 MINUTE"
_TAR = "concat('from-', lpad(CAST(g AS VARCHAR), 5, '0'), '-2010-02-', lpad(CAST(1 + g % 28 AS VARCHAR), 2, '0'), 'T', lpad(CAST(g % 24 AS VARCHAR), 2, '0'), '3000Z.tar.gz')"
_SNAP = "concat('201002', lpad(CAST(1 + g % 28 AS VARCHAR), 2, '0'), '-', lpad(CAST(g % 24 AS VARCHAR), 2, '0'), '3000-', g)"
_FLAGS = ", ".join(f"CASE WHEN is{f} THEN 't' ELSE 'f' END" for f in ("running", "exit", "guard", "fast", "stable", "authority"))
_SPINE = """SELECT coalesce(r.date, b.date) AS date, exit, fast, guard, running, stable, brunning FROM
 (SELECT CAST(validafter AS DATE) AS date, """ + ", ".join(
    f"CAST(sum({f}) // count(*) AS BIGINT) AS {f}" for f in ("exit", "fast", "guard", "running", "stable")
) + """ FROM (SELECT validafter, count(*) FILTER (isrunning) AS running, """ + ", ".join(
    f"count(*) FILTER (isrunning AND is{f}) AS {f}" for f in ("exit", "fast", "guard", "stable")
) + """ FROM v_status GROUP BY validafter) c GROUP BY 1 HAVING count(*) >= 12) r FULL JOIN
 (SELECT CAST(bucket AS DATE) AS date, CAST(sum(n) // count(*) AS BIGINT) AS brunning
  FROM (SELECT time_bucket(INTERVAL 30 MINUTE, seen) AS bucket, count(*) AS n FROM v_bridge_obs GROUP BY 1) h GROUP BY 1 HAVING count(*) >= 47) b
 ON r.date = b.date"""

FILE_ORACLES = {
    "scan_archive": f"SELECT {_FILE} AS name, line FROM {_LINES}",
    "archive_history": f"""SELECT {_FILE} AS name, sha1(string_agg(line, chr(10) ORDER BY k)) AS digest, count(*) AS lines
FROM {_LINES} WHERE g % 3 <> 0 GROUP BY g""",
    "bridge_snapshots": f"""SELECT {_TAR} AS name, 'from/descriptors' AS entry, {_STAMP} AS snapshot, row_number() OVER (PARTITION BY g ORDER BY k) - 1 AS doc_no,
 sha1(concat({SERVER_TEXT.format(k='k')}, {SIGNATURE_TEXT})) AS digest FROM {_LINES}
UNION ALL SELECT {_TAR}, 'from/statuses', {_STAMP}, 0, sha1(concat('@type x', chr(10), 'r a', g, chr(10), 's Running', chr(10))) FROM (SELECT DISTINCT g FROM {_LINES}) d""",
    "sanitized_scan": f"""SELECT CASE WHEN g % 5 = 3 THEN concat('odd', g) ELSE {_SNAP} END AS name, CASE WHEN g % 5 <> 3 THEN {_STAMP} END AS snapshot,
 sha1(string_agg(line, chr(10) ORDER BY k)) AS digest FROM {_LINES} GROUP BY g""",
    "ip_range_files": """SELECT concat('2010', lpad(CAST(s_suppkey // 50 AS VARCHAR), 4, '0')) AS version, s_suppkey * 1000 AS from_ip, s_suppkey * 1000 + 599 AS to_ip,
 concat('C', s_suppkey % 10) AS country FROM supplier WHERE s_suppkey // 50 % 3 <> 2""",
    "wide_csv": _with("SELECT CAST(date AS VARCHAR) AS date, bundle, CAST(downloads AS VARCHAR) AS downloads FROM v_packages"),
    "daily_counts_csv": _with(_SPINE),
    "raw_timings_csv": _with("SELECT source, started, completemillis FROM v_timing"),
    "sorted_csv": _with(
        """SELECT row_number() OVER (ORDER BY date) AS place, CAST(date AS VARCHAR) AS date
FROM (SELECT DISTINCT CAST(validafter AS DATE) AS date FROM v_status WHERE isrunning) d"""
    ),
    "bulk_export": _with(
        f"SELECT concat_ws(chr(9), strftime(validafter, '%Y-%m-%d %H:%M:%S'), fingerprint, descriptor, {_FLAGS}, dirport) AS line FROM v_status"
    ),
    "archive_sink": """SELECT 'server' AS type, CAST(month(first) AS INTEGER) AS month, count(*) AS documents, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS digests
FROM (SELECT sha1(text) AS digest, any_value(strlen(text)) AS bytes, coalesce(min(day) FILTER (day(day) % 2 = 0), min(day)) AS first
 FROM (SELECT text, DATE '2010-01-01' + CAST(doc_id % 60 AS INTEGER) AS day FROM documents) x GROUP BY 1) y GROUP BY 1, 2""",
    "ip_number": """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 97 <> 0 THEN
 ((o_orderkey % 256 * 256 + o_orderkey // 256 % 256) * 256 + o_orderkey // 7 % 256) * 256 + o_orderkey % 251 END AS ip FROM orders""",
    "text_columns": """SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS VARCHAR) AS user_id,
 CASE WHEN event_type = 'error' THEN 'NA' ELSE event_type END AS event_type, coalesce(printf('%.2f', floor(value * 4) / 4), 'NA') AS value FROM events""",
}

# The functions that run in Python workers are sent by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
