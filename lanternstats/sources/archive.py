"""File scans: archives, cached documents, bridge snapshots, and import histories."""

import bz2
import io
import re
import sys
import tarfile

from pyspark import cloudpickle
from pyspark.sql import functions as F

from lanternstats.functions import text as tx
from lanternstats.operators.documents import split_documents

FILE_COLUMNS = "path string, name string, modified timestamp, content binary"
#: Contents go to Spark in frames of about so many bytes.
BATCH_BYTES = 8 << 20


def list_files(spark, folder, modified_after=None):
    """Path, base name and content of every file below a folder; content is read only if used.

    ``modified_after`` (a timestamp text) leaves older files out of the listing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(folder).select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("modificationTime").alias("modified"),
        "content",
    )


def not_imported(files, history=None):
    """Files to parse: of each base name the first path, and none whose name is in ``history``.

    Only names and paths are compared.  The paths that remain are opened anew,
    so contents are never shuffled and old files never read; the driver's file
    index holds all paths anyway.
    """
    first = files.groupBy("name").agg(F.min("path").alias("path"))
    if history is not None:
        first = first.join(history.select("name").distinct(), "name", "left_anti")
    paths = [_escaped(r["path"]) for r in first.select("path").collect()]
    if not paths:
        return files.where(F.lit(False))
    return list_files(files.sparkSession, paths)


def _escaped(path):
    """A path as a pattern that only it matches."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def imported_names(files):
    """Rows to append to the import history; does not read content."""
    return files.select("name").distinct()


def _batches(rows, columns):
    """Rows as frames of at most ``BATCH_BYTES`` of content, or one larger row."""
    import pandas as pd

    held, size = [], 0
    for row in rows:
        if held and size + len(row[-1]) > BATCH_BYTES:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
        held.append(row)
        size += len(row[-1])
    if held:
        yield pd.DataFrame(held, columns=columns)


def unpacked(files):
    """Contents of ``.bz2`` files unpacked, other files as they are, ``.tar.bz2`` files left out."""
    columns = ["path", "name", "modified", "content"]

    def unpack(batches):
        for batch in batches:
            rows = batch.itertuples(index=False, name=None)
            yield from _batches(((*row[:-1], bz2.decompress(row[-1])) for row in rows), columns)

    files = files.where(~F.col("name").endswith(".tar.bz2")).select(*columns)
    packed = F.col("name").endswith(".bz2")
    return files.where(~packed).unionByName(files.where(packed).mapInPandas(unpack, FILE_COLUMNS))


def scan_archive(spark, folder, history=None, modified_after=None):
    """Documents of an archive tree, unpacked; of files with the same base name the first.

    With a history, files of known names are not opened; ``modified_after``
    keeps old files out of the listing, and so does the checkpoint of
    ``streaming.file_stream``.
    """
    return unpacked(not_imported(list_files(spark, folder, modified_after), history))


def scan_cached(spark, folder):
    """Documents of a client's cache files: whole consensuses, split descriptor files."""
    files = list_files(spark, folder)
    consensus = files.where(F.col("name") == "cached-consensus").withColumn("doc_no", F.lit(0))
    servers = split_documents(files.where(F.col("name").startswith("cached-descriptors")), "router ")
    extras = split_documents(files.where(F.col("name").startswith("cached-extrainfo")), "extra-info ")
    columns = ["path", "name", "doc_no", "content"]
    return consensus.select(*columns).unionByName(servers.select(*columns)).unionByName(
        extras.select(*columns)
    )


def _untarred(files):
    """Members of gzip tar files as ``path, name, entry, content``."""
    def members(batches):
        for batch in batches:
            for path, name, content in zip(batch["path"], batch["name"], batch["content"]):
                if not content:
                    continue
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
                    for member in tar:
                        data = tar.extractfile(member).read() if member.isfile() else b""
                        if data:
                            yield path, name, member.name, data

    def untar(batches):
        yield from _batches(members(batches), ["path", "name", "entry", "content"])

    return files.select("path", "name", "content").mapInPandas(
        untar, "path string, name string, entry string, content binary"
    )


def scan_bridge_snapshots(spark, folder, history=None):
    """Documents of half-hourly gzip tar snapshots, with the snapshot time of the file name.

    Lines starting with ``@`` before the first line are looked past to tell the
    kind of an entry.  Statuses stay whole, other entries are split.
    """
    entries = _untarred(not_imported(list_files(spark, folder), history))
    stamp = F.substring("name", 12, 17)
    entries = entries.withColumn(
        "snapshot",
        tx.timestamp(
            F.concat(
                F.substring(stamp, 1, 10), F.lit(" "), F.substring(stamp, 12, 2), F.lit(":"),
                F.substring(stamp, 14, 2), F.lit(":"), F.substring(stamp, 16, 2),
            )
        ),
    )
    first_line = F.regexp_extract(tx.body("content"), "\\A(?:@[^\n]*\n)*([^\n]*)", 1)
    typed = entries.withColumn("_first", first_line)
    statuses = typed.where(F.col("_first").startswith("r ")).withColumn("doc_no", F.lit(0))
    rest = typed.where(~F.col("_first").startswith("r "))
    servers = split_documents(rest.where(F.col("_first").startswith("router ")), "router ")
    extras = split_documents(rest.where(~F.col("_first").startswith("router ")), "extra-info ")
    columns = ["path", "name", "entry", "snapshot", "doc_no", "content"]
    return statuses.select(*columns).unionByName(servers.select(*columns)).unionByName(
        extras.select(*columns)
    )


def scan_sanitized_bridges(spark, folder, history=None):
    """Scrubbed bridge documents with the time of the first 16 characters of the file name.

    Names without such a time give a null time, not an error.
    """
    files = scan_archive(spark, folder, history)
    stamp = F.substring("name", 1, 15)
    return files.withColumn(
        "snapshot",
        F.try_to_timestamp(stamp, F.lit("yyyyMMdd-HHmmss")).cast("timestamp_ntz"),
    )


# The functions that run in Python workers are sent by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
