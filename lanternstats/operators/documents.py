"""Split files into documents and tell the document types apart."""

from pyspark.sql import functions as F

from lanternstats.functions import text as tx

SIGNED_DOCUMENT = "(?s)({start}.*?\nrouter-signature\n.*?\n-----END SIGNATURE-----\n)"


def split_documents(files, start_token):
    """One row per complete document of a concatenated file.

    ``files`` has ``content``; its other columns are kept.  A document runs
    from ``start_token`` to the end of its signature block; a truncated tail
    is dropped.  Adds ``doc_no`` and replaces ``content``.
    """
    keep = [c for c in files.columns if c != "content"]
    pieces = F.regexp_extract_all(
        tx.body("content"), F.lit(SIGNED_DOCUMENT.format(start=start_token)), F.lit(1)
    )
    return (
        files.select(*keep, F.posexplode_outer(pieces).alias("doc_no", "_piece"))
        .where("_piece IS NOT NULL")
        .select(*keep, "doc_no", tx.to_bytes("_piece").alias("content"))
    )


def classify_relay_documents(files):
    """Add ``text`` and ``doc_type`` (``status``, ``server``, ``extra``) from the first line.

    Documents of any other kind, and empty ones, are dropped.
    """
    typed = tx.bind(files, text=tx.body("content")).withColumn(
        "_first", F.regexp_extract("text", "^[^\r\n]*", 0)
    )
    doc_type = (
        F.when(F.col("_first") == "network-status-version 3", "status")
        .when(F.col("_first").startswith("router "), "server")
        .when(F.col("_first").startswith("extra-info "), "extra")
    )
    return tx.bind(typed, doc_type=doc_type).drop("_first").where("doc_type IS NOT NULL")


def classify_bridge_documents(files):
    """As above for bridge documents, where the telling line may stand anywhere."""
    typed = tx.bind(files, text=tx.body("content"))
    typed = tx.bind(typed, _telling=F.regexp_extract("text", "(?md)^(r |router |extra-info )", 1))
    telling = F.col("_telling")
    doc_type = (
        F.when(telling == "r ", "status")
        .when(telling == "router ", "server")
        .when(telling == "extra-info ", "extra")
    )
    return typed.withColumn("doc_type", doc_type).drop("_telling").where("doc_type IS NOT NULL")


def stale_consensus(docs, now, hours=6):
    """``valid-after`` of cached consensuses and whether it is more than ``hours`` before ``now``."""
    first_line = tx.first(tx.starting(tx.lines(F.col("text")), "valid-after "))
    seen = docs.select(
        *[c for c in docs.columns if c not in ("content", "text")],
        tx.timestamp(F.substring(first_line, 13, 2147483647)).alias("valid_after"),
    ).where("valid_after IS NOT NULL")
    return seen.withColumn("is_stale", is_older(F.col("valid_after"), now, hours))


def is_older(time, now, hours):
    """Whether ``time`` lies more than ``hours`` before ``now`` (a timestamp or its text)."""
    limit = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))
    return time < limit


def latest_is_stale(statuses, now, hours=6):
    """One row: the latest time of a status table and whether it is too old."""
    return statuses.agg(F.max("validafter").alias("latest")).withColumn(
        "is_stale", is_older(F.col("latest"), now, hours)
    )
