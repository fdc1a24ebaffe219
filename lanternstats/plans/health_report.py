"""The comparisons of one hour: from status documents to all tables of a health report."""

from pyspark.sql import functions as F

from lanternstats.operators import health, statuses


def one_consensus(headers):
    """Headers of one consensus per time; of several that with the smallest ``doc_id``."""
    rest = [c for c in headers.columns if c != "validafter"]
    return headers.where("is_consensus").groupBy("validafter").agg(
        F.min_by(F.struct(*rest), "doc_id").alias("_c")
    ).select("validafter", "_c.*")


def latest_documents(docs):
    """Header lines of the documents of the most recent time (``docs`` has ``doc_id`` and ``text``)."""
    return health.latest_only(health.health_headers(docs, keep=["doc_id"]))


def relay_flags(entries, votes, consensus):
    """Inputs of the flag comparison: flags by relay and authority, flags by relay of the consensus."""
    rows = entries.select("doc_id", "relay", "flags")
    voted = rows.join(votes.select("doc_id", "dir", "known_flags"), "doc_id").groupBy("relay", "dir").agg(
        F.max("flags").alias("flags"), F.max("known_flags").alias("known_flags")
    )
    listed = rows.join(consensus.select("doc_id"), "doc_id", "left_semi").groupBy("relay").agg(F.max("flags").alias("flags"))
    return voted, listed


def health_report(docs, now, root, expected=None, with_votes=False):
    """All comparisons of the latest votes with their consensus, from the documents themselves.

    Headers of all documents and entries of the latest ones are parsed once and kept below ``root``; the tables are
    made of these.  ``expected`` (column ``dir``) are the authorities that should have voted.  ``with_votes`` takes the latest
    time that has a vote and a consensus, else it is the latest of all.
    """
    spark = docs.sparkSession

    def written(name, frame):
        frame.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    headers = written("headers", health.health_headers(docs, keep=["doc_id"]))
    if with_votes:
        times = lambda test: headers.where(test).select("validafter").distinct()
        headers = headers.join(times("is_consensus").intersect(times("NOT is_consensus")), "validafter", "left_semi")
    headers = written("current", health.latest_only(headers))
    consensus, votes = one_consensus(headers), headers.where("NOT is_consensus")
    if expected is None:
        expected = spark.createDataFrame([(d,) for d in health.EXPECTED_AUTHORITIES], "dir string")
    current = docs.join(headers.select("doc_id"), "doc_id", "left_semi")
    entries = written("entries", statuses.vote_entries(current, keep=["doc_id"]))
    by_vote = entries.join(votes.select("doc_id", "dir"), "doc_id")
    of_consensus = entries.join(consensus.select("doc_id"), "doc_id", "left_semi")
    flags, listed = relay_flags(entries, votes, consensus)
    known = health.known_flags(votes)
    matrix = health.flag_matrix(flags, listed)
    return {
        "known_flags": health.known_flags(votes, consensus),
        "relay_counts": health.relay_counts(health.with_consensus_rows(by_vote, of_consensus)),
        "method_support": health.method_support(votes, consensus),
        "version_agreement": health.version_agreement(votes, consensus),
        "parameter_conflicts": health.parameter_conflicts(votes, consensus),
        "expiring_keys": health.expiring_keys(votes, now),
        "bandwidth_scanners": health.bandwidth_scanners(by_vote),
        "authority_versions": health.authority_versions(of_consensus),
        "missing_votes": health.missing_votes(votes, expected),
        "consensus_age": health.consensus_age(consensus, now),
        "flag_matrix": matrix,
        "flag_overlap": health.flag_overlap(matrix, known),
    }


#: Columns that name a row of each table of the report.
KEYS = {"authority_versions": ["relay"], "consensus_age": [], "flag_matrix": ["relay", "dir"]}


def report_rows(tables):
    """All tables of a report as rows ``table, key, value``; ``-`` stands for null."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    parts = []
    for name, frame in tables.items():
        key = KEYS.get(name, ["dir"])
        values = sorted(c for c in frame.columns if c not in key)
        flat = frame.select(*[F.array_join(c, " ").alias(c) if t.startswith("array") else F.col(c) for c, t in frame.dtypes])
        parts.append(
            flat.select(
                F.lit(name).alias("table"),
                F.concat_ws(" ", *map(text, key)).alias("key"),
                F.concat_ws("|", *map(text, values)).alias("value"),
            )
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows
