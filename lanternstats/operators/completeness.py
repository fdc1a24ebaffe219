"""How complete an archive is, and which referenced documents are missing."""

from pyspark.sql import functions as F

DAY_HOURS = 24
VOTE_KEY = ("dirsource", "digest")


def last_documents(docs, time, count=3):
    """The documents of the last few times; top-k over the distinct times."""
    newest = docs.select(time).distinct().orderBy(F.desc(time)).limit(count)
    return docs.join(newest, time, "left_semi")


def _share(found, total):
    return F.round(F.try_divide(F.lit(100.0) * F.col(found), F.col(total)), 1)


def archive_completeness(references, servers, extras, by):
    """Found and referenced server and extra-info descriptors per referring document.

    ``references`` has the columns ``by`` and ``descriptor``; ``servers`` has
    ``descriptor`` and ``extrainfo``; ``extras`` has ``extrainfo``.  References
    are counted before the joins, so a descriptor named by many documents
    moves once per referring document.
    """
    counted = references.groupBy(*by, "descriptor").agg(F.count(F.lit(1)).alias("_n"))
    found_server = servers.groupBy("descriptor").agg(
        F.first("extrainfo", ignorenulls=True).alias("extrainfo")
    )
    found_extra = extras.select("extrainfo").distinct().withColumn("_has_extra", F.lit(True))
    # Descriptors that name no extra-info stay out of the join: their nulls would be one hot key.
    names_one = F.col("extrainfo").isNotNull()
    known = (
        found_server.where(names_one)
        .join(found_extra, "extrainfo", "left")
        .unionByName(found_server.where(~names_one), allowMissingColumns=True)
        .withColumn("_has_server", F.lit(True))
    )
    joined = counted.join(known, "descriptor", "left")
    tally = lambda test: F.coalesce(F.sum(F.when(test, F.col("_n"))), F.lit(0)).cast("bigint")
    return (
        joined.groupBy(*by)
        .agg(
            tally(F.lit(True)).alias("all_servers"),
            tally(F.col("_has_server")).alias("found_servers"),
            tally(F.col("extrainfo").isNotNull()).alias("all_extras"),
            tally(F.col("_has_extra")).alias("found_extras"),
        )
        .select(
            *by,
            "found_servers", "all_servers", _share("found_servers", "all_servers").alias("servers_pct"),
            "found_extras", "all_extras", _share("found_extras", "all_extras").alias("extras_pct"),
        )
    )


def vote_completeness(vote_references, votes, by, key=("dirsource",)):
    """Found and referenced votes per consensus; both sides have ``by`` and ``key``."""
    asked = vote_references.select(*by, *key).distinct()
    found = votes.select(*by, *key).distinct().withColumn("_found", F.lit(1))
    return (
        asked.join(found, [*by, *key], "left")
        .groupBy(*by)
        .agg(F.count("_found").alias("found_votes"), F.count(F.lit(1)).alias("all_votes"))
        .withColumn("votes_pct", _share("found_votes", "all_votes"))
    )


def named_votes(consensuses):
    """Votes that consensuses name, by time, authority and digest."""
    return consensuses.select("validafter", F.inline("vote_references")).distinct()


def report_documents(headers, last=3):
    """The rows of ``headers`` that ``archive_report`` is about: the last consensuses and the votes they name.

    Headers are cheap to read; only the entries of these documents need be parsed.
    """
    consensuses = last_documents(headers.where("is_consensus"), "validafter", last)
    votes = headers.where("NOT is_consensus").join(named_votes(consensuses), ["validafter", *VOTE_KEY], "left_semi")
    return consensuses.unionByName(votes)


def archive_report(headers, entries, servers, extras, last=3):
    """Completeness of the last consensuses (``C``) and of the votes they name (``V``).

    ``headers`` is the output of ``statuses.status_headers``, with the ``digest`` of each vote; ``entries`` has
    ``validafter``, ``is_consensus``, ``dirsource``, ``digest`` and ``descriptor``.  A vote is found if one of
    the named time, authority and digest is at hand.
    """
    consensuses = last_documents(headers.where("is_consensus"), "validafter", last)
    named = named_votes(consensuses)
    votes = vote_completeness(named, headers.where("NOT is_consensus"), ["validafter"], VOTE_KEY)
    times = consensuses.select("validafter").distinct()
    listed = entries.where("is_consensus").join(times, "validafter", "left_semi").select(
        F.lit("C").alias("kind"), "validafter", F.lit(None).cast("string").alias("dirsource"), "descriptor"
    ).unionByName(
        entries.where("NOT is_consensus").join(named, ["validafter", *VOTE_KEY], "left_semi").select(
            F.lit("V").alias("kind"), "validafter", "dirsource", "descriptor"
        )
    )
    report = archive_completeness(listed, servers, extras, ["kind", "validafter", "dirsource"])
    return report.join(votes.withColumn("kind", F.lit("C")), ["kind", "validafter"], "left")


def documents_at_hand(consensuses, votes, servers, extras):
    """Keys of the documents we have, in the form of ``references_seen``."""
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    rows = lambda kind, frame, time, relay, digest: frame.select(
        F.lit(kind).alias("type"), F.col(time).alias("published"), relay.alias("relay"), digest.alias("digest")
    )
    return (
        rows("consensus", consensuses, "validafter", none, none)
        .unionByName(rows("vote", votes, "validafter", text("dirsource"), none))
        .unionByName(rows("server", servers, "published", text("fingerprint"), text("descriptor")))
        .unionByName(rows("extra", extras, "published", text("fingerprint"), text("extrainfo")))
    )


def references_seen(consensuses, entries, servers):
    """References found in parsed documents as rows ``type, published, relay, digest``.

    ``consensuses`` has ``validafter`` and ``vote_sources``; ``entries`` are relays
    listed by consensuses and votes; ``servers`` are server descriptors.
    """
    votes = consensuses.select(
        F.lit("vote").alias("type"), F.col("validafter").alias("published"),
        F.explode("vote_sources").alias("relay"), F.lit(None).cast("string").alias("digest"),
    )
    descriptors = entries.select(
        F.lit("server").alias("type"), "published",
        F.lower("relay").alias("relay"), F.col("descriptor").alias("digest"),
    )
    extras = servers.where("extrainfo IS NOT NULL").select(
        F.lit("extra").alias("type"), "published",
        F.col("fingerprint").alias("relay"), F.col("extrainfo").alias("digest"),
    )
    return votes.unionByName(descriptors).unionByName(extras)


def missing_references(references, have, now, current=None, key=("type", "published", "relay", "digest")):
    """References worth fetching: not at hand and still likely to be available.

    Descriptors count for 24 hours after publication, votes and consensuses
    only for the hour ``current``, whose consensus is itself wanted until it is
    at hand.  ``references`` may include those carried over from an earlier run.
    """
    key = list(key)
    if current is not None:
        wanted = {"type": "consensus", "published": current}
        row = [F.lit(wanted.get(c)).cast(references.schema[c].dataType).alias(c) for c in key]
        references = references.select(*key).unionByName(references.sparkSession.range(1).select(*row))
    cut_off = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(DAY_HOURS))
    fresh = F.col("published").cast("timestamp_ntz") >= cut_off
    if current is not None:
        hourly = F.col("type").isin("vote", "consensus")
        fresh = F.when(
            hourly, F.col("published").cast("timestamp_ntz") == F.lit(current).cast("timestamp_ntz")
        ).otherwise(fresh)
    wanted = references.where(fresh).select(*key).distinct().alias("w")
    known = have.select(*key).distinct().alias("h")
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"h.{c}")) for c in key]
    condition = same[0]
    for test in same[1:]:
        condition = condition & test
    return wanted.join(known, condition, "left_anti")


def missing_counts(missing):
    """Missing documents by type."""
    return missing.groupBy("type").agg(F.count(F.lit(1)).alias("missing"))
