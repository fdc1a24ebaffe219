"""Comparisons of votes with the consensus of the same hour."""

from pyspark.sql import functions as F

from lanternstats.functions import text as tx
from lanternstats.operators.documents import is_older

# Authorities expected to vote (fixed values).
EXPECTED_AUTHORITIES = ["dannenberg", "dizum", "gabelmoo", "ides", "maatuska", "moria1", "tor26", "urras"]
# Parameters a vote may set (fixed values).
VALID_PARAMETERS = ["circwindow", "CircuitPriorityHalflifeMsec", "refuseunknownexits"]
KEY_WARNING_DAYS = 14
#: Stands for an authority in rows of the consensus itself.
CONSENSUS = "consensus"
STALE_HOURS = 3


def latest_only(docs, time="validafter"):
    """Documents of the most recent time: one consensus and its votes."""
    return docs.where(F.col(time) == docs.agg(F.max(time)).scalar())


def health_headers(docs, keep=()):
    """One row per status document with the header lines that are compared, null if absent."""
    lines = tx.lines(F.substring_index("text", "\nr ", 1))
    head = tx.bind(docs, _lines=lines)
    value = lambda keyword: tx.last_value(F.col("_lines"), keyword)
    words = lambda keyword: F.split(value(keyword), " ")
    return head.select(
        *keep,
        (~F.array_contains("_lines", "vote-status vote")).alias("is_consensus"),
        tx.timestamp(value("valid-after ")).alias("validafter"),
        tx.field(tx.last(tx.starting(F.col("_lines"), "dir-source ")), 1).alias("dir"),
        words("known-flags ").alias("known_flags"),
        value("consensus-method ").alias("consensus_method"),
        value("consensus-methods ").alias("consensus_methods"),
        value("client-versions ").alias("client_versions"),
        value("server-versions ").alias("server_versions"),
        words("params ").alias("params"),
        tx.timestamp(value("dir-key-expires ")).alias("key_expires"),
    )


def _with_consensus(votes, consensus, *columns):
    return votes.join(
        consensus.select("validafter", *[F.col(c).alias(f"cons_{c}") for c in columns]), "validafter"
    )


def with_consensus_rows(votes, consensus):
    """Rows of votes and, with ``dir`` ``consensus``, those of the consensus."""
    return votes.unionByName(consensus.drop("dir").withColumn("dir", F.lit(CONSENSUS)).select(votes.columns))


def known_flags(votes, consensus=None):
    """Flags each authority votes on, one row per flag; and those of the consensus, if it is given."""
    rows = votes.select("validafter", "dir", "known_flags")
    if consensus is not None:
        rows = with_consensus_rows(rows, consensus)
    return rows.select("validafter", "dir", F.explode("known_flags").alias("flag"))


def relay_counts(entries, by=("dir",)):
    """Relays listed per status document, and running ones; only entries with flags count.

    Entries of the consensus have ``dir`` ``consensus``, see ``with_consensus_rows``.
    """
    return entries.where("has_flags").groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.array_contains("flags", "Running"), 1).otherwise(0)).alias("running"),
    )


def method_support(votes, consensus):
    """Whether a vote supports the consensus method.

    ``supported`` is the substring test, by which 1 is found in 10;
    ``supported_exactly`` compares whole numbers.
    """
    both = _with_consensus(votes, consensus, "consensus_method")
    method = tx.field(F.col("cons_consensus_method"), 0)
    return both.select(
        "dir",
        "consensus_methods",
        F.contains(F.col("consensus_methods"), method).alias("supported"),
        F.array_contains(F.split("consensus_methods", " "), method).alias("supported_exactly"),
    )


def version_agreement(votes, consensus):
    """Whether recommended versions equal the consensus; null if the authority recommends none."""
    both = _with_consensus(votes, consensus, "client_versions", "server_versions")
    same = lambda c: F.when(F.col(c).isNotNull(), F.col(c).eqNullSafe(F.col(f"cons_{c}")))
    return both.select(
        "dir", same("client_versions").alias("client_agrees"), same("server_versions").alias("server_agrees")
    )


def parameter_conflicts(votes, consensus, valid=VALID_PARAMETERS):
    """Whether a vote sets a parameter that is unknown or not in the consensus.

    ``conflicting`` looks for the parameter in the text of the consensus' line, where ``a=1`` is found in ``a=10``;
    ``conflicting_exactly`` compares whole parameters.
    """
    both = _with_consensus(votes, consensus, "params")
    agreed = F.coalesce(F.col("cons_params"), F.array().cast("array<string>"))
    line = F.when(F.col("cons_params").isNotNull(), F.concat(F.lit("params "), F.array_join("cons_params", " ")))
    conflict = lambda found: F.exists(
        F.coalesce(F.col("params"), F.array().cast("array<string>")),
        lambda p: ~found(p) | ~F.split(p, "=")[0].isin(valid),
    )
    return both.select(
        "dir", "params",
        conflict(lambda p: F.coalesce(F.contains(line, p), F.lit(False))).alias("conflicting"),
        conflict(lambda p: F.array_contains(agreed, p)).alias("conflicting_exactly"),
    )


def expiring_keys(votes, now, days=KEY_WARNING_DAYS):
    """Whether an authority's key expires within 14 days of ``now``."""
    limit = F.lit(now).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(days))
    return votes.where("key_expires IS NOT NULL").select(
        "dir", "key_expires", (limit > F.col("key_expires")).alias("expires_soon")
    )


def bandwidth_scanners(entries):
    """Authorities that measure bandwidth, with the number of measured relays."""
    return (
        entries.groupBy("dir")
        .agg(F.sum(F.when(F.col("is_measured"), 1).otherwise(0)).alias("measured"))
        .where("measured > 0")
    )


def authority_versions(entries):
    """Software versions of the relays flagged as authorities in the consensus."""
    return entries.where(
        F.array_contains("flags", "Authority") & F.col("version").isNotNull()
    ).select("relay", "nickname", "version")


def missing_votes(votes, expected):
    """Expected authorities (column ``dir``) without a vote."""
    return expected.select("dir").join(votes.select("dir").distinct(), "dir", "left_anti")


def consensus_age(consensus, now, hours=STALE_HOURS):
    """The newest consensus time and whether it is more than three hours old."""
    return consensus.agg(F.max("validafter").alias("validafter")).select(
        "validafter", is_older(F.col("validafter"), now, hours).alias("is_stale")
    )


def flag_matrix(votes, consensus):
    """State of every flag by relay and authority.

    ``votes`` has ``relay, dir, flags, known_flags``; ``consensus`` has ``relay,
    flags``.  ``agree``: in the vote, and in the consensus or the relay is not in
    the consensus.  ``lost``: in the vote only.  ``missing``: in the consensus
    only, though the authority voted on the relay and knows the flag.

    One join on the relay; the flag sets of a row are compared as arrays.
    """
    cons = F.col("_consensus")
    states = {
        "agree": F.when(cons.isNull(), F.col("flags")).otherwise(F.array_intersect("flags", cons)),
        "lost": F.when(cons.isNull(), F.array().cast("array<string>")).otherwise(F.array_except("flags", cons)),
        "missing": F.coalesce(
            F.array_intersect(F.array_except(cons, "flags"), F.col("known_flags")),
            F.array().cast("array<string>"),
        ),
    }
    def tag(state):
        return lambda f: F.struct(f.alias("flag"), F.lit(state).alias("state"))

    tagged = F.concat(*[F.transform(flags, tag(state)) for state, flags in states.items()])
    return (
        votes.join(consensus.select("relay", F.col("flags").alias("_consensus")), "relay", "left")
        .select("relay", "dir", F.inline(tagged))
    )


def flag_overlap(matrix, known):
    """Counts of the three states for every flag an authority knows; null where there are none.

    ``known`` has ``dir`` and ``flag``.
    """
    counts = matrix.groupBy("dir", "flag").agg(
        *[F.nullif(F.count_if(F.col("state") == s), F.lit(0)).alias(s) for s in ("lost", "agree", "missing")]
    )
    return known.select("dir", "flag").distinct().join(counts, ["dir", "flag"], "left")
