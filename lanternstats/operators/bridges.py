"""Bridge documents: running counts, users by country, unreliable versions."""

from pyspark.sql import functions as F

from lanternstats.functions import digests, text as tx
from lanternstats.operators.descriptors import UNSAFE_ROUNDING, explode_countries

SECONDS_PER_DAY = 86400.0
# Platform prefix of bridges whose country statistics are broken (fixed value).
BROKEN_PLATFORM = "Tor 0.2.2"


def running_bridges(docs, keep=()):
    """Number of ``s`` lines with the running flag after the first ``r`` line of a status."""
    lines = F.col("_lines")
    return tx.bind(docs, _lines=tx.lines(F.col("text"))).select(
        *keep,
        F.size(
            F.filter(
                F.slice(
                    lines,
                    F.greatest(tx.first_position(lines, lambda x: x.startswith("r ")), F.lit(1)),
                    F.size(lines),
                ),
                lambda x: x.startswith("s ") & F.contains(x, F.lit(" Running")),
            )
        ).cast("bigint").alias("running"),
    )


def with_identity(docs, sanitized=False):
    """Add ``bridge``: upper-case SHA-1 of the identity, or the identity itself if already hashed."""
    name = F.regexp_extract("text", "(?md)^extra-info [^ \n]+ ([^ \n]+)", 1)
    fingerprint = F.regexp_replace(
        F.regexp_extract("text", "(?md)^(?:opt )?fingerprint([^\n]*)$", 1), "[ \r]", ""
    )
    read = tx.bind(docs, _name=name, _fingerprint=fingerprint)
    identity = F.when(F.col("_fingerprint") != "", F.col("_fingerprint")).otherwise(F.col("_name"))
    bridge = F.upper(identity) if sanitized else digests.sha1_of_hex(identity)
    return tx.bind(read, bridge=bridge).drop("_name", "_fingerprint")


def without_known_relays(rows, hashed_relays):
    """Drop the rows of bridges that are also relays.

    Use it on parsed rows: they are small, while documents would be shuffled whole.
    """
    known = hashed_relays.select(F.col("hashed_relay").alias("bridge")).distinct()
    return rows.join(known, "bridge", "left_anti")


def _state(docs, keywords):
    """Relevant lines with, for each, the last earlier line of every keyword in ``keywords``."""
    relevant = tx.starting(tx.lines(F.col("text")), *keywords, "geoip-client-origins", "bridge-ips")
    cut = tx.bind(docs, _all=relevant)
    name = lambda keyword: "_" + keyword.strip()
    cut = tx.bind(cut, **{name(k): tx.held(F.col("_all"), k) for k in keywords})
    seen = F.transform(
        "_all",
        lambda line, i: F.struct(
            line.alias("line"), *[F.try_element_at(F.col(f"`{name(k)}`"), i + 1).alias(k.strip()) for k in keywords]
        ),
    )
    # A list without its header lines ends the document.
    return tx.bind(cut, _seen=seen).withColumn("_seen", tx.before_first(F.col("_seen"), _lacks_header))


def _has_list(seen, keyword):
    return seen["line"].startswith(keyword) & (F.length(tx.field(seen["line"], 1)) > 0)


def _lacks_header(seen):
    return (
        _has_list(seen, "geoip-client-origins")
        & (seen["published"].isNull() | seen["geoip-start-time"].isNull())
    ) | (_has_list(seen, "bridge-ips") & seen["bridge-stats-end"].isNull())


def bridge_users(docs, keep=()):
    """Users by bridge, time and country from both kinds of lists.

    Counts since ``geoip-start-time`` are scaled to a day; daily counts are
    taken as they are.  ``zy`` holds the total of the exact numbers; then all
    are rounded to two decimals.  Rows of an interval of zero length are dropped.
    """
    seen = (
        _state(docs, ("published ", "geoip-start-time ", "bridge-stats-end "))
        .select(*keep, "bridge", F.explode_outer("_seen").alias("_s"))
    )
    s = F.col("_s")
    stamp = lambda line: tx.timestamp(F.concat_ws(" ", tx.field(line, 1), tx.field(line, 2)))
    is_geoip = s["line"].startswith("geoip-client-origins")
    timed = tx.bind(
        seen.where(_has_list(s, "geoip-client-origins") | _has_list(s, "bridge-ips")),
        seen=F.when(is_geoip, stamp(s["published"])).otherwise(stamp(s["bridge-stats-end"])),
        _start=F.when(is_geoip, stamp(s["geoip-start-time"])),
        _pairs=F.split(tx.field(s["line"], 1), ","),
    )
    scale = F.when(
        is_geoip,
        F.try_divide(
            F.lit(SECONDS_PER_DAY), tx.seconds_between(F.col("seen"), F.col("_start")).cast("double")
        ),
    ).otherwise(F.lit(1.0))
    scaled = timed.withColumn("_scale", scale).where("seen IS NOT NULL AND _scale IS NOT NULL")
    users = lambda p: (tx.to_long(F.substring(p, 4, 2147483647)) - UNSAFE_ROUNDING).cast("double") * F.col("_scale")
    lists = tx.bind(
        scaled,
        _obs=F.transform(
            "_pairs", lambda p: F.struct(F.substring(p, 1, 2).alias("country"), users(p).alias("n"))
        ),
    ).where(~F.exists("_obs", lambda o: o["n"].isNull()))
    return explode_countries(
        lists.select(
            *keep, "bridge", F.to_date("seen").alias("date"), "seen",
            F.when(F.col("_s.line").startswith("geoip"), "geoip").otherwise("ips").alias("kind"),
            "_obs",
        ),
        "users",
        F.lit(0.0),
    ).withColumn("users", F.round("users", 2))


def broken_versions(docs, prefix=BROKEN_PLATFORM):
    """Keys (bridge, time) of descriptors published by versions with broken statistics."""
    split = tx.bind(docs, _lines=tx.lines(F.col("text")))
    read = tx.bind(
        split,
        _platform=tx.last_value(F.col("_lines"), "platform "),
        seen=tx.timestamp(tx.last_value(F.col("_lines"), "published ")),
    )
    return (
        read.where(F.col("_platform").startswith(prefix))
        .select("bridge", "seen")
        .distinct()
    )
