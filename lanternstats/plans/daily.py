"""Daily statistics of the relay network, as functions of the fact tables.

Each function takes DataFrames and returns one; ``updates`` (column ``date``)
limits the work to changed dates.  Facts are pre-aggregated on their full key
before every join, so a hot relay, descriptor or date never reaches one task
as raw rows.
"""

from pyspark.sql import Window, functions as F

from lanternstats.functions.numbers import big, count_when, int_div, round_div, sum_when
from lanternstats.functions.sizing import only_dates
from lanternstats.functions.text import seconds_between

ALL_COUNTRIES = "zy"


def _limited(facts, time_column, updates):
    return facts if updates is None else only_dates(facts, time_column, updates)


def relay_statuses_per_day(status, updates=None):
    """Number of distinct consensuses per date."""
    consensuses = _limited(status, "validafter", updates).select("validafter").distinct()
    return consensuses.groupBy(F.to_date("validafter").alias("date")).agg(
        F.count(F.lit(1)).alias("count")
    )


def _consensus_counts(status):
    """Counts per consensus; consensuses without a running relay are kept."""
    running = F.col("isrunning")
    return status.groupBy("validafter").agg(
        count_when(running).alias("running"),
        *[
            count_when(running & F.col(f"is{flag}")).alias(flag)
            for flag in ("exit", "guard", "fast", "stable")
        ],
    )


def network_size(status, per_day=None, updates=None):
    """Average number of running relays per date, and of those with four flags.

    One pass: counts per consensus, then their sums per date divided by the
    number of consensuses.  A stored ``per_day`` table replaces that number.
    """
    names = ("running", "exit", "guard", "fast", "stable")
    days = (
        _consensus_counts(_limited(status, "validafter", updates))
        .groupBy(F.to_date("validafter").alias("date"))
        .agg(F.count(F.lit(1)).alias("count"), *[F.sum(n).alias(n) for n in names])
        .where("running > 0")
    )
    if per_day is not None:
        days = days.drop("count").join(per_day.select("date", "count"), "date")
    return days.select("date", *[int_div(F.col(n), F.col("count")).alias(f"avg_{n}") for n in names])


def network_size_hour(status, updates=None):
    """The same counts per consensus, undivided."""
    counts = _consensus_counts(_limited(status, "validafter", updates)).where("running > 0")
    return counts.select(
        "validafter", *[F.col(n).alias(f"avg_{n}") for n in ("running", "exit", "guard", "fast", "stable")]
    )


_DESCRIBED = ("platform", "bandwidthavg", "bandwidthburst", "bandwidthobserved")


def running_descriptors(status, descriptor, updates=None):
    """Running entries counted by date and descriptor, with what the daily tables take from it."""
    return _running_descriptors(status, descriptor.select("descriptor", *_DESCRIBED), updates)


def _running_descriptors(status, descriptor, updates):
    """Running entries counted by date and descriptor, with the descriptor's columns if known.

    Entries are counted before they are joined.
    """
    counted = (
        _limited(status, "validafter", updates)
        .where("isrunning")
        .groupBy(F.to_date("validafter").alias("date"), "descriptor")
        .agg(F.count(F.lit(1)).alias("entries"))
    )
    return counted.join(descriptor, "descriptor", "left")


def _days(status, per_day, updates):
    return relay_statuses_per_day(status, updates) if per_day is None else per_day


def relay_platforms(status, descriptor, per_day=None, updates=None, running=None):
    """Average running relays per date by operating system; unknown platforms count in none.

    ``running``, the output of ``running_descriptors``, spares the join.
    """
    if running is None:
        running = _running_descriptors(status, descriptor.select("descriptor", "platform"), updates)
    platform = F.col("platform")
    systems = {"linux": "%Linux%", "darwin": "%Darwin%", "bsd": "%BSD%", "windows": "%Windows%"}
    other = ~(
        platform.like("%Windows%") | platform.like("%Darwin%")
        | platform.like("%BSD%") | platform.like("%Linux%")
    )
    tests = {name: platform.like(pattern) for name, pattern in systems.items()} | {"other": other}
    days = (
        running.groupBy("date")
        .agg(*[F.sum(F.when(t, F.col("entries")).otherwise(0)).alias(n) for n, t in tests.items()])
        .join(_days(status, per_day, updates), "date")
    )
    return days.select("date", *[int_div(F.col(n), F.col("count")).alias(f"avg_{n}") for n in tests])


def relay_versions(status, descriptor, per_day=None, updates=None, running=None):
    """Average running relays per date and software version."""
    if running is None:
        known = descriptor.select("descriptor", "platform").where("platform IS NOT NULL")
        running = _running_descriptors(status, known, updates)
    counted = (
        running.where("platform IS NOT NULL")
        .groupBy("date", F.substring("platform", 5, 5).alias("version"))
        .agg(F.sum("entries").alias("entries"))
        .join(_days(status, per_day, updates), "date")
    )
    return counted.select("date", "version", int_div(F.col("entries"), F.col("count")).alias("relays"))


def total_bandwidth(status, descriptor, per_day=None, updates=None, running=None):
    """Average total bandwidth per date; null where no descriptor of the date is known."""
    columns = ("bandwidthavg", "bandwidthburst", "bandwidthobserved")
    joined = running
    if running is None:
        joined = _running_descriptors(status, descriptor.select("descriptor", *columns), updates)
    measures = {
        "bwavg": F.col("bandwidthavg"),
        "bwburst": F.col("bandwidthburst"),
        "bwobserved": F.col("bandwidthobserved"),
        "bwadvertised": F.least("bandwidthavg", "bandwidthobserved"),
    }
    days = (
        joined.groupBy("date")
        .agg(
            *[
                F.sum(m.cast("decimal(20,0)") * F.col("entries").cast("decimal(18,0)")).alias(n)
                for n, m in measures.items()
            ]
        )
        .join(_days(status, per_day, updates), "date")
    )
    return days.select(
        "date", *[round_div(big(n), F.col("count").cast("decimal(18,0)")).alias(n) for n in measures]
    )


_BYTES = ("read", "written", "dirread", "dirwritten")


def history_by_relay(bwhist, updates=None):
    """Bytes per relay and date; an interval repeated in several documents counts once."""
    distinct = (
        _limited(bwhist, "intervalend", updates)
        .select("fingerprint", "intervalend", *_BYTES)
        .distinct()
    )
    return distinct.groupBy("fingerprint", F.to_date("intervalend").alias("date")).agg(
        *[F.sum(big(c)).alias(c) for c in _BYTES]
    )


def total_bwhist(bwhist, updates=None):
    """Total bytes per date; directory bytes scaled up to the relays that do not report them."""
    days = history_by_relay(bwhist, updates).groupBy("date").agg(
        *[F.sum(c).alias(c) for c in _BYTES],
        sum_when(F.col("dirwritten").isNotNull(), F.col("written")).alias("_written"),
        sum_when(F.col("dirread").isNotNull(), F.col("read")).alias("_read"),
    )
    total = big("written") + big("read")
    reporting = F.lit(1) + big("_written") + big("_read")
    scaled = lambda c: round_div(
        (F.col(c).cast("decimal(38,0)") * total).cast("decimal(38,0)"), reporting.cast("decimal(38,0)")
    )
    return days.select(
        "date",
        F.col("read").cast("bigint").alias("read"),
        F.col("written").cast("bigint").alias("written"),
        scaled("dirread").alias("dirread"),
        scaled("dirwritten").alias("dirwritten"),
    )


def _day_shares(dirreq):
    """Each observation with the seconds that fall on its last date and on the date before."""
    dirreq = dirreq.drop("date")
    today = F.to_date("statsend")
    since_midnight = seconds_between(F.col("statsend"), today)
    return dirreq.withColumn(
        "_shares",
        F.array(
            F.struct(today.alias("date"), F.least(since_midnight, F.col("seconds").cast("bigint")).alias("share")),
            F.struct(
                F.date_sub(today, 1).alias("date"),
                (F.col("seconds") - since_midnight).cast("bigint").alias("share"),
            ),
        ),
    ).select(
        *dirreq.columns,
        F.posexplode_outer("_shares").alias("_back", "_s"),
    ).where("_back = 0 OR _s.share > 0").select(*dirreq.columns, "_s.date", "_s.share")


def dirreq_split(dirreq):
    """Requests by relay, date and country, split over the two dates of an interval.

    Equal parts of one relay merge before they are summed.
    """
    parts = _day_shares(dirreq).select(
        F.lower(F.col("source").cast("string")).alias("fingerprint"),
        "date",
        "country",
        F.floor(F.col("requests") * F.col("share").cast("double") / F.col("seconds")).alias("requests"),
    )
    return parts.distinct().groupBy("fingerprint", "date", "country").agg(
        F.sum("requests").alias("requests")
    )


def relay_attributes(status, updates=None):
    """Per relay and date: entries with an open directory port and with the authority flag.

    Both are null if there are none; ``ismirror`` tells whether the relay was
    listed without the authority flag.
    """
    return (
        _limited(status, "validafter", updates)
        .groupBy(F.col("fingerprint").cast("string").alias("fingerprint"), F.to_date("validafter").alias("date"))
        .agg(
            F.sum(F.when(F.col("dirport") > 0, 1)).alias("opendirport"),
            F.sum(F.when(F.col("isauthority"), 1)).alias("authority"),
            F.coalesce(F.bool_or(~F.col("isauthority")), F.lit(False)).alias("ismirror"),
        )
    )


def reporting_relays(dirreq, updates=None):
    """Relays and dates touched by an all-countries observation."""
    days = _day_shares(dirreq.where(F.col("country") == ALL_COUNTRIES)).select(
        F.lower(F.col("source").cast("string")).alias("fingerprint"), "date"
    )
    return _limited(days, "date", updates).distinct().withColumn("requests", F.lit(1).cast("bigint"))


def user_stats(status, bwhist, dirreq, updates=None):
    """Directory requests and byte sums by date and country.

    The byte sums do not depend on the country, so they are summed per date
    and not per date and country.  Each fact table is read once: all three are
    brought to one row per relay and date, with the few countries of a relay
    packed in an array, joined on that key, and summed in one aggregation in
    which the byte counts stand on rows without a country.
    """
    if updates is not None:
        # An interval reaches the date of its end and the date before.
        ends = updates.select(F.explode(F.array("date", F.date_add("date", 1))).alias("date"))
        dirreq = only_dates(dirreq, "statsend", ends)
    key = ["fingerprint", "date"]
    requests = (
        dirreq_split(dirreq)
        .where("country IS NOT NULL")
        .groupBy(*key)
        .agg(
            F.collect_list(F.struct("country", "requests")).alias("_requests"),
            F.bool_or(F.col("country") == ALL_COUNTRIES).alias("_asked"),
        )
    )
    history = history_by_relay(
        bwhist.withColumn("fingerprint", F.col("fingerprint").cast("string")), updates
    )
    relays = history.join(requests, key, "full").join(relay_attributes(status, updates), key, "left")

    nothing = F.struct(
        F.lit(None).cast("string").alias("country"), F.lit(None).cast("bigint").alias("requests")
    )
    counted_requests = F.when(F.col("ismirror"), F.col("_requests"))
    rows = relays.select(
        *[c for c in relays.columns if c != "_requests"],
        F.inline_outer(
            F.concat(F.array(nothing), F.coalesce(counted_requests, F.array().cast("array<struct<country:string,requests:bigint>>")))
        ),
    )
    is_relay = F.col("country").isNull() & F.col("authority").isNull()
    asked = F.coalesce(F.col("_asked"), F.lit(False))
    counted = F.col("dirwritten").isNotNull()
    open_port = F.col("opendirport").isNotNull()
    always = F.lit(True)
    measures = {
        "dw": (always, "dirwritten"), "dr": (always, "dirread"),
        "drw": (asked, "dirwritten"), "drr": (asked, "dirread"),
        "bw": (always, "written"), "br": (always, "read"),
        "bwd": (counted, "written"), "brd": (counted, "read"),
        "bwr": (asked, "written"), "brr": (asked, "read"),
        "bwdr": (counted & asked, "written"), "brdr": (counted & asked, "read"),
        "bwp": (open_port, "written"), "brp": (open_port, "read"),
        "bwn": (~open_port, "written"), "brn": (~open_port, "read"),
    }
    sums = rows.groupBy("date", "country").agg(
        F.sum("requests").alias("r"),
        *[sum_when(is_relay & test, F.col(c)).cast("bigint").alias(n) for n, (test, c) in measures.items()],
    )
    # One row per country and date is left; the row without a country carries the byte sums.
    same_date = Window.partitionBy("date")
    return sums.select(
        "date", "country", "r", *[F.max(n).over(same_date).alias(n) for n in measures]
    ).where("country IS NOT NULL")


def tutorial_running_exit(status):
    """Listed and exit relays per day, averaged over consensuses, in date order."""
    days = (
        status.groupBy("validafter")
        .agg(F.count(F.lit(1)).alias("n"), count_when(F.col("isexit")).alias("exits"))
        .groupBy(F.to_date("validafter").alias("date"))
        .agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("n"), F.sum("exits").alias("exits"))
    )
    return days.select(
        "date",
        int_div(F.col("n"), F.col("count")).alias("avg_running"),
        int_div(F.col("exits"), F.col("count")).alias("avg_exit"),
    ).orderBy("date")


def tutorial_versions(status, descriptor):
    """Listed relays per day and version; unknown descriptors have a null version, last in its day."""
    counted = (
        status.groupBy(F.to_date("validafter").alias("date"), "descriptor")
        .agg(F.count(F.lit(1)).alias("entries"))
        .join(descriptor.select("descriptor", "platform"), "descriptor", "left")
        .groupBy("date", F.substring("platform", 5, 5).alias("version"))
        .agg(F.sum("entries").alias("entries"))
        .join(relay_statuses_per_day(status), "date")
    )
    return counted.select(
        "date", "version", int_div(F.col("entries"), F.col("count")).alias("count")
    ).orderBy("date", F.asc_nulls_last("version"))
