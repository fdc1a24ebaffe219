"""Statistics that are not based on relay facts, and daily averages with completeness gates."""

from pyspark.sql import functions as F

from lanternstats.functions.numbers import int_div
from lanternstats.operators.order_statistics import select_by_rank

MIN_CONSENSUSES = 12
MIN_BRIDGE_STATUSES = 24
MIN_TIMINGS = 4
OVERFLOW = 100_000_000


def _gated_averages(counts, names, minimum):
    days = counts.groupBy(F.to_date("validafter").alias("date")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in names]
    )
    return days.where(F.col("_n") >= minimum).select(
        "date", *[int_div(F.col(n), F.col("_n")).alias(n) for n in names]
    )


def relay_daily_averages(counts, minimum=MIN_CONSENSUSES):
    """Average relays per date and flag, for dates with at least half of all consensuses."""
    return _gated_averages(counts, ["exit", "fast", "guard", "running", "stable"], minimum)


def bridge_daily_averages(counts, minimum=MIN_BRIDGE_STATUSES):
    """Average running bridges per date, for dates with at least half of all statuses."""
    return _gated_averages(counts, ["brunning"], minimum)


def relays_and_bridges(relays, bridges):
    """Both averages for every date from the first to the last; gaps are null."""
    span = relays.select("date").union(bridges.select("date")).agg(
        F.min("date").alias("_from"), F.max("date").alias("_to")
    )
    dates = span.where("_from IS NOT NULL").select(
        F.explode(F.sequence("_from", "_to", F.make_dt_interval(days=F.lit(1)))).alias("date")
    )
    return dates.join(relays, "date", "left").join(bridges, "date", "left")


def latest_observations(observations):
    """One observation per bridge and date: all countries of the latest time.

    The latest times are found by aggregation and matched on bridge and time,
    so the many observations of one bridge spread over their times.
    """
    latest = observations.groupBy("bridge", "date").agg(F.max("seen").alias("seen"))
    return observations.join(latest, ["bridge", "date", "seen"], "left_semi")


def bridge_users_by_day(observations, hashed_relays, broken):
    """Users by date and country over bridges that are no relays and run no broken version.

    Negative observations do not count.
    """
    kept = (
        latest_observations(observations)
        .join(hashed_relays.select(F.col("hashed_relay").alias("bridge")).distinct(), "bridge", "left_anti")
        .join(broken.select("bridge", "seen").distinct(), ["bridge", "seen"], "left_anti")
        .where("users >= 0")
    )
    return kept.groupBy("date", "country").agg(F.sum("users").alias("users"))


def bridge_stats_rows(daily_users):
    """Whole users for the stored table; less than one user gives no row."""
    return daily_users.withColumn("users", F.col("users").cast("bigint")).where("users >= 1")


def completion_millis(start_s, start_us, end_s, end_us, corrected=False):
    """Download time in milliseconds.

    The start's microseconds are added, as in all stored results; with
    ``corrected`` they are subtracted.
    """
    thousand = F.lit(1000).cast("bigint")
    start_part = int_div(start_us, thousand)
    whole = end_s * 1000 + int_div(end_us, thousand) - start_s * 1000
    return whole - start_part if corrected else whole + start_part


def repair_overflow(millis):
    """Undo the integer overflow of old stored results."""
    return F.when(millis < 0, millis + OVERFLOW).otherwise(millis)


def timing_quartiles(timings, minimum=MIN_TIMINGS):
    """Quartiles of download times by source and date, for more than ``minimum`` downloads.

    The positions are n/4-1, n/2-1 and 3n/4-1, counted from 0 with whole-number division.
    """
    enough = lambda n, position: F.when(n > minimum, position)
    quarter = lambda n, k: int_div(n * k, F.lit(4).cast("bigint")) - 1
    quartiles = select_by_rank(
        timings.withColumn("date", F.to_date("started")),
        ["source", "date"],
        "completemillis",
        {
            "q1": lambda n: enough(n, quarter(n, 1)),
            "md": lambda n: enough(n, int_div(n, F.lit(2).cast("bigint")) - 1),
            "q3": lambda n: enough(n, quarter(n, 3)),
        },
    )
    return quartiles


def last_observation(observations, source, time):
    """The latest time seen from each source."""
    return observations.groupBy(source).agg(F.max(time).alias("last_seen"))


def wide(rows, key, column, value, columns=None, rename=None):
    """One column per country or bundle, in name order, nulls where nothing was reported.

    ``columns`` saves the pass that finds the names; ``rename`` maps a name to
    its heading.
    """
    grouped = rows.groupBy(*key)
    pivoted = grouped.pivot(column, columns) if columns else grouped.pivot(column)
    table = pivoted.agg(F.first(value))
    for old, new in (rename or {}).items():
        if old in table.columns:
            table = table.withColumnRenamed(old, new)
    return table
