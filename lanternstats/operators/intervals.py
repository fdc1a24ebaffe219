"""Statuses affected by changed descriptors."""

from pyspark.sql import functions as F

WINDOW_HOURS = 24  # the two-dates argument below holds for one day


def statuses_to_rewrite(statuses, changed, time="published"):
    """Statuses at most 24 hours after the publication of a changed descriptor, each once.

    A window of one day reaches a status from its own date or the date before:
    from its own date if the earliest change is not later, from the date
    before if the latest change is not too early.  So two numbers per date
    stand for all changes, no pairs are formed, and no status comes twice.
    """
    return _near_changes(statuses, changed, time, "inner").where("_hit").select(*statuses.columns)


def statuses_to_keep(statuses, changed, time="published"):
    """All other statuses, each once."""
    return _near_changes(statuses, changed, time, "left").where("NOT _hit").select(*statuses.columns)


def _near_changes(statuses, changed, time, how):
    days = changed.where(F.col(time).isNotNull()).groupBy(F.to_date(time).alias("_day")).agg(
        F.min(time).alias("_earliest"), F.max(time).alias("_latest")
    )
    same = days.select("_day", "_earliest")
    before = days.select(F.date_add("_day", 1).alias("_day"), "_latest")
    reach = F.col("validafter") - F.make_dt_interval(hours=F.lit(WINDOW_HOURS))
    hit = (F.col("_earliest") <= F.col("validafter")) | (F.col("_latest") >= reach)
    # One row a date, so statuses stay where they are.
    reached = F.broadcast(same.join(before, "_day", "full"))
    return statuses.withColumn("_day", F.to_date("validafter")).join(reached, "_day", how).withColumn("_hit", F.coalesce(hit, F.lit(False)))
