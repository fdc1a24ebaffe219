"""Facts limited to dates.

Joins in this package carry no broadcast hint.  The optimizer broadcasts below
``spark.sql.autoBroadcastJoinThreshold``, by the sizes it sees at run time, and
otherwise shuffles, splitting skewed partitions.
"""

from pyspark.sql import functions as F


def date_list(updates):
    """Distinct dates of ``updates``.

    Spark prunes date-partitioned facts by a joined table only if that table is
    filtered; the comparison, true for every date, is that filter.
    """
    return updates.where(F.col("date") >= F.lit("0001-01-01").cast("date")).select("date").distinct()


def only_dates(facts, time_column, updates):
    """Rows of ``facts`` whose date is listed in ``updates`` (column ``date``).

    When ``facts`` has a physical ``date`` column it is used as it stands, so
    that the semi join prunes partitions.
    """
    dates = date_list(updates)
    if "date" in facts.columns:
        return facts.join(dates, "date", "left_semi")
    keyed = facts.withColumn("_date", F.to_date(time_column))
    return keyed.join(
        dates.withColumnRenamed("date", "_date"), "_date", "left_semi"
    ).drop("_date")
