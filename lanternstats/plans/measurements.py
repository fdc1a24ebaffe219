"""Stored download timings and package requests: a batch changes only the groups that it touches."""

from pyspark.sql import functions as F

from lanternstats.plans import keyed_tables, summaries
from lanternstats.plans.warehouse import exists, upsert_table

TIMINGS = "source string, started timestamp_ntz, completemillis bigint"


def raw_timings(spark, root):
    path = f"{root}/raw/timings"
    if not exists(spark, path):
        return spark.createDataFrame([], f"{TIMINGS}, date date")
    return spark.read.schema(f"{TIMINGS}, date date").parquet(path)


def update_timings(spark, root, rows):
    """Add parsed timings (``source, started, completemillis``) and renew the quartiles of their sources and dates.

    Of two downloads of a source in the same second the one stored first counts.  Raw timings are kept by date; quartiles are
    computed for the (source, date) of the batch only and merged into the stored table.  Returns how many rows of the
    dates concerned were inserted, updated, unchanged or kept.  A batch that fails is run again: timings that it had
    stored are not stored twice, and its groups are renewed all the same.
    """
    staging = f"{root}/staging/timings"
    batch = rows.select("source", "started", "completemillis").withColumn("date", F.to_date("started"))
    batch.write.mode("overwrite").parquet(f"{staging}/parsed")
    batch = spark.read.schema(f"{TIMINGS}, date date").parquet(f"{staging}/parsed")
    days = [r[0] for r in batch.select("date").distinct().collect()]
    stored = raw_timings(spark, root).where(F.col("date").isin(days))
    new = keyed_tables.insert_if_absent(batch, stored, ["source", "started"])
    new.write.mode("overwrite").parquet(f"{staging}/new")
    new = spark.read.schema(f"{TIMINGS}, date date").parquet(f"{staging}/new")
    new.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(f"{root}/raw/timings")
    touched = batch.select("source", "date").distinct()
    groups = raw_timings(spark, root).where(F.col("date").isin(days)).join(touched, ["source", "date"], "left_semi")
    quartiles = summaries.timing_quartiles(groups.drop("date"))
    return upsert_table(spark, root, "timing_stats", quartiles.select("source", "q1", "md", "q3", "date"), ["date", "source"], "date")


def update_packages(spark, root, rows):
    """Merge parsed package requests (``date, bundle, downloads``): a later count of a date and bundle replaces the stored one."""
    counts = rows.select("bundle", "downloads", "date")
    return upsert_table(spark, root, "package_stats", counts, ["date", "bundle"], "date")
