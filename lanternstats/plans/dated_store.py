"""Tables of which a batch replaces whole dates, seen by readers only once the batch is committed.

Rows lie in folders by batch and date.  The commit table says which batch holds the rows of a date, so a batch that
fails is never seen and is run again, and no table is read while it is overwritten.
"""

from pyspark.sql import functions as F

from lanternstats.plans.warehouse import exists, stored_table

#: Rows whose time cannot be read have this date.
UNDATED = "1970-01-01"


def date_of(column):
    return F.coalesce(F.try_to_timestamp(F.col(column).cast("string")).cast("date"), F.lit(UNDATED).cast("date"))


def dates_of(*frames):
    """The dates of the frames' column ``date``: one a calendar day at most."""
    rows = frames[0].select("date")
    for frame in frames[1:]:
        rows = rows.unionByName(frame.select("date"))
    return sorted(r[0] for r in rows.distinct().collect())


class DatedStore:
    def __init__(self, spark, root, tables):
        """``tables``: for each name its columns, without ``date``, and the column that dates its rows."""
        self.spark, self.root, self.tables = spark, root, tables

    def read(self, name, dates=None, before=None):
        """The rows of a table as committed, of some ``dates`` only, or as they were ``before`` a batch."""
        columns, _ = self.tables[name]
        commits = stored_table(self.spark, f"{self.root}/commits")
        if commits is None or not exists(self.spark, f"{self.root}/{name}"):
            # A limit of none is known to be empty when the plan is made.
            return self.spark.createDataFrame([], f"{columns}, date date").limit(0)
        commits = commits.where(F.col("table") == name)
        if before is not None:
            commits = commits.where(F.col("batch") < before)
        rows = self.spark.read.schema(f"{columns}, batch bigint, date date").parquet(f"{self.root}/{name}")
        if dates is not None:
            rows, commits = rows.where(F.col("date").isin(dates)), commits.where(F.col("date").isin(dates))
        current = commits.groupBy("date").agg(F.max("batch").alias("batch"))
        return rows.join(current, ["batch", "date"], "left_semi").drop("batch")

    def write(self, batch, name, rows, placed=()):
        """The rows of a batch in their table; readers do not see them before ``commit``.

        ``placed`` are frames of further rows of which every task has few dates already.
        """
        columns, time = self.tables[name]
        path = f"{self.root}/{name}/batch={batch}"
        # Few files a date, and no task with all of a large one.
        dated = lambda rows: rows.drop("date").withColumn("date", date_of(time)) if time != "date" else rows
        frame = dated(rows).hint("rebalance", "date")
        for more in placed:
            frame = frame.unionByName(dated(more))
        frame.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy("date").parquet(path)
        return self.spark.read.schema(f"{columns}, date date").parquet(path)

    def stage(self, batch, name, rows):
        """Rows that a batch needs more than once."""
        path = f"{self.root}/staging/batch={batch}/{name}"
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self, batch, touched):
        """Make the batch the current one for all (table, date) in ``touched`` at once."""
        if touched:
            rows = [(name, batch, day) for name, day in touched]
            done = self.spark.createDataFrame(rows, "table string, batch bigint, date date")
            done.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
