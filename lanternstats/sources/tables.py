"""Stored tables and the CSV files of intermediate results."""

from pyspark.sql import functions as F

from lanternstats import schemas
from lanternstats.plans.summaries import repair_overflow

ALL = "all"
ALL_COUNTRIES = "zy"

# Columns of the intermediate CSV files (fixed values).
RELAY_COUNTS = "validafter timestamp_ntz, exit bigint, fast bigint, guard bigint, running bigint, stable bigint"
BRIDGE_COUNTS = "validafter timestamp_ntz, brunning bigint"
DAILY_COUNTS = (
    "date date, exit bigint, fast bigint, guard bigint, running bigint, stable bigint, brunning bigint"
)
TIMINGS_RAW = "source string, date date, start string, completemillis bigint"


def read_fixed_csv(spark, path, schema):
    """A CSV file with a header and known columns; ``NA`` is null, rows of another width are dropped."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("nullValue", "NA")
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", "false")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def read_daily_counts(spark, path):
    """Stored daily averages as a relay table and a bridge table, gaps dropped."""
    days = read_fixed_csv(spark, path, DAILY_COUNTS)
    relays = days.drop("brunning").where(
        "NOT (exit IS NULL AND fast IS NULL AND guard IS NULL AND running IS NULL AND stable IS NULL)"
    )
    return relays, days.select("date", "brunning").where("brunning IS NOT NULL")


def read_raw_timings(spark, path):
    """Stored download times with the integer overflow of old results repaired."""
    rows = read_fixed_csv(spark, path, TIMINGS_RAW)
    return rows.select(
        "source",
        F.try_to_timestamp(
            F.concat_ws(" ", F.date_format("date", "yyyy-MM-dd"), "start"), F.lit("yyyy-MM-dd HH:mm:ss")
        ).cast("timestamp_ntz").alias("started"),
        repair_overflow(F.col("completemillis")).alias("completemillis"),
    )


def read_wide_csv(spark, path, key, value, column="country"):
    """A CSV file with one column per country, melted to rows; ``NA`` cells give no row.

    The heading ``all`` becomes the country ``zy``.  Rows narrower or wider
    than the header are dropped.
    """
    # Only the header is looked at to learn the columns; every cell is read as text.
    wide = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    columns = [c for c in wide.columns if c not in key]
    strict = (
        spark.read.schema(wide.schema)
        .option("header", "true")
        .option("nullValue", "NA")
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", "false")
        .csv(path)
    )
    long = strict.unpivot(list(key), columns, column, value).where(F.col(value).isNotNull())
    return long.withColumn(
        column, F.when(F.col(column) == ALL, ALL_COUNTRIES).otherwise(F.col(column))
    )


def read_table(spark, path, name=None):
    """A stored Parquet table; known tables get their fixed schema."""
    schema = getattr(schemas, name.upper(), None) if name else None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_jdbc_table(spark, url, table, properties=None):
    """A table of an existing database, through Spark's own reader."""
    return spark.read.jdbc(url, table, properties=properties or {})
