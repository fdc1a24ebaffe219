"""Text logs: download timings, package requests, IP-range files."""

from pyspark.sql import functions as F

from lanternstats.functions import text as tx
from lanternstats.plans.summaries import completion_millis

TIMING_FIELDS = 20
UNIT_BYTES = {"kb": 1024, "mb": 1024 * 1024}


def _text_files(spark, folder, glob=None):
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(folder).select(
        "value",
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        # Rises along the lines of one block; with name and block it orders the lines of a file.
        F.monotonically_increasing_id().alias("line_no"),
    )


def timing_lines(lines, corrected=False):
    """Download times from lines of 20 numbers (``value, name, block, line_no``).

    The file name gives the source and the expected size; lines of failed or
    incomplete downloads are dropped.  Of several downloads started in the same
    second by a source, the first line counts.
    """
    parts = F.split("value", " ")
    size = F.regexp_extract("name", "^[^-]*-(\\d+)(kb|mb)\\.data$", 1).try_cast("bigint")
    unit = F.regexp_extract("name", "(kb|mb)\\.data$", 1)
    factor = F.when(unit == "kb", UNIT_BYTES["kb"]).when(unit == "mb", UNIT_BYTES["mb"])
    number = lambda n: F.try_element_at(F.col("_parts"), F.lit(n + 1)).try_cast("bigint")
    rows = (
        lines.withColumn("_parts", parts)
        .withColumn("_expected", size * factor)
        .where(
            (F.size("_parts") == TIMING_FIELDS)
            & (F.length(F.col("_parts")[0]) == 10)
            & (F.col("_parts")[16] != "0")
        )
        .where(number(19) > F.col("_expected"))
        .select(
            F.substring_index("name", ".", 1).alias("source"),
            F.timestamp_seconds(number(0)).cast("timestamp_ntz").alias("started"),
            completion_millis(number(0), number(1), number(16), number(17), corrected).alias("completemillis"),
            F.struct("name", "block", "line_no").alias("_order"),
        )
    )
    return rows.groupBy("source", "started").agg(
        F.min_by("completemillis", "_order").alias("completemillis")
    )


def scan_timings(spark, folder, corrected=False):
    return timing_lines(_text_files(spark, folder), corrected)


def package_lines(lines):
    """Requests by date and bundle from ``date x bundle:count …`` lines.

    ``lines`` has ``value, name, block, line_no``; the last line of a date
    replaces earlier ones.
    """
    parts = F.split("value", " ")
    latest = (
        lines.where(F.col("value") != "")
        .groupBy(parts[0].alias("_date"))
        .agg(F.max_by("value", F.struct("name", "block", "line_no")).alias("value"))
        .withColumn("_parts", parts)
    )
    pairs = F.slice("_parts", F.lit(3), F.greatest(F.size("_parts") - 2, F.lit(0)))
    rows = latest.select(F.to_date("_date").alias("date"), F.posexplode(pairs).alias("_no", "_pair")).select(
        "date",
        "_no",
        F.lower(tx.field(F.col("_pair"), 0, ":")).alias("bundle"),
        tx.to_long(tx.field(F.col("_pair"), 1, ":")).alias("downloads"),
    )
    return rows.groupBy("date", "bundle").agg(F.max_by("downloads", "_no").alias("downloads"))


def scan_packages(spark, folder):
    return package_lines(_text_files(spark, folder))


def scan_ip_ranges(spark, folder, known_versions=None):
    """Ranges of ``GeoIP-108_YYYYMMDD.csv`` files; versions already known are skipped."""
    lines = _text_files(spark, folder, "GeoIP-108_????????.csv")
    rows = lines.where(
        ~F.col("value").startswith("Copyright") & ~F.col("value").startswith('"begin')
    ).select(
        F.substring("name", len("GeoIP-108_") + 1, 8).alias("version"),
        F.split(F.regexp_replace("value", '"', ""), ",").alias("_parts"),
    )
    if known_versions is not None:
        rows = rows.join(known_versions.select("version").distinct(), "version", "left_anti")
    at = lambda n: F.try_element_at(F.col("_parts"), F.lit(n + 1))
    return rows.select(
        "version",
        at(2).try_cast("bigint").alias("from_ip"),
        at(3).try_cast("bigint").alias("to_ip"),
        at(4).alias("country"),
    ).where("from_ip IS NOT NULL AND to_ip IS NOT NULL")
