"""Countries of IP addresses: version choice, range lookup, overlay of versions.

Ranges are ``(version, from_ip, to_ip, country)`` with addresses as whole
numbers.  A block is the 2**16 addresses sharing their upper half, so a block
of one version holds at most 2**16 distinct addresses or range starts however
large the input is, and there are at most 2**16 blocks.
"""

from pyspark.sql import Window, functions as F

from lanternstats.functions.text import bind

BLOCK_BITS = 16
BLOCK = 1 << BLOCK_BITS
UNKNOWN = "ZZ"
# Country codes that do not name a country (fixed values; lower case, so that upper-case codes pass).
UNRESOLVED = ["--", "a1", "a2", "eu", "ap"]


def ip_number(address):
    """Dotted address to number; null if malformed."""
    parts = F.split(address, r"\.")
    octet = lambda n: F.try_element_at(parts, F.lit(n)).try_cast("bigint")
    return ((octet(1) * 256 + octet(2)) * 256 + octet(3)) * 256 + octet(4)


def choose_version(lookups, ranges, day, days_earlier=0):
    """Add ``version``: that of the date, else the latest before, else the first known.

    ``day`` is a column ``yyyyMMdd``.  Versions are named by date, so the sorted
    list held in a scalar subquery has at most one entry per calendar date.
    """
    known = ranges.agg(F.array_sort(F.collect_set("version")).alias("v")).scalar()
    wanted = F.col(day)
    if days_earlier:
        wanted = F.date_format(
            F.date_sub(F.to_date(wanted, "yyyyMMdd"), days_earlier), "yyyyMMdd"
        )
    dated = bind(lookups, _known=known, _wanted=wanted)
    chosen = F.coalesce(
        F.try_element_at(F.filter("_known", lambda v: v <= F.col("_wanted")), F.lit(-1)),
        F.try_element_at("_known", F.lit(1)),
    )
    return bind(dated, version=chosen).drop("_known", "_wanted")


def disjoint_pieces(ranges):
    """Ranges cut at block borders, disjoint within a version: the later start wins."""
    blocks = F.explode(F.sequence(F.shiftright("from_ip", BLOCK_BITS), F.shiftright("to_ip", BLOCK_BITS)))
    cut = ranges.select("version", "from_ip", "to_ip", "country", blocks.alias("block")).select(
        "version",
        "block",
        F.greatest("from_ip", F.col("block") * BLOCK).alias("from_ip"),
        F.least("to_ip", F.col("block") * BLOCK + (BLOCK - 1)).alias("to_ip"),
        "country",
        F.col("from_ip").alias("_start"),
    )
    one_per_start = cut.groupBy("version", "block", "from_ip").agg(
        F.max_by(F.struct("to_ip", "country"), F.struct("_start", "to_ip")).alias("_p")
    ).select("version", "block", "from_ip", "_p.*")
    following = F.lead("from_ip").over(Window.partitionBy("version", "block").orderBy("from_ip"))
    return one_per_start.withColumn(
        "to_ip", F.least("to_ip", F.coalesce(following - 1, F.col("to_ip")))
    )


def lookup_country(lookups, ranges, fill_gaps=False, any_case=False):
    """Add ``country`` to rows with ``version`` and ``ip``; ``ZZ`` if no range holds the address.

    Each distinct address is resolved once in its block and joined back.
    ``fill_gaps`` is the old form, see ``_segment_before``.  Codes that name no
    country give ``ZZ``: as they are written in ``UNRESOLVED``, or with
    ``any_case`` in upper case too.
    """
    keyed = lookups.withColumn("block", F.shiftright("ip", BLOCK_BITS))
    asked = keyed.select("version", "block", "ip").distinct()
    if fill_gaps:
        segments = overlay_ranges(ranges)
        found = _segment_before(asked, segments.select("from_ip").distinct()).join(
            segments.select("from_ip", "version", "country"), ["from_ip", "version"]
        ).select("version", "block", "ip", "country")
    else:
        found = _resolve(asked, disjoint_pieces(ranges))
    rows = keyed.join(found, ["version", "block", "ip"], "left")
    country = F.col("country")
    unresolved = (F.lower(country) if any_case else country).isin(UNRESOLVED)
    return rows.withColumn(
        "country", F.when(country.isNull() | unresolved, UNKNOWN).otherwise(country)
    ).drop("block")


def _segment_before(asked, starts):
    """Add ``from_ip``: the last segment of any version that starts at or before the address.

    The old form cuts the ranges of all versions into segments and does not
    look where one ends.  An address between segments belongs to the one before
    it, which is ``ZZ`` in the versions that do not cover it.
    """
    marks = asked.select("version", "block", "ip", F.lit(None).cast("bigint").alias("_from")).unionByName(
        starts.select(
            F.lit(None).cast("string").alias("version"), F.shiftright("from_ip", BLOCK_BITS).alias("block"),
            F.col("from_ip").alias("ip"), F.col("from_ip").alias("_from"),
        )
    )
    before = Window.partitionBy("block").orderBy("ip", F.col("_from").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = marks.withColumn("_last", F.max("_from").over(before)).where("_from IS NULL")
    # The last start of each block, carried to later blocks: at most 2**16 rows.
    last = marks.groupBy("block").agg(F.max("_from").alias("_top"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("block", F.max("_top").over(earlier).alias("_carried"))
    return inside.join(carried, "block", "left").select(
        "version", "block", "ip", F.coalesce("_last", "_carried").alias("from_ip")
    )


def _resolve(addresses, pieces):
    """Country of distinct addresses: the last piece at or before each in its block, if it reaches."""
    marks = pieces.select(
        "version", "block", F.col("from_ip").alias("ip"),
        F.struct("to_ip", "country").alias("_piece"), F.lit(False).alias("_asked"),
    ).unionByName(
        addresses.select(
            "version", "block", "ip",
            F.lit(None).cast("struct<to_ip:bigint,country:string>").alias("_piece"),
            F.lit(True).alias("_asked"),
        )
    )
    before = (
        Window.partitionBy("version", "block").orderBy("ip", "_asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marks.withColumn("_last", F.last("_piece", ignorenulls=True).over(before))
        .where("_asked")
        .select(
            "version", "block", "ip",
            F.when(F.col("_last.to_ip") >= F.col("ip"), F.col("_last.country")).alias("country"),
        )
    )


def overlay_ranges(ranges):
    """Disjoint segments over all versions: one row per segment and version that covers it.

    The next border of a segment is found inside its block or, for the last
    border of a block, among the first borders of later blocks.
    """
    borders = (
        ranges.select(F.explode(F.array(F.col("from_ip"), F.col("to_ip") + 1)).alias("from_ip"))
        .distinct()
        .withColumn("_block", F.shiftright("from_ip", BLOCK_BITS))
    )
    first = borders.groupBy("_block").agg(F.min("from_ip").alias("_first")).withColumn(
        "_next_first", F.lead("_first").over(Window.partitionBy(F.lit(0)).orderBy("_block"))
    )
    segments = (
        borders.withColumn(
            "_next", F.lead("from_ip").over(Window.partitionBy("_block").orderBy("from_ip"))
        )
        .join(first.select("_block", "_next_first"), "_block")
        .withColumn("to_ip", F.coalesce("_next", "_next_first") - 1)
        .where("to_ip IS NOT NULL")
        .select("from_ip", "to_ip")
    )
    versions = ranges.agg(F.array_sort(F.collect_set("version")).alias("v")).scalar()
    asked = segments.select(
        "to_ip", F.col("from_ip").alias("ip"),
        F.shiftright("from_ip", BLOCK_BITS).alias("block"), F.explode(versions).alias("version"),
    )
    covered = _resolve(asked.select("version", "block", "ip").distinct(), disjoint_pieces(ranges))
    return (
        segments.join(
            covered.where("country IS NOT NULL").select(F.col("ip").alias("from_ip"), "version", "country"),
            "from_ip",
        )
    )


def overlay_table(ranges):
    """The overlay with one country column per version, ``ZZ`` where a version has none."""
    wide = overlay_ranges(ranges).groupBy("from_ip", "to_ip").pivot("version").agg(F.first("country"))
    return wide.select(
        "from_ip", "to_ip",
        *[F.coalesce(F.col(f"`{v}`"), F.lit(UNKNOWN)).alias(f"v{v}") for v in wide.columns[2:]],
    )
