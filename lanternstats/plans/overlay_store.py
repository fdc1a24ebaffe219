"""The overlay of all versions of an IP-range file, stored and extended by one version at a time.

The overlay is a step function over the addresses: a mark is an address from which on a list of (version, country)
holds, up to the next mark.  Marks never reach beyond a block of 2**16 addresses; a range that covers the start of a
block is marked there again, with ``border`` false.  Adding a version merges its marks with the stored ones block by
block, and rewrites only the parts (2**24 addresses each) in which the version has a range.
"""

from pyspark.sql import Window, functions as F

from lanternstats.operators.ip_ranges import BLOCK, BLOCK_BITS, UNKNOWN, UNRESOLVED, disjoint_pieces
from lanternstats.plans.warehouse import exists, stored_table

PART_BITS = 24
_STATE = "array<struct<version:string,country:string>>"
MARKS = f"ip bigint, border boolean, state {_STATE}"


def _block(ip="ip"):
    return F.shiftright(ip, BLOCK_BITS)


def _part(ip="ip"):
    return F.shiftright(ip, PART_BITS).cast("int")


def version_marks(ranges):
    """Marks (ip, border, state) of one version; where its ranges overlap, the later start wins."""
    nothing = F.array().cast(_STATE)
    pieces = disjoint_pieces(ranges)
    starts = pieces.select(
        F.col("from_ip").alias("ip"), F.lit(False).alias("border"), F.array(F.struct("version", "country")).cast(_STATE).alias("on"), F.lit(None).cast(_STATE).alias("off")
    )
    # The end of a piece at the end of its block needs no mark: nothing holds at the start of the next one.
    ends = pieces.where((F.col("to_ip") + 1) % BLOCK != 0).select(
        (F.col("to_ip") + 1).alias("ip"), F.lit(False).alias("border"), F.lit(None).cast(_STATE).alias("on"), nothing.alias("off")
    )
    borders = ranges.select(F.explode(F.array(F.col("from_ip"), F.col("to_ip") + 1)).alias("ip")).select(
        "ip", F.lit(True).alias("border"), F.lit(None).cast(_STATE).alias("on"), F.lit(None).cast(_STATE).alias("off")
    )
    return starts.unionByName(ends).unionByName(borders).groupBy("ip").agg(
        F.max("border").alias("border"), F.coalesce(F.max("on"), F.max("off")).alias("state")
    )


def merge_marks(stored, new):
    """Marks of both step functions; each holds within its block from its own marks on."""
    none = F.lit(None).cast(_STATE)
    both = stored.select("ip", "border", F.col("state").alias("s"), none.alias("n")).unionByName(
        new.select("ip", "border", none.alias("s"), F.col("state").alias("n"))
    )
    rows = both.groupBy("ip").agg(F.max("border").alias("border"), F.max("s").alias("s"), F.max("n").alias("n"))
    so_far = Window.partitionBy(_block()).orderBy("ip").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.array().cast(_STATE))
    return rows.select("ip", "border", F.concat(held("s"), held("n")).alias("state"))


def known_versions(spark, root):
    """Versions of the stored overlay, in order: one a calendar date at most."""
    commits = stored_table(spark, f"{root}/commits")
    return [] if commits is None else sorted(r[0] for r in commits.select("version").distinct().collect())


def read_marks(spark, root, parts=None):
    """The stored marks, of some parts only if they are given."""
    commits = stored_table(spark, f"{root}/commits")
    if commits is None or not exists(spark, f"{root}/marks"):
        return spark.createDataFrame([], f"{MARKS}, part int")
    rows = spark.read.schema(f"{MARKS}, batch bigint, part int").parquet(f"{root}/marks")
    if parts is not None:
        rows, commits = rows.where(F.col("part").isin(parts)), commits.where(F.col("part").isin(parts))
    current = commits.groupBy("part").agg(F.max("batch").alias("batch"))
    return rows.join(F.broadcast(current), ["batch", "part"], "left_semi").drop("batch")


def add_version(spark, root, ranges):
    """Add ``ranges`` (version, from_ip, to_ip, country) of one version; false if that version is stored already.

    Only the parts that hold a border or a piece of the version, at most 257, are read and written; readers see
    them once they are committed together, so a run that fails is repeated.  ``add_versions`` takes several.
    """
    names = [r[0] for r in ranges.select("version").distinct().limit(2).collect()]
    if len(names) > 1:
        raise ValueError(f"one version at a time, not {names}")
    if not names or names[0] in known_versions(spark, root):
        return False
    commits = stored_table(spark, f"{root}/commits")
    batch = 1 if commits is None else 1 + commits.agg(F.max("batch")).first()[0]
    staging, path = f"{root}/staging", f"{root}/marks/batch={batch}"
    version_marks(ranges).withColumn("part", _part()).write.mode("overwrite").parquet(staging)
    new = spark.read.schema(f"{MARKS}, part int").parquet(staging)
    parts = sorted(r[0] for r in new.select("part").distinct().collect())
    merged = merge_marks(read_marks(spark, root, parts), new).withColumn("part", _part())
    merged.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(path)
    done = spark.createDataFrame([(batch, names[0], p) for p in parts], "batch bigint, version string, part int")
    done.coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return True


def add_versions(spark, root, ranges):
    """Add all versions of ``ranges`` that are not stored yet, the earliest first; returns them."""
    names = sorted(r[0] for r in ranges.select("version").distinct().collect())
    return [v for v in names if add_version(spark, root, ranges.where(F.col("version") == v))]


def segments(marks):
    """Disjoint segments (from_ip, to_ip, state) that some version covers.

    A segment that reaches into further blocks is put together again: in the first mark of a block that is no border
    it goes on from the last border before.  One row a block, 65,536 at most, tells where that is.
    """
    rows = marks.withColumn("block", _block())
    following = F.lead("ip").over(Window.partitionBy("block").orderBy("ip"))
    rows = rows.withColumn("to_ip", F.coalesce(following, (F.col("block") + 1) * BLOCK) - 1)
    covered = F.size("state") > 0
    last = rows.where("border").groupBy("block").agg(F.max("ip").alias("_last"))
    every = rows.select("block").distinct().join(last, "block", "left")
    before = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = every.select("block", F.last("_last", ignorenulls=True).over(before).alias("from_ip"))
    tails = rows.where(~F.col("border") & covered).join(heads, "block").groupBy("from_ip").agg(F.max("to_ip").alias("_to"))
    return (
        rows.where(F.col("border") & covered)
        .select(F.col("ip").alias("from_ip"), "to_ip", "state")
        .join(tails, "from_ip", "left")
        .select("from_ip", F.coalesce("_to", "to_ip").alias("to_ip"), "state")
    )


def overlay_table(spark, root):
    """The stored overlay with one country column per version, ``ZZ`` where a version has none."""
    found = segments(read_marks(spark, root)).withColumn("state", F.map_from_entries("state"))
    return found.select(
        "from_ip", "to_ip",
        *[F.coalesce(F.try_element_at("state", F.lit(v)), F.lit(UNKNOWN)).alias(f"v{v}") for v in known_versions(spark, root)],
    )


def lookup_country(lookups, marks, fill_gaps=False, any_case=False):
    """Add ``country`` to rows with ``version`` and ``ip`` from stored marks; see ``ip_ranges.lookup_country``.

    Distinct addresses meet the marks of their block once for all versions.
    """
    keyed = lookups.withColumn("_block", _block())
    asked = keyed.select("_block", "ip").distinct()
    state = F.when(F.size("state") > 0, F.col("state")) if fill_gaps else F.col("state")
    rows = marks.select(_block().alias("_block"), "ip", state.alias("_state"), F.lit(False).alias("_asked")).unionByName(
        asked.select("_block", "ip", F.lit(None).cast(_STATE).alias("_state"), F.lit(True).alias("_asked"))
    )
    so_far = Window.partitionBy("_block").orderBy("ip", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_held", F.last("_state", ignorenulls=True).over(so_far)).where("_asked")
    if fill_gaps:
        # What holds at the end of a block goes on through later ones: at most 65,536 rows.
        ends = rows.where("_state IS NOT NULL").groupBy("_block").agg(F.max_by("_state", "ip").alias("_end"))
        blocks = rows.select("_block").distinct().join(ends, "_block", "left")
        before = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        carried = blocks.select("_block", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
        found = found.join(carried, "_block").withColumn("_held", F.coalesce("_held", "_carried"))
    held = found.select("_block", "ip", F.map_from_entries("_held").alias("_held"))
    country = F.try_element_at("_held", F.col("version"))
    rows = keyed.join(held, ["_block", "ip"], "left").withColumn("country", country)
    unresolved = (F.lower("country") if any_case else F.col("country")).isin(UNRESOLVED)
    return rows.withColumn("country", F.when(F.col("country").isNull() | unresolved, UNKNOWN).otherwise(F.col("country"))).drop("_block", "_held")
