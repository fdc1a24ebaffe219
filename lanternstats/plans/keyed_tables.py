"""Keyed tables: insert if absent, upsert with actions, dirty dates, partial refresh, mirror."""

from pyspark.sql import functions as F

from lanternstats.functions.sizing import date_list


def insert_if_absent(new, stored, key, absent_key=None, order=None):
    """Rows of ``new`` to append: one per ``key``, and none whose key is stored.

    ``absent_key`` is the part of the key looked up in the stored table, for
    tables where a whole document is loaded or skipped.  ``order`` names the
    columns telling which of several new rows came first; among equals, and
    without it, a hash of the row decides, so that a rerun gives the same table.
    Keys are looked up before the rows are grouped, so that known documents go
    no further.
    """
    values = [c for c in new.columns if c not in key]
    rows = new
    if stored is not None:
        rows = rows.join(stored.select(*(absent_key or key)).distinct(), absent_key or key, "left_anti")
    if not values:
        return rows.select(*key).distinct().select(*new.columns)
    rank = F.struct(*(order or []), F.xxhash64(*values))
    first = rows.groupBy(*key).agg(F.min_by(F.struct(*values), rank).alias("_row"))
    return first.select(*key, "_row.*").select(*new.columns)


def upsert(new, stored, key, values):
    """Merge by key and tell what happens to each row.

    ``action`` is ``insert``, ``update``, ``unchanged``, or ``kept`` for rows
    only the stored table has.  Values come from ``new`` where it has the key.
    """
    left = new.select(*key, F.struct(*values).alias("_new"))
    right = stored.select(*key, F.struct(*values).alias("_old"))
    action = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "kept")
        .when(F.col("_new").eqNullSafe(F.col("_old")), "unchanged")
        .otherwise("update")
    )
    return (
        left.join(right, key, "full")
        .withColumn("action", action)
        .withColumn("_row", F.coalesce("_new", "_old"))
        .select(*key, *[F.col("_row")[v].alias(v) for v in values], "action")
    )


def action_counts(merged):
    """How many rows each action touched."""
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def latest_value(arrivals, key, value, order):
    """Overwriting by key: the value that arrived last, and whether arrivals differed."""
    return arrivals.groupBy(*key).agg(
        F.max_by(value, F.struct(*order)).alias(value),
        (F.min(value) != F.max(value)).alias("changed"),
    )


def dirty_dates(status=None, descriptor=None, bwhist=None):
    """Dates whose statistics a batch of new facts makes stale."""
    dates = []
    if status is not None:
        dates.append(status.select(F.to_date("validafter").alias("date")))
    if descriptor is not None:
        published = F.to_date("published")
        dates.append(
            descriptor.select(F.explode(F.array(published, F.date_add(published, 1))).alias("date"))
        )
    if bwhist is not None:
        dates.append(bwhist.select(F.to_date("intervalend").alias("date")))
    touched = dates[0]
    for more in dates[1:]:
        touched = touched.union(more)
    return touched.where("date IS NOT NULL").distinct()


def replace_dates(stored, fresh, updates, date=None):
    """Stored rows of other dates with the recomputed rows; dirty dates without new rows vanish."""
    date = F.col("date") if date is None else date
    dirty = date_list(updates).withColumnRenamed("date", "_date")
    others = stored.withColumn("_date", date).join(dirty, "_date", "left_anti").drop("_date")
    return others.unionByName(fresh.select(*stored.columns))


def denormalised_mirror(status, descriptor):
    """Status entries with their descriptor; descriptors without an entry keep a null time.

    A full outer join written as a left join and the unmatched rest: entries of
    one descriptor can be split over tasks in a left join, not in a full one.
    """
    own = [c for c in descriptor.columns if c != "descriptor" and c in status.columns]
    right = descriptor.select(
        "descriptor",
        *[F.col(c).alias(f"desc_{c}" if c in own else c) for c in descriptor.columns if c != "descriptor"],
    )
    matched = status.join(right, "descriptor", "left")
    listed = status.select("descriptor").distinct()
    unlisted = right.join(listed, "descriptor", "left_anti")
    return matched.unionByName(unlisted, allowMissingColumns=True)


def refresh_mirror(mirror, status, descriptor, changed):
    """The mirror with the rows of ``changed`` descriptors rebuilt from the fact tables."""
    keys = changed.select("descriptor").distinct()
    fresh = denormalised_mirror(
        status.join(keys, "descriptor", "left_semi"), descriptor.join(keys, "descriptor", "left_semi")
    )
    return mirror.join(keys, "descriptor", "left_anti").unionByName(fresh.select(*mirror.columns))


def with_date(facts, time):
    """Add the physical partition column of a fact table."""
    return facts.withColumn("date", F.to_date(time))

