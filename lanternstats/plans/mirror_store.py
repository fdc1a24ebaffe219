"""The stored mirror of status entries with their descriptors, and its index from descriptors to dates.

A row lies on the date of its entry, and a descriptor that no entry lists on the date it was published.  The index
tells on which dates a descriptor is listed, so a late descriptor rewrites only those.  Of the index and of the stored
descriptors only keys that a bitmap of the batch's keys lets pass are shuffled.
"""

from pyspark.sql import functions as F

from lanternstats.plans import keyed_tables
from lanternstats.plans.bridge_history import filter_bits, maybe_known
from lanternstats.plans.dated_store import DatedStore, date_of, dates_of


def _columns(frame):
    return ", ".join(f"`{name}` {kind}" for name, kind in frame.dtypes)


def _store(spark, root, status, descriptor):
    empty = keyed_tables.denormalised_mirror(status.where("false"), descriptor.where("false"))
    key = dict(descriptor.dtypes)["descriptor"]
    return DatedStore(
        spark,
        root,
        {
            # ``listed``: there is an entry; ``described``: there is a descriptor.
            "mirror": (f"{_columns(empty)}, listed boolean, described boolean", "date"),
            "descriptors": (_columns(descriptor), "date"),
            "listing": (f"descriptor {key}", "date"),
        },
    )


def _among(rows, keys):
    """Rows whose descriptor is in ``keys``; only those that may be are shuffled."""
    likely = maybe_known(rows, filter_bits(keys, "descriptor"), "descriptor").where("_maybe")
    return likely.join(keys.select("descriptor").distinct(), "descriptor", "left_semi").drop("_maybe")


def update(spark, root, batch, status, descriptor, published="published"):
    """Add new entries and descriptors, and renew the mirror of the dates they change; returns those dates.

    The rows are those that ``keyed_tables.insert_if_absent`` lets in: their keys are not stored yet.  Batches are
    numbered from 1 without gaps; one that fails is run again.  Changed are the dates of new entries, the dates on which
    a new descriptor is listed, and the publication dates of new descriptors and of those listed for the first time.
    Rows without a time lie on one date of their own; without a column ``published`` all unlisted descriptors do.
    """
    store = _store(spark, root, status, descriptor)
    entries = store.stage(batch, "entries", status.withColumn("date", date_of("validafter")))
    time = date_of(published) if published in descriptor.columns else date_of(F.lit(None))
    arrived = store.stage(batch, "descriptors", descriptor.withColumn("date", time))
    days, own = dates_of(entries), dates_of(arrived)

    # Where the index lists a new descriptor, and stored descriptors that a new entry lists.
    late = store.stage(batch, "late", _among(store.read("listing", before=batch), arrived).select("descriptor", "date"))
    on = dates_of(_among(store.read("descriptors", before=batch).select("descriptor", "date"), entries))
    known = store.stage(batch, "known", _among(store.read("descriptors", on, before=batch), entries).drop("date"))
    unlisted = store.read("mirror", on, before=batch).where("NOT listed").select("descriptor", "date")
    touched = sorted({*days, *own, *dates_of(late, unlisted.join(entries, "descriptor", "left_semi"))})
    if not touched:
        return touched

    # Stored rows stay as they are, but for entries that had no descriptor and descriptors that had no entry.
    before = store.read("mirror", touched, before=batch)
    whole = before.where("listed AND described")
    open_entries = before.where("listed AND NOT described").select(*status.columns, "date").unionByName(entries)
    mark = F.lit(True).alias("_described")
    at_hand = arrived.drop("date").unionByName(known).select("*", mark)
    joined = keyed_tables.denormalised_mirror(open_entries, at_hand).where("date IS NOT NULL")
    filled = joined.select("*", F.lit(True).alias("listed"), F.coalesce("_described", F.lit(False)).alias("described")).drop("_described")
    still = before.where("NOT listed").join(entries.select("descriptor").distinct(), "descriptor", "left_anti")
    new = arrived.join(entries.select("descriptor").union(late.select("descriptor")).distinct(), "descriptor", "left_anti")
    alone = (
        keyed_tables.denormalised_mirror(entries.where("false"), new.drop("date").select("*", mark))
        .drop("_described", "date")
        .join(new.select("descriptor", "date"), "descriptor")
        .select("*", F.lit(False).alias("listed"), F.lit(True).alias("described"))
    )

    rows = whole.unionByName(filled.select(whole.columns)).unionByName(still.select(whole.columns)).unionByName(alone.select(whole.columns))
    store.write(batch, "mirror", rows)
    store.write(batch, "descriptors", store.read("descriptors", own, before=batch).unionByName(arrived))
    lists = entries.select("descriptor", "date").where("descriptor IS NOT NULL").distinct()
    store.write(batch, "listing", store.read("listing", days, before=batch).unionByName(lists).distinct())
    # Dates are committed together, also those of which no row is left.
    store.commit(batch, [("mirror", d) for d in touched] + [("descriptors", d) for d in own] + [("listing", d) for d in days])
    return touched


def read_mirror(spark, root, status, descriptor):
    """The mirror as committed; the frames give the types."""
    return _store(spark, root, status, descriptor).read("mirror").drop("listed", "described", "date")
