"""Bridge statistics over all history: relays, broken versions and observations are kept between runs.

A bridge that turns out to be a relay leaves the statistics of all dates, also those that were computed before.  Of the
known relays a bitmap of a fixed number of bits is kept beside the set: only rows that may be relays go through the
anti join, all others pass by without a shuffle.
"""

from pyspark.sql import functions as F

from lanternstats.plans import summaries
from lanternstats.plans.dated_store import DatedStore, dates_of
from lanternstats.plans.warehouse import exists

#: Bits of the filter; its bitmaps of 4,096 bytes are 16 MB together, whatever the number of relays.
FILTER_BITS = 1 << 27


def _place(column):
    """Place of a value in the filter, from 1: bitmaps are numbered so."""
    return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(FILTER_BITS)) + 1


def filter_bits(relays, column="hashed_relay"):
    """(bucket, bits): the filter of a set of relays, or of the values of another column."""
    place = _place(column)
    return relays.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def maybe_known(rows, bits, column="bridge"):
    """Add ``_maybe``: false if ``column`` is certainly none of the filter's values."""
    place = _place(column)
    at = F.bitmap_bit_position(place)
    # The filter has 4,096 bitmaps at most.
    merged = bits.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    joined = rows.withColumn("_bucket", F.bitmap_bucket_number(place)).join(
        F.broadcast(merged.withColumnRenamed("bucket", "_bucket")), "_bucket", "left"
    )
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (at % 8).cast("int")) == 1
    return joined.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_bucket", "bits")


def without_known_relays(rows, relays, bits):
    """Rows of bridges that are no known relays; only those that may be are shuffled."""
    tested = maybe_known(rows, bits)
    known = relays.select(F.col("hashed_relay").alias("bridge")).distinct()
    passed = tested.where("NOT _maybe").unionByName(tested.where("_maybe").join(known, "bridge", "left_anti").select(tested.columns))
    return passed.drop("_maybe")


def _tables(observations):
    types = dict(observations.dtypes)
    return {
        "observations": (f"bridge {types['bridge']}, seen timestamp_ntz, country string, users {types['users']}", "date"),
        "bridge_stats": (f"country string, users {'double' if types['users'] == 'double' else 'bigint'}", "date"),
    }


class _Sets:
    """Sets that only grow, one folder a batch; those of later or failed batches are not read."""

    def __init__(self, spark, root, batch):
        self.spark, self.root, self.batch = spark, root, batch

    def read(self, name, schema, upto):
        """What the batches up to ``upto`` have added."""
        path = f"{self.root}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, batch bigint").parquet(path)
        return rows.where(F.col("batch") <= upto).drop("batch")

    def add(self, name, rows):
        """The rows that earlier batches lack, stored."""
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        before = self.read(name, schema, self.batch - 1)
        new = rows.distinct().join(before, rows.columns, "left_anti")
        path = f"{self.root}/{name}/batch={self.batch}"
        new.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path), self.read(name, schema, self.batch)


def update(spark, root, batch, relays, broken, observations):
    """Add a batch and bring the statistics of the dates it changes up to date; returns those dates.

    ``relays`` has ``hashed_relay``, ``broken`` has ``bridge, seen`` and ``observations`` have ``bridge, date, seen,
    country, users``.  Batches are numbered from 1 without gaps.  Changed dates are those of new observations, and of
    stored ones whose bridge has become a known relay or whose version is now known to be broken.  A batch that fails
    is run again.
    """
    store, sets = DatedStore(spark, root, _tables(observations)), _Sets(spark, root, batch)
    new_relays, all_relays = sets.add("relays", relays.select("hashed_relay").where("hashed_relay IS NOT NULL"))
    _, bits = sets.add("relay_bits", filter_bits(new_relays))
    new_broken, all_broken = sets.add("broken", broken.select("bridge", "seen"))

    columns = ["bridge", "seen", "country", "users", "date"]
    arrived = store.stage(batch, "arrived", observations.select(columns).distinct())
    days = dates_of(arrived)
    # Earlier observations of bridges that are new relays: the new ones' own filter finds them.
    stored = store.read("observations", before=batch)
    changed = maybe_known(stored, filter_bits(new_relays)).where("_maybe").join(
        new_relays.select(F.col("hashed_relay").alias("bridge")), "bridge", "left_semi"
    )
    late_broken = stored.join(new_broken, ["bridge", "seen"], "left_semi")
    dirty = sorted({*days, *dates_of(changed, late_broken)})
    if not dirty:
        return dirty
    both = store.read("observations", days, before=batch).select(columns).unionByName(arrived).distinct()
    added = store.write(batch, "observations", both)
    others = [d for d in dirty if d not in days]
    rows = added.select(columns).unionByName(store.read("observations", others, before=batch).select(columns))
    kept = store.stage(batch, "kept", without_known_relays(rows, all_relays, bits))
    # The relays are left out already.
    users = summaries.bridge_users_by_day(kept, all_relays.where("false"), all_broken)
    store.write(batch, "bridge_stats", users.select("country", "users", "date"))
    # A date without rows now is committed as well, so that its old ones are no longer seen.
    store.commit(batch, [("observations", d) for d in days] + [("bridge_stats", d) for d in dirty])
    return dirty


def read_stats(spark, root, observations):
    """Users by date and country over all batches; ``observations`` gives the types."""
    return DatedStore(spark, root, _tables(observations)).read("bridge_stats").select("date", "country", "users")
