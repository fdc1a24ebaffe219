"""Stored pseudonymised bridge documents, kept consistent while further batches arrive.

Tables below one folder, by date: ``extras``, ``servers``, ``mapping`` (bridge and time to the digests of both) and
``statuses``.  A batch writes the dates that it touches as a whole.

A late extra-info changes the text of its server descriptor and with it that one's digest, which statuses name.  The
batch carries the change on: extra-infos, servers of the same dates, mapping, and the statuses of the 24 hours after a
server whose digest changed.
"""

from pyspark.sql import functions as F

from lanternstats.operators import pseudonymise as ps
from lanternstats.operators.intervals import statuses_to_keep, statuses_to_rewrite
from lanternstats.plans.dated_store import DatedStore, date_of, dates_of

#: Columns of the tables, and the one that dates their rows.
TABLES = {
    "extras": ("bridge string, published string, scrubbed string, extra_digest string", "published"),
    "servers": ("bridge string, published string, scrubbed string, extra_digest string, server_digest string", "published"),
    "mapping": ("bridge string, published string, server_digest string, extra_digest string", "published"),
    "statuses": ("status string, validafter timestamp_ntz, scrubbed string", "validafter"),
}

def read_table(spark, root, name):
    """A table as committed."""
    return DatedStore(spark, root, TABLES).read(name)


def changed_servers(mapping, before):
    """Publication times of servers whose digest is not what it was before."""
    keys = ["bridge", "published"]
    old = before.select(*keys, F.col("server_digest").alias("_old"))
    both = mapping.join(old, keys, "left").where("server_digest <> coalesce(_old, '" + ps.NO_REFERENCE + "')")
    return both.select(F.try_to_timestamp("published").cast("timestamp_ntz").alias("published"))


def _linked(lines, mapping):
    return ps.link_statuses(lines, mapping, ["status", "validafter"], near=date_of("validafter"))


def apply_batch(spark, root, batch, statuses=None, servers=None, extras=None):
    """Scrub the raw documents of a batch, link them, and carry changes on to what is stored.

    ``servers`` and ``extras`` have ``text``; ``statuses`` have ``status`` (their name), ``validafter`` and ``text``.
    Batches have ascending numbers.  Of several extra-infos of one bridge and time the largest digest counts, whatever
    batch they came in, so two batches give what one with the documents of both gives; only statuses more than 24 hours after a
    changed server keep the reference they have.  A status that comes again replaces the stored one.
    """
    store = DatedStore(spark, root, TABLES)
    none = lambda columns: spark.createDataFrame([], columns).limit(0)
    statuses = none("status string, validafter timestamp_ntz, text string") if statuses is None else statuses
    servers, extras = (none("text string") if x is None else x for x in (servers, extras))
    dated = lambda rows: rows.withColumn("date", date_of("published"))
    new_extras = store.stage(batch, "extras", dated(ps.scrub_extras(extras)))
    new_servers = store.stage(batch, "servers", dated(ps.scrub_servers(servers)))
    lines = store.stage(batch, "lines", ps.scrub_statuses(statuses, keep=["status", "validafter"]))

    touched = []
    days = dates_of(new_extras, new_servers)
    stored = lambda name, dates: store.read(name, dates, before=batch)
    if days:
        infos = stored("extras", days).unionByName(new_extras).dropDuplicates(["bridge", "published", "extra_digest"])
        infos = store.write(batch, "extras", infos)
        texts = stored("servers", days).select("bridge", "published", "scrubbed").unionByName(new_servers.drop("date"))
        linked = ps.link_servers(texts, infos).dropDuplicates(["bridge", "published", "server_digest"])
        linked = store.write(batch, "servers", linked)
        mapping = store.write(batch, "mapping", ps.reference_mapping(linked, infos))
        touched += [(name, day) for name in ("extras", "servers", "mapping") for day in days]
        changed = store.stage(batch, "changed", changed_servers(mapping, stored("mapping", days)))
    else:
        mapping = stored("mapping", [])
        changed = none("published timestamp_ntz")

    # Statuses of the batch, and stored ones on the days of a change and the days after.
    reached = changed.where("published IS NOT NULL").select(F.explode(F.array(F.to_date("published"), F.date_add(F.to_date("published"), 1))).alias("date"))
    status_days = dates_of(lines.select(date_of("validafter").alias("date")), reached)
    if status_days:
        kept = stored("statuses", status_days).drop("date").join(lines.select("status").distinct(), "status", "left_anti")
        affected = store.stage(
            batch, "affected", ps.sanitized_statuses(statuses_to_rewrite(kept, changed).withColumnRenamed("scrubbed", "text"), keep=["status", "validafter"])
        )
        named = dates_of(*(x.where("published IS NOT NULL").select(date_of("published").alias("date")) for x in (lines, affected)))
        known = mapping.unionByName(stored("mapping", [d for d in named if d not in days])).drop("date")
        rewritten = _linked(affected, ps.mapping_with_read_digests(known, affected))
        written = store.write(batch, "statuses", statuses_to_keep(kept, changed), [rewritten, _linked(lines, known)])
        touched += [("statuses", day) for day in dates_of(written)]
    store.commit(batch, touched)
