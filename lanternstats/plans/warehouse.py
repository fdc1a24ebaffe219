"""Batch jobs over stored tables: load facts, then refresh the dates they touch."""

from pyspark.sql import functions as F

from lanternstats import schemas
from lanternstats.functions import text as tx
from lanternstats.functions.sizing import only_dates
from lanternstats.operators import bridges, completeness, descriptors, documents, statuses
from lanternstats.plans import daily, keyed_tables, summaries
from lanternstats.sources.sinks import append_facts

# Aggregate tables and the column their date is taken from.
AGGREGATES = {
    "relay_statuses_per_day": "date",
    "network_size": "date",
    "network_size_hour": "validafter",
    "relay_platforms": "date",
    "relay_versions": "date",
    "total_bandwidth": "date",
    "total_bwhist": "date",
    "user_stats": "date",
}


# Facts of which a later document replaces an earlier one.
OVERWRITTEN = {"dirreq_stats"}


def stage_documents(spark, root, files):
    """Read the raw files of a batch once and keep their documents by type.

    The parse jobs then read only the folder of their own type.
    """
    path = f"{root}/staging/documents"
    documents.classify_relay_documents(files).select("path", "content", "doc_type").write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "static").partitionBy("doc_type").parquet(path)
    staged = spark.read.schema("path string, content binary, doc_type string").parquet(path)
    return staged.withColumn("text", tx.body("content"))


def relay_facts(docs):
    """Fact tables of classified relay documents."""
    of = lambda kind: docs.where(F.col("doc_type") == kind).drop("doc_type")
    headers = statuses.status_headers(of("status"))
    return {
        "statusentry": statuses.status_entries(of("status"), keep=["path"]),
        "consensus": headers.where("is_consensus").select(
            "validafter", F.col("content").alias("rawdesc"), "path"
        ),
        "vote": headers.where("NOT is_consensus").select(
            "validafter", "dirsource", F.col("content").alias("rawdesc"), "path"
        ),
        "descriptor": descriptors.server_descriptors(of("server"), keep=["path"]),
        "extrainfo": descriptors.extra_infos(of("extra"), keep=["path"]),
        "bwhist": descriptors.history_rows(
            descriptors.history_values(of("extra"), keep=["path"]), keep=["path"]
        ),
        "dirreq_stats": descriptors.directory_requests(of("extra"), keep=["path"]),
    }


def exists(spark, path):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def stored_table(spark, path):
    return spark.read.parquet(path) if exists(spark, path) else None


def fact_table(spark, root, name):
    """A fact table with its fixed schema; empty before the first load."""
    schema = getattr(schemas, name.upper()) + ", date date"
    path = f"{root}/{'tables' if name in OVERWRITTEN else 'facts'}/{name}"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def load_facts(spark, root, batch, facts):
    """Append the rows of a batch that the fact tables lack, and note the dates they touch.

    New rows are written to a staging folder, the dirty dates to the updates
    table, and only then are the facts appended.  A batch that fails in
    between is run again: rows already appended are skipped and their dates
    are still in the updates table.
    """
    staged = {}
    for name, rows in facts.items():
        if name in OVERWRITTEN:
            key = schemas.KEYS[name]
            latest = rows.groupBy(*key).agg(F.max_by("requests", F.struct("path", "requests")).alias("requests"))
            upsert_table(spark, root, name, latest, key, schemas.EVENT_TIME[name])
            continue
        staged[name] = new_facts(spark, root, name, rows)
    touched = keyed_tables.dirty_dates(
        staged.get("statusentry"), staged.get("descriptor"), staged.get("bwhist")
    )
    touched.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("append").parquet(
        f"{root}/updates"
    )
    for name, rows in staged.items():
        append_facts(rows, f"{root}/facts/{name}", name)


def new_facts(spark, root, name, rows):
    """The rows of a batch that a fact table lacks, staged.

    The date of a row follows from its key, and all rows of an extra-info lie
    on its own dates.  So only the batch's dates, of which there is one per
    calendar day at most, are read of the stored table.
    """
    parsed, staging = f"{root}/staging/parsed-{name}", f"{root}/staging/{name}"
    rows.write.mode("overwrite").parquet(parsed)
    rows = spark.read.schema(rows.schema).parquet(parsed)
    date = F.to_date(schemas.EVENT_TIME[name])
    dates = [r[0] for r in rows.select(date.alias("date")).distinct().collect()]
    stored = fact_table(spark, root, name)
    known = F.col("date").isin([d for d in dates if d is not None])
    if None in dates:
        known = known | F.col("date").isNull()
    new = keyed_tables.insert_if_absent(
        rows, stored.where(known), schemas.KEYS[name],
        absent_key=["extrainfo"] if name == "bwhist" else None, order=["path"],
    ).drop("path")
    new.write.mode("overwrite").parquet(staging)
    return spark.read.schema(new.schema).parquet(staging)


def upsert_table(spark, root, name, rows, key, time):
    """Merge rows into a keyed table that is stored by date; only their dates are rewritten.

    A row with a known key and other values replaces the stored one.  Returns
    how many rows were inserted, updated, unchanged or kept in those dates.
    """
    path = f"{root}/tables/{name}"
    values = [c for c in rows.columns if c not in key]
    staging = f"{root}/staging/{name}"
    added = "date" not in rows.columns
    dated = lambda frame: keyed_tables.with_date(frame, time) if added else frame
    plain = lambda frame: frame.select(*rows.columns)
    schema = _schema_of(rows)
    dated(rows).write.mode("overwrite").parquet(f"{staging}/new")
    new = spark.read.schema(schema + (", date date" if added else "")).parquet(f"{staging}/new")
    if exists(spark, path):
        stored = only_dates(spark.read.schema(new.schema).parquet(path), time, new.select("date"))
    else:
        stored = spark.createDataFrame([], new.schema)
    keyed_tables.upsert(plain(new), plain(stored), key, values).write.mode("overwrite").parquet(
        f"{staging}/merged"
    )
    merged = spark.read.schema(schema + ", action string").parquet(f"{staging}/merged")
    dated(plain(merged)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("date").parquet(path)
    return keyed_tables.action_counts(merged)


def _schema_of(rows):
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def keyed_table(spark, root, name):
    return spark.read.parquet(f"{root}/tables/{name}")


def bridge_statistics(docs, hashed_relays, sanitized=False):
    """Tables of running bridges and bridge users from classified bridge documents.

    ``docs`` has ``doc_type``, ``text`` and ``snapshot``, the time of a status.
    Relays must have been read before, so that their identities are known.
    """
    of = lambda kind: docs.where(F.col("doc_type") == kind)
    counted = bridges.running_bridges(of("status"), keep=["snapshot"]).select(
        F.col("snapshot").alias("validafter"), F.col("running").alias("brunning")
    )
    counts = keyed_tables.latest_value(counted, ["validafter"], "brunning", ["brunning"])
    listed = bridges.bridge_users(bridges.with_identity(of("extra"), sanitized))
    users = bridges.without_known_relays(listed, hashed_relays).groupBy("bridge", "date", "seen", "country").agg(
        F.max("users").alias("users")
    )
    broken = bridges.broken_versions(bridges.with_identity(of("server"), sanitized))
    return {
        "bridge_network_size": summaries.bridge_daily_averages(counts),
        "bridge_stats": summaries.bridge_stats_rows(
            summaries.bridge_users_by_day(users, hashed_relays, broken)
        ),
    }


def update_missing(spark, root, batch, seen, have, now, current):
    """The list of missing references of a batch: those seen now and those carried over, less what is at hand.

    ``seen`` and ``have`` are the tables of ``completeness.references_seen`` and
    ``documents_at_hand``.  The list of each batch is stored, so a batch can be run again.
    """
    path = f"{root}/missing"
    references = seen
    before = stored_table(spark, path)
    if before is not None:
        earlier = before.where(F.col("batch") < batch)
        last = earlier.agg(F.max("batch")).first()[0]
        if last is not None:
            references = seen.unionByName(earlier.where(F.col("batch") == last).select(seen.columns))
    missing = completeness.missing_references(references, have, now, current)
    missing.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return spark.read.schema(missing.schema).parquet(f"{path}/batch={batch}")


def pending_updates(spark, root):
    """Dates touched since the last committed refresh."""
    done = latest_batch(spark, root)
    updates = spark.read.parquet(f"{root}/updates")
    if done is not None:
        updates = updates.where(F.col("batch") > done)
    return updates.select("date").distinct()


def aggregates(status, descriptor, bwhist, dirreq=None, updates=None, per_day=None, running=None):
    """The daily tables of the given dates.

    User statistics need ``dirreq``.  Stored tables ``per_day`` and ``running``
    (``daily.running_descriptors``) spare three of the tables their own pass
    over entries and descriptors.
    """
    tables = {
        "network_size": daily.network_size(status, updates=updates),
        "network_size_hour": daily.network_size_hour(status, updates),
        "relay_platforms": daily.relay_platforms(status, descriptor, per_day, updates, running),
        "relay_versions": daily.relay_versions(status, descriptor, per_day, updates, running),
        "total_bandwidth": daily.total_bandwidth(status, descriptor, per_day, updates, running),
        "total_bwhist": daily.total_bwhist(bwhist, updates),
    }
    if dirreq is not None:
        tables["user_stats"] = daily.user_stats(status, bwhist, dirreq, updates)
    return tables


def latest_batch(spark, root):
    """Number of the last refresh that finished, or None."""
    commits = stored_table(spark, f"{root}/commits")
    return None if commits is None else commits.agg(F.max("batch")).first()[0]


def write_table(spark, root, batch, name, rows):
    """Write the rows of a batch's dirty dates into a folder of their own; return them as stored."""
    path = f"{root}/aggregates/{name}/batch={batch}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def commit(spark, root, batch, updates):
    """Make the batch the current one for its dirty dates, in all tables at once."""
    updates.select("date").distinct().select(F.lit(batch).cast("bigint").alias("batch"), "date").write.mode(
        "append"
    ).parquet(f"{root}/commits")


def refresh(spark, root, batch, status, descriptor, bwhist, dirreq, updates):
    """Recompute the daily tables of the dirty dates and commit them together.

    Only dirty dates are written.  Readers follow the commit table, so a batch
    that fails is never seen and can be run again.  The number of consensuses
    per date, by which other tables divide, and the running entries per date
    and descriptor, of which three are made, are stored first.
    """
    per_day = write_table(
        spark, root, batch, "relay_statuses_per_day", daily.relay_statuses_per_day(status, updates)
    )
    running = daily.running_descriptors(status, descriptor, updates)
    staging = f"{root}/staging/running"
    running.write.mode("overwrite").parquet(staging)
    running = spark.read.schema(running.schema).parquet(staging)
    tables = aggregates(status, descriptor, bwhist, dirreq, updates, per_day, running)
    for name, rows in tables.items():
        write_table(spark, root, batch, name, rows)
    commit(spark, root, batch, updates)


def read_aggregate(spark, root, name):
    """A daily table: of every date the rows of the last batch that was committed for it."""
    current = spark.read.parquet(f"{root}/commits").groupBy("date").agg(F.max("batch").alias("batch"))
    rows = spark.read.parquet(f"{root}/aggregates/{name}").withColumn("batch", F.col("batch").cast("bigint"))
    gathered = stored_table(spark, f"{root}/gathered")
    if gathered is not None:
        # The last gathering holds every date, so no earlier folder is read.
        rows = rows.where(F.col("batch") >= gathered.agg(F.max("batch")).first()[0])
    columns = [c for c in rows.columns if c != "batch"]
    dated = rows.withColumn("_date", F.to_date(AGGREGATES[name]))
    return dated.join(current.withColumnRenamed("date", "_date"), ["batch", "_date"], "left_semi").select(columns)


def drop_superseded(spark, root, batch):
    """Gather the current rows of all tables under one new batch number and commit it for every date.

    Run it now and then, not beside a refresh.  Readers follow the new batch from then on; ``remove_superseded``
    removes the folders of earlier ones.
    """
    dates = spark.read.parquet(f"{root}/commits").select("date").distinct()
    for name in AGGREGATES:
        write_table(spark, root, batch, name, read_aggregate(spark, root, name))
    commit(spark, root, batch, dates)
    spark.createDataFrame([(batch,)], "batch bigint").write.mode("append").parquet(f"{root}/gathered")


def remove_superseded(spark, root):
    """Remove the folders of batches before the last but one that was gathered; returns their paths.

    A reader that began before the last gathering may still read what the one before it left, so that stays
    until the next time: no reader loses files unless it lasts from before one gathering until after the second one.
    """
    gathered = stored_table(spark, f"{root}/gathered")
    batches = [] if gathered is None else sorted({r.batch for r in gathered.collect()})
    if len(batches) < 2:
        return []
    jvm = spark.sparkContext._jvm
    removed = []
    for name in AGGREGATES:
        top = jvm.org.apache.hadoop.fs.Path(f"{root}/aggregates/{name}")
        system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in system.listStatus(top) if system.exists(top) else []:
            key, _, number = status.getPath().getName().partition("=")
            if key == "batch" and number.isdigit() and int(number) < batches[-2]:
                system.delete(status.getPath(), True)
                removed.append(f"{name}/batch={number}")
    return sorted(removed)
