"""The registered queries: every operator on the given tables."""

from pyspark.sql import functions as F

from lanternstats.file_queries import FILE_QUERIES, scratch
from lanternstats.fixtures import documents, tables, view
from lanternstats.functions import digests, text as tx
from lanternstats.functions.numbers import count_when
from lanternstats.operators import (
    bridges, completeness, descriptors, documents as docs_ops, health, intervals, ip_ranges,
    pseudonymise, statuses,
)
from lanternstats.plans import bridge_history, bridge_store, daily, health_report, keyed_tables, measurements, mirror_store, overlay_store, summaries, warehouse
from lanternstats.sources import logs, sinks

NOW = "2024-01-20 00:00:00"
#: Times that the archive report goes back; few of the test documents have votes of their time.
REPORT_TIMES = 400


def _q(function, *views):
    """A query applying ``function`` to fixture views."""
    def run(spark, sf_dir):
        return function(*[view(spark, sf_dir, v) for v in views])

    return run


def _d(function, *names):
    """A query applying ``function`` to fixture documents."""
    def run(spark, sf_dir):
        return function(*[documents(spark, sf_dir, n) for n in names])

    return run


# ------------------------------------------------------------ daily statistics

def _limited(function, *views):
    def run(spark, sf_dir):
        return function(
            *[view(spark, sf_dir, v) for v in views], updates=view(spark, sf_dir, "v_updates")
        )

    return run


def partial_refresh(status, updates):
    """A stale table of network sizes brought up to date for the dirty dates."""
    stored = daily.network_size(status).select(
        "date", *[(F.col(f"avg_{n}") + 1000).alias(f"avg_{n}") for n in ("running", "exit", "guard", "fast", "stable")]
    )
    return keyed_tables.replace_dates(stored, daily.network_size(status, updates=updates), updates)


def refresh_vanished(status, updates):
    """Dirty dates that have no rows any more leave the table."""
    stored = daily.network_size(status)
    left = status.where(F.dayofmonth("validafter") % 2 == 0)
    return keyed_tables.replace_dates(stored, daily.network_size(left, updates=updates), updates)


# ------------------------------------------------------------ summaries

def _relay_counts(status):
    running = F.col("isrunning")
    return status.groupBy("validafter").agg(
        *[count_when(running & F.col(f"is{f}")).alias(f) for f in ("exit", "fast", "guard", "stable")],
        count_when(running).alias("running"),
    )


def _bridge_counts(observations):
    half_hour = F.to_timestamp_ntz(
        F.date_format(
            F.timestamp_seconds(F.unix_timestamp(F.col("seen").cast("timestamp")) - F.unix_timestamp(F.col("seen").cast("timestamp")) % 1800),
            "yyyy-MM-dd HH:mm:ss",
        )
    )
    return observations.groupBy(half_hour.alias("validafter")).agg(F.count(F.lit(1)).alias("brunning"))


def daily_spine(status, observations):
    return summaries.relays_and_bridges(
        summaries.relay_daily_averages(_relay_counts(status), 12),
        summaries.bridge_daily_averages(_bridge_counts(observations), 47),
    )


def package_wide(packages):
    """Package requests with one column per bundle and ``NA`` for none."""
    return sinks.as_text(
        summaries.wide(packages, ["date"], "bundle", "downloads")
    )


def package_log(spark, sf_dir):
    """Request lines written and read back; a later line of a date replaces an earlier one."""
    tables(spark, sf_dir, "events")
    lines = spark.sql(
        "SELECT concat(date_format(date_add(DATE'2000-01-01', CAST(event_id DIV 2 AS INT)), 'yyyy-MM-dd'), ' - ',"
        " 'Bundle', user_id % 4, ':', event_id, ' other:', user_id) AS value,"
        " 'log' AS name, 0 AS block, event_id AS line_no FROM events"
    )
    return logs.package_lines(lines)


def timing_log(spark, sf_dir):
    """Download lines of 20 fields, some of them defective."""
    tables(spark, sf_dir, "events")
    lines = spark.sql(
        "SELECT concat(CASE WHEN event_id % 11 = 0 THEN '99' ELSE CAST(1264982400 + event_id * 300 AS STRING) END, ' ',"
        " user_id * 10, repeat(' 0', 14), ' ', CASE WHEN event_id % 7 = 0 THEN '0' ELSE CAST(1264982400 + event_id * 300 + event_id % 60 AS STRING) END,"
        " ' ', user_id * 1000, ' 0 ', CASE WHEN event_id % 5 = 0 THEN 51200 ELSE 51300 END,"
        " CASE WHEN event_id % 13 = 0 THEN ' extra' ELSE '' END) AS value,"
        " concat(event_type, '.x-50kb.data') AS name, 0 AS block, event_id AS line_no FROM events"
    )
    return logs.timing_lines(lines)


def timing_stats_batches(spark, sf_dir):
    """Stored quartiles after two batches, between which most groups of source and date are split."""
    root, timings = scratch(spark), view(spark, sf_dir, "v_timing")
    for k in (0, 1):
        measurements.update_timings(spark, root, timings.where(F.pmod(F.minute("started"), F.lit(2)) == k))
    return warehouse.keyed_table(spark, root, "timing_stats").select("source", "date", "q1", "md", "q3")


def package_stats_batches(spark, sf_dir):
    """Stored requests after two batches: the second corrects every count but those of clicks."""
    root, packages = scratch(spark), view(spark, sf_dir, "v_packages")
    early = packages.withColumn("downloads", F.col("downloads") - F.when(F.col("bundle") == "click", 0).otherwise(1))
    measurements.update_packages(spark, root, early)
    measurements.update_packages(spark, root, packages.where("bundle <> 'click'"))
    return warehouse.keyed_table(spark, root, "package_stats").select("date", "bundle", "downloads")


def bridge_history_batches(spark, sf_dir):
    """Stored bridge users after two batches; relays and broken versions of the second change dates of the first."""
    root = scratch(spark)
    observations, relays, broken = (view(spark, sf_dir, v) for v in ("v_bridge_obs", "v_hashed_relays", "v_broken"))
    half = lambda rows, column, k: rows.where(F.pmod(column, F.lit(2)) == k)
    for k in (0, 1):
        bridge_history.update(
            spark, root, k + 1, half(relays, F.col("hashed_relay"), 1 - k), half(broken, F.col("bridge"), 1 - k), half(observations, F.hour("seen"), k)
        )
    return bridge_history.read_stats(spark, root, observations)


def mirror_batches(spark, sf_dir):
    """The stored mirror after two batches, of which the second brings descriptors that earlier entries list."""
    root = scratch(spark)
    status = view(spark, sf_dir, "v_status")
    day = F.expr("CAST(date_add(DATE'2010-01-01', CAST(descriptor % 60 AS INT)) AS TIMESTAMP_NTZ)")
    descriptor = view(spark, sf_dir, "v_descriptor").withColumn("published", day)
    half = lambda rows, column, k: rows.where(F.pmod(column, F.lit(2)) == k)
    for k in (0, 1):
        mirror_store.update(
            spark, root, k + 1, half(status, F.col("fingerprint"), k), half(descriptor, F.col("descriptor"), 1 - k)
        )
    return mirror_store.read_mirror(spark, root, status, descriptor).drop("published")


# ------------------------------------------------------------ keyed tables

def _new(df, key="fingerprint"):
    return df.where(F.col(key) % 2 == 0)


def insert_if_absent(status):
    """Even relays arrive twice; those of every sixth are stored already."""
    new = _new(status)
    stored = status.where("fingerprint % 6 = 0")
    return keyed_tables.insert_if_absent(new.unionAll(new), stored, ["validafter", "fingerprint"])


def upsert_actions(dirreq):
    key = ["source", "statsend", "seconds", "country"]
    new = dirreq.where("source % 3 <> 0")
    stored = dirreq.where("source % 2 = 0").withColumn(
        "requests", F.when(F.col("source") % 4 == 0, F.col("requests") + 1).otherwise(F.col("requests"))
    )
    return keyed_tables.upsert(new, stored, key, ["requests"])


def changed_values(observations):
    """The last value per bridge and date, and whether an earlier one differed."""
    return keyed_tables.latest_value(
        observations, ["bridge", "date"], "users", ["seen", "country"]
    )


def dirty_dates(status, descriptor_dates, bwhist):
    return keyed_tables.dirty_dates(status, descriptor_dates, bwhist)


def dirty_dates_query(spark, sf_dir):
    tables(spark, sf_dir, "orders")
    published = spark.sql("SELECT CAST(o_orderdate AS TIMESTAMP_NTZ) AS published FROM orders")
    return dirty_dates(view(spark, sf_dir, "v_status"), published, view(spark, sf_dir, "v_bwhist"))


def mirror_refresh(status, descriptor):
    """Late descriptors fill the rows of a mirror built without them."""
    early = descriptor.where("descriptor % 4 <> 0")
    mirror = keyed_tables.denormalised_mirror(status, early)
    late = descriptor.where("descriptor % 4 = 0")
    return keyed_tables.refresh_mirror(mirror, status, descriptor, late)


# ------------------------------------------------------------ documents

def split_documents(files):
    pieces = docs_ops.split_documents(files.select("doc_id", "content"), "router ")
    return pieces.select(
        "doc_id", F.col("doc_no").cast("bigint").alias("doc_no"),
        F.length("content").cast("bigint").alias("bytes"), F.sha1("content").alias("digest"),
    )


def classify_documents(*frames):
    files = frames[0].select("doc_id", "content")
    for more in frames[1:]:
        files = files.unionAll(more.select("doc_id", "content"))
    return docs_ops.classify_relay_documents(files).groupBy("doc_type").agg(
        F.count(F.lit(1)).alias("documents")
    )


def document_digest(files):
    """Digest over whole texts, up to the first signature."""
    return files.select(
        "doc_id",
        digests.span_digest(
            F.col("content"), F.col("text"), "router ", "\nrouter-signature\n"
        ).alias("digest"),
    )


def status_headers(docs):
    named = F.transform("vote_references", lambda r: F.concat_ws(" ", r["dirsource"], r["digest"]))
    return statuses.status_headers(docs.select("doc_id", "text")).withColumns(
        {"vote_sources": F.array_join("vote_sources", ","), "vote_references": F.array_join(named, ",")}
    )


def parse_status_entries(docs):
    rows = statuses.status_entries(docs, keep=["doc_id"])
    return rows.withColumn("rawdesc", tx.body(F.col("rawdesc"))).select(
        "*", F.to_date("validafter").alias("date")
    )


def flag_counts(docs):
    return statuses.flag_counts(docs, keep=["doc_id"])


def identity_hash(docs):
    entries = statuses.status_entries(docs)
    return statuses.hashed_relays(entries)


def vote_digest(docs):
    return descriptors.vote_digests(docs, keep=["doc_id"])


def parse_server_descriptors(docs):
    return descriptors.server_descriptors(docs, keep=["doc_id"]).drop("rawdesc")


def parse_extra_infos(docs):
    return descriptors.extra_infos(docs, keep=["doc_id"]).drop("rawdesc", "extrainfo")


def history_explode(docs):
    return descriptors.history_values(docs, keep=["doc_id"]).select(
        "doc_id", "type", "intervalend", "value"
    )


def history_pivot(docs):
    values = descriptors.history_values(docs, keep=["doc_id"])
    return descriptors.history_rows(values, keep=["doc_id"]).drop("extrainfo")


def dirreq_observations(docs):
    return descriptors.directory_requests(docs, keep=["doc_id"])


def stale_consensus(docs):
    return docs_ops.stale_consensus(docs, "1997-01-01 00:00:00")


def references_seen(status_docs, server_docs):
    """References from consensuses, from entries of all statuses, and from server descriptors."""
    headers = statuses.status_headers(status_docs.select("doc_id", "text")).where("is_consensus")
    entries = statuses.vote_entries(status_docs)
    servers = descriptors.server_descriptors(server_docs)
    return completeness.references_seen(headers, entries, servers)


def _known_bridges(docs):
    return bridges.with_identity(docs)


def bridge_users_documents(docs):
    return bridges.bridge_users(_known_bridges(docs), keep=["doc_id"]).select(
        "doc_id", "bridge", "seen", "kind", "country", "users"
    )


def bridge_unknown_only(docs, relays):
    """Bridge users without the bridges seen as relays."""
    known = relays.select(
        F.upper(F.sha1(F.unhex(F.sha1(F.concat(F.lit("id"), F.col("hashed_relay").cast("string")).cast("binary")))))
        .alias("hashed_relay")
    )
    users = bridges.without_known_relays(bridges.bridge_users(_known_bridges(docs)), known)
    return users.groupBy("date", "kind", "country").agg(F.round(F.sum("users"), 2).alias("users"))


def bridge_unknown_query(spark, sf_dir):
    return bridge_unknown_only(
        documents(spark, sf_dir, "bridge_docs"), view(spark, sf_dir, "v_hashed_relays")
    )


def bridge_running(docs):
    return bridges.running_bridges(docs, keep=["doc_id"])


def broken_versions(docs):
    return bridges.broken_versions(bridges.with_identity(docs), prefix="Rly 0.2.2")


# ------------------------------------------------------------ consensus health

def _arrays(rows, *key):
    return rows.groupBy(*key).agg(F.collect_set("flag").alias("flags"))


def _flag_inputs(votes, consensus, known):
    per_vote = _arrays(votes, "relay", "dir")
    known_by_dir = _arrays(known, "dir").withColumnRenamed("flags", "known_flags")
    return per_vote.join(known_by_dir, "dir", "left"), _arrays(consensus, "relay")


def flag_matrix(votes, consensus, known):
    return health.flag_matrix(*_flag_inputs(votes, consensus, known))


def flag_overlap(votes, consensus, known):
    return health.flag_overlap(flag_matrix(votes, consensus, known), known)


def _is_vote():
    return statuses.is_vote(F.col("text"))


def missing_votes(spark, sf_dir):
    tables(spark, sf_dir, "supplier")
    expected = spark.sql("SELECT DISTINCT concat('auth', CAST(s_suppkey % 8 AS STRING)) AS dir FROM supplier")
    return health.missing_votes(view(spark, sf_dir, "v_vote_flags").where("dir <> 'auth7'"), expected)


def _parsed_statuses(docs, *columns):
    """Header lines and entries of all documents, parsed once: a row per entry, and one for a document without any."""
    spark, path = docs.sparkSession, f"{scratch(docs.sparkSession)}/parsed"
    headers = health.health_headers(docs, keep=["doc_id", "text"])
    entries = statuses.vote_entries(headers, keep=["doc_id", "is_consensus", "validafter", "dir", "known_flags"], outer=True)
    parsed = entries.select("doc_id", "is_consensus", "validafter", "dir", "known_flags", "has_flags", "flags", *columns)
    parsed.write.parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)


def vote_relay_counts(docs):
    """Relays by time and authority, and those of one consensus per time."""
    parsed = _parsed_statuses(docs)
    consensus = health_report.one_consensus(parsed.select("doc_id", "is_consensus", "validafter", "dir"))
    listed = lambda rows: rows.select("doc_id", "validafter", "dir", "flags", "has_flags")
    votes = listed(parsed.where("NOT is_consensus"))
    chosen = listed(parsed.where("is_consensus")).join(consensus.select("doc_id"), "doc_id", "left_semi")
    return health.relay_counts(health.with_consensus_rows(votes, chosen), by=("validafter", "dir"))


def health_report_rows(spark, sf_dir):
    """The whole report on the documents of the latest time with a vote and a consensus, as rows (table, key, value)."""
    docs = documents(spark, sf_dir, "status_docs")
    return health_report.report_rows(health_report.health_report(docs, NOW, scratch(spark), with_votes=True))


def bandwidth_scanners(docs):
    entries = statuses.vote_entries(docs.where(_is_vote()), keep=["doc_id"])
    return health.bandwidth_scanners(entries.withColumnRenamed("doc_id", "dir"))


def authority_versions(docs):
    entries = statuses.vote_entries(docs.where(~_is_vote()), keep=["doc_id"])
    return health.authority_versions(entries)


def _vote_headers(docs):
    """Header lines of all votes, and of one consensus per time."""
    headers = health.health_headers(docs, keep=["doc_id"])
    return headers.where("NOT is_consensus"), health_report.one_consensus(headers)


def method_support(docs):
    return health.method_support(*_vote_headers(docs))


def version_agreement(docs):
    return health.version_agreement(*_vote_headers(docs))


def params_conflicts(docs):
    return health.parameter_conflicts(*_vote_headers(docs)).drop("params")


def expiring_keys(docs):
    return health.expiring_keys(_vote_headers(docs)[0], NOW)


def latest_votes(docs):
    return health_report.latest_documents(docs).where("NOT is_consensus").select("validafter", "dir")


def flag_overlap_documents(docs):
    """Flags of parsed votes by authority and place in the vote, against those of parsed consensuses."""
    place = F.substring_index("nickname", "x", -1).alias("relay")
    parsed = _parsed_statuses(docs, place)
    # Documents without entries have headers only.
    entries = parsed.where("has_flags IS NOT NULL")
    together = lambda rows, *key: rows.groupBy(*key).agg(F.array_distinct(F.flatten(F.collect_set("flags"))).alias("flags"))
    known = health.known_flags(parsed.where("NOT is_consensus")).select("dir", "flag").distinct()
    voted = together(entries.where("NOT is_consensus"), "relay", "dir").join(
        known.groupBy("dir").agg(F.collect_set("flag").alias("known_flags")), "dir", "left"
    )
    return health.flag_overlap(health.flag_matrix(voted, together(entries.where("is_consensus"), "relay")), known)


def archive_report(spark, sf_dir):
    """Completeness of the consensuses of the last times and the votes they name, from parsed documents."""
    docs, root = documents(spark, sf_dir, "status_docs"), scratch(spark)

    def written(name, frame):
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    headers = statuses.status_headers(docs.select("doc_id", "text"))
    # Digests of votes as their files are named.
    headers = headers.withColumn("digest", F.expr("CASE WHEN NOT is_consensus THEN concat('D', doc_id DIV 8 % 2) END"))
    wanted = written("wanted", completeness.report_documents(written("headers", headers), REPORT_TIMES))
    current = docs.join(wanted.select("doc_id"), "doc_id", "left_semi")
    parsed = written("entries", statuses.vote_entries(current, keep=["doc_id"]))
    entries = parsed.join(wanted.select("doc_id", "validafter", "is_consensus", "dirsource", "digest"), "doc_id")
    # What is at hand: descriptors of four documents of five; those of even documents name an extra-info.
    have = parsed.where("doc_id % 5 <> 0").select(
        "doc_id", "descriptor", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("x"), "descriptor")).alias("extrainfo")
    )
    extras = have.where("doc_id % 4 = 0").select("extrainfo")
    return completeness.archive_report(wanted, entries, have.select("descriptor", "extrainfo"), extras, REPORT_TIMES)


def known_flags(docs):
    return health.known_flags(*_vote_headers(docs))


# ------------------------------------------------------------ completeness, ranges

def archive_completeness(refs, have):
    """Orders refer to customers; even customers at hand name a further document."""
    servers = have.select(
        F.col("doc_id").alias("descriptor"),
        F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") + 1).alias("extrainfo"),
    )
    extras = have.where("doc_id % 3 <> 0").select(F.col("doc_id").alias("extrainfo"))
    references = refs.select("published", F.col("doc_id").alias("descriptor"))
    return completeness.archive_completeness(references, servers, extras, ["published"])


def last_three_documents(refs):
    return completeness.last_documents(refs, "published", 3)


def vote_completeness(refs, have):
    named = refs.select("published", F.col("doc_id").alias("dirsource"))
    found = refs.join(have, "doc_id", "left_semi").select("published", F.col("doc_id").alias("dirsource"))
    return completeness.vote_completeness(named, found, ["published"])


def missing_references(refs, have):
    """Referenced documents not at hand, published after a cut-off."""
    typed = refs.select(F.lit("server").alias("type"), "published", "doc_id")
    known = have.select(F.lit("server").alias("type"), "doc_id")
    at_hand = typed.join(known, ["type", "doc_id"], "left_semi")
    return completeness.missing_references(
        typed, at_hand, "1998-01-02 00:00:00", key=("type", "published", "doc_id")
    ).drop("type")


def missing_counts(refs, have):
    missing = missing_references(refs, have).withColumn("type", F.lit("server"))
    return completeness.missing_counts(missing)


def ip_country(ips, ranges):
    return ip_ranges.lookup_country(
        ip_ranges.choose_version(ips, ranges, "day"), ranges
    ).select("req_id", "version", "country")


def ip_country_shuffled(ips, ranges):
    """The same lookup with the codes of no country in any case."""
    return ip_ranges.lookup_country(
        ip_ranges.choose_version(ips, ranges, "day"), ranges, any_case=True
    ).select("req_id", "version", "country")


def ip_country_gaps(ips, ranges):
    """The old lookup: gaps between ranges belong to the range before them."""
    return ip_ranges.lookup_country(
        ip_ranges.choose_version(ips, ranges, "day"), ranges, fill_gaps=True
    ).select("req_id", "version", "country")


def db_version_asof(ips, ranges):
    now = ip_ranges.choose_version(ips, ranges, "day")
    return ip_ranges.choose_version(
        now.withColumnRenamed("version", "version_now"), ranges, "day", days_earlier=7
    ).select("req_id", "version_now", F.col("version").alias("version_week"))


def ip_overlay(ranges):
    return ip_ranges.overlay_table(ranges)


def _stored_overlay(spark, sf_dir):
    """A stored overlay to which the versions of the ranges were added one by one."""
    root = scratch(spark)
    overlay_store.add_versions(spark, root, view(spark, sf_dir, "v_ip_ranges"))
    return root


def stored_overlay(spark, sf_dir):
    return overlay_store.overlay_table(spark, _stored_overlay(spark, sf_dir))


def ip_country_stored(spark, sf_dir):
    """The lookup of ``ip_country`` in the stored overlay."""
    marks = overlay_store.read_marks(spark, _stored_overlay(spark, sf_dir))
    lookups = ip_ranges.choose_version(view(spark, sf_dir, "v_ips"), view(spark, sf_dir, "v_ip_ranges"), "day")
    return overlay_store.lookup_country(lookups, marks).select("req_id", "version", "country")


def statuses_to_rewrite(spark, sf_dir):
    tables(spark, sf_dir, "events", "orders")
    events = spark.sql("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ) AS validafter, event_id AS status FROM events")
    changed = spark.sql(
        "SELECT CAST(TIMESTAMP'2024-01-01 00:00:00' AS TIMESTAMP_NTZ) + make_dt_interval(CAST(o_custkey % 20 AS INT) * 3,"
        " CAST(o_orderkey % 24 AS INT)) AS published FROM orders"
    )
    return intervals.statuses_to_rewrite(events, changed)


# ------------------------------------------------------------ pseudonymisation

def scrub_servers(docs):
    return pseudonymise.scrub_servers(docs, keep=["doc_id"])


def scrub_extras(docs):
    return pseudonymise.scrub_extras(docs, keep=["doc_id"])


def relink_servers(servers, extras):
    linked = pseudonymise.link_servers(
        pseudonymise.scrub_servers(servers, keep=["doc_id"]), pseudonymise.scrub_extras(extras)
    )
    return linked.select("doc_id", "bridge", "published", "extra_digest", "server_digest")


def reference_mapping(servers, extras):
    infos = pseudonymise.scrub_extras(extras)
    return pseudonymise.reference_mapping(
        pseudonymise.link_servers(pseudonymise.scrub_servers(servers), infos), infos
    )


def relink_statuses(statuses_, servers, extras):
    batch = pseudonymise.pseudonymise_batch(statuses_, servers, extras, ["doc_id"])
    return batch["statuses"]


def resanitized_servers(servers, extras):
    """Scrubbed servers and extra-infos go through the second form of the job unchanged."""
    infos = pseudonymise.scrub_extras(extras)
    linked = pseudonymise.link_servers(pseudonymise.scrub_servers(servers, keep=["doc_id"]), infos)
    as_text = lambda frame, *keep: frame.select(*keep, F.col("scrubbed").alias("text"))
    again = pseudonymise.link_servers(
        pseudonymise.sanitized_servers(as_text(linked, "doc_id"), keep=["doc_id"]), pseudonymise.sanitized_extras(as_text(infos))
    )
    return again.select("doc_id", "bridge", "published", "extra_digest", "server_digest")


def _late_batches(spark, sf_dir):
    """A store to which the extra-infos of odd documents come late, after all servers and statuses."""
    root = scratch(spark)
    status_docs, servers, extras = (documents(spark, sf_dir, n) for n in ("bridge_status_docs", "bridge_server_docs", "bridge_extra_docs"))
    noon = F.lit("2010-02-01 12:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.pmod(F.col("doc_id"), F.lit(14)).cast("int"))
    statuses_ = status_docs.select(F.col("doc_id").cast("string").alias("status"), noon.alias("validafter"), "text")
    bridge_store.apply_batch(spark, root, 1, statuses_, servers, extras.where("doc_id % 2 = 0"))
    bridge_store.apply_batch(spark, root, 2, extras=extras.where("doc_id % 2 <> 0"))
    return root


def late_extra_infos(spark, sf_dir):
    """Stored servers after late extra-infos: the same as if all had come together."""
    found = bridge_store.read_table(spark, _late_batches(spark, sf_dir), "servers")
    return found.select("bridge", "published", "extra_digest", "server_digest")


def rewritten_statuses(spark, sf_dir):
    """Stored statuses after late extra-infos: those of the 24 hours after a changed server are written anew."""
    found = bridge_store.read_table(spark, _late_batches(spark, sf_dir), "statuses")
    return found.select(F.col("status").cast("bigint").alias("doc_id"), "scrubbed")


def resanitized_statuses(spark, sf_dir):
    """Stored scrubbed documents go through the second form of the job unchanged."""
    raw = [documents(spark, sf_dir, n) for n in ("bridge_status_docs", "bridge_server_docs", "bridge_extra_docs")]
    root = scratch(spark)
    batch = pseudonymise.write_batch(spark, root, 1, *raw, ["doc_id"])
    lines = pseudonymise.sanitized_statuses(
        batch["statuses"].withColumnRenamed("scrubbed", "text"), keep=["doc_id"]
    )
    # Needed twice, parsed once.
    lines.write.parquet(f"{root}/again")
    lines = spark.read.schema(lines.schema).parquet(f"{root}/again")
    mapping = pseudonymise.mapping_with_read_digests(batch["mapping"], lines)
    return pseudonymise.link_statuses(lines, mapping, ["doc_id"])


QUERIES = {
    # daily statistics
    "relay_statuses_per_day": _q(daily.relay_statuses_per_day, "v_status"),
    "network_size": _q(daily.network_size, "v_status"),
    "network_size_hour": _q(daily.network_size_hour, "v_status"),
    "relay_platforms": _q(daily.relay_platforms, "v_status", "v_descriptor"),
    "relay_versions": _q(daily.relay_versions, "v_status", "v_descriptor"),
    "total_bandwidth": _q(daily.total_bandwidth, "v_status", "v_descriptor"),
    "total_bwhist": _q(daily.total_bwhist, "v_bwhist"),
    "dirreq_split": _q(daily.dirreq_split, "v_dirreq"),
    "relay_attributes": _q(daily.relay_attributes, "v_status"),
    "reporting_relays": _q(daily.reporting_relays, "v_dirreq"),
    "user_stats": _q(daily.user_stats, "v_status", "v_bwhist", "v_dirreq"),
    "tutorial_running_exit": _q(daily.tutorial_running_exit, "v_status"),
    "tutorial_versions": _q(daily.tutorial_versions, "v_status", "v_descriptor"),
    "network_size_dirty": _limited(daily.network_size, "v_status"),
    "relay_platforms_dirty": _limited(daily.relay_platforms, "v_status", "v_descriptor"),
    "total_bwhist_dirty": _limited(daily.total_bwhist, "v_bwhist"),
    "user_stats_dirty": _limited(daily.user_stats, "v_status", "v_bwhist", "v_dirreq"),
    "partial_refresh": _q(partial_refresh, "v_status", "v_updates"),
    "refresh_vanished": _q(refresh_vanished, "v_status", "v_updates"),
    # summaries
    "consensus_daily_avg": _q(lambda s: summaries.relay_daily_averages(_relay_counts(s)), "v_status"),
    "bridge_daily_avg": _q(lambda o: summaries.bridge_daily_averages(_bridge_counts(o)), "v_bridge_obs"),
    "daily_relays_bridges_spine": _q(daily_spine, "v_status", "v_bridge_obs"),
    "bridge_latest": _q(summaries.latest_observations, "v_bridge_obs"),
    "bridge_users": _q(summaries.bridge_users_by_day, "v_bridge_obs", "v_hashed_relays", "v_broken"),
    "bridge_stats_rows": _q(
        lambda *v: summaries.bridge_stats_rows(summaries.bridge_users_by_day(*v)),
        "v_bridge_obs", "v_hashed_relays", "v_broken",
    ),
    "timing_log": timing_log,
    "timing_quartiles": _q(summaries.timing_quartiles, "v_timing"),
    "last_observation": _q(lambda t: summaries.last_observation(t, "source", "started"), "v_timing"),
    "package_log": package_log,
    "package_wide": _q(package_wide, "v_packages"),
    # keyed tables
    "insert_if_absent": _q(insert_if_absent, "v_status"),
    "upsert_rows": _q(upsert_actions, "v_dirreq"),
    "upsert_actions": _q(lambda d: keyed_tables.action_counts(upsert_actions(d)), "v_dirreq"),
    "changed_values": _q(changed_values, "v_bridge_obs"),
    "dirty_dates": dirty_dates_query,
    "denormalised_mirror": _q(keyed_tables.denormalised_mirror, "v_status", "v_descriptor"),
    "mirror_refresh": _q(mirror_refresh, "v_status", "v_descriptor"),
    "mirror_batches": mirror_batches,
    # documents
    "split_documents": _d(split_documents, "cached_files"),
    "document_digest": _d(document_digest, "cached_files"),
    "classify_documents": _d(classify_documents, "status_docs", "server_docs", "extra_docs", "bridge_status_docs"),
    "status_headers": _d(status_headers, "status_docs"),
    "stale_consensus": _d(stale_consensus, "status_docs"),
    "references_seen": _d(references_seen, "status_docs", "server_docs"),
    "parse_status_entries": _d(parse_status_entries, "status_docs"),
    "flag_counts": _d(flag_counts, "status_docs"),
    "identity_hash": _d(identity_hash, "status_docs"),
    "vote_digest": _d(vote_digest, "status_docs"),
    "parse_server_descriptors": _d(parse_server_descriptors, "server_docs"),
    "parse_extra_infos": _d(parse_extra_infos, "extra_docs"),
    "history_explode": _d(history_explode, "extra_docs"),
    "history_pivot": _d(history_pivot, "extra_docs"),
    "dirreq_observations": _d(dirreq_observations, "extra_docs"),
    "bridge_users_geoip": _d(bridge_users_documents, "bridge_docs"),
    "bridge_unknown_only": bridge_unknown_query,
    "bridge_running": _d(bridge_running, "bridge_status_docs"),
    "broken_versions": _d(broken_versions, "bridge_server_docs"),
    # consensus health
    "flag_matrix": _q(flag_matrix, "v_vote_flags", "v_consensus_flags", "v_known_flags"),
    "flag_overlap": _q(flag_overlap, "v_vote_flags", "v_consensus_flags", "v_known_flags"),
    "known_flags": _d(known_flags, "status_docs"),
    "missing_votes": missing_votes,
    "vote_relay_counts": _d(vote_relay_counts, "status_docs"),
    "health_report": health_report_rows,
    "bandwidth_scanners": _d(bandwidth_scanners, "status_docs"),
    "authority_versions": _d(authority_versions, "status_docs"),
    "method_support": _d(method_support, "status_docs"),
    "version_agreement": _d(version_agreement, "status_docs"),
    "params_conflicts": _d(params_conflicts, "status_docs"),
    "expiring_keys": _d(expiring_keys, "status_docs"),
    "latest_votes": _d(latest_votes, "status_docs"),
    "flag_overlap_documents": _d(flag_overlap_documents, "status_docs"),
    "archive_report": archive_report,
    "consensus_age": _q(lambda s: health.consensus_age(s, NOW), "v_status"),
    "stale_status": _q(lambda s: docs_ops.latest_is_stale(s, "2024-02-02 00:00:00"), "v_status"),
    # completeness, ranges
    "archive_completeness": _q(archive_completeness, "v_refs", "v_have"),
    "last_three_documents": _q(last_three_documents, "v_refs"),
    "vote_completeness": _q(vote_completeness, "v_refs", "v_have"),
    "missing_references": _q(missing_references, "v_refs", "v_have"),
    "missing_counts": _q(missing_counts, "v_refs", "v_have"),
    "ip_country": _q(ip_country, "v_ips", "v_ip_ranges"),
    "ip_country_shuffled": _q(ip_country_shuffled, "v_ips", "v_ip_ranges"),
    "ip_country_gaps": _q(ip_country_gaps, "v_ips", "v_ip_ranges"),
    "db_version_asof": _q(db_version_asof, "v_ips", "v_ip_ranges"),
    "ip_overlay": _q(ip_overlay, "v_ip_ranges"),
    "statuses_to_rewrite": statuses_to_rewrite,
    # pseudonymisation
    "scrub_servers": _d(scrub_servers, "bridge_server_docs"),
    "scrub_extras": _d(scrub_extras, "bridge_extra_docs"),
    "relink_servers": _d(relink_servers, "bridge_server_docs", "bridge_extra_docs"),
    "reference_mapping": _d(reference_mapping, "bridge_server_docs", "bridge_extra_docs"),
    "relink_statuses": _d(relink_statuses, "bridge_status_docs", "bridge_server_docs", "bridge_extra_docs"),
    "resanitized_statuses": resanitized_statuses,
    "resanitized_servers": _d(resanitized_servers, "bridge_server_docs", "bridge_extra_docs"),
    "rewritten_statuses": rewritten_statuses,
    "late_extra_infos": late_extra_infos,
    "timing_stats_batches": timing_stats_batches,
    "package_stats_batches": package_stats_batches,
    "bridge_history": bridge_history_batches,
    "stored_overlay": stored_overlay,
    "ip_country_stored": ip_country_stored,
    # sources and sinks
    **FILE_QUERIES,
}
