"""Scrub bridge documents and keep the references between them intact.

Scrubbing is row by row and fails closed: a line that is not on the list drops
its document.  Digests depend on content that names other digests, so a batch
is linked in dependency order: extra-info, then server descriptor, then status.
"""

from pyspark.sql import functions as F

from lanternstats.functions import digests, text as tx
from lanternstats.operators.intervals import statuses_to_rewrite

NO_REFERENCE = "0" * 40
LOCAL = " 127.0.0.1 "  # stands for every address
# Line starts copied unchanged, and whole lines copied unchanged (fixed values).
SERVER_COPIED = [
    "reject ", "accept ", "platform ", "opt protocols ", "uptime ", "bandwidth ", "opt hibernating ",
]
SERVER_COPIED_WHOLE = ["opt hidden-service-dir", "opt caches-extra-info", "opt allow-single-hop-exits"]
EXTRA_COPIED = [
    "published ", "write-history ", "read-history ", "geoip-start-time ",
    "geoip-client-origins ", "bridge-stats-end ", "bridge-ips ",
]
EXTRA_DROPPED = ["dirreq-", "cell-", "exit-"]

_KEY_BLOCK = "(?ms)^(?:-----BEGIN |onion-key$|signing-key$).*?^-----END [^\n]*(?:\n|\\z)"
_SKIP = ""  # scrubbed lines are never empty, so an empty one marks a dropped line


def _any_start(line, keywords):
    test = line.startswith(keywords[0])
    for keyword in keywords[1:]:
        test = test | line.startswith(keyword)
    return test


def _signed_lines(text, remove_keys):
    """Lines before the signature; null if there is no signature line."""
    plain = F.regexp_replace(text, "\r\n?", "\n")
    if remove_keys:
        plain = F.regexp_replace(plain, _KEY_BLOCK, "")
    cut = F.regexp_extract(plain, "(?ms)\\A(.*?)^router-signature", 1)
    return F.when(plain.rlike("(?m)^router-signature"), F.split(F.regexp_replace(cut, "\n\\z", ""), "\n"))


def _grouped(digest):
    """Upper-case digest in groups of four."""
    return F.trim(F.regexp_replace(F.upper(digest), "(.{4})", "$1 "))


def _joined(lines):
    return F.concat(F.array_join(F.filter(lines, lambda x: x != _SKIP), "\n"), F.lit("\n"))


def _known(lines):
    """All lines were recognised."""
    return lines.isNotNull() & ~F.exists(lines, lambda x: x.isNull())


def _rest(line, start):
    return F.substring(line, len(start) + 1, 2147483647)


def _hashed(identity):
    """Hashed identity; null, which drops the document, unless it has 40 hex digits."""
    return F.when(F.length(identity) == 40, digests.sha1_of_hex(identity))


def _server_line(line):
    parts = F.split(line, " ")
    port = lambda n: F.try_element_at(parts, F.lit(n + 1))
    identity = F.regexp_replace(_rest(line, "opt fingerprint"), " ", "")
    member = lambda s: F.when(s.startswith("$"), F.concat(F.lit("$"), _hashed(_rest(s, "$")))).otherwise("Unnamed")
    family = F.transform(F.split(_rest(line, "family "), " "), member)
    return (
        F.when(
            line.startswith("router "),
            F.concat(F.lit("router Unnamed 127.0.0.1 "), port(3), F.lit(" "), port(4), F.lit(" "), port(5)),
        )
        .when(line.startswith("published "), line)
        .when(
            line.startswith("opt fingerprint "),
            F.concat(F.lit("opt fingerprint "), _grouped(_hashed(identity))),
        )
        .when(line.startswith("contact "), F.lit("contact somebody"))
        .when(line.startswith("opt extra-info-digest "), F.lit("opt extra-info-digest " + NO_REFERENCE))
        .when(_any_start(line, SERVER_COPIED) | line.isin(SERVER_COPIED_WHOLE), line)
        .when(
            line.startswith("family ") & ~F.exists(family, lambda s: s.isNull()),
            F.concat(F.lit("family "), F.array_join(family, " ")),
        )
        .when(line.startswith("@purpose ") | line.startswith("-----END "), F.lit(_SKIP))
    )


def scrub_servers(docs, keep=()):
    """Scrubbed server descriptors as ``bridge, published, scrubbed``.

    The extra-info digest is left at 40 zeros until ``link_servers``.  A digest
    line that comes before the publication time or the fingerprint drops the
    document, as does a missing one of them.
    """
    cut = tx.bind(docs, _lines=_signed_lines(F.col("text"), True)).where("_lines IS NOT NULL")
    scrubbed = tx.bind(cut, _out=F.transform("_lines", _server_line)).where(_known(F.col("_out")))
    position = lambda keyword: tx.first_position(F.col("_lines"), lambda x: x.startswith(keyword))
    start = tx.last_position(F.col("_lines"), lambda x: x.startswith("router "))
    return (
        tx.bind(
            scrubbed, _published=position("published "), _identity=position("opt fingerprint "),
            _digest=position("opt extra-info-digest "),
        )
        .where(
            (F.col("_published") > 0) & (F.col("_identity") > 0)
            & ((F.col("_digest") == 0) | (F.col("_digest") > F.greatest("_published", "_identity")))
        )
        .select(
            *keep,
            F.lower(
                F.regexp_replace(tx.last_value(F.col("_out"), "opt fingerprint "), " ", "")
            ).alias("bridge"),
            tx.last_value(F.col("_out"), "published ").alias("published"),
            _joined(F.slice("_out", F.greatest(start, F.lit(1)), F.size("_out"))).alias("scrubbed"),
        )
    )


def _extra_line(line):
    identity = digests.sha1_of_hex(tx.field(line, 2))
    return (
        F.when(line.startswith("extra-info "), F.concat(F.lit("extra-info Unnamed "), identity))
        .when(_any_start(line, EXTRA_COPIED), line)
        .when(_any_start(line, EXTRA_DROPPED), F.lit(_SKIP))
    )


def scrub_extras(docs, keep=()):
    """Scrubbed extra-info descriptors as ``bridge, published, scrubbed, extra_digest``."""
    cut = tx.bind(docs, _lines=_signed_lines(F.col("text"), False)).where("_lines IS NOT NULL")
    rows = (
        tx.bind(cut, _out=F.transform("_lines", _extra_line))
        .where(_known(F.col("_out")))
        .select(
            *keep,
            F.lower(tx.field(tx.last(tx.starting(F.col("_out"), "extra-info ")), 2)).alias("bridge"),
            tx.last_value(F.col("_out"), "published ").alias("published"),
            _joined(F.col("_out")).alias("scrubbed"),
        )
        .where("bridge IS NOT NULL AND published IS NOT NULL")
    )
    return tx.bind(rows, extra_digest=_text_digest(F.col("scrubbed")))


def _text_digest(text):
    return F.sha1(tx.to_bytes(text))


def _entries(docs, plain, keep, is_entry, identity):
    """One row per ``r`` line with the lines after it, and one for lines before the first; see ``scrub_statuses``.

    ``_parts`` are the fields of the ``r`` line; ``bridge`` is what ``identity`` makes of the second.
    """
    rows = docs.select(*keep, F.posexplode_outer(F.split(plain, "\n(?=r )")).alias("line_no", "_block"))
    rows = tx.bind(rows, _parts=F.split(F.substring_index("_block", "\n", 1), " "))
    is_r = F.col("_block").startswith("r ") & is_entry(F.col("_parts"))
    return tx.bind(rows, _is_r=is_r, bridge=F.when(is_r, identity(F.try_element_at(F.col("_parts"), F.lit(3)))))


def _of_entries(line):
    """Publication time, other text and what follows the address of the rows of ``_entries``."""
    part = lambda n: F.try_element_at(F.col("_parts"), F.lit(n + 1))
    is_r, known = F.col("_is_r"), F.col("bridge").isNotNull()
    time = F.concat_ws(" ", part(4), part(5))
    after = F.col("_block").substr(F.length(F.substring_index("_block", "\n", 1)) + 1, F.lit(2147483647))
    rest = F.concat(part(7), F.lit(" "), part(8), after)
    return [
        F.when(is_r & known, time).alias("published"),
        F.when(is_r, line).otherwise(F.col("_block")).alias("line"),
        F.when(is_r, F.when(known, rest).otherwise(F.concat(time, F.lit(LOCAL), rest))).alias("tail"),
    ]


def scrub_statuses(docs, keep=()):
    """Scrubbed statuses: one row per ``r`` line, with the lines after it, and its position.

    ``bridge`` (hashed identity) and ``published`` are set on these rows; ``tail`` holds what comes after the address.
    ``line`` holds text that cannot be made of these.  The digest of the descriptor is still missing.
    A status with any other line than ``r`` and ``s`` is dropped.
    """
    plain = F.regexp_replace(F.regexp_replace(F.col("text"), "\r\n?", "\n"), "\n\\z", "")
    cut = tx.bind(docs, _plain=plain).where(
        ~F.exists(
            F.split("_plain", "\n"),
            lambda x: ~(x.startswith("s ") | (x.startswith("r ") & (F.size(F.split(x, " ")) >= 9))),
        )
    )
    rows = _entries(cut, F.col("_plain"), keep, lambda _: F.lit(True), lambda x: F.lower(digests.sha1_of_base64(x)))
    return rows.select(*keep, "line_no", "bridge", *_of_entries(F.lit(None).cast("string")))


def set_extra_digest(text, digest):
    """Server descriptor text with the digest of its extra-info line replaced."""
    return F.regexp_replace(
        text, F.lit("(?m)^opt extra-info-digest .*$"),
        F.concat(F.lit("opt extra-info-digest "), F.upper(digest)),
    )


def _one_per_key(rows, *values):
    """One row per bridge and time; of several documents the largest text counts."""
    return rows.groupBy("bridge", "published").agg(
        F.max(F.struct(*values)).alias("_row")
    ).select("bridge", "published", "_row.*")


def link_servers(servers, extras, mapping=None):
    """Server descriptors with extra-info digests and their own final digest.

    Digests of this batch come first, then those of the stored ``mapping``, then zeros.
    """
    fresh = _one_per_key(extras, "extra_digest")
    linked = servers.join(fresh, ["bridge", "published"], "left")
    if mapping is not None:
        stored = mapping.select("bridge", "published", F.col("extra_digest").alias("_stored"))
        linked = linked.join(stored, ["bridge", "published"], "left").withColumn(
            "extra_digest", F.coalesce("extra_digest", "_stored")
        ).drop("_stored")
    known = linked.withColumn("extra_digest", F.coalesce("extra_digest", F.lit(NO_REFERENCE)))
    final = tx.bind(
        known, _text=set_extra_digest(F.col("scrubbed"), F.col("extra_digest"))
    ).drop("scrubbed").withColumnRenamed("_text", "scrubbed")
    return tx.bind(final, server_digest=_text_digest(F.col("scrubbed")))


def reference_mapping(linked_servers, extras, stored=None, status_lines=None):
    """(bridge, time) to the digests of both descriptors, 40 zeros where unknown.

    New digests replace stored ones; rows known only to the stored mapping or
    only named by a status stay.
    """
    servers = _one_per_key(linked_servers, "server_digest")
    infos = _one_per_key(extras, "extra_digest")
    keys = ["bridge", "published"]
    mapping = servers.join(infos, keys, "full")
    if status_lines is not None:
        named = status_lines.where("bridge IS NOT NULL").select(_bytes_of(F.col("bridge")).alias("_bridge"), "published").distinct()
        named = named.select(F.lower(F.hex("_bridge")).alias("bridge"), "published")
        mapping = mapping.join(named, keys, "full")
    if stored is not None:
        old = stored.select(
            *keys, F.col("server_digest").alias("_server"), F.col("extra_digest").alias("_extra")
        )
        mapping = mapping.join(old, keys, "full").select(
            *keys,
            F.coalesce("server_digest", "_server").alias("server_digest"),
            F.coalesce("extra_digest", "_extra").alias("extra_digest"),
        )
    return mapping.select(
        *keys,
        F.coalesce("server_digest", F.lit(NO_REFERENCE)).alias("server_digest"),
        F.coalesce("extra_digest", F.lit(NO_REFERENCE)).alias("extra_digest"),
    )


def _bytes_of(column):
    """Bytes of a hex value, half as many as digits; null for what is none."""
    return F.when(F.length(column) % 2 == 0, F.unhex(column))


def link_statuses(status_lines, mapping, status_key, near=None):
    """Scrubbed statuses put together again, with the digests of the mapping.

    A status came in as one row and is put together to one row of at most the
    same number of lines.  Lines of one much-listed bridge differ in their
    time; those of one time and bridge are left to the skew handling of the join.
    Rows without a bridge get keys that match nothing, so that their nulls do not meet in one task.

    Identities and digests travel as bytes, and text is made of them where a status is put together.  With ``near``, a
    column, statuses come out in ranges of it, so a writer finds few of its values in a task.
    """
    known = mapping.select(_bytes_of(F.col("bridge")).alias("_bridge"), "published", F.unhex("server_digest").alias("_digest"))
    no_bridge = F.xxhash64(*status_key, "line_no").cast("string").cast("binary")
    keyed = status_lines.select(
        *status_key, "line_no", F.coalesce(_bytes_of(F.col("bridge")), no_bridge).alias("_bridge"), "published", "line", "tail"
    )
    filled = keyed.join(known, ["_bridge", "published"], "left")
    groups = list(status_key)
    if near is not None:
        filled = filled.withColumn("_near", near).repartitionByRange("_near", *status_key)
        groups += ["_near"]
    short = lambda column: F.substring(F.base64(column), 1, 27)
    nothing = F.unhex(F.lit(NO_REFERENCE))

    def text(x):
        head = F.coalesce(x["line"], F.when(x["published"].isNotNull(), F.concat(F.lit("r Unnamed "), short(x["_bridge"]))))
        time = F.concat(x["published"], F.lit(LOCAL))
        entry = F.concat_ws(" ", head, short(F.coalesce(x["_digest"], nothing)), F.concat(F.coalesce(time, F.lit("")), x["tail"]))
        return F.when(x["tail"].isNotNull(), entry).otherwise(x["line"])

    ordered = F.array_sort(F.collect_list(F.struct("line_no", "_bridge", "published", "line", "tail", "_digest")))
    return filled.groupBy(*groups).agg(ordered.alias("_rows")).select(
        *status_key, F.concat(F.array_join(F.transform("_rows", text), "\n"), F.lit("\n")).alias("scrubbed")
    )


def pseudonymise_batch(statuses, servers, extras, status_key, mapping=None):
    """Scrub and link one batch; returns the three document tables and the new mapping.

    A job that writes more than one of them reads ``extras`` and ``servers``
    back from what it wrote first, see ``write_batch``.
    """
    scrubbed_extras = scrub_extras(extras)
    linked = link_servers(scrub_servers(servers), scrubbed_extras, mapping)
    return _linked_batch(scrubbed_extras, linked, scrub_statuses(statuses, keep=status_key), status_key, mapping)


def _linked_batch(scrubbed_extras, linked, lines, status_key, mapping):
    return {
        "extras": scrubbed_extras,
        "servers": linked,
        "statuses": link_statuses(lines, server_digests(linked, mapping), status_key),
        "mapping": reference_mapping(linked, scrubbed_extras, mapping, lines),
    }


def server_digests(linked_servers, stored=None):
    """The server part of ``reference_mapping``: all that statuses need of it."""
    fresh = _one_per_key(linked_servers, "server_digest")
    if stored is None:
        return fresh
    keys = ["bridge", "published"]
    return fresh.unionByName(stored.select(*keys, "server_digest").join(fresh, keys, "left_anti"))


def write_batch(spark, root, batch, statuses, servers, extras, status_key, mapping=None):
    """Scrub and link one batch into Parquet tables below ``root/batch=...``; every document is scrubbed once.

    Each batch has a folder of its own, so ``mapping`` may be the table that an earlier one wrote.
    """
    def written(name, frame):
        path = f"{root}/batch={batch}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    scrubbed_extras = written("extras", scrub_extras(extras))
    linked = written("servers", link_servers(scrub_servers(servers), scrubbed_extras, mapping))
    lines = written("status_lines", scrub_statuses(statuses, keep=status_key))
    linked_batch = _linked_batch(scrubbed_extras, linked, lines, status_key, mapping)
    return {
        "extras": scrubbed_extras,
        "servers": linked,
        "statuses": written("statuses", linked_batch["statuses"]),
        "mapping": written("mapping", linked_batch["mapping"]),
    }


# Documents that are scrubbed already: same references, no scrubbing.

def sanitized_servers(docs, keep=()):
    """Already scrubbed server descriptors in the form ``link_servers`` takes."""
    plain = F.regexp_replace(F.col("text"), "\r\n?", "\n")
    lines = tx.lines(plain)
    router = F.split(tx.last(tx.starting(lines, "router ")), " ")
    port = lambda n: F.try_element_at(router, F.lit(n + 1))
    anonymous = F.concat(F.lit("router Unnamed 127.0.0.1 "), port(3), F.lit(" "), port(4), F.lit(" "), port(5))
    return docs.select(
        *keep,
        F.lower(F.regexp_replace(tx.last_value(lines, "opt fingerprint "), " ", "")).alias("bridge"),
        tx.last_value(lines, "published ").alias("published"),
        F.regexp_replace(plain, F.lit("(?m)^router .*$"), anonymous).alias("scrubbed"),
    ).where("bridge IS NOT NULL AND published IS NOT NULL AND scrubbed IS NOT NULL")


def sanitized_extras(docs, keep=()):
    """Already scrubbed extra-info descriptors in the form of ``scrub_extras``."""
    plain = F.regexp_replace(F.col("text"), "\r\n?", "\n")
    lines = tx.lines(plain)
    rows = docs.select(
        *keep,
        F.lower(tx.field(tx.last(tx.starting(lines, "extra-info ")), 2)).alias("bridge"),
        tx.last_value(lines, "published ").alias("published"),
        F.regexp_replace(plain, "(?m)^extra-info [^ \n]+ ([^ \n]+).*$", "extra-info Unnamed $1").alias("scrubbed"),
    ).where("bridge IS NOT NULL AND published IS NOT NULL")
    return rows.withColumn("extra_digest", _text_digest(F.col("scrubbed")))


def sanitized_statuses(docs, keep=()):
    """Rows of already scrubbed statuses in the form of ``scrub_statuses``.

    ``read_digest`` is the reference the status had; it stands in for a
    descriptor the mapping does not know.
    """
    plain = F.regexp_replace(F.regexp_replace(F.col("text"), "\r\n?", "\n"), "\n\\z", "")
    rows = _entries(docs, plain, keep, lambda parts: F.size(parts) >= 9, digests.hex_of_base64)
    part = lambda n: F.try_element_at(F.col("_parts"), F.lit(n + 1))
    as_read = F.when(~F.coalesce(digests.base64_of_hex(F.col("bridge")) == part(2), F.lit(False)), F.concat(F.lit("r Unnamed "), part(2)))
    return rows.select(
        *keep, "line_no", "bridge", F.when(F.col("_is_r"), digests.hex_of_base64(part(3))).alias("read_digest"), *_of_entries(as_read)
    )


def mapping_with_read_digests(mapping, status_lines):
    """Add references read from scrubbed statuses for keys the mapping lacks."""
    keys = ["_bridge", "published"]
    read = status_lines.where("bridge IS NOT NULL").groupBy(_bytes_of(F.col("bridge")).alias("_bridge"), "published").agg(
        F.max(F.unhex("read_digest")).alias("_digest")
    )
    new = read.join(mapping.select(_bytes_of(F.col("bridge")).alias("_bridge"), "published"), keys, "left_anti")
    as_hex = lambda name: F.lower(F.hex(name))
    return mapping.unionByName(
        new.select(
            as_hex("_bridge").alias("bridge"), "published", as_hex("_digest").alias("server_digest"),
            F.lit(NO_REFERENCE).alias("extra_digest"),
        )
    )


def rewrite_statuses(statuses, changed, mapping, status_key):
    """Stored scrubbed statuses (``validafter``, ``text``) whose references may have changed.

    Only statuses of the 24 hours after a changed descriptor (``published``)
    are read and linked anew; the others stay as they are stored.
    """
    affected = statuses_to_rewrite(statuses, changed)
    lines = sanitized_statuses(affected, keep=status_key)
    return link_statuses(lines, mapping_with_read_digests(mapping, lines), status_key)
