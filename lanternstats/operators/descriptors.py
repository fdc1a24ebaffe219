"""Server and extra-info descriptors of relays."""

from pyspark.sql import functions as F

from lanternstats.functions import digests, text as tx

SIGNATURE = "\nrouter-signature\n"
MAX_HISTORY_AGE = 7 * 24 * 60 * 60
UNSAFE_ROUNDING = 4  # counts are reported rounded up to a multiple of eight

# Interval-history keywords and the column each one fills (fixed values).
HISTORY_COLUMNS = {
    "read-history": "read",
    "write-history": "written",
    "dirreq-read-history": "dirread",
    "dirreq-write-history": "dirwritten",
}


def server_descriptors(docs, keep=(), old_dirport=False):
    """Rows of ``descriptor``.

    The directory port is the fifth field of the ``router`` line;
    ``old_dirport`` takes the fourth instead.
    """
    split = tx.bind(docs, _lines=tx.lines(F.col("text")))
    split = tx.bind(
        split,
        _router=F.split(tx.first(F.col("_lines")), " "),
        descriptor=digests.span_digest(F.col("content"), F.col("text"), "router ", SIGNATURE),
    ).where("descriptor IS NOT NULL")
    at = lambda n: F.try_element_at(F.col("_router"), F.lit(n + 1))
    bandwidth = tx.last(tx.starting(F.col("_lines"), "bandwidth "))
    identity = F.regexp_replace(
        tx.last(tx.starting(F.col("_lines"), "opt fingerprint", "fingerprint")),
        "^(opt )?fingerprint| ", "",
    )
    extra = F.regexp_replace(
        tx.last(tx.starting(F.col("_lines"), "opt extra-info-digest ", "extra-info-digest ")),
        "^opt ", "",
    )
    return split.select(
        *keep,
        "descriptor",
        at(1).alias("nickname"),
        at(2).alias("address"),
        tx.to_int(at(3)).alias("orport"),
        tx.to_int(at(4 if old_dirport else 5)).alias("dirport"),
        F.lower(identity).alias("fingerprint"),
        tx.to_long(tx.field(bandwidth, 1)).alias("bandwidthavg"),
        tx.to_long(tx.field(bandwidth, 2)).alias("bandwidthburst"),
        tx.to_long(tx.field(bandwidth, 3)).alias("bandwidthobserved"),
        tx.last_value(F.col("_lines"), "platform ").alias("platform"),
        tx.timestamp(tx.last_value(F.col("_lines"), "published ")).alias("published"),
        tx.to_long(tx.last_value(F.col("_lines"), "uptime ")).alias("uptime"),
        F.lower(tx.field(extra, 1)).alias("extrainfo"),
        F.col("content").alias("rawdesc"),
    )


def extra_infos(docs, keep=()):
    """Rows of ``extrainfo``."""
    split = tx.bind(
        docs,
        _lines=tx.lines(F.col("text")),
        extrainfo=digests.span_digest(F.col("content"), F.col("text"), "extra-info ", SIGNATURE),
    ).where("extrainfo IS NOT NULL")
    head = tx.first(F.col("_lines"))
    return split.select(
        *keep,
        "extrainfo",
        tx.field(head, 1).alias("nickname"),
        F.lower(tx.field(head, 2)).alias("fingerprint"),
        tx.timestamp(tx.last_value(F.col("_lines"), "published ")).alias("published"),
        F.col("content").alias("rawdesc"),
    )


def _statistics_lines(docs, keep):
    """The lines that matter for histories and requests, with what was known when each was read.

    ``_lines`` holds the line, the publication time and the request header
    before it.  A request header with fewer than five fields, a request list
    holding a bad number, or a history with a bad number ends the document.  A broken
    history line itself is kept, because the values right of the bad one count;
    one that is too old is passed over before its numbers are looked at.
    """
    relevant = tx.starting(
        tx.lines(F.col("text")), "published ", *[k + " " for k in HISTORY_COLUMNS],
        "dirreq-stats-end ", "dirreq-v3-reqs ",
    )
    cut = tx.bind(docs, _all=relevant)
    cut = tx.bind(
        cut,
        _published=tx.held(F.col("_all"), "published ", lambda line: tx.timestamp(F.substring(line, 11, 19))),
        _header=tx.held(F.col("_all"), "dirreq-stats-end "),
    )
    at = lambda column, i: F.try_element_at(F.col(column), i + 1)
    known = F.transform(
        "_all",
        lambda line, i: F.struct(
            line.alias("line"), i.alias("line_no"), at("_published", i).alias("published"), at("_header", i).alias("header")
        ),
    )
    cut = tx.bind(cut, _known=known)
    cut = tx.bind(
        cut,
        _dropped=tx.first_position(F.col("_known"), lambda s: _ends_before(s["line"])),
        _broken=tx.first_position(F.col("_known"), _ends_after),
    )
    dropped, broken = F.col("_dropped"), F.col("_broken")
    length = (
        F.when((dropped > 0) & ((broken == 0) | (dropped < broken)), dropped - 1)
        .when(broken > 0, broken)
        .otherwise(F.size("_known"))
    )
    head = F.substring_index("text", "\n", 1)
    return cut.select(
        *keep,
        digests.span_digest(F.col("content"), F.col("text"), "extra-info ", SIGNATURE).alias("extrainfo"),
        tx.field(head, 2).alias("source"),
        F.slice("_known", F.lit(1), length).alias("_lines"),
    )


def _ends_before(line):
    header = line.startswith("dirreq-stats-end ") & (F.size(F.split(line, " ")) < 5)
    requests = line.startswith("dirreq-v3-reqs ") & (F.length(line) > len("dirreq-v3-reqs ")) & F.exists(
        F.split(F.substring(line, 16, 2147483647), ","), lambda p: _count(p).isNull()
    )
    return header | requests


def _ends_after(seen):
    line = seen["line"]
    return _is_history(line) & _is_recent(_history_end(line), seen["published"]) & (
        _interval_length(line).isNull()
        | F.exists(F.split(tx.field(line, 5), ","), lambda v: tx.to_long(v).isNull())
    )


def _history_end(line):
    return tx.timestamp(F.concat_ws(" ", tx.field(line, 1), tx.field(line, 2)))


def _is_recent(end, published):
    return F.coalesce(F.abs(tx.seconds_between(end, published)) <= MAX_HISTORY_AGE, F.lit(False))


def _is_history(line):
    return line.rlike("^(dirreq-)?(read|write)-history ") & (F.size(F.split(line, " ")) == 6)


def _interval_length(line):
    return tx.to_long(F.substring(tx.field(line, 3), 2, 2147483647))


def _count(pair):
    """Number behind ``cc=`` less the rounding offset."""
    return tx.to_int(F.substring(pair, 4, 2147483647)) - UNSAFE_ROUNDING


def history_values(docs, keep=()):
    """One row per reported interval value: line type, interval end, value, and ``rank``.

    ``rank`` rises in the order in which values are set: by line, and from
    right to left within a line.

    The last value of a line ends at the line's time and each earlier value one
    interval before.  A line whose time is more than seven days from the
    publication time known when it is read is dropped, hence also a line that
    comes before the ``published`` line.
    """
    cut = _statistics_lines(docs, keep)
    histories = tx.bind(
        cut.select(
            *keep, "extrainfo", F.lower("source").alias("fingerprint"), F.inline_outer("_lines")
        ).where(_is_history(F.col("line"))),
        _end=_history_end(F.col("line")),
        _length=_interval_length(F.col("line")),
        _texts=F.split(tx.field(F.col("line"), 5), ","),
    ).where(F.col("_length").isNotNull() & _is_recent(F.col("_end"), F.col("published")))
    first_kept = tx.last_position(F.col("_texts"), lambda v: tx.to_long(v).isNull())
    values = histories.select(
        *keep, "extrainfo", "fingerprint", "line_no", "_end", "_length",
        tx.field(F.col("line"), 0).alias("type"),
        F.size("_texts").alias("_n"),
        first_kept.alias("_bad"),
        F.posexplode_outer("_texts").alias("_pos", "_text"),
    ).where("_pos >= _bad")
    return values.select(
        *keep,
        "extrainfo",
        "fingerprint",
        "type",
        (F.col("line_no").cast("bigint") * 2**31 - F.col("_pos")).alias("rank"),
        tx.seconds_before(F.col("_end"), (F.col("_n") - 1 - F.col("_pos")) * F.col("_length")).alias("intervalend"),
        tx.to_long(F.col("_text")).alias("value"),
    )


def history_rows(values, keep=()):
    """Rows of ``bwhist``: one per document and interval, a later line wins."""
    latest = lambda keyword: F.max_by(
        F.when(F.col("type") == keyword, F.col("value")),
        F.when(F.col("type") == keyword, F.col("rank")),
    )
    return values.groupBy(*keep, "fingerprint", "extrainfo", "intervalend").agg(
        *[latest(keyword).alias(column) for keyword, column in HISTORY_COLUMNS.items()]
    )


def directory_requests(docs, keep=()):
    """Requests by country: reported count less the rounding offset, and ``zy`` for their sum."""
    cut = _statistics_lines(docs, keep)
    lists = (
        cut.select(*keep, "source", F.inline_outer("_lines"))
        .where(
            F.col("line").startswith("dirreq-v3-reqs ") & (F.length("line") > len("dirreq-v3-reqs "))
        )
        .withColumn("_pairs", F.split(F.substring("line", 16, 2147483647), ","))
    )
    observations = tx.bind(
        lists,
        statsend=tx.timestamp(
            F.concat_ws(" ", tx.field(F.col("header"), 1), tx.field(F.col("header"), 2))
        ),
        seconds=_interval_length(F.col("header")),
        _obs=F.transform(
            "_pairs",
            lambda p: F.struct(
                F.substring(p, 1, 2).alias("country"), _count(p).cast("bigint").alias("n")
            ),
        ),
    ).where("statsend IS NOT NULL AND seconds IS NOT NULL")
    return explode_countries(
        observations.select(*keep, "source", "statsend", "seconds", "_obs"),
        "requests",
        F.lit(0).cast("bigint"),
    )


def explode_countries(observations, value_name, zero):
    """Explode ``_obs`` (country, n) to rows and add the total as country ``zy``.

    A country listed twice keeps its last count; the total adds all of them.
    """
    keep = [c for c in observations.columns if c != "_obs"]
    total = F.aggregate("_obs", zero, lambda acc, o: acc + o["n"])
    # Sorted by country, the last count of each first.
    by_country = F.array_sort(
        F.transform("_obs", lambda o, i: F.struct(o["country"].alias("country"), (-i).alias("at"), o["n"].alias("n")))
    )
    observations = tx.bind(observations, _sorted=by_country)
    before = lambda i: F.try_element_at(F.col("_sorted"), F.greatest(i, F.lit(1)))["country"]
    firsts = F.filter("_sorted", lambda o, i: (o["country"] != "zy") & ((i == 0) | ~o["country"].eqNullSafe(before(i))))
    last_of_country = F.transform(firsts, lambda o: F.struct(o["country"].alias("country"), o["n"].alias("n")))
    rows = F.concat(
        last_of_country,
        F.array(F.struct(F.lit("zy").alias("country"), total.alias("n"))),
    )
    return observations.select(*keep, F.inline_outer(rows)).withColumnRenamed("n", value_name)


def vote_digests(docs, keep=()):
    """Upper-case SHA-1 of a status document up to its ``directory-signature`` token."""
    return docs.select(
        *keep,
        F.upper(
            digests.span_digest(
                F.col("content"), F.col("text"), "network-status-version ", "directory-signature "
            )
        ).alias("digest"),
    )
