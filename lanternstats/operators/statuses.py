"""Network-status documents: headers, entries and counts."""

from pyspark.sql import functions as F

from lanternstats import schemas
from lanternstats.functions import digests, text as tx

MIN_ENTRY_FIELDS = 9


def status_headers(docs):
    """One row per consensus or vote: type, time, authority and the votes it names.

    ``vote_sources`` are the authorities whose ``dir-source`` line is followed
    by a ``vote-digest`` line before the next ``dir-source`` line;
    ``vote_references`` are those authorities with the digests of their votes.
    """
    head = tx.bind(docs, _head=F.substring_index("text", "\nr ", 1))
    head = tx.bind(head, _lines=tx.lines(F.col("_head")))
    sections = F.split(F.col("_head"), "\n(?=dir-source )")
    voting = F.filter(
        sections, lambda s: s.startswith("dir-source ") & F.contains(s, F.lit("\nvote-digest "))
    )
    source_line = tx.last(tx.starting(F.col("_lines"), "dir-source "))
    return head.select(
        *[c for c in docs.columns if c != "text"],
        (~F.array_contains("_lines", "vote-status vote")).alias("is_consensus"),
        tx.timestamp(tx.last_value(F.col("_lines"), "valid-after ")).alias("validafter"),
        tx.field(source_line, 1).alias("dirname"),
        tx.field(source_line, 2).alias("dirsource"),
        tx.field(tx.last(tx.starting(F.col("_lines"), "fingerprint ")), 1).alias("fingerprint"),
        F.array_sort(
            F.array_distinct(
                F.transform(voting, lambda s: tx.field(F.substring_index(s, "\n", 1), 2))
            )
        ).alias("vote_sources"),
        F.array_sort(F.array_distinct(F.flatten(F.transform(voting, _references)))).alias("vote_references"),
    )


def _references(section):
    """Authority and digest of each vote that a section of a consensus names."""
    source = tx.field(F.substring_index(section, "\n", 1), 2).alias("dirsource")
    digests_ = F.regexp_extract_all(section, F.lit("\nvote-digest ([^ \r\n]+)"), F.lit(1))
    return F.transform(digests_, lambda d: F.struct(source, d.alias("digest")))


def _entry_blocks(text):
    """Text of each entry, from its ``r`` line to the line before the next one."""
    body = F.regexp_replace(text, "\r\n?", "\n")
    return F.filter(F.split(body, "\n(?=r )"), lambda b: b.startswith("r "))


def is_vote(text):
    """Whether a status document is a vote, whatever its line ends."""
    return F.substring_index(text, "\nr ", 1).rlike("(\\A|[\r\n])vote-status vote([\r\n]|\\z)")


def _is_short(line):
    return line.startswith("r ") & (F.size(F.split(line, " ")) < MIN_ENTRY_FIELDS)


def _is_broken(block):
    """An entry whose ``r`` line cannot be read; it ends the document."""
    parts = F.split(F.substring_index(block, "\n", 1), " ")
    return (
        (F.size(parts) < MIN_ENTRY_FIELDS)
        | tx.timestamp(
            F.concat_ws(" ", F.try_element_at(parts, F.lit(5)), F.try_element_at(parts, F.lit(6)))
        ).isNull()
        | tx.to_int(F.try_element_at(parts, F.lit(8))).isNull()
        | tx.to_int(F.try_element_at(parts, F.lit(9))).isNull()
    )


def status_entries(docs, keep=()):
    """Rows of ``statusentry`` from consensus texts, without a shuffle.

    ``docs`` has ``text``; ``keep`` names further columns to carry.  Votes
    give no rows.  Entries from the first broken ``r`` line on are dropped.
    """
    consensus = docs.where(~is_vote(F.col("text")))
    blocks = tx.bind(
        consensus,
        validafter=tx.timestamp(
            tx.last_value(tx.lines(F.substring_index("text", "\nr ", 1)), "valid-after ")
        ),
        _blocks=_entry_blocks(F.col("text")),
    ).where("validafter IS NOT NULL")
    entries = (
        blocks.select(
            *keep, "validafter", F.explode_outer(tx.before_first(F.col("_blocks"), _is_broken)).alias("_block")
        )
        .where("_block IS NOT NULL")
        .withColumn("_lines", F.split("_block", "\n"))
    )
    kept = tx.bind(
        entries,
        _r=F.split(tx.first(F.col("_lines")), " "),
        _flags=F.split(tx.last(F.filter("_lines", lambda x: x.startswith("s ") | (x == "s"))), " "),
        _raw=F.filter(
            "_lines",
            lambda x: x.startswith("r ") | x.startswith("s ") | (x == "s")
            | x.startswith("v ") | x.startswith("w ") | x.startswith("p "),
        ),
    )
    r = lambda n: F.element_at("_r", n + 1)
    bandwidth = tx.last(
        tx.starting(F.flatten(F.transform(tx.starting(F.col("_raw"), "w "), lambda w: F.split(w, " "))), "Bandwidth=")
    )
    return kept.select(
        *keep,
        "validafter",
        r(1).alias("nickname"),
        digests.hex_of_base64(r(2)).alias("fingerprint"),
        digests.hex_of_base64(r(3)).alias("descriptor"),
        tx.timestamp(F.concat_ws(" ", r(4), r(5))).alias("published"),
        r(6).alias("address"),
        tx.to_int(r(7)).alias("orport"),
        tx.to_int(r(8)).alias("dirport"),
        *[
            F.coalesce(F.array_contains("_flags", flag), F.lit(False)).alias(column)
            for flag, column in schemas.FLAG_COLUMNS.items()
        ],
        tx.last_value(F.col("_raw"), "v ").alias("version"),
        tx.to_long(F.substring(bandwidth, 11, 2147483647)).alias("bandwidth"),
        tx.last_value(F.col("_raw"), "p ").alias("ports"),
        tx.to_bytes(F.concat(F.array_join("_raw", "\n"), F.lit("\n"))).alias("rawdesc"),
    )


def vote_entries(docs, keep=(), outer=False):
    """Every relay listed in a status document with its flags: consensus or vote.

    With ``outer`` a document that lists none gives a row of nulls, of which ``has_flags`` is null as well.
    """
    blocks = tx.bind(docs, _blocks=_entry_blocks(F.col("text")))
    entries = blocks.select(*keep, F.explode_outer(tx.before_first(F.col("_blocks"), _is_broken)).alias("_block"))
    if not outer:
        entries = entries.where("_block IS NOT NULL")
    entries = entries.withColumn("_lines", F.split("_block", "\n"))
    parts = tx.bind(
        entries,
        _r=F.split(tx.first(F.col("_lines")), " "),
        _s=tx.last(tx.starting(F.col("_lines"), "s ")),
    )
    return parts.select(
        *keep,
        F.upper(digests.hex_of_base64(F.element_at("_r", 3))).alias("relay"),
        F.element_at("_r", 2).alias("nickname"),
        digests.hex_of_base64(F.element_at("_r", 4)).alias("descriptor"),
        tx.timestamp(F.concat_ws(" ", F.element_at("_r", 5), F.element_at("_r", 6))).alias("published"),
        F.filter(F.split(F.substring("_s", 3, 2147483647), " "), lambda f: f != "").alias("flags"),
        F.when(F.col("_block").isNotNull(), F.col("_s").isNotNull()).alias("has_flags"),
        tx.last_value(F.col("_lines"), "v ").alias("version"),
        F.exists(tx.starting(F.col("_lines"), "w "), lambda w: F.contains(w, F.lit(" Measured"))).alias("is_measured"),
    )


def flag_counts(docs, keep=()):
    """Per consensus: running entries, and exit, fast, guard and stable among them.

    Counting ends at the first ``r`` line with too few fields.
    """
    running = tx.bind(
        docs.where(~is_vote(F.col("text"))),
        validafter=tx.timestamp(
            tx.last_value(tx.lines(F.substring_index("text", "\nr ", 1)), "valid-after ")
        ),
        _running=F.filter(
            tx.before_first(tx.lines(F.col("text")), _is_short),
            lambda x: x.startswith("s ") & F.contains(x, F.lit(" Running")),
        ),
    )
    holding = lambda flag: F.size(
        F.filter("_running", lambda x: F.contains(x, F.lit(" " + flag)))
    ).cast("bigint")
    return running.select(
        *keep,
        "validafter",
        holding("Exit").alias("exit"),
        holding("Fast").alias("fast"),
        holding("Guard").alias("guard"),
        F.size("_running").cast("bigint").alias("running"),
        holding("Stable").alias("stable"),
    )


def hashed_relays(entries):
    """Upper-case SHA-1 of every relay identity seen (identities in hex)."""
    return entries.select(digests.sha1_of_hex(F.col("fingerprint")).alias("hashed_relay")).distinct()
