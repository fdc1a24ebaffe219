"""Helpers for keyword-per-line documents.

Documents are handled row by row: the body is decoded one byte to one
character, cut into lines or blocks with array functions and exploded only
into result rows.  No shuffle is needed to parse a document.
"""

import re

from pyspark.sql import functions as F

TIME_PATTERN = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"
CHARSET = "ISO-8859-1"


def bind(df, **columns):
    """Add columns that are computed once per row.

    The optimizer copies the expression of an ordinary column into every filter
    and lambda that uses it, which repeats costly text work.  A generator of
    one row is not copied.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))


def body(content):
    """Text of a document, one character per byte."""
    return F.decode(content, CHARSET)


def to_bytes(text):
    return F.encode(text, CHARSET)


def lines(text):
    """Lines of a text without their ends."""
    return F.split(text, "\r\n|\r|\n")


def starting(line_array, *keywords):
    """Lines beginning with one of ``keywords``."""
    def test(line):
        condition = line.startswith(keywords[0])
        for keyword in keywords[1:]:
            condition = condition | line.startswith(keyword)
        return condition

    return F.filter(line_array, test)


def last(array):
    """Last element, or null for an empty array."""
    return F.try_element_at(array, F.lit(-1))


def first(array):
    return F.try_element_at(array, F.lit(1))


def last_value(line_array, keyword):
    """What follows ``keyword`` on the last line starting with it; null if there is none."""
    return F.substring(last(starting(line_array, keyword)), len(keyword) + 1, 2147483647)


def held(line_array, keyword, value=lambda line: line):
    """For each line, ``value`` of the last line up to it that starts with ``keyword``; null before the first.

    The lines are cut into stretches that begin with such a line, and each stretch repeats its value for its
    lines, so the work grows with the lines.  Lines hold no line feeds.
    """
    stretches = F.split(F.array_join(line_array, "\n"), "\n(?=" + re.escape(keyword) + ")")

    def repeated(stretch):
        head = F.substring_index(stretch, "\n", 1)
        return F.array_repeat(F.when(head.startswith(keyword), value(head)), F.size(F.split(stretch, "\n")))

    return F.flatten(F.transform(stretches, repeated))


def field(line, number, separator=" "):
    """0-based field of a line; null if it is absent."""
    return F.try_element_at(F.split(line, separator), F.lit(number + 1))


def timestamp(text):
    """``yyyy-MM-dd HH:mm:ss`` to a timestamp without zone; null if malformed."""
    return F.regexp_extract(text, TIME_PATTERN, 0).try_cast("timestamp_ntz")


def to_long(text):
    return text.try_cast("bigint")


def to_int(text):
    return text.try_cast("int")


def seconds_between(end, start):
    return F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))


def seconds_before(end, seconds):
    """``end`` moved back by a number of seconds."""
    return (end - F.make_dt_interval(secs=seconds)).cast("timestamp_ntz")


def first_position(array, test):
    """1-based position of the first element meeting ``test``; 0 if none."""
    return F.array_position(F.transform(array, test), F.lit(True)).cast("int")


def last_position(array, test):
    """1-based position of the last element meeting ``test``; 0 if none."""
    from_end = F.array_position(F.reverse(F.transform(array, test)), F.lit(True)).cast("int")
    return F.coalesce(F.size(array) + 1 - F.nullif(from_end, F.lit(0)), F.lit(0))


def before_first(array, test):
    """Elements before the first one meeting ``test``; all of them if none does."""
    stop = F.nullif(first_position(array, test), F.lit(0))
    return F.slice(array, F.lit(1), F.coalesce(stop - 1, F.size(array)))
