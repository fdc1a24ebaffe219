"""Identities and SHA-1 digests."""

from pyspark.sql import functions as F


def hex_of_base64(text):
    """Lower-case hex of a base64 value, padded or not."""
    return F.lower(F.hex(F.try_to_binary(padded(text), F.lit("base64"))))


def padded(text):
    """Base64 text with its ``=`` padding restored."""
    return F.rpad(text, (F.ceil(F.length(text) / 4) * 4).cast("int"), F.lit("="))


def base64_of_hex(digest):
    """Unpadded 27-character base64 of a 40-digit hex digest."""
    return F.substring(F.base64(F.unhex(digest)), 1, 27)


def sha1_of_hex(digest):
    """Upper-case SHA-1 of the bytes written in hex; null if the hex is malformed."""
    return F.upper(F.sha1(F.unhex(F.when(digest.rlike("^([0-9A-Fa-f]{2})+$"), digest))))


def sha1_of_base64(text):
    """Upper-case SHA-1 of base64-encoded bytes."""
    return F.upper(F.sha1(F.try_to_binary(padded(text), F.lit("base64"))))


def span_digest(content, text, start_token, end_token):
    """SHA-1 over the bytes from ``start_token`` to the end of ``end_token``.

    ``text`` is ``content`` decoded one byte per character, so character
    offsets are byte offsets.  Null unless both tokens occur in this order.
    """
    start = F.locate(start_token, text)
    end = F.locate(end_token, text)
    span = content.substr(start, end - start + F.lit(len(end_token)))
    return F.when((start > 0) & (end > start), F.sha1(span))
