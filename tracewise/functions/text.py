"""Text rules: what counts as blank, usable or acceptable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The only characters that trimming removes, and texts that stand for nothing.
BLANKS = " \t\r\n"
UNUSABLE = ("", "1", "null", "[redacted]", "<redacted>", "redacted")


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def not_blank(c: Column) -> Column:
    """Null gives null."""
    return F.char_length(trimmed(c)) > 0


def usable(c: Column) -> Column:
    """Whether a text says anything; false for null."""
    return F.coalesce(~F.lower(trimmed(c)).isin(*UNUSABLE), F.lit(False))


def known_thread(c: Column) -> Column:
    """The trimmed thread id; null for blank and '0'."""
    t = trimmed(c)
    return F.nullif(F.nullif(t, F.lit("")), F.lit("0"))


def accepted_url(url: Column, prefix: str) -> Column:
    """Exact prefix, at most 2048 characters, no white space, control character or backslash."""
    return (
        url.startswith(prefix) & (F.char_length(url) <= 2048)
        & ~url.rlike(r"[\s\p{Cntrl}]") & ~url.contains("\\")
    )


def printable(c: Column, length: int) -> Column:
    """Printable ASCII without angle brackets, cut to a length and trimmed; null if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^ -~]", " "), "[<>]", " ")
    return F.nullif(F.trim(F.left(plain, F.lit(length))), F.lit(""))
