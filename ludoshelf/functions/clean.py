"""Scalar cleaning rules as Column expressions. Nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped or collapsed.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_OTHER_SPACE = r"\t-\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Runs that are not already a single plain space: ordinary text is scanned but hardly rewritten.
SPACE_RUN = rf" [ {_OTHER_SPACE}]+|[{_OTHER_SPACE}][ {_OTHER_SPACE}]*"
# The spellings accepted as booleans.
TRUE_WORDS = ("1", "true", "yes")
FALSE_WORDS = ("0", "false", "no")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim Unicode white space at both ends (plain ``trim`` only knows the space character)."""
    return F.btrim(col(c), F.lit(SPACES))


def collapse(c: Column | str) -> Column:
    """Runs of white space become one space, ends trimmed."""
    return F.trim(F.regexp_replace(col(c), SPACE_RUN, " "))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def http_url(c: Column | str) -> Column:
    """Keep a URL only if it starts with http:// or https:// (case-sensitive)."""
    c = col(c)
    return F.when(c.startswith("http://") | c.startswith("https://"), c)


def first_number(c: Column | str) -> Column:
    """First unsigned decimal number in a text, as double."""
    return blank_to_null(F.regexp_extract(col(c), r"(\d+(?:\.\d+)?)", 1)).cast("double")


def bounded_number(c: Column | str, maximum: float) -> Column:
    """First number in a text, kept only between 0 and ``maximum``."""
    number = first_number(c)
    return F.when(number.between(0, maximum), number)


def epoch_utc(c: Column | str) -> Column:
    """Epoch seconds to a UTC timestamp; null and 0 give null."""
    return F.timestamp_seconds(F.nullif(col(c).try_cast("bigint"), F.lit(0).cast("bigint")))


def percent(positive: Column, negative: Column) -> Column:
    """Share of positives in percent, two digits, ties to even; null without votes."""
    total = positive + negative
    return F.when(total != 0, F.bround(positive * F.lit(100) / total, 2))


def country_code(c: Column | str) -> Column:
    """Two-letter country code in lower case, or null when it is not one."""
    code = F.lower(strip(c))
    return F.when(code.rlike(r"\A[a-z]{2}\z"), code)
