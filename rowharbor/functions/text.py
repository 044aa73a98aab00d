"""Text expressions used around file names, headers, links and list-valued cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_ends(text: Column) -> Column:
    """Drop blanks and control characters at both ends."""
    return F.btrim(text, F.lit("".join(map(chr, range(33)))))


def normalise_header(name: Column) -> Column:
    return F.lower(trim_ends(name))


def file_extension(path: Column) -> Column:
    """Lower-cased text after the last dot; empty when there is none or it leads the text."""
    return F.lower(F.regexp_extract(path, r"(?s)^.+\.([^.]*)$", 1))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def url_host(url: Column) -> Column:
    """Host part of a link, or of a bare host with a path."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1)


def uid_valid(uid: Column) -> Column:
    """Dataset ids look like ``ab12-cd34``."""
    return F.coalesce(uid.rlike(r"\A[a-z0-9]{4}-[a-z0-9]{4}\z"), F.lit(False))


def capitalise_first(text: Column) -> Column:
    return F.concat(F.upper(F.left(text, F.lit(1))), F.substr(text, F.lit(2)))


def ordinal(number: Column) -> Column:
    """1st, 2nd, 3rd, 4th, 11th, 21st."""
    unit = number % 10
    suffix = (
        F.when((number % 100).between(11, 13), "th")
        .when(unit == 1, "st")
        .when(unit == 2, "nd")
        .when(unit == 3, "rd")
        .otherwise("th")
    )
    return F.concat(number.cast("string"), suffix)


def comma_split(text: Column) -> Column:
    """Split at commas; a backslash protects the character after it, a final one stands for
    itself. Parts are trimmed, and blank text gives no parts."""
    trimmed = trim_ends(text)
    dangling = F.length(F.regexp_extract(trimmed, r"(\\*)$", 1)) % 2 == 1
    closed = F.concat(trimmed, F.when(dangling, F.lit("\\")).otherwise(F.lit("")), F.lit(","))
    parts = F.regexp_extract_all(closed, F.lit(r"(?s)((?:\\.|[^,\\])*),"), 1)
    plain = F.transform(parts, lambda p: trim_ends(F.regexp_replace(p, r"(?s)\\(.)", "$1")))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(plain)


def comma_join(parts: Column) -> Column:
    escaped = F.transform(parts, lambda p: F.regexp_replace(trim_ends(p), r"([,\\])", r"\\$1"))
    return F.array_join(escaped, ", ")


def strip_version(text: Column) -> Column:
    """First version number of a text."""
    return F.regexp_extract(text, r"(\d+\.\d+(?:\.\d+)?)", 1)
