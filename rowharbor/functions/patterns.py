"""Date patterns of control files, restated as the patterns Spark's parser understands."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried when a control file names none.
DEFAULT_TIME_FORMATS = (
    "ISO8601",
    "MM/dd/yy",
    "MM/dd/yyyy",
    "dd-MMM-yyyy",
    "MM/dd/yyyy hh:mm:ss a Z",
    "MM/dd/yyyy hh:mm:ss a",
)

# Pattern letters that Spark can parse. Control files may also write a year as "Y".
_PARSEABLE = set("GyYMDdaKhHkmsSzZ")
_NUMERIC = set("yYDdKhHkmsS")
_TOKEN = re.compile(r"'(?:[^']|'')*'|([A-Za-z])\1*|[^A-Za-z']+")


class UnsupportedPattern(ValueError):
    """A pattern that is neither ``ISO8601`` nor made of parseable letters."""


@dataclass(frozen=True)
class TimePattern:
    """One translated format. ``spark`` is None for ISO 8601. ``shape`` is a regular expression
    that every text of the format matches: a cheap test that spares a failing parse, which is slow."""

    source: str
    spark: str | None
    shape: str = ""
    zoned: bool = False
    zone_last: bool = False

    @property
    def is_iso(self) -> bool:
        return self.spark is None


def _is_numeric(token: str) -> bool:
    return token[0] in _NUMERIC or (token[0] == "M" and len(token) <= 2)


def translate(pattern: str) -> TimePattern:
    """Restate one control-file pattern.

    A two-letter numeric field becomes one letter, which reads one or two digits; fields that
    touch each other (``yyyyMMdd``) keep their width, since nothing else separates them.
    """
    if pattern.upper() == "ISO8601":
        return TimePattern(pattern, None)
    tokens = [m.group(0) for m in _TOKEN.finditer(pattern)]
    if not pattern or "".join(tokens) != pattern:
        raise UnsupportedPattern(f"'{pattern}' is not a valid date pattern")
    out: list[str] = []
    shape: list[str] = []
    zoned = zone_last = False
    for i, token in enumerate(tokens):
        letter = token[0]
        if not letter.isalpha():
            plain = token[1:-1].replace("''", "'") or "'" if letter == "'" else token
            shape.append(re.escape(plain))
            # "[", "]" and the reserved "#", "{", "}" mean something else to the parser
            out.append(re.sub(r"[\[\]#{}]+", lambda m: "'" + m.group(0) + "'", token)
                       if letter != "'" else token)
            continue
        if letter not in _PARSEABLE:
            raise UnsupportedPattern(f"'{pattern}' is not a valid date pattern")
        if letter in "Zz":
            zoned, zone_last = True, i == len(tokens) - 1
            out.append("[XXX][XX]" if letter == "Z" else "z")
            shape.append(r"(Z|[+-]\d{2}:?\d{2})" if letter == "Z" else r"\S.*")
            continue
        shape.append(r"[+-]?\d+" if _is_numeric(token) else r"[\p{L}.]+")
        token = token.replace("Y", "y")
        beside = [t for t in tokens[max(i - 1, 0):i] + tokens[i + 1:i + 2] if t[0].isalpha()]
        glued = any(_is_numeric(t) for t in beside)
        if len(token) == 2 and token[0] in "MdHhKkms" and not glued:
            token = token[0]
        elif token[0] == "a":
            token = "a"
        elif token[0] == "y" and len(token) != 2:
            token = "yyyy" if len(token) <= 4 else token
        out.append(token)
    return TimePattern(pattern, "".join(out), f"(?i)^{''.join(shape)}$", zoned, zone_last)


def translate_all(patterns) -> list[TimePattern]:
    return [translate(p) for p in patterns]


def readable_format(pattern: Column) -> Column:
    """Whether ``translate`` takes a pattern, for a column of them."""
    unquoted = F.regexp_replace(pattern, r"'(?:[^']|'')*'", "")
    letters = "".join(sorted(_PARSEABLE))
    return (F.upper(pattern) == "ISO8601") | ((pattern != "") & unquoted.rlike(f"^(?:[{letters}]|[^A-Za-z'])*$"))
