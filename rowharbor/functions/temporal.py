"""Timestamp parsing: the first format that fits a cell wins, and nothing depends on the
session time zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowharbor.functions.patterns import TimePattern, translate_all

# North American zone abbreviations, which name a fixed offset.
ZONE_ABBREVIATIONS = {
    "EST": "-05:00", "EDT": "-04:00",
    "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00",
    "PST": "-08:00", "PDT": "-07:00",
    "AKST": "-09:00", "AKDT": "-08:00",
    "HST": "-10:00", "HDT": "-09:00",
}

_ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
_ISO_ANY = r"^\d{4}-\d{2}-\d{2}($|[T ]\d)"
_ISO_ZONED = r"^\d{4}-\d{2}-\d{2}[T ].*(Z|[+-]\d{2}(:?\d{2})?)$"
_TRAILING_ZONE = r"\s*(Z|[A-Z]{3,4}|[+-]\d{2}:?\d{2})$"


def zone_of(name: str | None) -> str:
    """A zone Spark accepts, for a control-file ``timezone``."""
    return ZONE_ABBREVIATIONS.get((name or "UTC").upper(), name or "UTC")


def _utc_wall_clock(instant: Column) -> Column:
    """The UTC reading of an instant, whatever the session zone is."""
    seconds = F.unix_micros(instant).cast("decimal(24,0)") / F.lit(1000000).cast("decimal(7,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=seconds.cast("decimal(18,6)")
    )


def _with_zone(cell: Column, pattern: str, zone: str) -> Column:
    return F.try_to_timestamp(F.concat(cell, F.lit(" " + zone)), F.lit(pattern + " VV"))


def _floating_one(cell: Column, p: TimePattern) -> Column:
    if p.is_iso:
        return F.when(cell.rlike(_ISO_ANY), cell.try_cast("timestamp_ntz"))
    if p.zoned and p.zone_last:
        # a floating value keeps the wall clock and forgets the zone
        bare = p.spark.removesuffix("[XXX][XX]").removesuffix("z").rstrip()
        without = F.regexp_replace(cell, _TRAILING_ZONE, "")
        read = _utc_wall_clock(_with_zone(without, bare, "UTC"))
    elif p.zoned:
        read = _utc_wall_clock(F.try_to_timestamp(cell, F.lit(p.spark)))
    else:
        read = _utc_wall_clock(_with_zone(cell, p.spark, "UTC"))
    return F.when(cell.rlike(p.shape), read)


def _fixed_one(cell: Column, p: TimePattern, zone: str) -> Column:
    if p.is_iso:
        text = (
            F.when(cell.rlike(_ISO_ZONED), cell)
            .when(cell.rlike(_ISO_DAY), F.concat(cell, F.lit("T00:00:00 " + zone)))
            .when(cell.rlike(_ISO_ANY), F.concat(cell, F.lit(" " + zone)))
        )
        return text.try_cast("timestamp")
    if p.zoned:
        read = F.try_to_timestamp(cell, F.lit(p.spark))
    else:
        read = _with_zone(cell, p.spark, zone)
    return F.when(cell.rlike(p.shape), read)


def _first(parses: list[Column], sql_type: str) -> Column:
    return F.coalesce(*parses) if parses else F.lit(None).cast(sql_type)


def parse_floating(cell: Column, formats: Sequence[str]) -> Column:
    """Zone-less timestamp from text; null where no format fits."""
    return _first([_floating_one(cell, p) for p in translate_all(formats)], "timestamp_ntz")


def parse_fixed(cell: Column, formats: Sequence[str], timezone: str | None = "UTC") -> Column:
    """Instant from text. An offset in the cell wins over the default zone."""
    zone = zone_of(timezone)
    return _first([_fixed_one(cell, p, zone) for p in translate_all(formats)], "timestamp")
