"""Cell cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


WHITE_SPACE = " \t\n\u000b\f\r"


def trim_cell(cell: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.btrim(cell, F.lit(WHITE_SPACE))


def empty_to_null(cell: Column) -> Column:
    return F.nullif(cell, F.lit(""))


def clean_cell(cell: Column, trim: bool, empty_is_null: bool) -> Column:
    out = trim_cell(cell) if trim else cell
    return empty_to_null(out) if empty_is_null else F.coalesce(out, F.lit(""))
