"""From text cells to dataset types; cells that do not fit are collected per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.control import FileControl
from rowharbor.functions.temporal import parse_fixed, parse_floating
from rowharbor.runtime import field
from rowharbor.sources.delimited import data_columns

ERRORS = "_errors"
ERROR_TYPE = "struct<column:string,value:string,expected:string>"

# Dataset type names and the Spark types that hold them. Any other name is a Spark type.
SQL_TYPES = {
    "text": "string",
    "number": "decimal(38,9)",
    "calendar_date": "timestamp_ntz",
    "date": "timestamp",
}


# Composite columns are built from others; a cell that carries one is kept as it is written.
TEXT_TYPES = ("text", "string", "location", "point")


def sql_type(type_name: str) -> str:
    return SQL_TYPES.get(type_name, type_name)


def field_types(df: DataFrame) -> dict[str, str]:
    """Dataset types of a stored table's columns; composite ones are left out."""
    named = {"string": "text", "timestamp_ntz": "calendar_date", "timestamp": "date"}
    atomic = {n: t for n, t in df.dtypes if not t.startswith(("struct", "array", "map"))}
    return {n: named.get(t, t) for n, t in atomic.items()}


def typed_cell(name: str, type_name: str, control: FileControl) -> Column:
    cell, o = field(name), control.for_column(name)
    if type_name in TEXT_TYPES:
        return cell
    if type_name == "calendar_date":
        return parse_floating(cell, o.floating_formats)
    if type_name == "date":
        return parse_fixed(cell, o.fixed_formats, o.timezone)
    return cell.try_cast(sql_type(type_name))


def _error(column: str, value: Column, expected: str) -> Column:
    return F.struct(
        F.lit(column).alias("column"),
        value.cast("string").alias("value"),
        F.lit(expected).alias("expected"),
    )


def cast_types(df: DataFrame, types: Mapping[str, str], control: FileControl) -> DataFrame:
    """Cast every data column to its dataset type (text where the dataset names none).

    A cell that holds something but cannot be read as its type is null afterwards and listed
    in ``_errors`` with its column, text and expected type.
    """
    own = data_columns(df)
    others = [c for c in df.columns if c not in own and c != ERRORS]
    hard = [c for c in own if types.get(c, "text") not in TEXT_TYPES]
    parsed = df.select(
        *[field(c) for c in df.columns],
        *[typed_cell(c, types[c], control).alias(f"_typed_{c}") for c in hard],
    )
    none = F.array().cast(f"array<{ERROR_TYPE}>")
    # a concatenation of short arrays stays inside generated code, unlike a filtered array
    found = [
        F.when(
            field(f"_typed_{c}").isNull() & (F.coalesce(field(c), F.lit("")) != ""),
            F.array(_error(c, field(c), types[c])),
        ).otherwise(none)
        for c in hard
    ]
    earlier = [field(ERRORS)] if ERRORS in df.columns else [none]
    errors = F.concat(*earlier, *found)
    return parsed.select(
        *[field(f"_typed_{c}").alias(c) if c in hard else field(c) for c in own],
        *[field(c) for c in others],
        errors.alias(ERRORS),
    )


def add_error(df: DataFrame, bad: Column, column: str, value: Column, expected: str) -> DataFrame:
    """List one more error on the rows where ``bad`` holds."""
    entry = _error(column, value, expected)
    none = F.array().cast(f"array<{ERROR_TYPE}>")
    before = field(ERRORS) if ERRORS in df.columns else none
    return df.withColumn(ERRORS, F.concat(before, F.when(bad, F.array(entry)).otherwise(none)))
