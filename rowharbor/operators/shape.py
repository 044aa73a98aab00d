"""Which columns a file contributes, and how their cells are cleaned."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from rowharbor.control import FileControl
from rowharbor.functions.cells import clean_cell, trim_cell
from rowharbor.runtime import field
from rowharbor.sources.delimited import data_columns, usable_names

COMPUTED = "computed"  # metadata key of a column the dataset computes itself


def map_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Name file columns by position. A name given twice belongs to its last position; the
    earlier one falls back to a placeholder and is left out."""
    have = data_columns(df)
    if len(columns) != len(have):
        raise ValueError(f"{len(columns)} names for {len(have)} columns")
    usable = usable_names(columns)
    chosen = [field(have[i]).alias(n) for i, n in enumerate(usable) if n == columns[i]]
    kept = [field(c) for c in df.columns if c not in have]
    return df.select(*chosen, *kept)


def _as_field_name(header: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", header.strip().lower()).strip("_")


def fit_names(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Give file columns the dataset's spelling: equal but for case and blanks, or equal once
    written as a field name (``Another Name`` is ``another_name``)."""
    have = data_columns(df)
    free = {f.lower(): f for f in fields if f not in have}
    renamed = {}
    for spell in (lambda h: h.strip().lower(), _as_field_name):
        for name in have:
            if name not in fields and name not in renamed and spell(name) in free:
                renamed[name] = free.pop(spell(name))
    return df.select(*[field(c).alias(renamed.get(c, c)) for c in df.columns])


def ignore_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Leave columns out; a name the file does not have is no error."""
    unwanted = set(names)
    return df.select(*[field(c) for c in df.columns if c not in unwanted])


def clean_cells(df: DataFrame, control: FileControl) -> DataFrame:
    """Trim cells and turn empty ones into nulls, each column by its own options."""
    own = set(data_columns(df))

    def cell(name: str):
        o = control.for_column(name)
        return clean_cell(field(name), o.trim, o.empty_is_null).alias(name)

    return df.select(*[cell(c) if c in own else field(c) for c in df.columns])


def trim_stored(df: DataFrame, control: FileControl) -> DataFrame:
    """Trim the text columns of the stored side where the control asks for it."""
    text = {n for n, t in df.dtypes if t == "string"}
    return df.select(
        *[
            trim_cell(field(c)).alias(c)
            if c in text and control.for_column(c).trim_stored
            else field(c)
            for c in df.columns
        ]
    )


def drop_system_columns(df: DataFrame) -> DataFrame:
    """Hide columns that start with a colon or that the dataset computes."""
    keep = [
        f.name
        for f in df.schema.fields
        if not f.name.startswith(":") and not (f.metadata or {}).get(COMPUTED)
    ]
    return df.select(*[field(c) for c in keep])
