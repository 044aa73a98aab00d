"""What happens to rows that could not be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.operators.typing import ERRORS
from rowharbor.runtime import field
from rowharbor.sources.delimited import RECORD_NO, SRC_FILE, with_record_no


class UninterpretableRows(ValueError):
    """More rows could not be read than the policy allows."""


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that loaded, without the error list, and rows to set aside, with it."""
    bad = F.size(ERRORS) > 0
    return df.filter(~bad).drop(ERRORS), df.filter(bad)


# Share of bad rows each policy tolerates.
TOLERANCE = {"none": 0.0, "tenpercent": 0.1, "all": 1.0}


def drop_uninterpretable(df: DataFrame, policy: str | None) -> DataFrame:
    """Good rows, provided that the share of bad ones is within the policy. Pass staged rows:
    they are counted here and used again by the caller."""
    limit = TOLERANCE.get((policy or "None").lower())
    if limit is None:
        raise ValueError(f"unknown policy '{policy}'")
    bad = F.size(ERRORS) > 0
    if limit < 1.0:
        seen = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad")).first()
        if seen["bad"] > seen["rows"] * limit:
            raise UninterpretableRows(f"{seen['bad']} of {seen['rows']} rows cannot be read")
    return df.filter(~bad).drop(ERRORS)


def error_report(staged: DataFrame, leading: int = 1, whole_folder: bool = False) -> DataFrame:
    """One row per bad cell, with its line in the file: ``leading`` records (a header) come
    before the data. Pass staged rows; only the bad ones are numbered."""
    bad = with_record_no(staged, True, whole_folder, only=F.size(ERRORS) > 0)
    cells = bad.select(
        field(SRC_FILE).alias("file"),
        (F.col(RECORD_NO) + (leading + 1)).alias("line"),
        F.explode(ERRORS).alias("_e"),
    ).select("file", "line", "_e.*")
    message = F.concat(
        F.lit("Cannot read '"), F.col("value"), F.lit("' in column '"), F.col("column"),
        F.lit("' as "), F.col("expected"), F.lit(" (line "), F.col("line").cast("string"),
        F.lit(" of file)"),
    )
    return cells.withColumn("message", message)
