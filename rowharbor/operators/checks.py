"""Validation of files against datasets.

Schema checks work on relations, so that one plan checks any number of files:

* ``headers(file_id, dataset_id, pos, name)``: header cells of each file
* ``dataset_columns(dataset_id, pos, field_name, type, is_row_id)``
* ``left_out(file_id, name)``: names a control ignores or builds itself

Each check gives ``(file_id, dataset_id, status, message)`` for what is wrong.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.control import CHARSETS, FileControl
from rowharbor.functions.cells import trim_cell
from rowharbor.functions.patterns import readable_format
from rowharbor.functions.text import file_extension, normalise_header
from rowharbor.operators.typing import typed_cell
from rowharbor.runtime import field
from rowharbor.sources.delimited import CORRUPT, SRC_FILE, blank_row, data_columns

DELIMITED_EXTENSIONS = ("csv", "tsv")
GIS_EXTENSIONS = ("zip", "geojson", "kml", "kmz")

_OUT = ("file_id", "dataset_id", "status", "message")


def check_ragged(df: DataFrame) -> DataFrame:
    """Records whose number of cells differs from the header's. Reads the whole file."""
    wrong = F.col(CORRUPT).isNotNull() & ~blank_row(data_columns(df))
    return df.filter(wrong).select(
        F.col(SRC_FILE).alias("file"),
        F.lit("ROWS_DO_NOT_CONTAIN_SAME_NUMBER_OF_COLUMNS").alias("status"),
        F.col(CORRUPT).alias("record"),
    )


def check_datetimes(df: DataFrame, types: Mapping[str, str], control: FileControl) -> DataFrame:
    """Cells of date columns that no format of the control can read; blank cells pass."""
    dated = [c for c in df.columns if types.get(c) in ("calendar_date", "date")]
    if not dated:
        nothing = F.lit(None).cast("string")
        return df.filter(F.lit(False)).select(
            "*", nothing.alias("column"), nothing.alias("value"), F.lit("INVALID_DATETIME").alias("status")
        )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                field(c).alias("value"),
                (typed_cell(c, types[c], control).isNull() & (trim_cell(field(c)) != ""))
                .alias("bad"),
            )
            for c in dated
        ]
    )
    carried = [field(c) for c in df.columns if c not in dated]
    return (
        df.select(*carried, F.explode(cells).alias("_cell"))
        .filter(F.col("_cell.bad"))
        .select(
            *carried,
            F.col("_cell.column").alias("column"),
            F.col("_cell.value").alias("value"),
            F.lit("INVALID_DATETIME").alias("status"),
        )
    )


def _verdict(df: DataFrame, status: str, message: Column) -> DataFrame:
    return df.select("file_id", "dataset_id", F.lit(status).alias("status"), message.alias("message"))


def _beside(headers: DataFrame, columns: DataFrame, left_out: DataFrame | None) -> DataFrame:
    """One row per file: its header, its dataset's columns and the names its control leaves out.
    The lists are as long as a header or a dataset is wide; each relation is read once."""
    files = headers.groupBy("file_id", "dataset_id").agg(
        F.transform(
            F.collect_list(F.struct(normalise_header(F.col("name")).alias("name"))),
            lambda h: h["name"],
        ).alias("_names")
    )
    lists = columns.groupBy("dataset_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "field_name", "is_row_id"))).alias("_columns")
    )
    # a file of an unknown dataset has only extra columns
    both = files.join(lists, "dataset_id", "left")
    if left_out is None:
        return both.withColumn("_left_out", F.array().cast("array<string>"))
    outs = left_out.groupBy("file_id").agg(F.collect_set("name").alias("_outs"))
    held = F.coalesce(F.col("_outs"), F.array().cast("array<string>"))
    return both.join(outs, "file_id", "left").withColumn("_left_out", held).drop("_outs")


def _within(value: Column, values: Column | str) -> Column:
    return F.coalesce(F.array_contains(values, value), F.lit(False))


def _fault(status: str, message: Column) -> Column:
    return F.struct(F.lit(status).alias("status"), message.alias("message"))


def _extra() -> Column:
    """Faults of a row of ``_beside``: names that no column bears, or given twice."""
    known = F.transform(F.col("_columns"), lambda c: F.lower(c["field_name"]))
    ignored = F.transform(F.col("_left_out"), normalise_header)
    judged = F.filter(F.col("_names"), lambda n: ~_within(n, ignored))
    wrong = F.filter(
        F.array_distinct(judged),
        lambda n: ~_within(n, known) | (F.size(F.filter(judged, lambda m: m.eqNullSafe(n))) > 1),
    )
    return F.transform(
        wrong,
        lambda n: _fault(
            "PUBLISH_ERROR",
            F.concat(
                F.lit("Extra Columns Specified: the file contains column '"), n,
                F.lit("', but the dataset does not."),
            ),
        ),
    )


def _missing() -> Column:
    """Faults of a row of ``_beside``: at most one, what a replace would leave unfilled."""
    absent = F.filter(F.col("_columns"), lambda c: ~_within(F.lower(c["field_name"]), "_names"))
    gaps = F.filter(absent, lambda c: ~_within(c["field_name"], "_left_out"))
    row_ids = F.filter(F.col("_columns"), lambda c: F.coalesce(c["is_row_id"], F.lit(False)))
    row_id = F.get(row_ids, F.lit(0))["field_name"]
    no_id = F.exists(absent, lambda c: F.coalesce(c["is_row_id"], F.lit(False)))
    listed = F.array_join(F.transform(gaps, lambda c: c["field_name"]), ", ")
    unmapped = _fault(
        "MISSING_COLUMNS", F.concat(F.lit("Missing Fields: not mapped: "), listed)
    )
    no_key = _fault(
        "PUBLISH_ERROR",
        F.concat(
            F.lit("Missing Row Identifier: column '"), row_id, F.lit("' must be present in the file."),
        ),
    )
    some = F.size(gaps) > 0
    return F.filter(
        F.array(F.when(some & row_id.isNull(), unmapped).when(some & no_id, no_key)),
        lambda fault: fault.isNotNull(),
    )


def _faults(beside: DataFrame, faults: Column) -> DataFrame:
    return beside.select("file_id", "dataset_id", F.inline(faults))


def extra_columns(
    headers: DataFrame, columns: DataFrame, left_out: DataFrame | None = None
) -> DataFrame:
    """Header names the dataset does not have. A name given twice is extra; names that the control
    ignores (``left_out``) are never extra."""
    return _faults(_beside(headers, columns, left_out), _extra())


def missing_columns(
    headers: DataFrame, columns: DataFrame, left_out: DataFrame | None = None
) -> DataFrame:
    """What a replace would leave unfilled. With a row identifier in the header, partial files
    are fine; without one in the dataset, the missing fields are listed; where the dataset has
    one and the header does not, that is the fault."""
    return _faults(_beside(headers, columns, left_out).filter("_columns IS NOT NULL"), _missing())


def check_columns(
    headers: DataFrame,
    columns: DataFrame,
    left_out: DataFrame | None = None,
    method: str = "replace",
) -> DataFrame:
    """Extra columns, and for a replace also missing ones."""
    beside = _beside(headers, columns, left_out)
    if method.lower() != "replace":
        return _faults(beside, _extra())
    missing = F.when(F.col("_columns").isNotNull(), _missing()).otherwise(
        F.array().cast("array<struct<status string, message string>>")
    )
    return _faults(beside, F.concat(_extra(), missing))


def check_synthetic(headers: DataFrame, columns: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Faults of composite columns, from ``synthetic(file_id, dataset_id, name, part, source)``:
    a composite that is also a header, and components of the wrong type. A component the dataset
    does not know passes."""
    named = headers.select(
        "file_id", "dataset_id", normalise_header(F.col("name")).alias("_name")
    ).distinct()
    composites = synthetic.select(
        "file_id", "dataset_id", "name", F.lower("name").alias("_name")
    ).distinct()
    clash = composites.join(named, ["file_id", "dataset_id", "_name"], "left_semi")
    ambiguous = _verdict(
        clash,
        "PUBLISH_ERROR",
        F.concat(F.lit("Ambiguous Column Name: '"), F.col("name"), F.lit("' is also in the file.")),
    )
    typed = synthetic.join(
        columns.select("dataset_id", F.col("field_name").alias("source"), "type"),
        ["dataset_id", "source"],
    )
    text_only = F.col("part").isin("address", "city", "state")
    kind = F.lower("type")
    wrong = F.when(text_only, kind != "text").otherwise(~kind.isin("text", "number"))
    needs = F.when(text_only, "'text' column").otherwise("'text' or 'number' columns")
    unsupported = _verdict(
        typed.filter(wrong),
        "PUBLISH_ERROR",
        F.concat(
            F.lit("Unsupported Datatype: "), F.col("part"), F.lit(" component of '"),
            F.col("name"), F.lit("' is of type '"), F.col("type"), F.lit("'; it requires "), needs,
        ),
    )
    return ambiguous.unionByName(unsupported)


def check_file_format(files: DataFrame, gis: bool = False) -> DataFrame:
    """Whether each file's extension can be published."""
    allowed = GIS_EXTENSIONS if gis else DELIMITED_EXTENSIONS
    extension = file_extension(F.col("path"))
    return files.select(
        "*", extension.alias("extension"), extension.isin(*allowed).alias("allowed")
    )


def check_actions(jobs: DataFrame) -> DataFrame:
    """Publishing rules over many jobs: ``(job_id, job_type, action, requested, row_id)``; the
    first rule a job breaks is its message, null when it breaks none."""
    action, kind = F.lower("action"), F.lower("job_type")
    known = action.isin("replace", "upsert", "append", "delete")
    legal = (
        F.when(kind == "port", action.isin("upsert", "replace"))
        .when(kind == "gis", action == "replace")
        .otherwise(known)
    )
    message = (
        F.when(~F.coalesce(known, F.lit(False)), "Unknown Publish Method")
        .when(F.lower("requested") != action, "Conflicting Publish Methods")
        .when((action == "delete") & F.col("row_id").isNull(), "Dataset Requirement Unfulfilled")
        .when(~legal, "Publish Method Not Allowed")
    )
    status = F.when(message.isNull(), "VALID").otherwise("PUBLISH_ERROR")
    return jobs.select("job_id", status.alias("status"), message.alias("message"))


def check_settings(jobs: DataFrame) -> DataFrame:
    """Formats and charsets over many jobs, ``(job_id, formats array<string>, encoding)``: which of a job's
    time formats cannot be read, and whether its charset can. No charset at all is fine."""
    bad = F.filter("formats", lambda f: ~readable_format(f))
    charset = F.coalesce(F.lower("encoding"), F.lit("utf-8")).isin(*CHARSETS)
    broken = F.coalesce(F.size(bad), F.lit(0)) > 0
    message = F.when(broken, F.concat(F.lit("Unsupported Date Time Format: "), F.array_join(bad, ", "))).when(
        ~charset, F.concat(F.lit("Unsupported Encoding: "), F.col("encoding"))
    )
    status = F.when(message.isNull(), "VALID").otherwise("PUBLISH_ERROR")
    return jobs.select("job_id", status.alias("status"), message.alias("message"))


def check_metadata(updates: DataFrame) -> DataFrame:
    """Metadata records without a title or with a malformed dataset id."""
    blank = F.coalesce(F.btrim("title"), F.lit("")) == ""
    message = F.when(F.length(F.btrim("dataset_id")) != 9, "Invalid dataset id").when(
        blank, "Dataset title is required"
    )
    judged = updates.select("dataset_id", message.alias("message"))
    return judged.filter(F.col("message").isNotNull())
