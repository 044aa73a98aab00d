"""Side outputs: rows set aside, the run log, and JSON exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowharbor.operators.shape import drop_system_columns

VERSION = "0.1"

RUN_LOG = (
    "Date timestamp_ntz, DatasetID string, FileToPublish string, PublishMethod string, "
    "JobFile string, RowsUpdated bigint, RowsCreated bigint, RowsDeleted bigint, "
    "Success boolean, Errors string, Version string"
)


def write_set_aside(df: DataFrame, path: str) -> None:
    """Bad rows with their error lists, added to those of earlier runs."""
    df.write.mode("append").parquet(path)


def run_log_rows(runs: DataFrame) -> DataFrame:
    """Run-log rows from job results. Missing counts become 0; ``Errors`` is set only where a
    run failed and ``Success`` only where it did not."""
    failed = F.coalesce(F.col("is_error"), F.lit(False))

    def count(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    return runs.select(
        F.col("run_at").cast("timestamp_ntz").alias("Date"),
        F.col("dataset_id").alias("DatasetID"),
        F.col("file").alias("FileToPublish"),
        F.col("method").alias("PublishMethod"),
        F.col("job_file").alias("JobFile"),
        count("rows_updated").alias("RowsUpdated"),
        count("rows_created").alias("RowsCreated"),
        count("rows_deleted").alias("RowsDeleted"),
        F.when(~failed, F.lit(True)).alias("Success"),
        F.when(failed, F.col("message")).alias("Errors"),
        F.lit(VERSION).alias("Version"),
    )


def append_run_log(runs: DataFrame, path: str) -> None:
    run_log_rows(runs).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    """All rows as JSON lines."""
    drop_system_columns(df).write.mode("overwrite").json(path)


def write_delimited(df: DataFrame, path: str, separator: str = ",", header: bool = True) -> None:
    """Rows as delimited text. Tab-separated files are written without quoting."""
    options = {
        "sep": separator,
        "header": header,
        "escape": '"',
        "quote": "\u0000" if separator == "\t" else '"',
        # blanks at the ends of a cell are part of it
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    }
    df.write.mode("overwrite").options(**options).csv(path)
