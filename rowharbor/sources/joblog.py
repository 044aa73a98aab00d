"""Job logs: JSON arrays of ``{type, data}`` events, one file per job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = (
    "type string, data struct<jobId:string, dataset:string, filename:string, newFilename:string, "
    "email:string, user:string, timestamp:timestamp, duration:bigint, inserted:int, updated:int, "
    "deleted:int, errors:int, details:struct<type:string, totalErrors:int, column:string, "
    "value:string, record:bigint, expectedType:array<string>>, "
    "control:struct<opaque:string>, portControl:struct<opaque:string>>"
)


def scan_job_log(
    spark: SparkSession, path: str | list[str], json_lines: bool = False
) -> DataFrame:
    """Events with their position in the log; keys nobody asks for are left out. A log is one
    array per file, or one event per line, which Spark can split."""
    raw = spark.read.schema(LOG_SCHEMA).option("multiLine", not json_lines).json(path)
    placed = raw.select(
        F.col("_metadata.file_path").alias("log_file"),
        F.monotonically_increasing_id().alias("pos"),
        "type",
        "data",
    )
    return flatten_log(placed)


def flatten_log(events: DataFrame) -> DataFrame:
    """``type`` and ``data`` as plain columns. The opaque id is that of the
    control, or of the port control where there is none."""
    d = F.col("data")
    return events.select(
        *[c for c in events.columns if c not in ("type", "data")],
        "type",
        d["jobId"].alias("job_id"),
        d["dataset"].alias("dataset_id"),
        d["filename"].alias("filename"),
        d["timestamp"].alias("at"),
        d["duration"].alias("duration"),
        d["inserted"].alias("inserted"),
        d["updated"].alias("updated"),
        d["deleted"].alias("deleted"),
        d["errors"].alias("errors"),
        d["details"].alias("details"),
        F.when(d["control"].isNotNull(), d["control"]["opaque"])
        .otherwise(d["portControl"]["opaque"]).alias("opaque"),
    )
