"""The list of registered queries and the SQL each one is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowharbor.runtime import scratch_path
from rowharbor.sources.sinks import write_delimited

Query = Callable[[SparkSession, str], DataFrame]

FILES, FILE_ROWS = 8, 500_000  # files of an export in order, and the rows of a large one's

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL twin where there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_delimited(df: DataFrame, tag: str, separator: str = ",", header: bool = True) -> str:
    """Write a table as delimited text for a scan to read."""
    path = scratch_path(df.sparkSession, tag)
    write_delimited(df, path, separator, header)
    return path


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows laid out so that the files of a write hold them in key order, as many files as ``df`` needs:
    what one task sorts does not grow with the table."""
    files = max(FILES, -(-df.count() // FILE_ROWS))
    return df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
