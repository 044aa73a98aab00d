"""Files that arrive in a folder, published one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowharbor.control import Control
from rowharbor.plans.jobs import publish_rows
from rowharbor.sources.delimited import (
    SRC_BLOCK,
    SRC_FILE,
    SRC_POS,
    SRC_TIME,
    csv_schema,
    drop_leading,
    leading_records,
    reader_options,
)
from rowharbor.runtime import field
from rowharbor.sources.store import DatasetStore


def read_folder(spark: SparkSession, folder: str, control: Control, max_files: int | None) -> DataFrame:
    """New files of a folder as a stream of text rows. Names come from the control."""
    file = control.file
    if not file.columns:
        raise ValueError("a stream needs the columns named in the control")
    reader = (
        spark.readStream.schema(csv_schema(file.columns))
        .options(**reader_options(file))
        .option("header", leading_records(file) == 1)  # more are dropped from each batch
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(folder)
    return rows.select(
        *[field(c) for c in rows.columns],
        F.col("_metadata.file_path").alias(SRC_FILE),
        F.col("_metadata.file_modification_time").alias(SRC_TIME),
        F.col("_metadata.file_block_start").alias(SRC_BLOCK),
    )


def ingest_stream(
    spark: SparkSession,
    folder: str,
    control: Control,
    store: DatasetStore,
    dataset_id: str,
    types: Mapping[str, str],
    key: str | None,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Publish every new file of a folder into a dataset, then stop.

    Each micro-batch becomes one version, committed under the batch's name. A batch that runs
    again after a failure overwrites the folder it left behind, or is skipped where it had been
    committed.
    """

    def publish_batch(rows: DataFrame, batch_id: int) -> None:
        placed = rows.select("*", F.monotonically_increasing_id().alias(SRC_POS))
        if leading_records(control.file) > 1:
            placed = drop_leading(placed, leading_records(control.file))
        publish_rows(
            store, dataset_id, placed, control, types, key, batch=f"{checkpoint}#{batch_id}"
        )

    return (
        read_folder(spark, folder, control, max_files)
        .writeStream.foreachBatch(publish_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
