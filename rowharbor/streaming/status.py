"""Job status events as a stream, reduced to the newest one per job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def deduplicated(events: DataFrame, at: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Events without repeats that arrive within ``delay`` of each other; older state is let go."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def status_stream(events: DataFrame, order: Sequence[str]) -> DataFrame:
    """Newest event per job as a running aggregate. The state is one row per job."""
    rest = [c for c in events.columns if c != "job_id"]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return events.groupBy("job_id").agg(newest).select("job_id", "_newest.*")


def closed_jobs(
    events: DataFrame, at: str, silence: str, delay: str, keys: Sequence[str] = ("event_id",)
) -> DataFrame:
    """Jobs that have been silent: ``job_id, first_at, last_at, events, type``, the last event's type.

    Events of a job belong together while less than ``silence`` lies between them, in whatever order they
    arrive; a repeated event counts once. Once the watermark, ``delay`` behind the newest event, is past the
    end of the silence, the job's row is written and its state let go; so state is kept for jobs
    and events of the last ``delay`` and ``silence`` only. Later events are late, and left out.
    """
    once = deduplicated(events, at, keys, delay)
    quiet = F.session_window(at, silence).alias("_session")
    newest = F.max(F.struct(at, *keys, "type")).alias("_newest")
    return (
        once.groupBy("job_id", quiet)
        .agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("events"), newest)
        .select("job_id", "first_at", "last_at", "events", "_newest.type")
    )


def write_closed(closed: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of closed jobs, each once. Stops when the source has nothing new."""
    return (
        closed.writeStream.outputMode("append").format("parquet")
        .option("path", folder).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def write_status(status: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Store what changed in each micro-batch, in a folder named after the batch, so that a batch
    that runs again replaces itself. Stops when the source has nothing new."""

    def store(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return (
        status.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_status(stored: DataFrame) -> DataFrame:
    """Newest stored row per job, over all batches."""
    rest = [c for c in stored.columns if c not in ("job_id", "batch")]
    newest = F.max_by(F.struct(*rest), "batch").alias("_newest")
    return stored.groupBy("job_id").agg(newest).select("job_id", "_newest.*")
