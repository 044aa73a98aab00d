"""What job logs tell, for all jobs at once. A log is ``(job_id, pos, type, ...)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.operators.skew import join_hot
from rowharbor.runtime import materialise

COMMITTING, COMMITTED, FINISHED, FAILURE = (
    "committing-job", "committed-job", "finished", "failure",
)


def of_type(kind: str) -> Column:
    return F.lower("type") == kind.lower()


def first_event(log: DataFrame, kind: str) -> DataFrame:
    """First event of a type per job. Filtered before the aggregate, combined map-side."""
    rest = [c for c in log.columns if c != "job_id"]
    first = F.min_by(F.struct(*rest), "pos").alias("_first")
    return log.filter(of_type(kind)).groupBy("job_id").agg(first).select("job_id", "_first.*")


def crud_counts(log: DataFrame) -> DataFrame:
    """Rows created, updated and deleted, and errors, from each job's finishing event."""
    return first_event(log, FINISHED).select(
        "job_id",
        F.col("inserted").alias("rows_created"),
        F.col("updated").alias("rows_updated"),
        F.col("deleted").alias("rows_deleted"),
        "errors",
    )


def commit_state(
    submissions: DataFrame, index_log: DataFrame, job_log: DataFrame
) -> DataFrame:
    """Where each submission ``(dataset_id, opaque)`` stands.

    The dataset's index log ``(dataset_id, pos, type, opaque, job_id)`` names the job that took
    it; that job's own log tells whether it was committed. A log that is not there could not be
    read: UNKNOWN.
    """
    readable = index_log.select("dataset_id").distinct().withColumn("_read", F.lit(True))
    taken = (
        index_log.filter(of_type(COMMITTING) & F.col("opaque").isNotNull())
        .groupBy("dataset_id", "opaque")
        .agg(F.min_by("job_id", "pos").alias("job_id"))
    )
    jobs = job_log.groupBy("job_id").agg(F.max(of_type(COMMITTED)).alias("_committed"))
    known = submissions.join(readable, "dataset_id", "left").join(taken, ["dataset_id", "opaque"], "left")
    # submissions that no job took have no job id; they and jobs of very many submissions are no hot spot
    judged = join_hot(known, materialise(jobs, "job-states"), ["job_id"])
    state = (
        F.when(F.col("_read").isNull(), "UNKNOWN")
        .when(F.col("job_id").isNull(), "NOT_COMMITTING")
        .when(F.col("_committed").isNull(), "UNKNOWN")
        .when(F.col("_committed"), "COMMITTED")
        .otherwise("COMMITTING")
    )
    return judged.select(*submissions.columns, "job_id", state.alias("state"))


def stage_durations(
    log: DataFrame, percentiles: Sequence[float] = (0.5, 0.95), accuracy: int = 10_000
) -> DataFrame:
    """Events, total, longest and percentile durations of each stage."""
    quantiles = [
        F.percentile_approx("duration", p, accuracy).alias(f"p{round(p * 100)}")
        for p in percentiles
    ]
    return log.filter(F.col("duration").isNotNull()).groupBy(F.col("type").alias("stage")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("duration").alias("total"),
        F.max("duration").alias("longest"),
        *quantiles,
    )


def failure_details(log: DataFrame) -> DataFrame:
    """Failures, one row per expected type."""
    d = F.col("details")
    return log.filter(of_type(FAILURE)).select(
        "job_id",
        d["type"].alias("reason"),
        d["column"].alias("column"),
        d["value"].alias("value"),
        d["record"].alias("record"),
        F.explode_outer(d["expectedType"]).alias("expected_type"),
    )


def progress(status: DataFrame) -> DataFrame:
    """Whole percent of each status report, and the outcome its text announces."""
    done = F.expr("CAST(rows AS DECIMAL(20, 0)) * 100 DIV nullif(CAST(total AS DECIMAL(20, 0)), 0)")
    outcome = F.when(F.col("english").startswith("SUCCESS"), "SUCCESS").when(
        F.col("english").startswith("FAILURE"), "PUBLISH_ERROR"
    )
    return status.select("*", done.cast("int").alias("percent"), outcome.alias("outcome"))


def latest_status(events: DataFrame, order: Sequence[str] = ("at",)) -> DataFrame:
    """Newest report per job; ``order`` must not tie inside a job."""
    rest = [c for c in events.columns if c != "job_id"]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return events.groupBy("job_id").agg(newest).select("job_id", "_newest.*")


def run_summary(run_log: DataFrame) -> DataFrame:
    """Runs, failures and row counts per dataset and publish method."""
    return run_log.groupBy(
        F.col("DatasetID").alias("dataset_id"), F.lower("PublishMethod").alias("method")
    ).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.coalesce(F.col("Success"), F.lit(False))).alias("succeeded"),
        F.count_if(F.col("Errors").isNotNull()).alias("failed"),
        F.sum("RowsCreated").alias("rows_created"),
        F.sum("RowsUpdated").alias("rows_updated"),
        F.sum("RowsDeleted").alias("rows_deleted"),
        F.max("Date").alias("last_run"),
    )
