"""Session-level helpers shared by the operators: scratch space and materialised steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes up to which a written table of one row per split or file is sent to every task; a larger one is
# joined by shuffle.
BYTES_TO_BROADCAST = 64 << 20


_own_folders: dict[str, str] = {}


def field(name: str) -> Column:
    """Column by exact name; file headers may hold dots, spaces or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is made only where a local session names none, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="rowharbor-")
    return _own_folders[context.applicationId]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path nobody has used yet, below the shared scratch folder."""
    return f"{scratch_root(spark)}/rowharbor/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to shared scratch space and read it back.

    Used where several consumers need the very same rows. Unlike a cache the files survive
    lost executors, the lineage is cut, and the reader knows the exact size, so that Catalyst
    itself decides whether the result is small enough to broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_bytes(df: DataFrame) -> int:
    """Size of a table that was written, as Catalyst knows it from the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark would send a written table whole to every task, by its size in bytes."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return written_bytes(df) <= int(str(limit))


def join_splits(rows: DataFrame, splits: DataFrame, keys: list[str]) -> DataFrame:
    """Attach a materialised one-row-per-split table to the rows of the splits."""
    small = written_bytes(splits) <= BYTES_TO_BROADCAST
    return rows.join(F.broadcast(splits) if small else splits, keys, "left")
