"""Steps shared by the operators of this package."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowharbor.runtime import scratch_path

# Characters that separate words, as a Java regular expression class.
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting that holds for the block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The files outlive lost executors and cut the lineage; the shuffle files behind them are
    released as soon as they are written, so that steps in a row don't add up on disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    with setting(spark, CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_digest() -> Column:
    """A number for a row's id and text; null differs from zero and from empty."""
    return F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull())


def spare(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def unit_interval(hex_digest: Column, digits: int = 13) -> Column:
    """A number strictly between 0 and 1 from the first hex digits of a digest."""
    number = F.conv(F.substring(hex_digest, 1, digits), 16, 10).cast("bigint")
    return (number + F.lit(0.5)) / F.lit(float(16**digits))


def global_rank(df: DataFrame, order: list[Column], name: str, tag: str) -> DataFrame:
    """``df`` with gapless ranks from 0 over all rows, sorted by range; no task sees them all."""
    placed = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        tag,
    )
    part = F.shiftright("_place", 33)
    ahead = F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )  # one row per partition of the sort, so this fits one task, and the broadcast below
    starts = (
        placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(ahead, F.lit(0)).alias("_start"))
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + inside).drop("_part", "_start", "_place")
    )


def running_before(df: DataFrame, group: str, key: str, value: str, ties: list[str], tag: str,
                   rows_per_range: int = 1000) -> DataFrame:
    """Adds ``_before``: the sum of ``value`` over the earlier rows of the group, by ``key``.

    ``key`` is a hex digest, so equal ranges of it hold equal shares of a group: each group is
    cut into as many ranges as its rows need, ranges are summed, their sums run up, and rows
    are sorted within their range only. A group of any size is spread over many tasks.
    ``df`` must give the same rows each time it is read. Null is a group like any other.
    """
    sizes = materialise(
        df.groupBy(F.col(group).alias("_group"))
        .agg(F.ceil(F.count("*") / F.lit(float(rows_per_range))).alias("_ranges")),
        f"{tag}-groups",
    )
    ranged = (
        df.join(sizes, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
        .withColumn("_range", F.floor(unit_interval(F.col(key), 8) * F.col("_ranges")))
        .drop("_ranges")
    )
    up_to = Window.partitionBy("_group").orderBy("_at")
    starts = materialise(
        ranged.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_at"))
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_start", F.sum("_sum").over(up_to) - F.col("_sum")).drop("_sum"),
        f"{tag}-ranges",
    )
    earlier = Window.partitionBy(group, "_range").orderBy(key, *ties)
    return (
        ranged.withColumn("_inside", F.sum(value).over(
            earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(value))
        .join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_at")))
        .withColumn("_before", F.col("_start") + F.col("_inside"))
        .drop("_group", "_at", "_range", "_start", "_inside")
    )
