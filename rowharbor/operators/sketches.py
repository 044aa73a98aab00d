"""Column statistics that merge: a row for each part of a table and column, with sketches.

What a part holds is described once, when it is written; the statistics of a version are those of
its parts, merged, without reading a row of the table again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowharbor.runtime import field

HLL_BITS, KLL_ITEMS = 14, 400  # of distinct counts (error under 1 %) and of quantiles (under 1 %)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
SKETCHES = (
    "pos int, column_name string, rows bigint, nulls bigint, smallest_text string, largest_text string, "
    "smallest double, largest double, total decimal(38,6), shortest int, longest int, distinct_sketch binary, quantile_sketch binary"
)


def _counted(c: Column) -> Column:
    """The value as text: sketches take texts and whole numbers only, and merge only with their like."""
    return c.cast("string")


def describe(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by`` (all rows without it) and column of ``df``: counts, extremes and sketches.

    One pass with partial aggregation; of each group only fixed-size sketches reach the shuffle.
    """
    columns = [f for f in df.schema.fields if f.name not in by and isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.BinaryType)]
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    rows = []
    for i, f in enumerate(columns):
        c, numeric = field(f.name), isinstance(f.dataType, NUMERIC)
        value = c.cast("double") if numeric else F.lit(None).cast("double")
        short = F.length(c) if isinstance(f.dataType, T.StringType) else F.lit(None).cast("int")
        finite = F.when(value.isNotNull() & ~F.isnan(value), value)
        aggregates += [
            F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}"),
            F.min(value).alias(f"a{i}"), F.max(value).alias(f"b{i}"), F.sum(finite.try_cast("decimal(28,6)")).alias(f"s{i}"),
            F.min(short).alias(f"x{i}"), F.max(short).alias(f"y{i}"),
            F.hll_sketch_agg(_counted(c), HLL_BITS).alias(f"d{i}"),
            (F.kll_sketch_agg_double(finite, KLL_ITEMS) if numeric else F.max(F.lit(None).cast("binary"))).alias(f"q{i}"),
        ]
        rows.append(F.struct(
            F.lit(i).alias("pos"), F.lit(f.name).alias("column_name"), F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"n{i}")).alias("nulls"), F.col(f"lo{i}").alias("smallest_text"), F.col(f"hi{i}").alias("largest_text"),
            F.col(f"a{i}").alias("smallest"), F.col(f"b{i}").alias("largest"), F.col(f"s{i}").cast("decimal(38,6)").alias("total"),
            F.col(f"x{i}").alias("shortest"), F.col(f"y{i}").alias("longest"),
            F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("quantile_sketch")))
    grouped = df.groupBy(*[field(b) for b in by]).agg(*aggregates)
    return grouped.select(*[field(b) for b in by], F.inline(F.array(*rows)))


def merge(parts: DataFrame, percentiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """The statistics of all parts together, one row per column: ``distinct_values`` and the percentiles
    are estimates, all else is exact. Extremes of columns that are no numbers compare as text."""
    merged = parts.groupBy("pos", "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.min("smallest").alias("smallest"), F.max("largest").alias("largest"),
        F.min("smallest_text").alias("smallest_text"), F.max("largest_text").alias("largest_text"),
        F.sum("total").alias("total"), F.min("shortest").alias("shortest"), F.max("longest").alias("longest"),
        F.kll_merge_agg_double("quantile_sketch").alias("_q"),
    )
    held = F.col("rows") - F.col("nulls")
    quantiles = [
        F.when(F.col("smallest").isNotNull() & (held > 0), F.kll_sketch_get_quantile_double("_q", F.lit(p))).alias(f"p{round(p * 100)}")
        for p in percentiles
    ]
    return merged.select(
        "pos", "column_name", "rows", "nulls", "distinct_values", "smallest", "largest",
        F.when(F.col("smallest").isNull(), F.col("smallest_text")).alias("smallest_text"),
        F.when(F.col("smallest").isNull(), F.col("largest_text")).alias("largest_text"),
        (F.col("total") / F.nullif(held, F.lit(0))).cast("double").alias("mean"), "shortest", "longest", *quantiles,
    )
