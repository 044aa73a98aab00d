"""Statistics of columns and of the column lists of datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowharbor.runtime import field

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def column_statistics(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest and largest value as text, mean of
    numbers, shortest and longest text.

    One pass with partial aggregation. Distinct counts are estimates unless ``exact`` is set,
    which costs a shuffle of the values.
    """
    aggregates: list[Column] = [F.count(F.lit(1)).alias("rows")]
    described: list[Column] = []
    for i, f in enumerate(df.schema.fields):
        c = field(f.name)
        distinct = F.count_distinct(c) if exact else F.approx_count_distinct(c)
        aggregates += [
            F.count(c).alias(f"n{i}"),
            distinct.alias(f"d{i}"),
            F.min(c).alias(f"lo{i}"),
            F.max(c).alias(f"hi{i}"),
        ]
        mean = short = long = F.lit(None)
        if isinstance(f.dataType, _NUMERIC):
            aggregates.append(F.avg(c).alias(f"s{i}"))
            mean = F.col(f"s{i}")
        if isinstance(f.dataType, T.StringType):
            aggregates += [F.min(F.length(c)).alias(f"a{i}"), F.max(F.length(c)).alias(f"b{i}")]
            short, long = F.col(f"a{i}"), F.col(f"b{i}")
        described.append(
            F.struct(
                F.lit(i).alias("pos"),
                F.lit(f.name).alias("column_name"),
                F.col("rows").alias("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
                F.col(f"d{i}").cast("bigint").alias("distinct_values"),
                F.col(f"lo{i}").cast("string").alias("smallest"),
                F.col(f"hi{i}").cast("string").alias("largest"),
                mean.cast("double").alias("mean"),
                short.cast("int").alias("shortest"),
                long.cast("int").alias("longest"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*described)))


def count_types(columns: DataFrame) -> DataFrame:
    """Location and point columns per dataset."""
    return columns.groupBy("dataset_id").agg(
        F.count_if(F.col("type") == "location").alias("locations"),
        F.count_if(F.col("type") == "point").alias("points"),
    )


def unmapped_columns(columns: DataFrame, mapped: DataFrame, ignored: DataFrame) -> DataFrame:
    """Dataset columns that are neither mapped nor ignored (both ``(dataset_id, field_name)``)."""
    taken = mapped.select("dataset_id", "field_name").unionByName(
        ignored.select("dataset_id", "field_name")
    )
    return columns.join(taken.distinct(), ["dataset_id", "field_name"], "left_anti")


def field_list(columns: DataFrame) -> DataFrame:
    """Per dataset, in column order: the names as quoted text and as a list, and name to type.
    A dataset's width bounds the lists."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "field_name", "type")))
    listed = columns.groupBy("dataset_id").agg(ordered.alias("_cols"))
    names = F.col("_cols.field_name")
    return listed.select(
        "dataset_id",
        F.array_join(F.transform(names, lambda n: F.concat(F.lit('"'), n, F.lit('"'))), ",")
        .alias("quoted"),
        names.alias("fields"),
        F.map_from_arrays(names, F.col("_cols.type")).alias("types"),
    )


def find_column(columns: DataFrame, wanted: DataFrame, by: str = "field_name") -> DataFrame:
    """First column of a dataset whose field (or display) name is the wanted one, ignoring case:
    ``wanted(dataset_id, name)`` plus the found ``field_name``, or null."""
    known = columns.groupBy("dataset_id", F.lower(field(by)).alias("_name")).agg(
        F.min_by("field_name", "pos").alias("field_name")
    )
    keyed = wanted.withColumn("_name", F.lower("name"))
    return keyed.join(known, ["dataset_id", "_name"], "left").select(
        "dataset_id", "name", "field_name"
    )
