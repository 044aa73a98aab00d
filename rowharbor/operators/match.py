"""Matching file headers to dataset columns, for a whole catalogue of files at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.functions.names import (
    INFINITE,
    display_name_distance,
    field_letters,
    field_name_distance,
    header_letters,
    may_be_field,
)
from rowharbor.runtime import materialise


def score_columns(headers: DataFrame, columns: DataFrame) -> DataFrame:
    """Candidate pairs of finite badness, smaller is better.

    ``headers(file_id, dataset_id, pos, name)`` meets
    ``columns(dataset_id, pos, field_name, display_name)``. Each distinct header text of a dataset
    meets the dataset's columns once; of the pairs that can match at all, each distinct pair of texts of
    all datasets is scored once, with built-in functions.
    """
    texts = headers.select("dataset_id", "name").distinct()
    listed = columns.select("dataset_id", F.col("pos").alias("column_pos"), "field_name", "display_name")
    by_display = display_name_distance(F.col("name"), F.col("display_name"))
    met = texts.join(listed, "dataset_id").withColumn("_display", by_display)
    met = met.filter((F.col("_display") < INFINITE) | may_be_field(F.col("name"), F.col("field_name")))
    met = materialise(met.drop("display_name"), "pairs")
    letters = (
        met.select("name", "field_name").distinct()
        .withColumn("_letters", header_letters(F.col("name"))).withColumn("_field", field_letters(F.col("field_name")))
    )
    cost = field_name_distance(F.col("name"), F.col("field_name"), F.col("_letters"), F.col("_field"))
    costs = materialise(letters.select("name", "field_name", cost.alias("_cost")), "costs")
    finite = costs.filter(F.col("_cost") < INFINITE)
    badness = F.least("_display", F.coalesce("_cost", F.lit(INFINITE)))
    scored = met.join(finite, ["name", "field_name"], "left").withColumn("badness", badness)
    scored = scored.filter(F.col("badness") < INFINITE).drop("_display", "_cost")
    return headers.withColumnRenamed("pos", "header_pos").join(scored, ["dataset_id", "name"]).select(
        "file_id", "dataset_id", "header_pos", F.col("name").alias("header"),
        "column_pos", "field_name", "badness",
    )


def match_columns(headers: DataFrame, columns: DataFrame) -> DataFrame:
    """One-to-one assignment, best pairs first: ``(file_id, dataset_id, header_pos, header,
    field_name, badness)``, nulls where a header stays unmatched.

    The candidates of a file, a list no longer than its header times the dataset's width, are put
    in order (badness, then header, then column; positions count from 0) and walked through once; a
    pair counts unless the flag of its header or of its column is set. All files are matched in one job, and their lists meet the
    headers by one more join.
    """
    file = ["file_id", "dataset_id"]
    pair = F.struct("badness", "header_pos", "column_pos", "field_name")
    ranked = score_columns(headers, columns).groupBy(*file).agg(
        F.array_sort(F.collect_list(pair)).alias("_pairs")
    )

    def flags(name: str) -> Column:
        widest = F.array_max(F.transform("_pairs", lambda p: p[name]))
        return F.array_repeat(F.lit(False), widest.cast("int") + 1)

    def marked(taken: Column, at: Column) -> Column:
        return F.transform(taken, lambda x, i: x | (i == at))

    def take(acc: Column, p: Column) -> Column:
        used = F.get(acc["headers"], p["header_pos"].cast("int")) | F.get(acc["columns"], p["column_pos"].cast("int"))
        more = F.struct(
            marked(acc["headers"], p["header_pos"]).alias("headers"),
            marked(acc["columns"], p["column_pos"]).alias("columns"),
            F.array_append(acc["pairs"], p).alias("pairs"),
        )
        return F.when(used, acc).otherwise(more)

    start = F.struct(
        flags("header_pos").alias("headers"), flags("column_pos").alias("columns"),
        F.filter(F.col("_pairs"), lambda p: F.lit(False)).alias("pairs"),
    )
    chosen = F.aggregate("_pairs", start, take, lambda acc: acc["pairs"])
    matched = ranked.select(*file, F.inline(chosen))
    out = headers.select(*file, F.col("pos").alias("header_pos"), F.col("name").alias("header"))
    return out.join(matched, [*file, "header_pos"], "left").select(
        *file, "header_pos", "header", "field_name", "badness"
    )
