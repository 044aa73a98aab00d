"""Copying datasets: schema, data, or both."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.operators import publish
from rowharbor.operators.shape import drop_system_columns
from rowharbor.runtime import field


class InvalidSchemas(ValueError):
    """Two datasets whose columns differ."""


def copy_schema(source: DataFrame) -> DataFrame:
    """A new, empty dataset with the columns of the source."""
    visible = drop_system_columns(source)
    return source.sparkSession.createDataFrame([], visible.schema)


def copy_catalog_rows(
    catalog: DataFrame, renames: DataFrame, same_domain: bool = True
) -> DataFrame:
    """Catalogue rows of the copies: ``renames(dataset_id, new_id, new_title)``. A blank title
    keeps the old one; the resource name is cleared where it would clash."""
    title = F.coalesce(F.nullif(F.btrim("new_title"), F.lit("")), F.col("title"))
    copied = catalog.join(renames, "dataset_id")
    values = {"dataset_id": F.col("new_id"), "title": title}
    if same_domain and "resource_name" in catalog.columns:
        values["resource_name"] = F.lit(None).cast("string")
    return copied.select(
        *[values[c].alias(c) if c in values else field(c) for c in catalog.columns]
    )


def copy_data(
    source: DataFrame, target: DataFrame, key: str | None = None, method: str = "upsert",
    order: Column | None = None,
) -> DataFrame:
    """The target after all visible rows of the source were published into it. Of source rows that
    repeat a key, an upsert takes the last by ``order``, or as they are read."""
    rows = drop_system_columns(source)
    if method == "upsert" and key is not None:
        at = F.monotonically_increasing_id() if order is None else order
        ordered = drop_system_columns(source.withColumn("_order", at))
        rows = publish.last_by_key(ordered, key, F.col("_order")).drop("_order")
    if method == "replace":
        return publish.replace(target, rows)
    if method == "upsert":
        return publish.upsert(target, rows, key)
    raise ValueError(f"a copy cannot use the publish method '{method}'")


def copy_all(source: DataFrame) -> DataFrame:
    """Schema and data into a new dataset: with nothing there yet, every row is created."""
    return publish.append(copy_schema(source), drop_system_columns(source))


def schemas_alike(a: DataFrame, b: DataFrame) -> bool:
    """Equal column names and types, position by position."""
    return [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]


def assert_schemas_alike(a: DataFrame, b: DataFrame) -> None:
    if not schemas_alike(a, b):
        raise InvalidSchemas("INVALID_SCHEMAS")


def compare_schemas(pairs: DataFrame, columns: DataFrame) -> DataFrame:
    """``pairs(source_id, sink_id)`` with whether their columns agree by position, name and type.

    Columns are hashed to one row per dataset first, so each pair compares two values.
    """
    described = columns.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("width"),
        # a dataset's width bounds the list
        F.sha2(
            F.to_json(F.array_sort(F.collect_list(F.struct("pos", "field_name", "type")))), 256
        ).alias("shape"),
    )
    left = described.select(
        F.col("dataset_id").alias("source_id"), F.col("width").alias("_w1"), F.col("shape").alias("_s1")
    )
    right = described.select(
        F.col("dataset_id").alias("sink_id"), F.col("width").alias("_w2"), F.col("shape").alias("_s2")
    )
    judged = pairs.join(left, "source_id", "left").join(right, "sink_id", "left")
    alike = F.col("_s1").eqNullSafe(F.col("_s2"))
    return judged.select(
        "source_id", "sink_id", F.when(alike, "SUCCESS").otherwise("INVALID_SCHEMAS").alias("status")
    )


def adapt_grouped_columns(columns: DataFrame) -> DataFrame:
    """Columns of a grouped view, ready for a copy: a column with a ``grouping_aggregate`` in its
    ``format`` map is renamed after it; that entry and ``drill_down`` are removed."""
    aggregate = F.try_element_at("format", F.lit("grouping_aggregate"))
    renamed = F.coalesce(F.concat(aggregate, F.lit("_"), F.col("field_name")), F.col("field_name"))
    cleaned = F.map_filter(
        "format", lambda k, v: ~k.isin("grouping_aggregate", "drill_down")
    )
    return columns.withColumn("field_name", renamed).withColumn("format", cleaned)


def materialise_grouped_view(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, str]
) -> DataFrame:
    """The rows a copied grouped view holds: ``{column: aggregate}`` as ``aggregate_column``."""
    chosen = [
        getattr(F, function)(field(column)).alias(f"{function}_{column}")
        for column, function in aggregates.items()
    ]
    return df.groupBy(*[field(k) for k in keys]).agg(*chosen)
