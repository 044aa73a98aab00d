"""Geographic datasets made of layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_layers(file_layers: DataFrame, existing: DataFrame) -> DataFrame:
    """Which existing layer each file layer replaces: ``file_layers(dataset_id, layer)`` against
    ``existing(dataset_id, layer, uid)``.

    One layer on either side is a pair whatever the names; otherwise names must be equal. Layers
    without a partner are left out.
    """
    n_file = file_layers.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("_n_file"), F.min("layer").alias("_only_layer")
    )
    n_existing = existing.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("_n_existing"), F.min("uid").alias("_only_uid")
    )
    counts = n_file.join(n_existing, "dataset_id")
    single = (F.col("_n_file") == 1) & (F.col("_n_existing") == 1)
    alone = counts.filter(single).select(
        "dataset_id", F.col("_only_layer").alias("layer"), F.col("_only_uid").alias("uid")
    )
    several = counts.filter(~single).select("dataset_id")
    named = (
        file_layers.select("dataset_id", "layer")
        .join(existing.select("dataset_id", "layer", "uid"), ["dataset_id", "layer"])
        .join(several, "dataset_id", "left_semi")
        .select("dataset_id", "layer", "uid")
    )
    return alone.unionByName(named)


def apply_layer_map(file_layers: DataFrame, layer_map: DataFrame) -> DataFrame:
    """File layers with the uid they replace; null for a layer that becomes new."""
    return file_layers.join(
        layer_map.select("dataset_id", "layer", F.col("uid").alias("replaces")),
        ["dataset_id", "layer"],
        "left",
    )


def replace_layers(target: DataFrame, features: DataFrame, layer_map: DataFrame) -> DataFrame:
    """The dataset after its mapped layers were replaced and unmapped ones added.

    ``target`` has ``dataset_id, uid`` and the feature columns, ``features`` has ``dataset_id,
    layer`` instead. A new layer's uid is its name.
    """
    mapped = features.join(layer_map, ["dataset_id", "layer"], "left")
    arrived = mapped.withColumn("uid", F.coalesce("uid", "layer")).drop("layer")
    gone = layer_map.select("dataset_id", "uid")
    kept = target.join(gone, ["dataset_id", "uid"], "left_anti")
    return kept.unionByName(arrived.select(*target.columns))


def scan_summary(features: DataFrame) -> DataFrame:
    """Features per dataset and layer, and per dataset with a null layer."""
    levels = features.groupingSets(
        [["dataset_id", "layer"], ["dataset_id"]], "dataset_id", "layer"
    )
    return levels.agg(
        F.count(F.lit(1)).alias("features"),
        F.max("reference_system").alias("reference_system"),
        F.grouping("layer").alias("is_total"),
    )
