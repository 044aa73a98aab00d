"""Geographic files: GeoJSON and KML, geometry of any kind as nested parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GEOJSON_SCHEMA = (
    "type string, name string, crs struct<properties:struct<name:string>>, "
    "features array<struct<type:string, id:string, properties:variant, geometry:variant>>"
)

# Bytes no document holds: the reader takes a whole file for one record, and has its bytes at hand. Of a stream it
# would fetch each number or list that stands for a text, as a feature's id, by a read of its own.
_NO_END = "\u0001\u0002end\u0002\u0001"

_LINE = "struct<coordinates:string>"
_POLYGON = f"struct<outerBoundaryIs:struct<LinearRing:{_LINE}>, innerBoundaryIs:array<struct<LinearRing:array<{_LINE}>>>>"
_SHAPES = f"Point:array<{_LINE}>, LineString:array<{_LINE}>, Polygon:array<{_POLYGON}>"
KML_SCHEMA = (
    f"name string, description string, Point {_LINE}, LineString {_LINE}, Polygon {_POLYGON}, "
    f"MultiGeometry struct<{_SHAPES}, MultiGeometry:array<struct<{_SHAPES}>>>, "
    "ExtendedData struct<Data:array<struct<_name:string, value:string>>>"
)


def scan_geojson(
    spark: SparkSession, path: str | list[str], sequence: bool = False
) -> DataFrame:
    """One row per feature: file, layer name, reference system, ``properties`` with the types they have
    in the file, geometry type, its coordinates as JSON text (null for a collection), and its ``parts``:
    ``(type, coordinates)`` of each member of a collection, or of the geometry itself. A collection within
    a collection is one part, with its members as JSON text. A file is one collection of features, or a
    ``sequence`` of one per line, which Spark can split."""
    reader = spark.read.schema(GEOJSON_SCHEMA)
    whole = (reader if sequence else reader.option("lineSep", _NO_END)).json(path)
    return geojson_features(whole.select("*", F.col("_metadata.file_path").alias("file")))


def geojson_features(collections: DataFrame) -> DataFrame:
    exploded = collections.select(
        "file",
        F.col("name").alias("layer"),
        F.col("crs.properties.name").alias("reference_system"),
        F.posexplode("features").alias("feature_no", "_f"),
    )
    shape = F.col("_f.geometry")
    members = F.try_variant_get(shape, "$.geometries", "array<variant>")
    parts = F.when(members.isNotNull(), F.transform(members, _part)).when(_kind(shape).isNotNull(), F.array(_part(shape)))
    return exploded.select(
        "file", "layer", "reference_system", "feature_no",
        F.col("_f.id").alias("feature_id"), F.col("_f.properties").alias("properties"),
        _kind(shape).alias("geometry_type"), _json(shape, "$.coordinates").alias("coordinates"), parts.alias("parts"),
    )


def _kind(shape: Column) -> Column:
    return F.try_variant_get(shape, "$.type", "string")


def _json(shape: Column, path: str) -> Column:
    return F.to_json(F.try_variant_get(shape, path, "variant"))


def _part(shape: Column) -> Column:
    inside = F.coalesce(_json(shape, "$.coordinates"), _json(shape, "$.geometries"))
    return F.struct(_kind(shape).alias("type"), inside.alias("coordinates"))


def scan_kml(spark: SparkSession, path: str | list[str], sequence: bool = False) -> DataFrame:
    """One row per placemark: name, description, ``properties`` (extended data), geometry type, coordinates
    (null for several geometries), and ``parts``: ``(type, coordinates, holes)`` of each geometry, those
    of a multi-geometry by kind, points first. A file is one document, or a ``sequence`` of one placemark per
    line, which Spark can split."""
    marks = (
        spark.read.schema(KML_SCHEMA)
        .option("rowTag", "Placemark")
        .option("multiLine", not sequence)
        .xml(path)
    )
    several = F.col("MultiGeometry")
    inner = F.coalesce(several["MultiGeometry"], F.array().cast(f"array<struct<{_SHAPES}>>"))
    kind = (
        F.when(F.col("Point").isNotNull(), "Point")
        .when(F.col("LineString").isNotNull(), "LineString")
        .when(F.col("Polygon").isNotNull(), "Polygon")
        .when(several.isNotNull(), "MultiGeometry")
    )
    single = F.filter(F.array(_line("Point", F.col("Point")), _line("LineString", F.col("LineString")), _polygon(F.col("Polygon"))),
                      lambda p: p.isNotNull())
    nested = F.flatten(F.transform(inner, _shapes))
    parts = F.when(several.isNotNull(), F.concat(_shapes(several), nested)).when(F.size(single) > 0, single)
    data = F.map_from_entries(F.transform("ExtendedData.Data", lambda d: F.struct(d["_name"], d["value"])))
    return marks.select(
        F.col("_metadata.file_path").alias("file"),
        "name",
        "description",
        data.alias("properties"),
        kind.alias("geometry_type"),
        F.when(several.isNull(), F.get(parts, F.lit(0))["coordinates"]).alias("coordinates"),
        parts.alias("parts"),
    )


def _line(kind: str, shape: Column) -> Column:
    none = F.lit(None).cast("array<string>")
    part = F.struct(F.lit(kind).alias("type"), F.btrim(shape["coordinates"]).alias("coordinates"), none.alias("holes"))
    return F.when(shape.isNotNull(), part)


def _polygon(shape: Column) -> Column:
    rings = F.flatten(F.transform(shape["innerBoundaryIs"], lambda b: b["LinearRing"]))
    part = F.struct(
        F.lit("Polygon").alias("type"), F.btrim(shape["outerBoundaryIs"]["LinearRing"]["coordinates"]).alias("coordinates"),
        F.transform(rings, lambda r: F.btrim(r["coordinates"])).alias("holes"))
    return F.when(shape.isNotNull(), part)


def _shapes(several: Column) -> Column:
    """The parts of a multi-geometry, by kind."""
    lists = [
        F.transform(several["Point"], lambda p: _line("Point", p)),
        F.transform(several["LineString"], lambda p: _line("LineString", p)),
        F.transform(several["Polygon"], _polygon),
    ]
    none = F.array().cast("array<struct<type:string, coordinates:string, holes:array<string>>>")
    return F.concat(*[F.coalesce(x, none) for x in lists])
