"""Composite columns: locations, points, and points looked up by address."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.control import GEOCODED_PARTS, LOCATION_PARTS, FileControl, Synthetic
from rowharbor.operators.skew import join_hot
from rowharbor.operators.typing import add_error
from rowharbor.runtime import field, materialise


def _put(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a composite column; it takes the place of a mapped column of that name."""
    kept = [field(c) for c in df.columns if c.lower() != name.lower()]
    return df.select(*kept, value.alias(name))


def synthetic_location(df: DataFrame, name: str, parts: Mapping[str, str]) -> DataFrame:
    """A location from its component columns; components nobody names stay null."""

    def part(p: str) -> Column:
        source = parts.get(p)
        value = field(source) if source else F.lit(None)
        kind = "double" if p in ("latitude", "longitude") else "string"
        return value.try_cast(kind).alias(p)

    return _put(df, name, F.struct(*[part(p) for p in LOCATION_PARTS]))


def synthetic_point(df: DataFrame, name: str, latitude: str, longitude: str) -> DataFrame:
    """A point from two columns, null where either is missing; a value off the globe is an
    error of the row."""
    lat, lon = field(latitude).try_cast("double"), field(longitude).try_cast("double")
    whole = lat.isNotNull() & lon.isNotNull()
    on_globe = lat.between(-90, 90) & lon.between(-180, 180)
    pair = F.struct(lon.alias("longitude"), lat.alias("latitude"))
    text = F.concat_ws(", ", field(latitude).cast("string"), field(longitude).cast("string"))
    flagged = add_error(df, F.coalesce(whole & ~on_globe, F.lit(False)), name, text, "point")
    return _put(flagged, name, F.when(whole & on_globe, pair))


def address_part(column: Column) -> Column:
    """Address text made comparable: case, punctuation and runs of blanks do not count."""
    plain = F.regexp_replace(F.lower(column.cast("string")), r"[^\p{L}\p{N}]+", " ")
    return F.coalesce(F.btrim(plain), F.lit(""))


def geocode_join(
    df: DataFrame, gazetteer: DataFrame, name: str, parts: Mapping[str, str]
) -> DataFrame:
    """A point per row, looked up in a gazetteer by its address parts.

    The gazetteer has the part columns plus ``latitude`` and ``longitude``. It is reduced to one
    place per address, so no row is multiplied. Rows whose address is blank are not looked up, and
    addresses that many rows share are spread (see ``join_hot``).
    """
    used = [p for p in GEOCODED_PARTS if parts.get(p)]
    marks = [f"_g_{p}" for p in used]
    places = materialise(
        gazetteer.groupBy(*[address_part(field(p)).alias(f"_g_{p}") for p in used])
        .agg(F.min(F.struct("longitude", "latitude")).alias("_point")),
        "places",
    )
    keyed = df
    for p in used:
        keyed = keyed.withColumn(f"_g_{p}", address_part(field(parts[p])))
    blank = F.concat(*[field(m) for m in marks]) == ""
    found = join_hot(keyed, places.filter(~blank), marks, blank)
    kept = [c for c in df.columns if c.lower() != name.lower()]
    return found.select(*[field(c) for c in kept], F.col("_point").alias(name))


def place_locations(df: DataFrame, gazetteer: DataFrame, name: str, parts: Mapping[str, str]) -> DataFrame:
    """Locations without coordinates get those of their address, where the gazetteer knows it."""
    address = {p: parts[p] for p in GEOCODED_PARTS if parts.get(p)}
    if not address:
        return df
    point = geocode_join(df, gazetteer, "_point", address)
    place = field(name)
    known = place["latitude"].isNotNull() & place["longitude"].isNotNull()
    filled = place.withField("latitude", F.col("_point.latitude")).withField("longitude", F.col("_point.longitude"))
    return point.withColumn(name, F.when(known | F.col("_point").isNull(), place).otherwise(filled)).drop("_point")


def add_synthetic_columns(
    df: DataFrame, control: FileControl, gazetteer: DataFrame | None = None
) -> DataFrame:
    """All composite columns a control asks for."""
    out = df
    for name, spec in control.synthetic_locations.items():
        out = synthetic_location(out, name, spec.parts)
        if control.use_geocoding and gazetteer is not None:
            out = place_locations(out, gazetteer, name, spec.parts)
    for name, spec in control.synthetic_points.items():
        out = _point(out, name, spec, gazetteer)
    return out


def _point(df: DataFrame, name: str, spec: Synthetic, gazetteer: DataFrame | None) -> DataFrame:
    if spec.kind == "point":
        return synthetic_point(df, name, spec.parts["latitude"], spec.parts["longitude"])
    if gazetteer is None:
        raise ValueError(f"column '{name}' needs a gazetteer")
    return geocode_join(df, gazetteer, name, spec.parts)
