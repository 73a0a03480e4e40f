"""Permits: parsing, classes, places, and addresses as a fallback for geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.functions.geo import wgs84_from_rd
from kerbsight.functions.text import address, classes_of, object_names
from kerbsight.functions.wkb import point_of


def valid_on(permits: DataFrame, day, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Permits whose range, both ends included, holds the day."""
    return permits.where((F.col(start) <= F.lit(day)) & (F.col(end) >= F.lit(day)))


def with_classes(permits: DataFrame, objects: str = "objecten") -> DataFrame:
    """Adds ``names`` and ``classes`` by the keywords of the permit's objects."""
    named = permits.withColumn("names", object_names(F.col(objects)))
    return named.withColumn("classes", classes_of(F.col("names")))


def located(permits: DataFrame, addresses: DataFrame, geometry: str = "geometrie_locatie", place: str = "locatie") -> DataFrame:
    """Adds ``x`` and ``y``: the geometry's point, or that of the address in ``place`` if it has exactly that.

    One join with all addresses (street, number, postcode, x, y); of several hits that with the least coordinates.
    """
    parts = address(F.col(place))
    p = permits.withColumn("_g", point_of(geometry)).withColumns({f"_{k}": v for k, v in parts.items()})
    a = addresses.groupBy("street", "number", F.upper(F.regexp_replace("postcode", r"\s", "")).alias("postcode")).agg(F.min(F.struct("x", "y")).alias("_a"))
    joined = p.join(a, (p["_street"] == a["street"]) & (p["_number"] == a["number"]) & (p["_postcode"] == a["postcode"]), "left")
    return joined.select(*permits.columns, F.coalesce("_g.x", "_a.x").alias("x"), F.coalesce("_g.y", "_a.y").alias("y"))


def prepared(permits: DataFrame, addresses: DataFrame, day, geometry: str = "geometrie_locatie", place: str = "locatie") -> DataFrame:
    """Permits of a day with classes, a place in words and, where it can be found, coordinates: ``lat`` and ``lon``.

    ``healthy`` tells the two sides of the quarantine apart: whether the permit has coordinates. Permits whose objects
    name no class, or without a place, are on neither side.
    """
    named = with_classes(valid_on(permits, day)).where((F.size("classes") > 0) & F.col(place).isNotNull())
    found = located(named, addresses, geometry, place)
    lat, lon = wgs84_from_rd(F.col("x"), F.col("y"))
    return found.withColumns({"lat": lat, "lon": lon}).withColumn("healthy", F.col("lat").isNotNull() & F.col("lon").isNotNull())


def require_healthy(prepared_permits: DataFrame) -> DataFrame:
    """The healthy permits; an error if there is none, since every object would then look unpermitted."""
    good = prepared_permits.where("healthy")
    if good.isEmpty():
        raise ValueError("no permit has coordinates")
    return good


def exploded(permits: DataFrame) -> DataFrame:
    """One row for each class of each permit."""
    return permits.withColumn("object_class", F.explode("classes"))
