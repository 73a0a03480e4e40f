"""Polygons with holes and parts: a shape is an array of rings, a ring an array of (x, y); the last vertex joins the first.

Outer rings and holes of all parts stand side by side. A point lies in the shape if it lies in an odd number of rings, so
holes, islands in holes and several parts need no marks. Shapes come from WKB text (``wkb.rings_of``) or GeoJSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbsight.functions.geo import crossings, edge_distance, rd_from_wgs84

#: The coordinates of a GeoJSON geometry, by how deep its lists go.
_LINE, _LINES, _SHAPES = "array<array<double>>", "array<array<array<double>>>", "array<array<array<array<double>>>>"
#: The metric grid, and the names under which files call it and latitude with longitude.
GRID, WGS84 = "28992", ("4326", "84")


def _vertices(ring: Column) -> Column:
    return F.transform(ring, lambda v: F.struct(F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(1)).alias("y")))


def rings_of_geojson(kind: Column, coordinates: Column) -> Column:
    """The rings of a Polygon or MultiPolygon whose coordinates are JSON text; null for other types and broken text."""
    rings = F.when(kind == "Polygon", F.from_json(coordinates, _LINES)).when(kind == "MultiPolygon", F.flatten(F.from_json(coordinates, _SHAPES)))
    return _sound(F.transform(rings, _vertices))


def lines_of_geojson(kind: Column, coordinates: Column) -> Column:
    """The lines of a geometry as arrays of vertices: of polygons the rings, closed; null for points and broken text."""
    lines = F.when(kind == "LineString", F.array(F.from_json(coordinates, _LINE))).when(kind == "MultiLineString", F.from_json(coordinates, _LINES))
    closed = F.transform(rings_of_geojson(kind, coordinates), lambda r: F.concat(r, F.slice(r, 1, 1)))
    found = F.coalesce(F.transform(lines, _vertices), closed)
    return F.when(F.forall(found, lambda line: F.forall(line, lambda v: v["x"].isNotNull() & v["y"].isNotNull())), found)


def _sound(rings: Column) -> Column:
    """The shape, null where a vertex lacks a coordinate or a ring has fewer than three vertices."""
    fine = F.forall(rings, lambda r: (F.size(r) >= 3) & F.forall(r, lambda v: v["x"].isNotNull() & v["y"].isNotNull()))
    return F.when(fine & (F.size(rings) > 0), rings)


def on_grid(rings: Column, crs: Column) -> Column:
    """Rings or lines on the metric grid. Those in longitude and latitude are projected, and so are those without a
    reference system, as GeoJSON has it; null for any other system."""

    def projected(v: Column) -> Column:
        x, y = rd_from_wgs84(v["y"], v["x"])
        return F.struct(x.alias("x"), y.alias("y"))

    code = F.regexp_extract(F.coalesce(crs, F.lit("CRS84")), r"(\d+)\D*$", 1)
    return F.when(code == GRID, rings).when(code.isin(*WGS84), F.transform(rings, lambda r: F.transform(r, projected)))


def in_shape(px: Column, py: Column, rings: Column) -> Column:
    """Whether a point lies in an odd number of rings."""
    return F.aggregate(rings, F.lit(0), lambda total, ring: total + crossings(px, py, ring)) % 2 == 1


def shape_distance(px: Column, py: Column, rings: Column) -> Column:
    """Distance from a point to the shape: 0 inside, else to the closest edge, of outer rings and holes alike."""
    return F.when(in_shape(px, py, rings), 0.0).otherwise(F.array_min(F.transform(rings, lambda r: edge_distance(px, py, r))))


def edges(rings: Column) -> Column:
    """All edges of a shape as (ax, ay, bx, by)."""

    def of(ring: Column) -> Column:
        n = F.size(ring)
        at = lambda i, end: [F.element_at(ring, i)[c].cast("double").alias(f"{end}{c}") for c in "xy"]
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(*at(i, "a"), *at(i % n + 1, "b")))

    return F.flatten(F.transform(rings, of))


def area(rings: Column) -> Column:
    """Area of a shape in square units, where holes wind the other way than the rings around them, as formats ask for."""

    def signed(ring: Column) -> Column:
        n = F.size(ring)
        cross = lambda i: F.element_at(ring, i)["x"] * F.element_at(ring, i % n + 1)["y"] - F.element_at(ring, i % n + 1)["x"] * F.element_at(ring, i)["y"]
        return F.aggregate(F.transform(F.sequence(F.lit(1), n), cross), F.lit(0.0), lambda a, b: a + b) / 2

    return F.abs(F.aggregate(F.transform(rings, signed), F.lit(0.0), lambda a, b: a + b))


def bounds(rings: Column) -> tuple[Column, Column, Column, Column]:
    """(least x, largest x, least y, largest y)."""
    side = lambda k, f: f(F.transform(F.flatten(rings), lambda v: v[k]))
    return side("x", F.array_min), side("x", F.array_max), side("y", F.array_min), side("y", F.array_max)
