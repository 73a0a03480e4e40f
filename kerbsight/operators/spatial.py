"""Clustering and spatial joins on grid cells; none is a cross join, none puts all rows under one key.

Places on earth become points in space, so cells have the same size at every latitude and across the 180th meridian.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from kerbsight.functions import shapes
from kerbsight.functions.geo import CLUSTER_RADIUS, along_segment, ellipsoidal, haversine, on_sphere, segment_distance
from kerbsight.operators.components import connected_components
from kerbsight.operators.neighbours import nearest_places
from kerbsight.operators.scratch import written

#: Spheres and ellipsoids differ by less than this share of a distance.
SLACK = 0.01
_POINT = ("_p0", "_p1", "_p2")


def _cell(side: float, *coordinates: Column) -> list[Column]:
    return [F.floor(c / side) for c in coordinates]


def _around(reach: int, dimensions: int, later_only: bool = False) -> Column:
    """Steps to neighbouring cells, as an array of arrays."""
    steps = [s for s in itertools.product(range(-reach, reach + 1), repeat=dimensions) if not later_only or s > (0,) * dimensions]
    return F.array(*[F.array(*map(F.lit, s)) for s in steps])


def _on_surface(side: float, cell: list[Column], radius: float = CLUSTER_RADIUS) -> Column:
    """Whether a cell may hold points of the sphere."""
    centre = F.sqrt(sum(((c + 0.5) * side * (c + 0.5) * side for c in cell), F.lit(0.0)))
    return F.abs(centre - radius) <= side


def clusters(points: DataFrame, eps: float, by: list[str], id_col: str = "detection_id", lat: str = "gps_lat", lon: str = "gps_lon") -> DataFrame:
    """Adds ``cluster``, the smallest id among the points that steps of at most ``eps`` metres connect within a group.

    That is density clustering in which one point suffices. Cells are so small that points of one cell are always
    connected, so each cell is a star around its smallest id; only points of different cells nearby are compared.
    A negative ``eps`` makes each point its own cluster. Points without a position are their own cluster too.
    """
    if eps < 0:
        return points.withColumn("cluster", F.col(id_col))
    side = max(eps, 1e-3) * 0.57
    place = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(*by, F.col(id_col).alias("_id"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
    place = place.withColumns(dict(zip(_POINT, on_sphere(F.col("_lat"), F.col("_lon")), strict=True)))
    names = ["_c0", "_c1", "_c2"]
    cell = place.withColumns(dict(zip(names, _cell(side, *map(F.col, _POINT)), strict=True)))
    keys = [*by, *names]
    star = cell.join(cell.groupBy(*keys).agg(F.min("_id").alias("_m")), keys).select(F.col("_id").alias("a"), F.col("_m").alias("b"))
    moved = cell.withColumn("_o", F.explode(_around(2, 3, later_only=True))).withColumns({n: F.col(n) + F.col("_o")[k] for k, n in enumerate(names)})
    gap = [F.greatest(F.col(n) * side - F.col(p), F.col(p) - (F.col(n) + 1) * side, F.lit(0.0)) for n, p in zip(names, _POINT, strict=True)]
    moved = moved.where((sum((g * g for g in gap), F.lit(0.0)) <= eps * eps) & _on_surface(side, list(map(F.col, names))))
    moved = moved.select(*keys, F.col("_id").alias("_id2"), F.col("_lat").alias("_lat2"), F.col("_lon").alias("_lon2"))
    near = cell.select(*keys, "_id", "_lat", "_lon").join(moved, keys).where(haversine(F.col("_lat"), F.col("_lon"), F.col("_lat2"), F.col("_lon2")) <= eps).select(F.col("_id").alias("a"), F.col("_id2").alias("b"))
    found = connected_components(star.unionByName(near))
    return points.join(found.withColumnRenamed("node", id_col), id_col, "left").withColumn("cluster", F.coalesce("component", id_col)).drop("component")


def nearest(
    left: DataFrame, right: DataFrame, id_col: str, right_id: str, on: list[str], distance: Callable[..., Column] = ellipsoidal,
    place: tuple[str, str] = ("lat", "lon"), right_place: tuple[str, str] = ("lat", "lon"), flat: bool = False, keep_unmatched: bool = False, within: float = math.inf,
) -> DataFrame:
    """Each left row with the closest right row of the same group: its id, place and ``distance``; ties to the least id.

    Cells adapt to where rows lie, see :mod:`kerbsight.operators.neighbours`. ``distance`` takes both places' columns; with
    ``flat`` they are metres in the plane. Places on earth are compared as points in space and ranked by ``distance`` among
    those that are within 2 % of the closest; the default is good up to some tens of kilometres, for longer ones take
    :func:`kerbsight.functions.geo.far_distance`. Left ids are unique. Rows without a place, of groups without right rows, or without one
    ``within`` so many metres, are dropped, or kept with nulls.
    """
    there = " and ".join(f"{c} is not null" for c in ["_x", "_y", *on])
    own = left.select(*on, F.col(id_col).alias("_lid"), F.col(place[0]).alias("_x"), F.col(place[1]).alias("_y")).where(there)
    theirs = right.select(*on, F.col(right_id).alias("_rid"), F.col(right_place[0]).alias("_x"), F.col(right_place[1]).alias("_y")).where(there)
    hits = nearest_by_place(own, theirs, on, distance, flat, within)
    out = left.join(own.join(hits, [*on, "_x", "_y"]).select(F.col("_lid").alias(id_col), "_n"), id_col, "left" if keep_unmatched else "inner")
    return out.select(*left.columns, F.col("_n.r.id").alias(right_id), F.col("_n.r.x").alias("near_x"), F.col("_n.r.y").alias("near_y"), F.col("_n.d").alias("distance"))


def nearest_by_place(left: DataFrame, right: DataFrame, on: list[str], distance: Callable[..., Column], flat: bool = False, within: float = math.inf) -> DataFrame:
    """``(*on, _x, _y, _n)``: each place of ``left`` (on, _x, _y) with the nearest of ``right`` (on, _rid, _x, _y) in ``_n``.

    ``_n`` has the distance ``d`` and ``r``: id, x and y. Coordinates aren't null. Places without one ``within`` so many
    metres are left out.
    """
    names = list(_POINT[:2] if flat else _POINT)
    points = (lambda x, y: (F.col(x).cast("double"), F.col(y).cast("double"))) if flat else (lambda x, y: on_sphere(F.col(x), F.col(y)))
    at = dict(zip(names, points("_x", "_y"), strict=True))
    spots = written(left.select(*on, "_x", "_y").distinct().withColumns(at).withColumn("_l", F.monotonically_increasing_id()), "spots")
    theirs = right.groupBy(*on, "_x", "_y").agg(F.min("_rid").alias("_rid")).withColumns(at)
    theirs = written(theirs.select(*on, *names, F.struct(F.col("_rid").alias("id"), F.col("_x").alias("x"), F.col("_y").alias("y")).alias("_r")), "spots")
    found = nearest_places(spots, theirs, on, names, lambda r: distance(F.col("_x"), F.col("_y"), r["x"], r["y"]), 0.0 if flat else 2 * SLACK, within)
    found = found if within == math.inf else found.where(F.col("_n.d") <= within)
    return written(spots.select(*on, "_x", "_y", "_l").join(found, "_l").drop("_l"), "nearest")


def _cells(x0: Column, x1: Column, y0: Column, y1: Column, size: float) -> Column:
    """All cells that a bounding box touches."""
    span = lambda a, b: F.sequence(F.floor(a / size), F.floor(b / size))
    return F.flatten(F.transform(span(x0, x1), lambda i: F.transform(span(y0, y1), lambda j: F.struct(i.alias("i"), j.alias("j")))))


def nearest_segment(points: DataFrame, segments: DataFrame, id_col: str, segment_id: str) -> DataFrame:
    """Each point (x, y) with its closest segment (ax, ay, bx, by), in the plane, the closest point on it and the distance.

    As :func:`nearest`, with a segment's bounding box in the cell of its middle; ties go to the least segment id. Points
    and segments without coordinates are left out. Point ids are unique.
    """
    corners = ["ax", "ay", "bx", "by"]
    own = points.select(F.col(id_col).alias("_pid"), F.col("x").alias("_x"), F.col("y").alias("_y")).where("_x is not null and _y is not null")
    spots = written(own.select("_x", "_y").distinct().withColumns({"_p0": F.col("_x").cast("double"), "_p1": F.col("_y").cast("double"), "_l": F.monotonically_increasing_id()}), "spots")
    s = segments.select(F.col(segment_id).alias("_sid"), *[F.col(c).cast("double").alias(c) for c in corners]).where(" and ".join(f"{c} is not null" for c in corners))
    ends = {f"_p{k}_{w}": f(f"a{axis}", f"b{axis}") for k, axis in enumerate("xy") for w, f in (("low", F.least), ("high", F.greatest))}
    s = s.groupBy(*corners).agg(F.min("_sid").alias("_sid")).withColumns(ends)
    s = written(s.select(*ends, F.struct(F.col("_sid").alias("id"), *corners).alias("_r")), "segments")

    def closest(r: Column) -> tuple[Column, Column]:
        t = along_segment(F.col("_x"), F.col("_y"), *[r[c] for c in corners])
        return r["ax"] + t * (r["bx"] - r["ax"]), r["ay"] + t * (r["by"] - r["ay"])

    found = nearest_places(spots, s, [], ["_p0", "_p1"], lambda r: segment_distance(F.col("_x"), F.col("_y"), *[r[c] for c in corners]), 0.0)
    x, y = closest(F.col("_n.r"))
    hits = written(spots.select("_x", "_y", "_l").join(found, "_l").select("_x", "_y", "_n", x.alias("_nx"), y.alias("_ny")), "nearest")
    out = points.join(own.join(hits, ["_x", "_y"]).select(F.col("_pid").alias(id_col), "_n", "_nx", "_ny"), id_col)
    return out.select(*points.columns, F.col("_n.r.id").alias(segment_id), F.col("_nx").alias("near_x"), F.col("_ny").alias("near_y"), F.col("_n.d").alias("distance"))


def _rings(areas: DataFrame, column: str) -> Column:
    """A column of shapes: arrays of rings as they are, a single ring as the only one of its shape."""
    kind = areas.schema[column].dataType
    return F.col(column) if isinstance(kind.elementType, ArrayType) else F.when(F.col(column).isNotNull(), F.array(column))


def _bounded(areas: DataFrame, by: float, size: float) -> DataFrame:
    """Areas once for each cell that the bounding box of their ``_rings``, widened by ``by``, touches, with that box."""
    x0, x1, y0, y1 = shapes.bounds(F.col("_rings"))
    box = {"_x0": x0 - by, "_x1": x1 + by, "_y0": y0 - by, "_y1": y1 + by}
    return areas.where("_rings is not null").withColumns(box).withColumn("_cell", F.explode(_cells(*map(F.col, box), size)))


def _cell_of(x: str, y: str, size: float) -> Column:
    return F.struct(F.floor(F.col(x) / size).alias("i"), F.floor(F.col(y) / size).alias("j"))


def _near_box(points: DataFrame, id_col: str, x: str, y: str, bounded: DataFrame, size: float) -> DataFrame:
    """Points with the areas whose widened box holds them: rings are looked at for these pairs only."""
    own = points.select(id_col, F.col(x).alias("_x"), F.col(y).alias("_y"), _cell_of(x, y, size).alias("_cell"))
    inside = F.col("_x").between(F.col("_x0"), F.col("_x1")) & F.col("_y").between(F.col("_y0"), F.col("_y1"))
    return own.join(bounded, "_cell").where(inside)


def holding(points: DataFrame, areas: DataFrame, id_col: str, area_id: str, x: str = "x", y: str = "y", ring: str = "ring", size: float = 0.05) -> DataFrame:
    """``(id_col, area_id)``: each point with every area whose shape holds it; areas that share a border may overlap by rounding.

    ``ring`` names a ring, or an array of rings in which holes and parts stand side by side. Areas without one hold nothing.
    """
    bounded = _bounded(areas.select(area_id, _rings(areas, ring).alias("_rings")), 0.0, size)
    return _near_box(points, id_col, x, y, bounded, size).where(shapes.in_shape(F.col("_x"), F.col("_y"), F.col("_rings"))).select(id_col, area_id)


def containing(points: DataFrame, areas: DataFrame, id_col: str, area_id: str, x: str = "x", y: str = "y", ring: str = "ring", size: float = 0.05, keep_unmatched: bool = False) -> DataFrame:
    """Each point with the area (least id first) of those :func:`holding` it; points outside all are dropped or kept with null."""
    hit = holding(points, areas, id_col, area_id, x, y, ring, size)
    return points.join(hit.groupBy(id_col).agg(F.min(area_id).alias(area_id)), id_col, "left" if keep_unmatched else "inner")


def _touching(radius: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cells of which a part may lie within ``radius`` of an area, and whether the whole cell does."""

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, size = batch.column("_edges").flatten(), batch.column("_edges").value_lengths().to_numpy()
            edges, end = [flat.field(k).to_numpy(zero_copy_only=False) for k in range(4)], np.cumsum(size)
            levels, *box = (batch.column(c).to_numpy() for c in ("_level", "_x0", "_x1", "_y0", "_y1"))
            found: list[list[np.ndarray]] = [[], [], [], []]
            for k, (level, x0, x1, y0, y1) in enumerate(zip(levels, *box, strict=True)):
                side = 2.0**level
                i, j = (x.ravel() for x in np.meshgrid(*[np.arange(np.floor(low / side), np.floor(high / side) + 1) for low, high in ((x0, x1), (y0, y1))]))
                x, y = (i[:, None] + 0.5) * side, (j[:, None] + 0.5) * side
                ax, ay, bx, by = (e[end[k] - size[k] : end[k]] for e in edges)
                dx, dy = bx - ax, by - ay
                square = dx * dx + dy * dy
                t = np.clip(((x - ax) * dx + (y - ay) * dy) / np.where(square == 0, 1.0, square), 0.0, 1.0)
                away = np.sqrt(np.min((ax + t * dx - x) ** 2 + (ay + t * dy - y) ** 2, axis=1))
                crossed = ((ay > y) != (by > y)) & (x < dx * (y - ay) / np.where(dy == 0, 1.0, dy) + ax)
                away = np.where(crossed.sum(axis=1) % 2 == 1, -away, away)
                half = side * 0.7072 + 1e-9  # of a cell's diagonal, and a little for rounding
                near = away - half <= radius
                for out, values in zip(found, (np.full(near.sum(), k), i[near], j[near], (away + half <= radius)[near]), strict=True):
                    out.append(values)
            of, i, j, whole = (np.concatenate(x) if x else np.zeros(0) for x in found)
            at = pa.array(of.astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("_a").take(at), batch.column("_level").take(at), pa.array(i.astype(np.int64)), pa.array(j.astype(np.int64)), pa.array(whole.astype(bool))], names=["_a", "_level", "_i", "_j", "_whole"])

    return touched


#: Cells along the longer side of an area's widened box, at least half as many.
ACROSS = 12


def apart_from(points: DataFrame, areas: DataFrame, id_col: str, radius: float, x: str = "x", y: str = "y", ring: str = "ring") -> DataFrame:
    """Adds ``apart``: whether no area comes within ``radius`` of the point. Without any area nothing is apart.

    Rings as in :func:`containing`; a point in a hole is as far from the area as from the hole's edge. Cells fit the size of
    an area, so each touches a bounded number. From the distance of its middle a whole cell may be near an area: its points
    are decided at once, however many areas cover them, and only the others are held against the areas of their cell.
    """
    x0, x1, y0, y1 = (f(c, F.lit(radius)) for f, c in zip((lambda c, r: c - r, lambda c, r: c + r) * 2, shapes.bounds(F.col("_rings")), strict=True))
    known = areas.select(_rings(areas, ring).alias("_rings")).where("_rings is not null").distinct()
    known = known.withColumns({"_a": F.monotonically_increasing_id(), "_x0": x0, "_x1": x1, "_y0": y0, "_y1": y1})
    known = written(known.withColumn("_level", F.ceil(F.log2(F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"), F.lit(1e-3)) / ACROSS)).cast("int")), "areas")
    side, cell = F.pow(F.lit(2.0), F.col("_level")), ["_level", "_i", "_j"]
    edges = known.select("_a", "_level", "_x0", "_x1", "_y0", "_y1", shapes.edges(F.col("_rings")).alias("_edges"))
    touched = written(edges.mapInArrow(_touching(radius), "_a long, _level int, _i long, _j long, _whole boolean"), "touched")
    levels = [r["_level"] for r in known.select("_level").distinct().collect()]
    own = points.select(id_col, F.col(x).alias("_x"), F.col(y).alias("_y")).withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    own = own.withColumns({"_i": F.floor(F.col("_x") / side), "_j": F.floor(F.col("_y") / side)})
    # Tables of cells are small as files and large in memory, so none is sent to every executor.
    sure = own.join(touched.where("_whole").select(*cell).distinct().hint("merge"), cell, "left_semi").select(id_col).distinct()
    met = own.join(sure.hint("merge"), id_col, "left_anti").join(touched.where("not _whole").drop("_whole").hint("merge"), cell).select(id_col, "_x", "_y", "_a")
    met = met.join(known.drop("_level").hint("merge"), "_a").where(F.col("_x").between(F.col("_x0"), F.col("_x1")) & F.col("_y").between(F.col("_y0"), F.col("_y1")))
    near = met.where(shapes.shape_distance(F.col("_x"), F.col("_y"), F.col("_rings")) <= radius).select(id_col).distinct()
    near = sure.unionByName(near).withColumn("_near", F.lit(True))
    return points.join(near, id_col, "left").withColumn("apart", F.lit(bool(levels)) & F.col("_near").isNull()).drop("_near")


def edges_of(features: DataFrame, feature_id: str, lines: str = "lines") -> DataFrame:
    """``(feature_id, ax, ay, bx, by)``: the segments of each feature's lines, arrays of arrays of vertices."""
    line = features.select(feature_id, F.explode(lines).alias("_line"))
    ends = F.transform(F.sequence(F.lit(1), F.size("_line") - 1), lambda i: F.struct(F.element_at("_line", i).alias("a"), F.element_at("_line", i + 1).alias("b")))
    return line.where(F.size("_line") > 1).select(feature_id, F.explode(ends).alias("e")).select(feature_id, F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"))


def nearest_feature(points: DataFrame, features: DataFrame, id_col: str, feature_id: str, size: float = 250.0) -> DataFrame:
    """Each point (x, y) with its closest feature, the closest point of it and the distance, in the plane.

    Features have ``lines`` and, where they are areas, ``rings``, else null there. A point within an area is at distance 0
    from it; otherwise edges count, of holes too. Ties go to the least feature id.
    """
    inside = containing(points, features, id_col, feature_id, ring="rings", size=size)
    at_zero = inside.select(*points.columns, feature_id, F.col("x").alias("near_x"), F.col("y").alias("near_y"), F.lit(0.0).alias("distance"))
    rest = points.join(inside.select(id_col), id_col, "left_anti")
    return at_zero.unionByName(nearest_segment(rest, edges_of(features, feature_id), id_col, feature_id))


def within_any(points: DataFrame, centres: DataFrame, id_col: str, radius: float, x: str = "x", y: str = "y", cx: str = "cx", cy: str = "cy") -> DataFrame:
    """Points that lie within ``radius`` of any centre, in the plane."""
    spread = centres.select(F.col(cx).alias("_x"), F.col(cy).alias("_y")).withColumn("_cell", F.explode(_cells(F.col("_x") - radius, F.col("_x") + radius, F.col("_y") - radius, F.col("_y") + radius, 2 * radius)))
    hit = points.select(id_col, F.col(x).alias("_px"), F.col(y).alias("_py"), _cell_of(x, y, 2 * radius).alias("_cell")).join(spread, "_cell").where(F.pow(F.col("_px") - F.col("_x"), 2) + F.pow(F.col("_py") - F.col("_y"), 2) <= radius * radius)
    return points.join(hit.select(id_col), id_col, "left_semi")
