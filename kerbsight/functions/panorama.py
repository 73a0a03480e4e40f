"""Points of an equirectangular panorama on the faces of a cube, in closed form."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Faces by index.
FRONT, RIGHT, BACK, LEFT, UP, DOWN = range(6)


def on_cube(px: Column, py: Column, width: int, height: int, face: int) -> tuple[Column, Column, Column]:
    """(face, x, y) of a pixel, on faces of ``face`` pixels: the face is where the ray leaves a cube around the camera.

    Along x the faces front and back follow the ray's x, right and left its z, up and down its x; along y the sides
    follow its height downwards, up and down its depth.
    """
    u, v = ((px + 0.5) / width - 0.5) * (2 * math.pi), -((py + 0.5) / height - 0.5) * math.pi
    x, y, z = F.cos(v) * F.sin(u), F.sin(v), F.cos(v) * F.cos(u)
    ax, ay, az = F.abs(x), F.abs(y), F.abs(z)
    upright, side = (ay > ax) & (ay > az), ax > az
    index = F.when(upright, F.when(y > 0, UP).otherwise(DOWN)).when(side, F.when(x > 0, RIGHT).otherwise(LEFT)).otherwise(F.when(z > 0, FRONT).otherwise(BACK))
    most = F.greatest(ax, ay, az)
    pixel = lambda c: F.round((c / most / 2 + 0.5) * (face - 1)).cast("int")
    return index, pixel(F.when(upright, x).when(side, z).otherwise(x)), pixel(F.when(upright, -z).otherwise(-y))


def boxes_on_cube(boxes: DataFrame, id_col: str, width: int, height: int, face: int) -> DataFrame:
    """``(id, face, x0, y0, x1, y1)``: a panorama's boxes (corner form) on every face that one of their corners is on.

    A side without a corner on the face runs to the face's edge: the left and right side need one of their two corners,
    the top the upper left (or right), the bottom the lower right (or left).
    """
    corner = lambda tag, x, y: F.struct(F.lit(tag).alias("tag"), F.col(x).alias("px"), F.col(y).alias("py"))
    c = boxes.select(id_col, F.explode(F.array(corner("tl", "x0", "y0"), corner("tr", "x1", "y0"), corner("bl", "x0", "y1"), corner("br", "x1", "y1"))).alias("c"))
    index, x, y = on_cube(F.col("c.px"), F.col("c.py"), width, height, face)
    placed = c.select(id_col, index.alias("face"), "c.tag", x.alias("x"), y.alias("y"))
    at = lambda tag, axis: F.max(F.when(F.col("tag") == tag, F.col(axis)))
    zero, edge = F.lit(0), F.lit(face)
    return placed.groupBy(id_col, "face").agg(
        F.coalesce(at("tl", "x"), at("bl", "x"), zero).alias("x0"), F.greatest(F.coalesce(at("tl", "y"), zero), F.coalesce(at("tr", "y"), zero)).alias("y0"),
        F.coalesce(at("br", "x"), at("tr", "x"), edge).alias("x1"), F.coalesce(at("br", "y"), at("bl", "y"), edge).alias("y1"),
    )


#: Where each side face looks, and whether its pixels run with the angle. The back is met at either end of the panorama.
_SIDES = ((FRONT, 0.0, 1), (RIGHT, math.pi / 2, -1), (BACK, math.pi, -1), (BACK, -math.pi, -1), (LEFT, -math.pi / 2, 1))


def _side_part(u0: Column, u1: Column, v0: Column, v1: Column, centre: float, sign: int) -> Column:
    """What a side face sees of angles u0 to u1 and heights v0 to v1: (x0, x1, y0, y1) from -1 to 1, null for nothing.

    At an angle w off the face's centre a height v stands at tan(v) / cos(w). A box above or below the horizon is on the
    face only where that is within 1, so close enough to the centre.
    """
    above, below = F.tan(F.greatest(v0, F.lit(0.0))), F.tan(F.greatest(-v1, F.lit(0.0)))
    reach = F.acos(F.least(F.greatest(above, below), F.lit(1.0)))
    lo = F.greatest(u0 - centre, -F.least(reach, F.lit(math.pi / 4)))
    hi = F.least(u1 - centre, F.least(reach, F.lit(math.pi / 4)))
    widest, closest = F.greatest(F.abs(lo), F.abs(hi)), F.when((lo <= 0) & (hi >= 0), 0.0).otherwise(F.least(F.abs(lo), F.abs(hi)))
    top = F.least(F.lit(1.0), F.tan(v1) / F.cos(F.when(v1 >= 0, widest).otherwise(closest)))
    bottom = F.greatest(F.lit(-1.0), F.tan(v0) / F.cos(F.when(v0 <= 0, widest).otherwise(closest)))
    x = (F.tan(lo), F.tan(hi)) if sign > 0 else (-F.tan(hi), -F.tan(lo))
    return F.when(lo <= hi, F.struct(x[0].alias("x0"), x[1].alias("x1"), (-top).alias("y0"), (-bottom).alias("y1")))


def _flat_part(u0: Column, u1: Column, v0: Column, v1: Column) -> Column:
    """What the upper face sees of angles u0 to u1 and heights v0 to v1, as :func:`_side_part`.

    Heights are circles around the face's middle, angles are rays from it. Extremes of their part within the square lie at
    its ends, on the axes and diagonals, and where its circles cross the square's sides.
    """
    inner, outer = 1 / F.tan(v1), F.when(v0 > 1e-9, 1 / F.tan(v0)).otherwise(F.lit(math.inf))
    turns = [u0, u1, *[F.lit(k * math.pi / 4) for k in range(-4, 5)]]
    for radius in (inner, outer):
        a = F.when(radius >= 1, F.asin(1 / radius))
        for b in (a, math.pi / 2 - a):
            turns += [b, -b, math.pi - b, b - math.pi]
    edge = lambda u: 1 / F.greatest(F.abs(F.sin(u)), F.abs(F.cos(u)))
    met = F.filter(F.array(*turns), lambda u: u.isNotNull() & (u >= u0) & (u <= u1) & (edge(u) >= inner - 1e-9))
    points = F.flatten(F.transform(met, lambda u: F.transform(F.array(inner, F.least(outer, edge(u))), lambda r: F.struct((r * F.sin(u)).alias("x"), (-r * F.cos(u)).alias("y")))))
    most = lambda f, axis: f(F.transform(points, lambda p: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), p[axis]))))
    return F.when((v1 > 0) & (F.size(met) > 0), F.struct(most(F.array_min, "x").alias("x0"), most(F.array_max, "x").alias("x1"), most(F.array_min, "y").alias("y0"), most(F.array_max, "y").alias("y1")))


def outlines_on_cube(boxes: DataFrame, id_col: str, width: int, height: int, face: int) -> DataFrame:
    """``(id, face, x0, y0, x1, y1)``: the box around what every face shows of a panorama's boxes (corner form).

    A box's outline bends on a face, and a face can show part of a box without any of its corners; here the outline itself
    is clipped against the face, in closed form. Boxes of no or negative extent give nothing.
    """
    u, v = (lambda c: ((F.col(c) + 0.5) / width - 0.5) * (2 * math.pi)), (lambda c: -((F.col(c) + 0.5) / height - 0.5) * math.pi)
    u0, u1, v0, v1 = u("x0"), u("x1"), v("y1"), v("y0")
    part = lambda index, seen: F.struct(F.lit(index).alias("face"), seen.alias("s"))
    parts = [part(index, _side_part(u0, u1, v0, v1, centre, sign)) for index, centre, sign in _SIDES]
    parts += [part(UP, _flat_part(u0, u1, v0, v1)), part(DOWN, _flat_part(u0, u1, -v1, -v0))]
    seen = boxes.where("x1 > x0 and y1 > y0").select(id_col, F.explode(F.array(*parts)).alias("p")).where("p.s is not null").select(id_col, "p.face", "p.s.*")
    pixel = lambda c: F.round((c / 2 + 0.5) * (face - 1)).cast("int")
    return seen.groupBy(id_col, "face").agg(*[pixel(f(c)).alias(c) for c, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max))])
