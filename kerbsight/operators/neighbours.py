"""Nearest neighbours by two trees of counted cells that are descended together.

Places become points; a cell of level k has sides of ``2**k`` units, and all cells of a level are one aggregate away from
the places. Beginning with one cell that holds everything, each round splits the cells of every pair of a left and a right
cell and keeps what may matter: the box around a cell's places bounds all distances between two cells from below and
above, and no right cell can hold a neighbour that is farther off than the farthest place of another one. Dense cells are
split on, sparse ones stay large, and a pair is done when its places make few enough pairs to compare.

So neither a crowd in one spot nor a place far from all others meets more than a few cells at a time. What a round leaves
is written, so no round repeats another. What has an extent, such as a segment, is a box in the cell of its middle.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbsight.operators.scratch import written

#: Pairs of places that a pair of cells compares at most, unless they lie within one unit.
PAIRS = 1 << 9
#: Levels that the first round descends, and every later one.
FIRST, STEP = 3, 1
#: Levels in all: units are the extent / 2**DEPTH, millimetres for the whole earth.
DEPTH = 34


def _cells(places: DataFrame, on: list[str], names: list[str], level: int, tag: str) -> DataFrame:
    """Cells of a level: place in the grid, number of places and the box around them."""
    at = [F.shiftright(f"{n}_cell", level).alias(f"{tag}{k}") for k, n in enumerate(names)]
    box = [f(f"{n}_{word}").alias(f"{tag}{word}{k}") for k, n in enumerate(names) for f, word in ((F.min, "low"), (F.max, "high"))]
    return places.groupBy(*on, *at).agg(F.count("*").alias(f"{tag}n"), *box)


def _gaps(k: int) -> tuple[Column, Column]:
    """The least and largest distance along one axis between the boxes of two cells."""
    al, ah, bl, bh = (F.col(f"{t}{w}{k}") for t in ("a", "b") for w in ("low", "high"))
    return F.greatest(al - bh, bl - ah, F.lit(0.0)), F.greatest(ah - bl, bh - al)


def candidate_cells(left: DataFrame, right: DataFrame, on: list[str], names: list[str], slack: float, pairs: int | None = None, within: float = math.inf) -> list[tuple[int, DataFrame]]:
    """Pairs of cells that can hold a left place and its nearest right one, by level: ``(*on, a0.., b0.., an, bn)``.

    Both tables have for each coordinate the ends ``<name>_low`` and ``<name>_high`` and the cell of level 0, ``<name>_cell``.
    Distances in which the result is ranked may
    differ from those between the points by the share ``slack``. What is farther off than ``within`` may be left out.
    """
    pairs = PAIRS if pairs is None else pairs
    axes = range(len(names))
    a, b, up = [f"a{k}" for k in axes], [f"b{k}" for k in axes], [f"_up{k}" for k in axes]
    top = lambda df, tag: _cells(df, on, names, DEPTH, tag).select(*on, *[f"{tag}{k}" for k in axes])
    # At the top all cells are cell 0, so pairs are those of equal cells.
    met = top(left, "a").join(top(right, "b").withColumnsRenamed(dict(zip(b, a, strict=True))), [*on, *a]).withColumns({y: F.col(x) for x, y in zip(a, b, strict=True)})
    active, level, done = met.withColumn("bound", F.lit(within)), DEPTH, []
    while level > 0:
        step = min(FIRST if level == DEPTH else STEP, level)
        level -= step
        # Left cells come last: the pairs of a left cell then lie in one task already, as its parent's did.
        for tag, side, keys in (("b", right, b), ("a", left, a)):
            cells = _cells(side, on, names, level, f"_{tag}")
            cells = cells.withColumns({k: F.shiftright(f"_{k}", step) for k in keys})
            active = active.join(cells, [*on, *keys])
            active = active.drop(*keys) if tag == "b" else active.withColumnsRenamed(dict(zip(a, up, strict=True)))
            active = active.withColumnsRenamed({c: c[1:] for c in cells.columns if c.startswith(f"_{tag}")})
        gaps = [_gaps(k) for k in axes]
        near, far = (F.sqrt(reduce(lambda x, y: x + y, [g[i] * g[i] for g in gaps])) for i in (0, 1))
        meets = F.col("_near") <= F.col("bound") * (1 + slack) + 1e-6
        bound = F.least("bound", F.min("_far").over(Window.partitionBy(*on, *up, *a)))
        kept = active.withColumns({"_near": near, "_far": far}).where(meets).withColumn("bound", bound).where(meets)
        few = (F.col("an") * F.col("bn") <= pairs) | F.lit(level == 0)
        kept = written(kept.select(*on, *a, *b, "an", "bn", "bound", few.alias("_few")), "cells")
        n = kept.agg(F.count_if("_few").alias("few"), F.count_if(~F.col("_few")).alias("more")).first()
        if n["few"] or not n["more"] and not done:
            done.append((level, kept.where("_few").select(*on, *a, *b, "an", "bn")))
        if not n["more"]:
            break
        active = kept.where("not _few").select(*on, *a, *b, "bound")
    return done


def _at_levels(places: DataFrame, on: list[str], names: list[str], levels: list[int], tag: str) -> DataFrame:
    """Places once for each level, with their cell there."""
    rows = places.withColumn("_level", F.explode(F.array(*map(F.lit, levels))))
    return rows.withColumns({f"{tag}{k}": F.expr(f"shiftright(`{n}_cell`, _level)") for k, n in enumerate(names)}).drop(*[f"{n}_cell" for n in names])


def _boxed(places: DataFrame, names: list[str]) -> DataFrame:
    """Points as boxes without extent."""
    return places if f"{names[0]}_low" in places.columns else places.withColumns({f"{n}_{w}": F.col(n) for n in names for w in ("low", "high")}).drop(*names)


def nearest_places(left: DataFrame, right: DataFrame, on: list[str], names: list[str], distance: Callable[[Column], Column], slack: float, within: float = math.inf) -> DataFrame:
    """``(_l, _n)`` for each left place that has a right one in its group: the nearest, as a struct of ``d`` and ``r``.

    ``left`` has _l, the columns ``on``, the coordinates ``names`` and any others; ``right`` the same coordinates, or their
    ends ``<name>_low`` and ``<name>_high``, and ``_r``, a struct whose first field decides ties. ``distance`` is made of
    that struct and the left columns; it
    must be no less than that of the boxes and no more than to their farthest point. Right places farther off than
    ``within`` may be missed.
    """
    axes = range(len(names))
    left, right = _boxed(left, names), _boxed(right, names)
    box = [f"{n}_{w}" for n in names for w in ("low", "high")]
    ends = left.select(*box).unionByName(right.select(*box)).agg(*[f(f"{n}_{w}").alias(f"{n}_{w}") for n in names for f, w in ((F.min, "low"), (F.max, "high"))]).first()
    ends = {k: v or 0.0 for k, v in ends.asDict().items()}
    unit = max(max(ends[f"{n}_high"] - ends[f"{n}_low"] for n in names), 1e-9) / (1 << DEPTH)
    middle = lambda n: (F.col(f"{n}_low") + F.col(f"{n}_high")) / 2
    cell = {f"{n}_cell": F.greatest(F.lit(0), F.least(F.floor((middle(n) - ends[f"{n}_low"]) / unit), F.lit((1 << DEPTH) - 1))) for n in names}
    left, right = left.withColumns(cell), right.withColumns(cell)
    done = candidate_cells(left, right, on, names, slack, within=within)
    levels = [level for level, _ in done]
    pairs = reduce(DataFrame.unionByName, [df.withColumn("_level", F.lit(level)) for level, df in done]).drop("an", "bn")
    a, b = [[*on, "_level", *[f"{tag}{k}" for k in axes]] for tag in "ab"]
    # Places of a right cell, few for what it meets, are one array; so a left place is a row for each cell, not each place.
    own = _at_levels(right.drop(*box), on, names, levels, "b").join(pairs.select(*b), b, "left_semi").groupBy(*b).agg(F.collect_list("_r").alias("_rs"))
    met = pairs.join(own, b).select(*a, "_rs").join(_at_levels(left.drop(*box), on, names, levels, "a"), a)
    best = F.array_min(F.transform("_rs", lambda r: F.struct(distance(r).alias("d"), r.alias("r"))))
    return met.select("_l", best.alias("_n")).groupBy("_l").agg(F.min("_n").alias("_n"))
