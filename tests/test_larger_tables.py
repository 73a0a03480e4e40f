"""Steps whose work must not grow faster than their tables, and places on borders."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kerbsight.functions import geo
from kerbsight.operators import evaluation, neighbours, sampling, spatial

POINT = "struct<x: double, y: double>"


def test_cells_leave_few_places_to_compare(spark):
    """Among even places a left one meets some hundred right ones, however many there are."""
    r = random.Random(5)
    unit = 2**34 / 1000
    side = lambda: spark.createDataFrame([(x, x, y, y, int(x * unit), int(y * unit)) for x, y in ((r.uniform(0, 1000), r.uniform(0, 1000)) for _ in range(4000))], "px_low double, px_high double, py_low double, py_high double, px_cell long, py_cell long")
    n = sum(df.agg(F.sum(F.col("an") * F.col("bn"))).first()[0] or 0 for _, df in neighbours.candidate_cells(side(), side(), [], ["px", "py"], 0.0))
    assert n < 300 * 4000


def test_nearest_within_some_metres_equals_brute_force(spark):
    r = random.Random(6)
    left, right = ([(k, r.uniform(0, 500), r.uniform(0, 500)) for k in range(n)] for n in (120, 60))
    a, b = spark.createDataFrame(left, "id long, x double, y double"), spark.createDataFrame(right, "other long, x double, y double")
    near = lambda **kw: {x.id: x.other for x in spatial.nearest(a, b, "id", "other", [], geo.planar, place=("x", "y"), right_place=("x", "y"), flat=True, within=30.0, **kw).collect()}
    best = {k: min((math.dist((x, y), q[1:]), q[0]) for q in right) for k, x, y in left}
    want = {k: i for k, (d, i) in best.items() if d <= 30.0}
    assert near() == want and 0 < len(want) < 120
    assert near(keep_unmatched=True) == {k: want.get(k) for k in best}


@pytest.mark.parametrize("shared", [False, True])
def test_runs_on_one_spot_are_not_paired_row_by_row(spark, shared):
    """Frames of a crowd within reach of each other: no cell's frames are joined with all of the cells around."""
    r = random.Random(7)
    rows = [(k, 52.37 + r.uniform(0, 6e-4), 4.9 + r.uniform(0, 9e-4), r.sample(range(5), 2)) for k in range(300)]
    rows += [(300, None, 4.9, [1]), (302, 52.5, 4.9, [1]), (304, 52.37, 4.9, [])]
    df = spark.createDataFrame(rows, "frame_id long, gps_lat double, gps_lon double, classes array<int>")
    found = sampling.nearest_in_run(df.where("frame_id % 2 = 0"), df.where("frame_id % 2 = 1"), 20.0, shared_class=shared)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FLOOR" not in plan.upper()
    got = {x.frame_id: (x.auto_id, x.auto_classes) for x in found.collect()}

    def away(p, q):
        a = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(a))

    for p in rows:
        if p[0] % 2 == 0:
            fits = [q for q in rows if q[0] % 2 == 1 and p[1] is not None and (not shared or set(p[3]) & set(q[3])) and away(p, q) <= 20.0]
            best = min(fits, key=lambda q: (away(p, q), q[0]), default=None)
            assert got[p[0]] == ((best[0], best[3]) if best else (None, None))


def test_a_place_on_a_border_is_held_by_both_areas(spark):
    """Borders that differ by rounding overlap: 4.8 + 0.03 + 0.03 lies beyond 4.8 + 0.06."""
    x = 4.8 + 0.03 * 3
    ring = lambda a, b: [{"x": a, "y": 0.0}, {"x": b, "y": 0.0}, {"x": b, "y": 1.0}, {"x": a, "y": 1.0}]
    areas = spark.createDataFrame([(1, ring(4.8, math.nextafter(x, 9))), (2, ring(x, 5.0))], f"k long, ring array<{POINT}>")
    points = spark.createDataFrame([(7, x, 0.5), (8, 4.81, 0.5), (9, 6.0, 0.5)], "id long, x double, y double")
    assert sorted(map(tuple, spatial.holding(points, areas, "id", "k").collect())) == [(7, 1), (7, 2), (8, 1)]
    assert sorted((r.id, r.k) for r in spatial.containing(points, areas, "id", "k").collect()) == [(7, 1), (8, 1)]


def test_no_cells_of_areas_are_broadcast(spark):
    """A wide radius makes many cells of a small file; a driver that gathers them fails."""
    r = random.Random(8)
    corner = lambda x, y: [{"x": x, "y": y}, {"x": x + 60, "y": y}, {"x": x + 60, "y": y + 40}, {"x": x, "y": y + 40}]
    at = [(r.uniform(0, 3000), r.uniform(0, 3000)) for _ in range(40)]
    areas = spark.createDataFrame([(k, corner(*p)) for k, p in enumerate(at)] + [(99, None)], f"k long, ring array<{POINT}>")
    where = [(k, r.uniform(-500, 3500), r.uniform(-500, 3500)) for k in range(300)]
    found = spatial.apart_from(spark.createDataFrame(where, "id long, x double, y double"), areas, "id", 300.0)
    gap = lambda x, y: min(math.hypot(max(a - x, 0, x - a - 60), max(b - y, 0, y - b - 40)) for a, b in at)
    got = {x.id: x.apart for x in found.collect()}
    assert got == {k: gap(x, y) > 300.0 for k, x, y in where} and len(set(got.values())) == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 4 and "explode(flatten" not in plan


def boxes(spark, n):
    gt = [(k, k // 4, 2 + k % 2, 10.0 * (k % 4), 0.0, 10.0 * (k % 4) + 12, 10.0) for k in range(n)]
    pred = [(k, i, c, k % 10 / 10, x0 + 1, y0, x1, y1) for k, i, c, x0, y0, x1, y1 in gt]
    columns = "image_id long, object_class int"
    corners = "x0 double, y0 double, x1 double, y1 double"
    return spark.createDataFrame(gt, f"gt_id long, {columns}, {corners}"), spark.createDataFrame(pred, f"pred_id long, {columns}, score double, {corners}")


def test_greedy_overlap_takes_images_in_batches(spark):
    found = evaluation.greedy_overlap(*boxes(spark, 60))
    assert "InPandas" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 60


def test_matching_runs_once(spark):
    """Predictions are dealt out by ranges, which reads them twice; what matches them must not run twice."""
    gt, pred = boxes(spark, 400)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    matched = evaluation.coco_match(gt, pred)
    table = evaluation.average_precision(matched.mapInArrow(counted, matched.schema), gt)
    assert table.count() > 0 and seen.value == 400


def test_matches_do_not_depend_on_what_is_matched_together(spark, monkeypatch):
    gt, pred = boxes(spark, 200)
    rows = lambda: sorted(map(str, evaluation.coco_match(gt, pred, areas={"all": (0.0, 1e9), "part": {2: (0.0, 110.0)}}).collect()))
    together = rows()
    monkeypatch.setattr(evaluation, "_TOGETHER", 1)
    assert rows() == together and len(together) == 400
