"""Edges that the registered queries don't show, and operators against brute force."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbsight.functions import boxes, geo, panorama, text, wkb
from kerbsight.operators import detections as ops
from kerbsight.operators import evaluation, neighbours, permits, sampling, spatial
from kerbsight.operators.components import connected_components


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def frame(spark, data):
    return spark.createDataFrame(data, "frame_id long, gps_lat double, gps_lon double, image_timestamp timestamp, gps_timestamp timestamp")


def test_validity_modes(spark):
    from datetime import datetime

    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    f = frame(spark, [(1, 52.0, 4.0, t(5), t(0)), (2, 52.0, 4.0, t(6), t(0)), (3, None, 4.0, t(1), t(0)), (4, 0.0, 4.0, t(9), t(0)), (5, 52.0, 4.0, None, t(0)), (6, 52.0, 4.0, t(0), t(9))])
    assert rows(ops.valid_frames(f), "frame_id") == [(1,), (6,)]
    assert rows(ops.invalid_frames(f), "frame_id") == [(4,)]
    assert rows(ops.invalid_frames(f, "partition"), "frame_id") == [(2,), (3,), (4,), (5,)]


def test_thresholds_compare_single_precision(spark):
    d = spark.sql("select * from values (1, 2, cast(0.82 as float)), (2, 2, cast(0.8201 as float)), (3, 3, cast(0.83 as float)), (4, 7, cast(0.99 as float)) as t(id, object_class, confidence)")
    assert rows(d.where(ops.above("confidence", ops.CONFIDENCE)), "id") == [(2,)]
    assert d.where(ops.above("confidence", {})).count() == 4


def test_score_edges(spark):
    d = spark.createDataFrame([(2, 39.999), (2, 40.0), (3, 100.0), (4, 250.0), (1, 90.0), (2, None)], "object_class int, distance double")
    assert [r[0] for r in d.select(ops.score()).collect()] == [0.0, 0.4, 1.0, 1.0, 0.0, 0.0]


def test_representative_ties(spark):
    d = spark.createDataFrame([(3, 1, 0.9, 0.5), (2, 1, 0.9, 0.5), (1, 1, 0.1, 0.9)], "detection_id long, cluster long, confidence double, area double")
    assert rows(ops.representatives(d, ["cluster"]), "detection_id") == [(2,)]


def test_transitions(spark):
    d = spark.createDataFrame([(1, "Pending"), (2, "Pending"), (3, "Processed")], "id long, status string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    assert rows(ops.transition(d, "id"), "id") == [(1,), (2,)]
    assert rows(ops.transition(d, "id", only=ids()), "id") == []
    assert rows(ops.transition(d, "id", only=ids(2, 3)), "id") == [(2,)]
    assert rows(ops.transition(d, "id", exclude=ids(2)), "id") == [(1,)]
    assert rows(ops.transition(d, "id", exclude=ids()), "id") == [(1,), (2,)]


def test_top_k_limits(spark):
    d = spark.createDataFrame([(i, 2 + i % 2, i / 10, "A") for i in range(10)], "detection_id long, object_class int, score double, district string")
    best = lambda limits: ops.top_k(d, limits, ["district"], [F.desc("score"), F.col("detection_id")])
    assert rows(best({2: 1, 3: -1}), "detection_id") == [(5,), (7,), (8,), (9,)]
    assert best({4: 3}).count() == 0


def test_components_equal_union_find(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 80)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = {r_.node: r_.component for r_ in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clusters_equal_brute_force(spark):
    r = random.Random(3)
    pts = [(i, r.choice([2, 3]), 52.3 + r.random() * 6e-4, 4.8 + r.random() * 9e-4) for i in range(250)]

    def d(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * geo.CLUSTER_RADIUS * math.asin(math.sqrt(h))

    label = {p[0]: p[0] for p in pts}
    changed = True
    while changed:
        changed = False
        for a in pts:
            for b in pts:
                if a[1] == b[1] and d(a, b) <= 5 and label[a[0]] > label[b[0]]:
                    label[a[0]], changed = label[b[0]], True
    df = spark.createDataFrame([*pts, (999, 2, None, 4.8)], "detection_id long, object_class int, gps_lat double, gps_lon double")
    got = dict(rows(spatial.clusters(df, 5.0, ["object_class"]), "detection_id", "cluster"))
    assert got == label | {999: 999}
    assert all(a == b for a, b in rows(spatial.clusters(df, -1.0, ["object_class"]), "detection_id", "cluster"))


def test_nearest_equals_brute_force_and_keeps_unmatched(spark):
    r = random.Random(4)
    left = [(i, r.choice([2, 3, 4]), 52.3 + r.random() / 5, 4.8 + r.random() / 5) for i in range(80)]
    right = [(i, r.choice([2, 3]), 52.3 + r.random() / 5, 4.8 + r.random() / 5) for i in range(40)]
    a = spark.createDataFrame(left, "detection_id long, object_class int, lat double, lon double")
    b = spark.createDataFrame(right, "permit_id long, object_class int, lat double, lon double")
    dist = lambda x1, y1, x2, y2: geo.planar(x1, y1, x2, y2)
    got = dict(rows(spatial.nearest(a, b, "detection_id", "permit_id", ["object_class"], dist, flat=True), "detection_id", "permit_id"))
    want = {p[0]: min((math.hypot(p[2] - q[2], p[3] - q[3]), q[0]) for q in right if q[1] == p[1])[1] for p in left if p[1] != 4}
    assert got == want
    kept = spatial.nearest(a, b, "detection_id", "permit_id", ["object_class"], dist, flat=True, keep_unmatched=True)
    assert kept.count() == 80 and kept.where("permit_id is null").count() == sum(p[1] == 4 for p in left)
    assert spatial.nearest(a, b.limit(0), "detection_id", "permit_id", ["object_class"]).count() == 0
    assert spatial.nearest(a.limit(0), b, "detection_id", "permit_id", ["object_class"]).count() == 0


def crowd(r, x, y, size, n):
    return [(x + r.uniform(-size, size), y + r.uniform(-size, size)) for _ in range(n)]


@pytest.mark.parametrize("pairs", [64, 4096])
def test_nearest_among_crowds_and_loners(spark, monkeypatch, pairs):
    """Crowds on a spot, a line of places, repeated places and loners a thousand kilometres off, against brute force."""
    monkeypatch.setattr(neighbours, "PAIRS", pairs)
    r = random.Random(12)
    left = [*crowd(r, 0, 0, 1e-2, 150), *crowd(r, 5000, 0, 300, 100), *[(7.0, 7.0)] * 40, (1e6, -1e6), (-2e6, 3.0), (4000.0, 4000.0)]
    right = [*crowd(r, 0, 300, 1e-3, 150), *crowd(r, 5100, 50, 300, 60), *[(9.0, 9.0)] * 30, *((k * 10.0, 2000.0) for k in range(100)), (5e6, 5e6)]
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(left)], "detection_id long, x double, y double")
    b = spark.createDataFrame([(i, *p) for i, p in enumerate(right)], "permit_id long, u double, v double")
    got = {x.detection_id: x for x in spatial.nearest(a, b, "detection_id", "permit_id", [], geo.planar, place=("x", "y"), right_place=("u", "v"), flat=True).collect()}
    for i, p in enumerate(left):
        d, k = min((math.dist(p, q), k) for k, q in enumerate(right))
        assert got[i].permit_id == k and math.isclose(got[i].distance, d, abs_tol=1e-9), (p, got[i], right[k])


def test_cells_bound_the_pairs_that_are_compared(spark):
    """A crowd of thousands within a metre of each other makes many small pairs of cells and no large one."""
    r = random.Random(3)
    scaled = lambda places: spark.createDataFrame([(x, y, int((x + 1e5) / 2e5 * 2**34), int((y + 1e5) / 2e5 * 2**34)) for x, y in places], "px double, py double, px_cell long, py_cell long").selectExpr("px as px_low", "px as px_high", "py as py_low", "py as py_high", "px_cell", "py_cell")
    left, right = scaled([*crowd(r, 0, 0, 0.5, 3000), (9e4, 9e4)]), scaled([*crowd(r, 0, 0, 0.5, 3000), *crowd(r, -8e4, 0, 0.5, 3000)])
    sizes = [x.n for _, df in neighbours.candidate_cells(left, right, [], ["px", "py"], 0.0, pairs=256) for x in df.select((F.col("an") * F.col("bn")).alias("n")).collect()]
    assert max(sizes) <= 256 and 3000 < sum(sizes) < 400 * 3000


def test_nearest_on_the_globe_at_any_distance(spark):
    r = random.Random(21)
    some = lambda n: [(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for _ in range(n)]
    left, right = [*some(60), (90.0, 0.0), (-90.0, 17.0), (0.0, 180.0), (0.0, -180.0)], some(12)
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(left)], "detection_id long, lat double, lon double")
    b = spark.createDataFrame([(i, *p) for i, p in enumerate(right)], "permit_id long, lat double, lon double")
    got = dict(rows(spatial.nearest(a, b, "detection_id", "permit_id", [], geo.far_distance), "detection_id", "permit_id"))
    assert got == {i: min((sphere(p, q), k) for k, q in enumerate(right))[1] for i, p in enumerate(left)}


def sphere(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * geo.CLUSTER_RADIUS * math.asin(min(1.0, math.sqrt(h)))


def test_places_near_poles_and_the_180th_meridian(spark):
    r = random.Random(9)
    near = lambda la, lo, k: [(min(90.0, la + r.uniform(-1, 1) * 2e-3), (lo + r.uniform(-1, 1) * k + 180) % 360 - 180) for _ in range(25)]
    places = [*near(89.999, 0, 180), *near(-89.9995, 0, 180), *near(10, 180, 2e-3), *near(75, 30, 1e-2), *near(0, 0, 2e-3)]
    pts = list(enumerate(places))
    df = spark.createDataFrame([(i, 1, la, lo) for i, (la, lo) in pts], "detection_id long, g int, gps_lat double, gps_lon double")
    label = dict(enumerate(range(len(pts))))
    changed = True
    while changed:
        changed = False
        for i, a in pts:
            for j, b in pts:
                if label[i] > label[j] and sphere(a, b) <= 40:
                    label[i], changed = label[j], True
    assert dict(rows(spatial.clusters(df, 40.0, ["g"]), "detection_id", "cluster")) == label
    odd = df.where("detection_id % 2 = 1").select(F.col("detection_id").alias("permit_id"), "g", "gps_lat", "gps_lon")
    got = dict(rows(spatial.nearest(df, odd, "detection_id", "permit_id", ["g"], geo.haversine, place=("gps_lat", "gps_lon"), right_place=("gps_lat", "gps_lon")), "detection_id", "permit_id"))
    away = {i: min(sphere(a, b) for j, b in pts if j % 2) for i, a in pts}
    assert len(got) == len(pts) and all(abs(sphere(pts[i][1], pts[j][1]) - away[i]) < 1e-6 for i, j in got.items())
    runs = df.select(F.col("detection_id").alias("frame_id"), "gps_lat", "gps_lon", F.array(F.lit(1)).alias("classes"))
    found = dict(rows(sampling.nearest_in_run(runs.where("frame_id % 2 = 0"), runs.where("frame_id % 2 = 1"), 60.0), "frame_id", "auto_id"))
    reach = {i for i, d in away.items() if i % 2 == 0 and d * geo.COMPARE_RADIUS / geo.CLUSTER_RADIUS <= 60}
    assert {i for i, j in found.items() if j is not None} == reach


def test_nearest_segment_gives_the_closest_point(spark):
    r = random.Random(8)
    pts = [(i, r.uniform(0, 5e4), r.uniform(0, 300)) for i in range(60)] + [(99, -4e5, 7.0)]
    seg = [(i, *(x := r.uniform(0, 9e3), y := r.uniform(0, 300)), x + r.uniform(-80, 80), y + r.uniform(-80, 80)) for i in range(30)]
    got = spatial.nearest_segment(spark.createDataFrame([*pts, (100, None, 1.0)], "p long, x double, y double"), spark.createDataFrame(seg, "s long, ax double, ay double, bx double, by double"), "p", "s")
    found = {x.p: x for x in got.collect()}
    assert set(found) == {p[0] for p in pts}
    for i, x, y in pts:
        best = []
        for k, ax, ay, bx, by in seg:
            t = min(1.0, max(0.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            best.append((math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay)), k, ax + t * (bx - ax), ay + t * (by - ay)))
        d, k, fx, fy = min(best)
        f = found[i]
        assert f.s == k and abs(f.distance - d) < 1e-6 and math.hypot(f.near_x - fx, f.near_y - fy) < 1e-6


def test_ellipsoidal_distance_against_the_iterated_one(spark):
    r = random.Random(6)
    data = [(la := r.uniform(-80, 80), lo := r.uniform(-180, 180), la + r.uniform(-1, 1) * s, (lo + r.uniform(-1, 1) * s + 180) % 360 - 180, s) for s in (1e-4, 1e-3, 1e-2, 5e-2) for _ in range(50)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, s double")
    for x in df.select("s", geo.ellipsoidal(*map(F.col, "abcd")).alias("e"), geo.geodesic("a", "b", "c", "d").alias("g")).collect():
        assert abs(x.e - x.g) < (1e-3 if x.s <= 1e-2 else 2e-2), x


def test_numbers_follow_the_order(spark):
    d = spark.range(1000).repartition(7).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(37)))
    got = sampling.numbered(d, "n", "v", F.desc("id")).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001)) and [(r.v, -r.id) for r in got] == sorted((r.v, -r.id) for r in got)


def test_ring_is_half_open_and_not_convex(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (2, 4), (2, 2), (0, 2))])
    at = lambda x, y: geo.in_ring(F.lit(float(x)), F.lit(float(y)), ring)
    r = one(spark, a=at(1, 1), b=at(1, 3), c=at(3, 3), d=at(0, 0), e=at(4, 1), f=at(5, 5), g=geo.ring_distance(F.lit(1.0), F.lit(3.0), ring))
    assert tuple(r) == (True, False, True, True, False, False, 1.0)


def test_projection_and_geodesic(spark):
    x, y = geo.rd_from_wgs84(F.lit(52.372143838117), F.lit(4.90559760435224))
    la, lo = geo.wgs84_from_rd(F.lit(121687.0), F.lit(487484.0))
    r = one(spark, x=x, y=y, la=la, lo=lo, g=geo.geodesic(F.lit(52.0), F.lit(4.0), F.lit(52.0), F.lit(5.0)), z=geo.geodesic(F.lit(52.0), F.lit(4.0), F.lit(52.0), F.lit(4.0)))
    assert abs(r.x - 122202) < 100 and abs(r.y - 487250) < 500 and abs(r.la - 52.374) < 0.01 and abs(r.lo - 4.898) < 0.01
    assert abs(r.g - 68677.6) < 5 and r.z == 0.0


def test_wkb(spark):
    point = (b"\x01" + struct.pack("<I", 0x20000001) + struct.pack("<I", 28992) + struct.pack("<dd", 1.0, 2.0)).hex()
    square = (b"\x01" + struct.pack("<III", 3, 1, 5) + struct.pack("<10d", 0, 0, 2, 0, 2, 2, 0, 2, 0, 0)).hex()
    assert wkb.parse(point)[1] == [[(1.0, 2.0)]] and wkb.centroid(*wkb.parse(square)) == (1.0, 1.0)
    df = spark.createDataFrame([(point,), (square,), ("zz",), (None,), (point[:-2],)], "g string").select(wkb.point_of("g").alias("p"))
    assert [tuple(r.p) if r.p else (None, None) for r in df.collect()] == [(1.0, 2.0), (1.0, 1.0), (None, None), (None, None), (None, None)]


def test_keywords(spark):
    names = {"Schaftkeet": [2], "Container overig": [2], "Container 1,8 x 6,5 m": [2], "Puin- of afvalcontainer": [2], "Mobiel toilet": [3], "Bouwhekken": []}
    df = spark.createDataFrame([(n, f'[{{"object": "{n}"}}]') for n in names], "n string, objecten string")
    assert {r.n: r.classes for r in permits.with_classes(df).collect()} == names
    bad = spark.createDataFrame([("[{",), (None,), ('[{"other": 1}]',)], "objecten string")
    assert [r.classes for r in permits.with_classes(bad).collect()] == [[], [], []]


def test_permits_prepared(spark):
    import datetime

    import pytest

    d = datetime.date(2024, 1, 10)
    point = (b"\x01" + struct.pack("<I", 0x20000001) + struct.pack("<I", 28992) + struct.pack("<dd", 121000.0, 487000.0)).hex()
    keet = '[{"object": "Keet"}]'
    data = [(1, keet, "Dam 1 1012 LG", None), (2, keet, None, point), (3, keet, "Dam 1 1012lg", point), (4, keet, "nowhere", None), (5, "[]", "Dam 1 1012LG", None), (6, keet, "Dam 9 1012LG", "zz")]
    p = spark.createDataFrame([(i, o, a, g, d, d) for i, o, a, g in data], "permit_id int, objecten string, locatie string, geometrie_locatie string, valid_from date, valid_to date")
    book = spark.createDataFrame([("Dam", 1, "1012 lg", 121500.0, 487100.0), ("Dam", 1, "1012LG", 121400.0, 487100.0)], "street string, number int, postcode string, x double, y double")
    got = permits.prepared(p, book, d)
    assert {r.permit_id: (r.x, r.healthy) for r in got.collect()} == {1: (121400.0, True), 3: (121000.0, True), 4: (None, False), 6: (None, False)}
    assert rows(permits.require_healthy(got), "permit_id") == [(1,), (3,)]
    with pytest.raises(ValueError):
        permits.require_healthy(got.where("not healthy"))


def test_map_and_dataset_writers(spark, tmp_path):
    import json

    from kerbsight.sources import writers

    o = spark.createDataFrame([(1, 2, 1.0, 52.0, 4.0, False, 7, 52.1, 4.1, 120.0, 3, 52.2, 4.2, 9.5), (2, 3, 0.5, 52.0, 4.0, True, None, None, None, None, None, None, None, None), (3, 4, 0.1, 52.0, 4.0, False, None, None, None, None, None, None, None, None)], "detection_id long, object_class int, score double, gps_lat double, gps_lon double, private boolean, permit_id long, permit_lat double, permit_lon double, permit_distance double, bridge_id long, bridge_lat double, bridge_lon double, bridge_distance double")
    made = writers.map_rows(o)
    assert rows(made, "kind", "detection_id", "priority", "colour") == [("bridge_line", 1, 1, "blue"), ("object", 1, 1, "orange"), ("object", 2, 2, "gray"), ("permit", 1, 1, "red"), ("permit_line", 1, 1, "green")]
    lines = {(r.detection_id, r.kind): json.loads(r.value) for r in writers.map_features(made).collect()}
    assert lines[1, "bridge_line"]["geometry"] == {"type": "LineString", "coordinates": [[4.0, 52.0], [4.2, 52.2]]} and lines[1, "bridge_line"]["properties"]["label"] == "9.5m"
    assert lines[2, "object"]["geometry"] == {"type": "Point", "coordinates": [4.0, 52.0]}
    i = spark.createDataFrame([("b.jpg",), ("a.jpg",), ("no.jpg",)], "image_name string")
    d = spark.createDataFrame([(9, "b.jpg", 2, 0.5, 0.5, 0.2, 0.2), (8, "b.jpg", 7, 0.5, 0.5, 0.2, 0.2), (7, "no.jpg", 2, 0.5, 0.5, 0.2, 0.2), (6, "a.jpg", 3, 0.5, 0.5, 0.2, 0.4)], "detection_id long, image_name string, object_class int, x_center double, y_center double, width double, height double")
    images, annotations = writers.coco_dataset(i, d, i.where("image_name <> 'no.jpg'"), 100, 50, {2: 1, 3: 2})
    assert rows(images, "image_id", "file_name") == [(1, "a.jpg"), (2, "b.jpg")]
    assert [(r.id, r.image_id, r.category_id, list(r.bbox)) for r in annotations.orderBy("id").collect()] == [(1, 1, 2, [40, 15, 20, 20]), (2, 2, 1, [40, 20, 20, 10])]
    assert {json.loads(r.value)["id"] for r in writers.coco_lines(images, annotations).where("part = 'annotations'").collect()} == {1, 2}
    writers.sampling_metadata(spark.createDataFrame([(1, 52.0, 4.0), (2, None, 4.0)], "frame_id int, gps_lat double, gps_lon double"), str(tmp_path / "meta"))
    back = {r.frame_id: r.geometry and wkb.parse(bytes(r.geometry).hex()) for r in spark.read.parquet(str(tmp_path / "meta")).collect()}
    assert back == {1: (wkb.POINT, [[(4.0, 52.0)]]), 2: None}
    writers.report(o.select("detection_id", "object_class"), str(tmp_path / "report"), by=("object_class",))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 3


def test_texts(spark):
    a = text.address(F.lit("Lange Kade 12B, 1017 AB Amsterdam"))
    r = one(spark, **a, none=text.address(F.lit("geen adres"))["street"], base=text.basename(F.lit("a/b/c_0042.jpg?x=1")), fix=text.repaired(F.lit("52.37.21")), n=text.source_and_number(F.lit("run_7_0042.jpg"))[1], line=text.label_line(F.lit(2), F.lit(0.5)))
    assert tuple(r) == ("Lange Kade", 12, "B", "1017AB", None, "c_0042.jpg", 52.3721, 42, "2 0.500000")
    forms = {"Damrak 1 1012LG": ("Damrak", 1, "", "1012LG"), "Dam 12 A 1012 lg Amsterdam": ("Dam", 12, "A", "1012LG"), "1e Weg 3 2-hs 1012   Ab": ("1e Weg", 3, "2-hs", "1012AB"), "Dam 1012": (None,) * 4, "Dam 1, 1012 LGX": (None,) * 4, "Plein 1945 de 5, 1017 AB": ("Plein 1945 de", 5, "", "1017AB"), " Kade 7 - 1 ,  1017AB 2000 BB": ("Kade 7 -", 1, "", "1017AB"), "Weg 40 45 12, 1017ab": ("Weg 40", 45, "12", "1017AB"), "Weg 19 2, 1017 AB": ("Weg", 19, "2", "1017AB"), "12 1017 AB": (None,) * 4, "": (None,) * 4}
    df = spark.createDataFrame([(k,) for k in forms], "a string")
    assert {x.a: tuple(x)[1:] for x in df.select("a", *[c.alias(k) for k, c in text.address(F.col("a")).items()]).collect()} == forms
    many = one(spark, a=text.repaired(F.lit("4." + "9" * 80 + ".5")), b=text.repaired(F.lit("x.y")), c=text.repaired(F.lit("7")), d=text.day_folder(F.to_date(F.lit("2024-03-01"))))
    assert (round(many.a, 6), many.b, many.c, many.d) == (5.0, None, 7.0, "2024-03-01")


def test_boxes(spark):
    b = tuple(F.lit(float(v)) for v in (0, 0, 10, 10))
    c = tuple(F.lit(float(v)) for v in (5, 5, 15, 15))
    r = one(spark, i=boxes.iou(b, c), none=boxes.iou(b, tuple(F.lit(float(v)) for v in (10, 0, 12, 9))), x=boxes.pixels_from_centre(F.lit(0.1), F.lit(0.5), F.lit(0.4), F.lit(0.5), F.lit(99), F.lit(100))[0], w=boxes.fit_within(F.lit(4000), F.lit(2000), 1000, 1000)[1])
    assert abs(r.i - 25 / 175) < 1e-12 and r.none == 0.0 and r.x == -9 and r.w == 500


def _images(spark, seed=1, n=12):
    r = random.Random(seed)
    box = lambda: (x := r.randrange(-5, 40), y := r.randrange(-5, 30), x + r.randrange(1, 20), y + r.randrange(1, 20))
    gt = [(k, k // 4, 2 + k % 2, *map(float, box())) for k in range(1, n * 4)]
    pred = [(k, k // 4, 2 + k % 2, r.randrange(10) / 10, *map(float, box())) for k in range(n * 4)]
    cols = "x0 double, y0 double, x1 double, y1 double"
    return spark.createDataFrame(gt, f"gt_id long, image_id long, object_class int, {cols}"), spark.createDataFrame(pred, f"pred_id long, image_id long, object_class int, score double, {cols}"), gt, pred


def test_pixels_equal_masks(spark):
    g, p, gt, pred = _images(spark)
    got = {r.object_class: (r.tp, r.fp, r.fn, r.tn) for r in evaluation.pixel_stats(g, p, 40, 30).collect()}
    want = {}
    for k in (2, 3):
        sums = np.zeros(4, int)
        for image in {r[1] for r in gt}:
            m = np.zeros((2, 30, 40), bool)
            for at, data, skip in ((0, gt, 3), (1, pred, 4)):
                for r in data:
                    if r[1] == image and r[2] == k:
                        x0, y0, x1, y1 = (int(v) for v in r[skip:])
                        m[at, max(y0, 0) : max(y1, 0), max(x0, 0) : max(x1, 0)] = True
            a, b = m
            sums += [(a & b).sum(), (b & ~a).sum(), (a & ~b).sum(), (~a & ~b).sum()]
        want[k] = tuple(int(v) for v in sums)
    assert got == want


def plain_coco(gt, pred, areas, most):
    """A COCO evaluation in plain Python: {(class, area, iou): (n, ap, recalls)}."""
    def overlap(p, g):
        w, h = min(p[2], g[2]) - max(p[0], g[0]), min(p[3], g[3]) - max(p[1], g[1])
        both = max(w, 0) * max(h, 0)
        union = (p[2] - p[0]) * (p[3] - p[1]) + (g[2] - g[0]) * (g[3] - g[1]) - both
        return both / union if union > 0 else 0.0

    size = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    out = {}
    for kind in {r[2] for r in gt}:
        for name, r in areas.items():
            low, high = r[kind] if isinstance(r, dict) else r
            for t in evaluation.IOUS:
                n, scored = 0, []
                for image in {r_[1] for r_ in [*gt, *pred]}:
                    g = sorted([x for x in gt if x[1:3] == (image, kind)], key=lambda x: (not low <= size(x[3:]) <= high, x[0]))
                    n += sum(low <= size(x[3:]) <= high for x in g)
                    used = set()
                    for place, p in enumerate(sorted([x for x in pred if x[1:3] == (image, kind)], key=lambda x: (-x[3], x[0]))[:most], 1):
                        best, hit = min(t, 1 - 1e-10), None
                        for k, x in enumerate(g):
                            outside = not low <= size(x[3:]) <= high
                            if k in used or (hit is not None and outside and low <= size(g[hit][3:]) <= high):
                                continue
                            if overlap(p[4:], x[3:]) >= best:
                                best, hit = overlap(p[4:], x[3:]), k
                        if hit is not None:
                            used.add(hit)
                        ignored = not low <= size(g[hit][3:] if hit is not None else p[4:]) <= high
                        if not ignored:
                            scored.append((-p[3], image, p[0], hit is not None, place))
                if not n:
                    continue
                tp, points = 0, []
                for k, x in enumerate(sorted(scored), 1):
                    tp += x[3]
                    points.append((tp / n, tp / k))
                ap = sum(max([q for r_, q in points if r_ >= k / 100], default=0.0) for k in range(101)) / 101
                out[kind, name, t] = (n, round(ap, 9), tuple(round(sum(x[3] and x[4] <= m for x in scored) / n, 9) for m in evaluation.MAX_DETECTIONS))
    return out


def test_average_precision_equals_a_plain_evaluator(spark):
    r = random.Random(12)
    gt, pred = [], []
    for image in range(200):
        for _ in range(r.randrange(0, 6)):
            x, y = r.randrange(60), r.randrange(40)
            b = (x, y, x + r.randrange(2, 30), y + r.randrange(2, 30))
            kind = r.choice([2, 3])
            gt.append((len(gt), image, kind, *map(float, b)))
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                pred.append((len(pred), image, r.choice([kind, kind, kind, 2]), r.randrange(8) / 8, *(float(v + r.randrange(-3, 4)) for v in b[:2]), *(float(v + r.randrange(-1, 5)) for v in b[2:])))
        for _ in range(r.choice([0, 0, 1, 12])):
            pred.append((len(pred), image, 3, r.randrange(8) / 8, 1.0, 1.0, 9.0, float(r.randrange(3, 50))))
    cols = "x0 double, y0 double, x1 double, y1 double"
    g, p = spark.createDataFrame(gt, f"gt_id long, image_id long, object_class int, {cols}"), spark.createDataFrame(pred, f"pred_id long, image_id long, object_class int, score double, {cols}")
    areas = {"all": (0.0, 1e10), "small": {2: (0.0, 150.0), 3: (0.0, 90.0)}, "large": {2: (150.0, 1e10), 3: (90.0, 1e10)}}
    table = evaluation.average_precision(evaluation.coco_match(g, p, areas=areas), g, areas)
    got = {(x.object_class, x.area, x.iou): (x.n_gt, round(x.ap, 9), tuple(round(x[f"recall_{m}"], 9) for m in evaluation.MAX_DETECTIONS)) for x in table.collect()}
    want = plain_coco(gt, pred, areas, 500)
    assert got == want and len({v[1] for v in want.values()}) > 20
    summary = {x.metric: x.value for x in evaluation.coco_summary(table).collect()}
    mean = lambda f, k: round(sum(v[k] if k == 1 else v[2][-1] for key, v in want.items() if f(key)) / sum(map(f, want)), 3)
    assert len(summary) == 12 and summary["AP_50_medium"] == -1
    assert abs(summary["AP"] - mean(lambda k: k[1] == "all", 1)) < 2e-3 and abs(summary["AR_75"] - mean(lambda k: k[1:] == ("all", 0.75), 2)) < 2e-3
    assert abs(summary["AP_50_small"] - mean(lambda k: k[1:] == ("small", 0.5), 1)) < 2e-3


def test_average_precision_of_perfect_and_absent_predictions(spark):
    g, p, gt, _ = _images(spark, 2)
    same = spark.createDataFrame([(r[0], r[1], r[2], 0.9, *r[3:]) for r in gt], p.schema)
    ap = evaluation.average_precision(evaluation.coco_match(g, same), g)
    assert {(round(r.ap, 9), r.recall_500) for r in ap.collect()} == {(1.0, 1.0)}
    away = same.withColumns({c: F.col(c) + 1000 for c in ("x0", "y0", "x1", "y1")})
    for none in (away, same.limit(0)):
        assert {(r.ap, r.recall_500) for r in evaluation.average_precision(evaluation.coco_match(g, none), g).collect()} == {(0.0, 0.0)}


def test_greedy_match_takes_each_truth_once(spark):
    g = spark.createDataFrame([(1, 1, 2, 0.0, 0.0, 10.0, 10.0)], "gt_id long, image_id long, object_class int, x0 double, y0 double, x1 double, y1 double")
    p = spark.createDataFrame([(7, 1, 2, 0.5, 0.0, 0.0, 10.0, 10.0), (8, 1, 2, 0.9, 0.0, 0.0, 10.0, 9.0)], "pred_id long, image_id long, object_class int, score double, x0 double, y0 double, x1 double, y1 double")
    m = evaluation.coco_match(g, p, ious=(0.5,))
    assert rows(m.where(F.col("gt_ids")[0].isNotNull()), "pred_id", "place") == [(8, 1)]
    assert rows(evaluation.greedy_overlap(g, p), "pred_id", "gt_id") == [(7, 1)]


def test_greedy_overlap_equals_brute_force(spark):
    g, p, gt, pred = _images(spark, 5, 20)
    used, want = set(), set()
    for q in sorted(pred):
        for t in sorted(gt):
            if t[0] not in used and t[1:3] == q[1:3] and min(q[6], t[5]) > max(q[4], t[3]) and min(q[7], t[6]) > max(q[5], t[4]):
                used.add(t[0])
                want.add((q[0], t[0]))
                break
    assert set(rows(evaluation.greedy_overlap(g, p), "pred_id", "gt_id")) == want and len(want) > 5


def test_f_beta_and_sizes(spark):
    r = one(spark, a=evaluation.f_beta(F.lit(0.5), F.lit(1.0)), b=evaluation.f_beta(F.lit(0.5), F.lit(1.0), 2.0), c=evaluation.f_beta(F.lit(0.0), F.lit(0.0)))
    assert tuple(r) == (0.667, 0.833, None)
    assert evaluation.sizes_of(100.0)["medium"][4] == (1.0298, 12.5452) or abs(evaluation.sizes_of(100.0)["medium"][4][1] - 12.5452) < 1e-9


def test_samples(spark):
    d = spark.range(200).withColumn("w", F.when(F.col("id") < 50, 0.0).otherwise(1.0))
    assert sampling.weighted_sample(d, 20, "w", "id").where("id < 50").count() == 0
    assert sampling.weighted_sample(d, 500, "w", "id").count() == 150
    again = [r.id for r in sampling.weighted_sample(d.repartition(7), 20, "w", "id").collect()]
    assert sorted(again) == sorted(r.id for r in sampling.weighted_sample(d, 20, "w", "id").collect())
    assert sampling.one_of_each(d.withColumn("g", F.col("id") % 7), ["g"], "id").count() == 7


def test_differences(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(sampling.differences(a, b), "x", "side") == [(2, "only_a"), (3, "only_b")]
    assert rows(sampling.differences(a, b, all_rows=True), "x", "side") == [(1, "only_a"), (2, "only_a"), (3, "only_b")]


def test_feedback_and_best_images(spark):
    n = spark.createDataFrame([("a", "Pending"), ("b", "Pending"), ("c", "Processed"), ("d", "Pending")], "signal_id string, status string")
    st = spark.createDataFrame([("a", "Gemeld", "t", "u", None), ("b", "Afgehandeld", "t", "u", None), ("c", "Afgehandeld", "t", "u", None)], "signal_id string, state string, text string, user string, update_time timestamp")
    moved, stay = ops.feedback(n, st)
    assert rows(moved, "signal_id", "status") == [("b", "Afgehandeld")] and rows(stay, "signal_id") == [("a",), ("d",)]
    o = spark.createDataFrame([(1, 2, "x"), (1, 2, "y"), (2, 3, "q"), (2, 3, "p")], "object_id int, object_class int, image_name string")
    d = spark.createDataFrame([("x", 2, 0.1), ("y", 2, 0.5), ("p", 2, 0.9)], "image_name string, object_class int, area double")
    assert rows(ops.best_images(o, d), "object_id", "image_name") == [(1, "y"), (2, "p")]


def test_ticket_texts(spark):
    import json

    from kerbsight.functions import tickets

    day = F.to_date(F.lit("2024-01-02"))
    near = tickets.ticket_text(F.lit(2), day, F.lit("P-1"), F.lit(41.6))
    r = one(spark, a=near, b=tickets.ticket_text(F.lit(9), day, F.lit(None).cast("string"), F.lit(None).cast("double")), p=tickets.payload(near, F.lit(52.0), F.lit(4.0), day))
    assert r.a == "A container was seen on 2024-01-02. The nearest permit is P-1, at 42 m." and r.b == "A object was seen on 2024-01-02. There is no permit nearby."
    assert "district" not in json.loads(r.p)["location"]


def test_notes_lists_and_times(spark):
    from kerbsight.functions import tickets

    r = one(
        spark, a=tickets.distance_note(F.lit(41.6), F.lit(None).cast("double")), b=tickets.triage_note(F.lit(3)), c=tickets.inspection_note(F.lit(2)), d=text.share_a_class(F.lit("2; 3"), F.lit("3;4")), e=text.share_a_class(F.lit(""), F.lit("")),
        f=text.epoch_time(F.lit(1.5)).cast("double"), g=text.whole_seconds(F.lit("1970-01-01T00:00:09.75Z")).cast("long"), h=text.whole_seconds(F.lit("no")), i=text.share_a_class(F.lit("2"), F.lit(None).cast("string")),
    )
    assert r.a == "Distance to the nearest permit: 42 m" and "mobile toilet" in r.b and "container" in r.c
    assert one(spark, n=tickets.triage_note(F.lit(2), ("Is it a {}?", "Then go on."), "Steps")).n == "Steps:\n1. Is it a container?\n2. Then go on."
    assert (r.d, r.e, r.f, r.g, r.h, r.i) == (True, False, 1.5, 9, None, False)


def test_settings():
    import datetime

    import pytest

    from kerbsight.plans import settings

    s = settings.from_parameters(settings.from_map({"min_score": 0.5, "send_limits": {"2": 1}}), date="2024-03-01", districts="noord, WEST", send_limits="2:-1, 3:4", skip_ids="5")
    assert (s.min_score, s.districts, s.send_limits, s.skip_ids, s.cutoff) == (0.5, ("Noord", "West"), {2: -1, 3: 4}, (5,), datetime.date(2023, 3, 3))
    assert settings.from_parameters(s) == s
    for bad in ({"min_score": 2}, {"typo": 1}, {"confidence": {2: 7}}, {"send_limits": {9: 1}}):
        with pytest.raises(ValueError):
            settings.from_map(bad)


def test_boxes_across_cube_faces(spark):
    from kerbsight.functions import panorama

    b = spark.createDataFrame([(1, 310.0, 150.0, 330.0, 170.0), (2, 390.0, 150.0, 410.0, 170.0)], "id int, x0 double, y0 double, x1 double, y1 double")
    got = {(r.id, r.face): (r.x0, r.y0, r.x1, r.y1) for r in panorama.boxes_on_cube(b, "id", 640, 320, 101).collect()}
    assert set(got) == {(1, panorama.FRONT), (2, panorama.FRONT), (2, panorama.RIGHT)}
    x0, y0, x1, y1 = got[1, panorama.FRONT]
    assert 40 < x0 < 50 < x1 < 60 and 40 < y0 < 50 < y1 < 60
    assert got[2, panorama.FRONT][2] == 101 and got[2, panorama.RIGHT][0] == 0


def on_faces(x, y, width, height, face):
    """Faces and places on them of points of a panorama, one by one."""
    u, v = ((x + 0.5) / width - 0.5) * 2 * np.pi, -((y + 0.5) / height - 0.5) * np.pi
    p = np.stack([np.cos(v) * np.sin(u), np.sin(v), np.cos(v) * np.cos(u)])
    ax, ay, az = np.abs(p)
    upright, side = (ay > ax) & (ay > az), ax > az
    index = np.where(upright, np.where(p[1] > 0, 4, 5), np.where(side, np.where(p[0] > 0, 1, 3), np.where(p[2] > 0, 0, 2)))
    most = np.maximum(np.maximum(ax, ay), az)
    across, down = np.where(upright | ~side, p[0], p[2]), np.where(upright, -p[2], -p[1])
    at = lambda c: (c / most / 2 + 0.5) * (face - 1)
    return index, at(across), at(down)


def test_outlines_on_a_cube_equal_projected_pixels(spark):
    """Against thousands of points of each box: on a face, over edges and corners, around poles, over the whole width."""
    r = random.Random(17)
    w, h, face = 800, 400, 200
    boxes_ = [(x := r.uniform(0, w - 60), y := r.uniform(0, h - 40), x + r.choice([5, 60, r.uniform(1, w - 1 - x)]), y + r.choice([5, 40, r.uniform(1, h - 1 - y)])) for _ in range(60)]
    boxes_ = [(a, b, min(c, w - 1), min(d, h - 1)) for a, b, c, d in boxes_] + [(0, 0, w - 1, h - 1), (0, 0, w - 1, 20), (380, 0, 420, h - 1), (290, 90, 310, 110), (0, 150, 30, 250), (770, 150, 799, 250), (5, 5, 5, 9)]
    df = spark.createDataFrame([(i, *map(float, b)) for i, b in enumerate(boxes_)], "id long, x0 double, y0 double, x1 double, y1 double")
    got = {(x.id, x.face): (x.x0, x.y0, x.x1, x.y1) for x in panorama.outlines_on_cube(df, "id", w, h, face).collect()}
    assert not any(i == len(boxes_) - 1 for i, _ in got)
    for i, (x0, y0, x1, y1) in enumerate(boxes_[:-1]):
        index, a, b = on_faces(*(g.ravel() for g in np.meshgrid(np.linspace(x0, x1, 700), np.linspace(y0, y1, 700))), w, h, face)
        for f in range(6):
            own = index == f
            if own.any():
                want = (a[own].min(), b[own].min(), a[own].max(), b[own].max())
                assert (i, f) in got and all(abs(p - q) <= 2.6 for p, q in zip(got[i, f], want, strict=True)), (boxes_[i], f, got.get((i, f)), want)
            elif (i, f) in got:
                g = got[i, f]
                assert min(g[2] - g[0], g[3] - g[1]) <= 2, (boxes_[i], f, g)
