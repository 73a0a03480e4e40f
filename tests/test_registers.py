"""Shapes with holes, the paged service, features of files, refused documents and the state of sources."""

import json
import math
import random
import threading
import urllib.parse
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbsight.functions import shapes, wkb
from kerbsight.operators import spatial
from kerbsight.sources import readers, rest
from kerbsight.sources.schemas import DETECTIONS, FRAMES
from kerbsight.streaming import rejects, sources_state
from test_sources import document, put

RING = "array<struct<x: double, y: double>>"

# --- shapes ---


def star(r, cx, cy, size, n):
    turns = sorted(r.random() for _ in range(n))
    return [(cx + size * r.uniform(0.4, 1) * math.cos(2 * math.pi * t), cy + size * r.uniform(0.4, 1) * math.sin(2 * math.pi * t)) for t in turns]


def holds(x, y, rings):
    inside = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                inside = not inside
    return inside


def to_segment(x, y, a, b):
    (ax, ay), (bx, by) = a, b
    length = (bx - ax) ** 2 + (by - ay) ** 2
    t = min(1, max(0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / length)) if length else 0
    return math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))


def away(x, y, rings):
    return 0 if holds(x, y, rings) else min(to_segment(x, y, a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True))


def some_shapes(seed, n=25):
    r, out = random.Random(seed), {}
    for k in range(n):
        cx, cy = r.uniform(0, 1000), r.uniform(0, 1000)
        rings = [star(r, cx, cy, 90, 9)]
        if k % 2:
            rings.append(star(r, cx, cy, 25, 5))
        if k % 4 == 1:
            rings += [star(r, cx, cy, 8, 4), star(r, cx + 300, cy, 40, 6)]
        out[k] = rings
    return out


def shape_frame(spark, found):
    rows = [(k, [[{"x": x, "y": y} for x, y in ring] for ring in rings] if rings else None) for k, rings in found.items()]
    return spark.createDataFrame(rows, f"area_id long, rings array<{RING}>")


def some_points(spark, seed, n=300):
    r = random.Random(seed)
    at = {k: (r.uniform(-50, 1350), r.uniform(-50, 1050)) for k in range(n)}
    return at, spark.createDataFrame([(k, *v) for k, v in at.items()], "id long, x double, y double")


@pytest.mark.parametrize("seed", range(2))
def test_holes_and_parts_equal_a_plain_version(spark, seed):
    found = some_shapes(seed) | {99: None}
    at, points = some_points(spark, seed)
    areas = shape_frame(spark, found)
    got = {r.id: r.area_id for r in spatial.containing(points, areas, "id", "area_id", ring="rings", size=100.0, keep_unmatched=True).collect()}
    want = {k: min((a for a, rings in found.items() if rings and holds(*v, rings)), default=None) for k, v in at.items()}
    assert got == want and len(set(want.values())) > 5
    for radius in (0.0, 10.0, 120.0):
        apart = {r.id: r.apart for r in spatial.apart_from(points, areas, "id", radius, ring="rings").collect()}
        assert apart == {k: min(away(*v, rings) for rings in found.values() if rings) > radius for k, v in at.items()}


def test_nearest_feature_equals_a_plain_version(spark):
    found = {f"A{k}": v for k, v in some_shapes(7, 9).items()}
    lines = {"L1": [[(0.0, 0.0), (300.0, 900.0), (310.0, 900.0)]], "L2": [[(900.0, 100.0), (901.0, 100.0)], [(0.0, 1000.0), (50.0, 1000.0)]], "L0": [[(5.0, 5.0)]]}
    at, points = some_points(spark, 7, 150)
    vertices = lambda parts: [[{"x": x, "y": y} for x, y in part] for part in parts]
    rows = [(k, vertices(v), vertices([r + r[:1] for r in v])) for k, v in found.items()] + [(k, None, vertices(v)) for k, v in lines.items()] + [("N", None, None)]
    features = spark.createDataFrame(rows, f"feature_id string, rings array<{RING}>, lines array<{RING}>")
    got = {r.id: r for r in spatial.nearest_feature(points, features, "id", "feature_id", size=40.0).collect()}
    assert len(got) == len(at)
    for k, (x, y) in at.items():
        d = {f: away(x, y, v) for f, v in found.items()} | {f: min(to_segment(x, y, a, b) for part in v for a, b in zip(part, part[1:], strict=False)) for f, v in lines.items() if f != "L0"}
        best = min(d, key=lambda f: (d[f], f))
        assert got[k].feature_id == best and math.isclose(got[k].distance, d[best], abs_tol=1e-6)
        assert math.isclose(math.hypot(got[k].near_x - x, got[k].near_y - y), d[best], abs_tol=1e-6)


def test_shapes_from_wkb_and_back(spark):
    found = some_shapes(3, 6)
    text = shape_frame(spark, found).select("area_id", wkb.polygon_hex("rings").alias("geometry"), F.lit(False).alias("encumbered"))
    point = "0101000000" + "00" * 16
    odd = spark.createDataFrame([(50, point, False), (51, "zz", False), (52, None, False), (53, "", None)], "area_id long, geometry string, encumbered boolean")
    hidden = text.limit(1).select("area_id", "geometry", F.lit(True).alias("encumbered")).unionByName(text.limit(1).select("area_id", "geometry", F.lit(None).cast("boolean").alias("encumbered")))
    got = readers.public_ground(text.unionByName(odd).unionByName(hidden)).collect()
    assert sorted([[(v.x, v.y) for v in ring] for ring in r.rings] for r in got) == sorted(found.values())
    multi = "0106000000020000000103000000010000000400000000000000000000000000000000000000000000000000104000000000000000000000000000001040000000000000104000000000000000000000000000000000"
    polygon = wkb.parse(multi)
    assert polygon is None  # cut off: it announces two polygons and has one
    whole = multi.replace("000200000001030000", "000100000001030000", 1)
    (r,) = spark.createDataFrame([(whole,)], "g string").select(wkb.rings_of("g").alias("rings")).collect()
    assert [(v.x, v.y) for v in r.rings[0]] == [(0, 0), (4, 0), (4, 4)]


def test_geojson_with_systems_holes_and_parts(spark, tmp_path):
    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    geometries = {
        "hole": ("Polygon", [square(0, 0, 10), square(4, 4, 2)]), "parts": ("MultiPolygon", [[square(0, 0, 1)], [square(5, 5, 1), square(5.2, 5.2, 0.1)]]), "line": ("LineString", [[0, 0], [3, 4]]),
        "lines": ("MultiLineString", [[[0, 0], [1, 1]], [[2, 2], [3, 3], [4, 4]]]), "point": ("Point", [1, 2]), "thin": ("Polygon", [[[0, 0], [1, 1]]]), "text": ("Polygon", "none"), "gap": ("Polygon", [[[0, 0], [1], [2, 2]]]),
    }
    collection = lambda crs: {"type": "FeatureCollection", "features": [{"geometry": {"type": t, "coordinates": c}, "properties": {"objectnummer": k}} for k, (t, c) in geometries.items()]} | ({"crs": {"type": "name", "properties": {"name": crs}}} if crs else {})
    (tmp_path / "grid.json").write_text(json.dumps(collection("urn:ogc:def:crs:EPSG::28992")))
    got = {r.feature_id: r for r in readers.features(readers.geojson(spark, str(tmp_path / "grid.json"))).collect()}
    assert {k: r.rings and len(r.rings) for k, r in got.items()} == {"hole": 2, "parts": 3, "line": None, "lines": None, "point": None, "thin": None, "text": None, "gap": None}
    assert {k: r.lines and [len(x) for x in r.lines] for k, r in got.items() if k in ("line", "lines", "point", "parts")} == {"line": [2], "lines": [2, 3], "point": None, "parts": [6, 6, 6]}
    area = readers.features(readers.geojson(spark, str(tmp_path / "grid.json"))).where("feature_id = 'hole'").select(shapes.area(F.col("rings")).alias("a")).first().a
    assert area in (96.0, 104.0)
    for crs in (None, "urn:ogc:def:crs:OGC:1.3:CRS84", "EPSG:4326"):
        geometries = {"here": ("Polygon", [[[4.9, 52.37], [4.91, 52.37], [4.91, 52.38]]])}
        (tmp_path / "world.json").write_text(json.dumps(collection(crs)))
        (r,) = readers.features(readers.geojson(spark, str(tmp_path / "world.json"))).collect()
        assert abs(r.rings[0][0].x - 121800) < 300 and abs(r.rings[0][0].y - 486700) < 800, r.rings
    (tmp_path / "other.json").write_text(json.dumps(collection("EPSG:3857")))
    assert readers.features(readers.geojson(spark, str(tmp_path / "other.json"))).first().rings is None


# --- the paged service ---

ITEMS = [{"code": f"D{k:02d}", "naam": f"district {k}", "extra": k * 0.5, "n": k, "on": k % 2 == 0, "deep": {"x": str(k)}, "geometrie": None if k == 7 else {"type": "Polygon", "coordinates": [[[120000 + 100 * k, 480000], [120100 + 100 * k, 480000], [120100 + 100 * k, 480100], [120000 + 100 * k, 480100]]]}} for k in range(23)]


class Service(BaseHTTPRequestHandler):
    """Pages of ITEMS; ``/total`` tells how many, ``/links`` gives the next address, others fail in their own ways."""

    calls: list = []
    failures = 0

    def do_GET(self):  # noqa: N802
        parts = urllib.parse.urlsplit(self.path)
        q = dict(urllib.parse.parse_qsl(parts.query))
        page, size = int(q.get("page", 1)), int(q.get("_pageSize", 20))
        type(self).calls.append((parts.path, page))
        if parts.path == "/flaky" and type(self).failures:
            type(self).failures -= 1
            self.send_response(503)
            self.end_headers()
            return
        if parts.path == "/gone":
            self.send_response(404)
            self.end_headers()
            return
        own = ITEMS[(page - 1) * size : page * size]
        body = {"_embedded": {"stadsdelen": own}}
        if parts.path in ("/total", "/flaky"):
            body["page"] = {"number": page, "totalPages": -(-len(ITEMS) // size)}
        elif parts.path == "/links" and page * size < len(ITEMS):
            body["_links"] = {"next": {"href": f"/links?page={page + 1}&_pageSize={size}"}}
        elif parts.path == "/other":
            body = {"message": "no"}
        elif parts.path == "/list":
            body = own
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def service():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def paged(spark, url, schema="code string", **options):
    spark.dataSource.register(rest.PagedJson)
    return spark.read.format("paged_json").options(url=url, **({"items": "_embedded.stadsdelen", "wait": "0"} | options)).schema(schema).load()


@pytest.mark.parametrize(("path", "size", "partitions"), [("/total", 5, 3), ("/total", 5, 50), ("/total", 100, 4), ("/links", 4, 3), ("/links", 100, 3)])
def test_all_pages_are_read_once(spark, service, path, size, partitions):
    Service.calls.clear()
    df = paged(spark, service + path, pageSize=str(size), partitions=str(partitions))
    assert sorted(r.code for r in df.collect()) == [x["code"] for x in ITEMS]
    pages = -(-len(ITEMS) // size)
    calls = [p for _, p in Service.calls]
    assert sorted(set(calls)) == list(range(1, pages + 1)) and all(calls.count(p) == 1 for p in range(2, pages + 1))
    assert df.rdd.getNumPartitions() == (min(partitions, pages) if path == "/total" else 1)


def test_types_failures_and_other_answers(spark, service):
    row = paged(spark, f"{service}/total", "code string, extra double, n long, on boolean, `deep.x` string, deep string, lost string, naam long").where("code = 'D03'").first()
    assert tuple(row) == ("D03", 1.5, 3, False, "3", '{"x":"3"}', None, None)
    Service.failures = 2
    assert paged(spark, f"{service}/flaky", retries="2").count() == 23
    assert paged(spark, f"{service}/list", items="", pageSize="100").count() == 23
    for path, word in (("/gone", "404"), ("/other", "no list")):
        with pytest.raises(Exception, match=word):
            paged(spark, service + path, retries="0").count()
    with pytest.raises(Exception, match="needs a schema"):
        spark.read.format("paged_json").options(url=service).load()
    with pytest.raises(ValueError, match="url"):
        rest.Options({"items": "x"})


def test_districts_of_the_service(spark, service):
    d = readers.district_service(spark, f"{service}/total", pageSize="6", wait="0")
    assert d.count() == 22 and "D07" not in {r.district_code for r in d.collect()}
    points = spark.createDataFrame([(1, 120350.0, 480050.0), (2, 120750.0, 480050.0), (3, 0.0, 0.0)], "id long, x double, y double")
    found = spatial.containing(points, d, "id", "district_code", ring="rings", size=500.0, keep_unmatched=True)
    assert {r.id: r.district_code for r in found.collect()} == {1: "D03", 2: None, 3: None}


# --- refused documents ---


def drop(spark, tables):
    for t in (tables.frames, tables.detections, tables.rejects):
        spark.sql(f"drop table if exists {t}")


def landing(folder):
    folder.mkdir()
    put(folder, "a", document("a.jpg", 3))
    put(folder, "b", document("b.jpg", 0))
    put(folder, "cut", '{"image_file_name": "d.jp')
    put(folder, "empty_name", document(" "))
    put(folder, "again", document("b.jpg", 1))
    put(folder, "no_time", document("t.jpg", image_file_timestamp="no time"))
    put(folder, "types", document("y.jpg", gps_data="here"))
    put(folder, "far", document("f.jpg", gps_data={"latitude": 99.0, "longitude": 0.0, "coordinate_time_stamp": None}))
    faulty = document("x.jpg", 4)
    faulty["detections"][0]["object_class"] = None
    faulty["detections"][1]["boundingBox"]["width"] = 7
    faulty["detections"][2]["boundingBox"] = None
    put(folder, "faulty", faulty)


def held(spark, tables):
    frames = sorted(r.image_name for r in spark.table(tables.frames).collect())
    found = sorted((r.image_name, r.object_class) for r in spark.table(tables.detections).collect())
    refused = sorted((r.path.rsplit("/", 1)[-1], -1 if r["at"] is None else r["at"], r.reason) for r in spark.table(tables.rejects).collect())
    return frames, found, refused


WANT = (
    ["a.jpg", "b.jpg", "x.jpg"],
    [("a.jpg", 2), ("a.jpg", 3), ("a.jpg", 4), ("b.jpg", 2), ("x.jpg", 5)],
    [("b.json", -1, "image name repeats"), ("cut.json", -1, "not JSON of the expected types"), ("empty_name.json", -1, "no image name"), ("far.json", -1, "position outside the earth"), ("faulty.json", 0, "no class"),
     ("faulty.json", 1, "no box within the image"), ("faulty.json", 2, "no box within the image"), ("no_time.json", -1, "image time can't be read"), ("types.json", -1, "not JSON of the expected types")],
)


def test_every_document_is_a_frame_or_a_reject(spark, tmp_path):
    tables = rejects.Tables("r1_frames", "r1_detections", "r1_rejects")
    landing(tmp_path / "in")
    run = lambda: rejects.ingest_with_rejects(spark, str(tmp_path / "in"), tables, str(tmp_path / "checkpoint"))
    assert run() == {"frames": 3, "detections": 5, "rejects": 9}
    assert held(spark, tables) == WANT
    assert spark.table(tables.frames).drop("batch").schema.names == FRAMES.names and spark.table(tables.detections).drop("batch").schema.names == DETECTIONS.names
    joined = spark.table(tables.detections).join(spark.table(tables.frames).select("frame_id"), "frame_id")
    assert joined.count() == 5
    assert run() == {"frames": 0, "detections": 0, "rejects": 0} and held(spark, tables) == WANT
    put(tmp_path / "in", "z", document("z.jpg", 1))
    assert run() == {"frames": 1, "detections": 1, "rejects": 0}
    assert spark.table(tables.frames).count() == 4 and spark.table(tables.detections).count() == 6 and spark.table(tables.rejects).count() == 9
    drop(spark, tables)


@pytest.mark.parametrize("broken_at", [1, 2, 3])
def test_a_batch_that_fails_midway_and_is_repeated(spark, tmp_path, monkeypatch, broken_at):
    """The write number ``broken_at`` of the first batch fails after it has written."""
    tables = rejects.Tables("r2_frames", "r2_detections", "r2_rejects")
    landing(tmp_path / "in")
    real, calls = rejects.put, []

    def failing(*args):
        real(*args)
        calls.append(args[1])
        if len(calls) == broken_at:
            raise RuntimeError("lost")

    monkeypatch.setattr(rejects, "put", failing)
    run = lambda: rejects.ingest_with_rejects(spark, str(tmp_path / "in"), tables, str(tmp_path / "checkpoint"))
    with pytest.raises(Exception, match="lost"):
        run()
    assert spark.table(tables.frames).count() == 3
    run()
    assert held(spark, tables) == WANT
    drop(spark, tables)


def test_batches_of_few_files(spark, tmp_path):
    tables = rejects.Tables("r3_frames", "r3_detections", "r3_rejects")
    landing(tmp_path / "in")
    (tmp_path / "in" / "again.json").unlink()
    rejects.ingest_with_rejects(spark, str(tmp_path / "in"), tables, str(tmp_path / "checkpoint"), max_files=2)
    frames, _, refused = held(spark, tables)
    assert frames == WANT[0] and len(refused) == 8 and spark.table(tables.frames).select("batch").distinct().count() > 1
    drop(spark, tables)


# --- state of sources ---

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Handle:
    """What a processor asks of Spark, in memory."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, *_):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):  # noqa: N802
        return iter(list(self.timers))

    def deleteTimer(self, t):  # noqa: N802
        self.timers.remove(t)

    def registerTimer(self, t):  # noqa: N802
        self.timers.append(t)

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return 1000


def images(*rows):
    at = lambda m: None if m is None else datetime(2024, 1, 1) + timedelta(minutes=m)
    return pd.DataFrame([(at(m), lat, lon) for m, lat, lon in rows], columns=["image_timestamp", "gps_lat", "gps_lon"])


def test_late_images_are_counted_and_move_nothing():
    h = Handle()
    p = sources_state.SourceStatus(timedelta(minutes=60), timedelta(minutes=5))
    p.init(h)
    feed = lambda *rows: next(iter(p.handleInputRows(("cam",), iter([images(*rows)]), h))).iloc[0]
    r = feed((100, 52.1, 4.1), (90, 52.0, 4.0), (None, 1.0, 1.0))
    assert (r.n, r.n_late, r.n_unplaced, r.gps_lat, r.status) == (2, 1, 0, 52.1, "active")
    r = feed((39, 51.0, 4.0), (41, 51.5, 4.0))  # one beyond the hour, one within it but older than the last
    assert (r.n, r.n_late, r.gps_lat, r.last_time) == (3, 2, 52.1, datetime(2024, 1, 1, 1, 40))
    r = feed((200, None, 4.0), (150, 52.5, 4.5))
    assert (r.n, r.n_unplaced, r.gps_lat, r.last_time) == (5, 1, 52.5, datetime(2024, 1, 1, 3, 20))
    assert h.timers == [1000 + 5 * 60_000]
    assert next(iter(p.handleExpiredTimer(("cam",), h, None))).iloc[0].status == "silent"


def test_state_over_batches_of_a_stream(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        folder, seen = tmp_path / "in", []
        folder.mkdir()
        stream = spark.readStream.schema("customer string, image_timestamp timestamp, gps_lat double, gps_lon double").json(str(folder))

        def run():
            q = sources_state.source_status(stream).writeStream.outputMode("update").foreachBatch(lambda df, k: seen.extend(df.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            assert q.awaitTermination(120)

        lines = lambda name, *rows: (folder / name).write_text("\n".join(json.dumps({"customer": c, "image_timestamp": f"2024-01-01T{t}:00Z", "gps_lat": 52.0, "gps_lon": lon}) for c, t, lon in rows))
        lines("1.json", ("a", "10:00", 4.0), ("a", "10:30", 4.5), ("b", "08:00", 4.8))
        run()
        lines("2.json", ("a", "09:00", 4.1), ("a", "10:20", 4.2), (None, "10:00", 4.9))
        run()
        last = {}
        for r in seen:
            last[r["source"]] = (r["n"], r["n_late"], r["gps_lon"], r["last_time"].hour)
        assert last == {"a": (3, 1, 4.5, 10), "b": (1, 0, 4.8, 8), "": (1, 0, 4.9, 10)}
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
