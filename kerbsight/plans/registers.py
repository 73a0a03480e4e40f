"""Registered queries over public registers and refused documents: shapes with holes, district pages, features, rejects."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.functions import geo, wkb
from kerbsight.operators import detections as ops
from kerbsight.operators import evaluation, sampling, spatial
from kerbsight.operators.scratch import scratch_dir
from kerbsight.operators.status_log import StatusLog
from kerbsight.plans import steps, views
from kerbsight.plans.catalogue import CHAIN, DAY, RUN, SIZES, _runs, hav, placed, query, r3
from kerbsight.plans.more import _poly
from kerbsight.plans.reports import SIZED, split_report
from kerbsight.sources import readers, writers
from kerbsight.sources.outbox import NotSent, deliver_once
from kerbsight.sources.schemas import LANDING
from kerbsight.streaming import rejects


def _box(x: str, y: str, w: float, h: float) -> F.Column:
    at = lambda dx, dy: F.struct((F.col(x) + dx).alias("x"), (F.col(y) + dy).alias("y"))
    return F.array(at(0.0, 0.0), at(w, 0.0), at(w, h), at(0.0, h))


def ground_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground as a database has it: WKB text, some of it broken, and a flag, some of it null."""
    p = views.table(spark, sf_dir, "part").where("p_partkey % 4 = 0").selectExpr(
        "p_partkey", "120000D + p_partkey * 3571 % 9973 as x0", "480000D + p_partkey * 611 % 9949 as y0",
        "case when p_partkey % 12 = 0 then null else p_partkey % 16 = 0 end as encumbered",
    )
    p = p.withColumns({"x1": F.col("x0") + 20, "y1": F.col("y0") + 15, "x2": F.col("x0") + 80})
    rings = F.array(_box("x0", "y0", 60.0, 40.0), _box("x1", "y1", 20.0, 12.0), _box("x2", "y0", 10.0, 10.0))
    return p.select("encumbered", F.when(F.col("p_partkey") % 20 == 0, "0103zz").otherwise(wkb.polygon_hex(rings)).alias("geometry"))


_APART = "sqrt(pow(greatest({x} - x, 0, x - {x} - {w}), 2) + pow(greatest({y} - y, 0, y - {y} - {h}), 2))"


@query(f"""select frame_id, not exists (select 1 from ground g where least(case when x > x0 + 20 and x < x0 + 40 and y > y0 + 15 and y < y0 + 27
    then least(x - x0 - 20, x0 + 40 - x, y - y0 - 15, y0 + 27 - y) else {_APART.format(x="x0", y="y0", w=60, h=40)} end, {_APART.format(x="(x0 + 80)", y="y0", w=10, h=10)}) <= 3) as private from points""",
    views.GRID, "ground as (select 120000::double + p_partkey * 3571 % 9973 as x0, 480000::double + p_partkey * 611 % 9949 as y0 from part where p_partkey % 4 = 0 and p_partkey % 12 <> 0 and p_partkey % 16 <> 0 and p_partkey % 20 <> 0)")
def public_ground(spark, sf_dir):
    """Points more than 3 metres from public ground with holes and parts, read from WKB text behind its filter."""
    ground = readers.public_ground(ground_rows(spark, sf_dir))
    return spatial.apart_from(views.grid_points(spark, sf_dir), ground, "frame_id", 3.0, ring="rings").select("frame_id", F.col("apart").alias("private"))


def district_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of ten districts, as a service would send them; the last district has no geometry."""
    n = views.table(spark, sf_dir, "nation").selectExpr("n_nationkey as k", "n_name", "120000D + (n_nationkey % 5) * 2000 as x0", "480000D + (n_nationkey div 5) * 2000 as y0")
    n = n.withColumns({"x1": F.col("x0") + 700, "y1": F.col("y0") + 900})
    plain = lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"]))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(plain(_box("x0", "y0", 2000.0, 2000.0)), plain(_box("x1", "y1", 600.0, 500.0))).alias("coordinates"))
    item = F.struct(F.concat(F.lit("D"), "k").alias("code"), F.col("n_name").alias("naam"), F.when(F.col("k") != 24, shape).alias("geometrie"))
    embedded = F.struct(F.struct(F.array_sort(F.collect_list(item)).alias("stadsdelen")).alias("_embedded"))
    return n.groupBy(F.floor(F.col("k") / 10).alias("page")).agg(F.to_json(embedded).alias("document"))


@query("""select frame_id, 'D' || n_nationkey as district_code, n_name as district from points join nation on n_nationkey <> 24
  where x >= 120000 + (n_nationkey % 5) * 2000 and x < 120000 + (n_nationkey % 5) * 2000 + 2000 and y >= 480000 + (n_nationkey // 5) * 2000 and y < 480000 + (n_nationkey // 5) * 2000 + 2000
  and not (x >= 120700 + (n_nationkey % 5) * 2000 and x < 121300 + (n_nationkey % 5) * 2000 and y >= 480900 + (n_nationkey // 5) * 2000 and y < 481400 + (n_nationkey // 5) * 2000)""", views.GRID)  # fmt: skip
def district_service_lookup(spark, sf_dir):
    """Points with the district that holds them, from the pages of the district service."""
    kind = "_embedded struct<stadsdelen: array<struct<code: string, naam: string, geometrie: string>>>"
    items = district_pages(spark, sf_dir).select(F.explode(F.from_json("document", kind)["_embedded"]["stadsdelen"]).alias("i")).select("i.*")
    d = readers.districts(items)
    found = spatial.containing(views.grid_points(spark, sf_dir), d, "frame_id", "district_code", ring="rings", size=500.0)
    return found.join(d.select("district_code", "district"), "district_code").select("frame_id", "district_code", "district")


def bridge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridges and quays as rows of a GeoJSON file on the grid: lines of two segments, and rectangles."""
    b = views.table(spark, sf_dir, "supplier").selectExpr("s_suppkey as k", "120000D + s_suppkey * 611 % 9973 as x0", "480000D + s_suppkey * 3571 % 9949 as y0")
    at = lambda dx, dy: F.array(F.col("x0") + dx, F.col("y0") + dy)
    line, shape = F.array(at(0.0, 0.0), at(40.0, 10.0), at(60.0, -30.0)), F.array(F.array(at(0.0, 0.0), at(50.0, 0.0), at(50.0, 20.0), at(0.0, 20.0), at(0.0, 0.0)))
    area = F.col("k") % 3 == 0
    return b.select(F.format_string("B%05d", "k").alias("feature_id"), F.when(area, "Polygon").otherwise("LineString").alias("type"), F.when(area, F.to_json(shape)).otherwise(F.to_json(line)).alias("coordinates"), F.lit("urn:ogc:def:crs:EPSG::28992").alias("crs"))


@query("""select frame_id, arg_min(feature_id, struct_pack(d := d, i := feature_id)) as feature_id, round(min(d), 3) as distance from (
  select frame_id, feature_id, case when area and x >= x0 and x < x0 + 50 and y >= y0 and y < y0 + 20 then 0 else sqrt(pow(x - ax - t * (bx - ax), 2) + pow(y - ay - t * (by_ - ay), 2)) end as d from (
    select *, least(1, greatest(0, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / ((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)))) as t from points, edges)) group by frame_id""", views.GRID,
  """corners as (select printf('B%05d', s_suppkey) as feature_id, 120000::double + s_suppkey * 611 % 9973 as x0, 480000::double + s_suppkey * 3571 % 9949 as y0, s_suppkey % 3 = 0 as area from supplier),
  steps(area, dx, dy, ex, ey) as (values (false, 0, 0, 40, 10), (false, 40, 10, 60, -30), (true, 0, 0, 50, 0), (true, 50, 0, 50, 20), (true, 50, 20, 0, 20), (true, 0, 20, 0, 0)),
  edges as (select c.*, x0 + dx as ax, y0 + dy as ay, x0 + ex as bx, y0 + ey as by_ from corners c join steps s using (area))""")  # fmt: skip
def nearest_feature(spark, sf_dir):
    """Each point with its closest bridge or quay, as lines and areas of a GeoJSON file."""
    found = spatial.nearest_feature(views.grid_points(spark, sf_dir), readers.features(bridge_rows(spark, sf_dir)), "frame_id", "feature_id")
    return found.select("frame_id", "feature_id", r3("distance").alias("distance"))


@query(f"""select 'F' || frame_id as feature_id, cast(k as integer) as k, round(155000 + {_poly(geo.TO_X, "p", "q")}, 3) as x, round(463000 + {_poly(geo.TO_Y, "p", "q")}, 3) as y from (
  select frame_id, k, 0.36 * (gps_lat + dy - 52.15517440::double) as p, 0.36 * (gps_lon + dx - 5.38720621::double) as q from frames, (values (1, 0::double, 0::double), (2, 0.001::double, 0::double), (3, 0.001::double, 0.002::double)) as v(k, dx, dy) where gps_lat <> 0 and frame_id % 4 = 0)""", views.FRAMES)  # fmt: skip
def features_on_grid(spark, sf_dir):
    """Vertices of triangles in longitude and latitude, projected as they are read."""
    f = views.frames(spark, sf_dir).where("gps_lat <> 0 and frame_id % 4 = 0")
    at = lambda dx, dy: F.array(F.col("gps_lon") + dx, F.col("gps_lat") + dy)
    shape = F.array(F.array(at(0.0, 0.0), at(0.001, 0.0), at(0.001, 0.002)))
    rows = f.select(F.concat(F.lit("F"), "frame_id").alias("feature_id"), F.lit("Polygon").alias("type"), F.to_json(shape).alias("coordinates"), F.lit(None).cast("string").alias("crs"))
    v = readers.features(rows).select("feature_id", F.posexplode(F.col("rings")[0]).alias("k", "v"))
    return v.select("feature_id", (F.col("k") + 1).alias("k"), r3("v.x").alias("x"), r3("v.y").alias("y"))


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing documents as text by path; some are cut off, some lack or repeat what they need."""
    e = views.table(spark, sf_dir, "events").where("event_id % 5 = 0")
    box = "named_struct('x_center', if(event_id % 20 = 0, 1.5, 0.5), 'y_center', 0.5, 'width', 0.25, 'height', 0.25)"
    detection = lambda c, p, b: f"named_struct('object_class', {c}, 'confidence', {p}, 'tracking_id', 1, 'boundingBox', {b})"
    whole = box.replace("if(event_id % 20 = 0, 1.5, 0.5)", "0.5")
    name = "case when event_id % 55 = 0 then ' ' when event_id % 95 = 0 then 'same.jpg' else concat('img_', event_id, '.jpg') end"
    e = e.selectExpr(
        "event_id", f"{name} as image_file_name", "if(event_id % 65 = 0, 'no time', '2024-01-01T00:00:05Z') as image_file_timestamp",
        "named_struct('latitude', if(event_id % 85 = 0, 95D, 52D), 'longitude', 4.9D, 'coordinate_time_stamp', '2024-01-01T00:00:00Z') as gps_data",
        f"array({detection('if(event_id % 15 = 0, null, 2)', '0.5', whole)}, {detection('3', '0.5', box)}, {detection('4', 'if(event_id % 25 = 0, 2.0, 0.5)', whole)}) as detections",
    )
    text = F.to_json(F.struct("image_file_name", "image_file_timestamp", "gps_data", "detections"))
    return e.select(F.format_string("doc_%09d", "event_id").alias("path"), F.when(F.col("event_id") % 35 == 0, F.substring(text, 1, 30)).otherwise(text).alias("value"))


def parsed(raw: DataFrame) -> DataFrame:
    """Texts as the rows that the stream of documents has."""
    kind = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in LANDING.fields)}, {rejects.CORRUPT} string"
    return raw.select("path", F.from_json("value", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rejects.CORRUPT}).alias("d")).select("d.*", "path")


_DOCS = """docs as (select event_id, printf('doc_%09d', event_id) as path, case when event_id % 35 = 0 then 'not JSON of the expected types' when event_id % 55 = 0 then 'no image name'
    when event_id % 65 = 0 then 'image time can''t be read' when event_id % 85 = 0 then 'position outside the earth' end as reason from events where event_id % 5 = 0),
  judged as (select event_id, path, coalesce(reason, case when event_id % 95 = 0 and path <> (select min(path) from docs where event_id % 95 = 0 and reason is null) then 'image name repeats' end) as reason from docs)"""


@query("""select path, cast(null as integer) as at, reason from judged where reason is not null
  union all select path, 0, 'no class' from judged where reason is null and event_id % 15 = 0
  union all select path, 1, 'no box within the image' from judged where reason is null and event_id % 20 = 0
  union all select path, 2, 'confidence outside 0 to 1' from judged where reason is null and event_id % 25 = 0""", _DOCS)  # fmt: skip
def rejected_documents(spark, sf_dir):
    """What ingestion refuses: documents, and detections within good documents, with the reason."""
    _, _, refused = rejects.split(rejects.checked(parsed(raw_documents(spark, sf_dir))))
    return refused.select("path", "at", "reason")


@query("""select 'img_' || event_id || '.jpg' as image_name, count(*) filter (where event_id % 15 <> 0 or c <> 2) as n from (
  select event_id, c from judged, (values (2), (3), (4)) as v(c) where reason is null and event_id % 95 <> 0 and not (c = 3 and event_id % 20 = 0) and not (c = 4 and event_id % 25 = 0)) group by event_id having n > 0""", _DOCS)  # fmt: skip
def accepted_detections(spark, sf_dir):
    """How many detections of each good document ingestion takes."""
    frames, found, _ = rejects.split(rejects.checked(parsed(raw_documents(spark, sf_dir))))
    known = frames.where("image_name <> 'same.jpg'").select("frame_id")
    return found.join(known, "frame_id").groupBy("image_name").agg(F.count("*").alias("n"))


@query("""select detection_id, status, cast(done as varchar) as processed_at from (select *, row_number() over (partition by detection_id order by done desc, b desc) as k from (
  select event_id as detection_id, 'S' || b as status, timestamp '2024-01-10 00:00:00' + to_hours(cast((b * 7 + event_id % 5) % 11 as integer)) as done, b from events, range(1, 5) as v(b) where event_id % (b + 1) = 0)) where k = 1""")  # fmt: skip
def status_log_compacted(spark, sf_dir):
    """The current status of every detection, from a snapshot of three batches of the log and one behind it."""
    log = StatusLog(spark, f"{scratch_dir(spark)}/status-{uuid.uuid4().hex}")
    e = views.table(spark, sf_dir, "events")
    for b in range(1, 5):
        at = f"timestampadd(HOUR, cast(({b * 7} + event_id % 5) % 11 as int), timestamp'2024-01-10 00:00:00')"
        log.append(e.where(f"event_id % {b + 1} = 0").selectExpr("event_id as detection_id", f"'S{b}' as status", f"{at} as processed_at"))
        if b in (2, 3):
            log.compact()
    return log.current().withColumn("processed_at", F.col("processed_at").cast("string"))


def _send(row: dict) -> str:
    """A service that refuses every fifth ticket."""
    if row["id"] % 5 == 0:
        raise NotSent
    return row["signal_id"]


@query("select id, case when id % 5 = 0 then 'failed' else 'sent' end as outcome, case when id % 5 = 0 then null else signal_id end as signal_id from tickets where state = 'Gemeld'", views.TICKETS)
def notification_split(spark, sf_dir):
    """Tickets sent and refused, each sent once however often the result is computed."""
    new = views.tickets(spark, sf_dir).where("state = 'Gemeld'").select("id", "signal_id")
    return deliver_once(new, _send, f"{scratch_dir(spark)}/outbox-{uuid.uuid4().hex}", chunk=1000).select("id", "outcome", "signal_id")


@query("""select cluster, object_class, arg_min(image_id, struct_pack(n := -n, i := image_id)) as image_id, cast(max(n) as bigint) as n from (
  select l.cluster, d.object_class, d.frame_id as image_id, count(*) as n from detections d join labelled l on l.frame_id = d.frame_id group by 1, 2, 3) group by 1, 2""",
  views.FRAMES, views.DETECTIONS, f"""near as (select a.frame_id as a, b.frame_id as b from frames a join frames b on abs(a.gps_lat - b.gps_lat) < 0.0005 where a.gps_lat is not null and b.gps_lat is not null and {hav("a.gps_lat", "a.gps_lon", "b.gps_lat", "b.gps_lon")} <= 20.0),
  reach as (select frame_id as node, frame_id as seen from frames where gps_lat is not null union select r.node, n.b from reach r join near n on n.a = r.seen),
  labelled as (select node as frame_id, min(seen) as cluster from reach group by node)""")  # fmt: skip
def images_by_cluster(spark, sf_dir):
    """Of images within 20 metres of each other, the one with most detections of each class."""
    f = views.frames(spark, sf_dir).select(F.col("frame_id").alias("image_id"), "gps_lat", "gps_lon")
    return ops.selected_images(f, views.detections(spark, sf_dir).select(F.col("frame_id").alias("image_id"), "object_class"), 20.0)


@query("""select "Object Class", "True Positives", "False Positives", "False Negatives", "Recall" from (select * from rows_) where split = 'val' and size = 'small'""", views.BOXES, SIZED,
  """rows_ as (select split, class as "Object Class", size, tp as "True Positives", fp as "False Positives", fn as "False Negatives", round(tp / nullif(tp + fn, 0), 3) as "Recall" from (
  select coalesce(t.split, s.split) as split, case coalesce(t.object_class, s.object_class) when 2 then 'container' when 3 then 'mobile_toilet' else 'scaffolding' end as class, coalesce(t.size, s.size) as size,
    count(*) filter (where t.image_id is not null and s.image_id is not null) as tp, count(*) filter (where t.image_id is null) as fp, count(*) filter (where s.image_id is null) as fn
  from (select distinct image_id, object_class, size, case image_id % 3 when 0 then 'train' when 1 then 'val' else 'test' end as split from sized) t
  full join (select distinct image_id, object_class, size, case image_id % 3 when 0 then 'train' when 1 then 'val' else 'test' end as split from pred join sizes using (object_class)) s
  on t.image_id = s.image_id and t.object_class = s.object_class and t.size = s.size group by 1, 2, 3))""")  # fmt: skip
def report_slice(spark, sf_dir):
    """One size and split of the report of all splits."""
    whole = split_report(spark, sf_dir).withColumnsRenamed({"split": "Split", "size": "Size"})
    return evaluation.report_slice(whole, size="small", split="val")


@query("""select id, category_id, image_id, area, cast(x as varchar) || ',' || cast(w as varchar) as box from (
  select row_number() over (order by image_id, category_id, x, y, w, h) as id, * from (
    select object_class + 1 as category_id, dense_rank() over (order by 'run/img_' || frame_id || '.jpg') as image_id, round(cast(width as double) * cast(height as double), 10) as area,
      round(cast(x_center as double) - cast(width as double) / 2, 6) as x, cast(y_center as double) - cast(height as double) / 2 as y, round(cast(width as double), 6) as w, cast(height as double) as h from detections))""", views.DETECTIONS)  # fmt: skip
def relative_coco(spark, sf_dir):
    """Annotations of a dataset with boxes as shares of the image."""
    d = views.detections(spark, sf_dir).withColumn("image_name", F.concat(F.lit("img_"), "frame_id", F.lit(".txt")))
    images = d.select(F.lit("run").alias("folder"), F.concat(F.lit("img_"), "frame_id", F.lit(".jpg")).alias("image_name")).distinct().withColumns({"width": F.lit(1280), "height": F.lit(720)})
    _, a = writers.relative_coco(images, d, "store://x/", "https://x/", "2024-01-10T00:00:00Z")
    return a.select("id", "category_id", "image_id", "area", F.concat_ws(",", F.round(F.col("bbox")[0], 6).cast("string"), F.round(F.col("bbox")[2], 6).cast("string")).alias("box"))


@query("select frame_id from (select frame_id, min(d) as d from met where d <= 50 group by frame_id) where d <= 30 and frame_id % 4 <> 0", views.FRAMES, RUN)
def usable_matches(spark, sf_dir):
    """Matches of two runs within 30 metres whose image is there."""
    m = sampling.nearest_in_run(*_runs(spark, sf_dir), 50.0).where("auto_id is not null").withColumn("image_name", F.concat(F.lit("img_"), "frame_id", F.lit(".jpg")))
    there = views.frames(spark, sf_dir).where("frame_id % 4 <> 0").select("image_name")
    return sampling.usable_matches(m, there, 30.0).select("frame_id")


@query("""select p_partkey, lat, case when p_partkey % 7 = 0 then 'no class' when p_partkey % 5 = 0 then 'unknown class' when p_partkey % 11 = 0 then 'gps_lat is no number' end as reason from (
  select p_partkey, case when p_partkey % 7 <> 0 and p_partkey % 5 <> 0 and p_partkey % 11 <> 0 then 52.3 + (p_partkey % 1000) / 1000000::double end as lat from part)""")  # fmt: skip
def metadata_fixed(spark, sf_dir):
    """Rows of hand-made metadata, with dots between thousands taken out, or why they are refused."""
    lat = "case when p_partkey % 11 = 0 then 'north' else format_string('52.300.%03d', p_partkey % 1000) end"
    rows = views.table(spark, sf_dir, "part").selectExpr("p_partkey", "case when p_partkey % 7 = 0 then null when p_partkey % 5 = 0 then 9 else 2 end as object_class", f"{lat} as gps_lat", "'4.9' as gps_lon")
    good, refused = ops.fixed_metadata(rows)
    return good.select("p_partkey", F.round("gps_lat", 6).alias("lat"), F.lit(None).cast("string").alias("reason")).unionByName(refused.select("p_partkey", F.lit(None).cast("double").alias("lat"), "reason"))


@query("""select path, target, path <> min(path) over (partition by target) as clash from (
  select distinct 'in/' || (event_id % 3) || '/f' || (event_id // 6) || '.jpg' as path, 'out/f' || (event_id // 6) || '.jpg' as target from events)""")
def copy_manifest(spark, sf_dir):
    """Where sampled files go; of several with one name the first path is copied."""
    e = views.table(spark, sf_dir, "events").selectExpr("concat('in/', event_id % 3, '/f', event_id div 6, '.jpg') as path")
    return sampling.copy_manifest(e, "out")


@query("select o_orderkey, o_orderdate from orders where o_custkey = 7 order by o_orderdate, o_orderkey limit 1")
def point_lookup(spark, sf_dir):
    """The first order of one customer."""
    return ops.point_lookup(views.table(spark, sf_dir, "orders"), "o_custkey", 7, "o_orderdate", "o_orderkey").select("o_orderkey", "o_orderdate")


def _notify(row: dict) -> str:
    """A service that refuses every fifth object."""
    if row["detection_id"] % 5 == 0:
        raise NotSent
    return f"S-{row['detection_id']}"


@query("""select detection_id, district, object_class, case when detection_id % 5 = 0 then 'failed' else 'sent' end as outcome, case when detection_id % 5 <> 0 then 'S-' || detection_id end as signal_id from (
  select *, row_number() over (partition by district, object_class order by round(score, 6) desc, detection_id) as rank from placed
  where score >= 0.4 and detection_date = date '2024-01-10' and district_k <> 24 and detection_id % 7 <> 0) where rank <= case when district_k % 4 = 0 then case object_class when 2 then 4 when 3 then 3 when 4 then 3 end else 1 end""", *CHAIN)  # fmt: skip
def submit_step(spark, sf_dir):
    """A day's best objects of the active districts, sent once, with two kinds of limits; some were processed before."""
    objects = placed(spark, sf_dir).withColumn("status", F.lit("Pending"))
    log = StatusLog(spark, f"{scratch_dir(spark)}/status-{uuid.uuid4().hex}")
    done = objects.where("detection_id % 7 = 0").select("detection_id", F.lit("Processed").alias("status"), F.current_timestamp().alias("processed_at"))
    log.append(done)
    names = {r["n_nationkey"]: r["n_name"] for r in views.table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()}
    config = {name: steps.District() if k % 4 == 0 else steps.District({2: 1, 3: 1, 4: 1}) for k, name in names.items() if k != 24}
    sent, failed = steps.submit(objects, log, config, _notify, f"{scratch_dir(spark)}/outbox-{uuid.uuid4().hex}", DAY, [F.desc(F.round("score", 6)), F.col("detection_id")], chunk=100)
    return sent.unionByName(failed).select("detection_id", "district", "object_class", "outcome", "signal_id")


@query()
def evaluation_summary(spark, sf_dir):
    """The twelve values of every split, over all classes and by class, in one plan."""
    g, p = views.gt_boxes(spark, sf_dir), views.pred_boxes(spark, sf_dir)
    images = g.select("image_id").unionByName(p.select("image_id")).distinct().withColumn("split", F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("image_id") % 3 + 1).cast("int")))
    return steps.evaluate(g, p, images, 1280, 720, SIZES)["summary"]
