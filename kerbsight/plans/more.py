"""Further registered queries: projections, filters, reports and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbsight.functions import geo, panorama
from kerbsight.operators import evaluation, permits, sampling, spatial
from kerbsight.plans import views
from kerbsight.plans.catalogue import OVERLAP, RUN, UNIFORM, _runs, query, r3
from kerbsight.sources import writers

X, Y = "(0.36 * (gps_lat - 52.15517440::double))", "(0.36 * (gps_lon - 5.38720621::double))"


def _poly(terms, p: str, q: str) -> str:
    return " + ".join("*".join([f"({k}::double)", *[p] * i, *[q] * j]) for i, j, k in terms)


@query(f"select frame_id, round(155000 + {_poly(geo.TO_X, X, Y)}, 3) as x, round(463000 + {_poly(geo.TO_Y, X, Y)}, 3) as y from frames where gps_lat <> 0", views.FRAMES)
def rd_projection(spark, sf_dir):
    x, y = geo.rd_from_wgs84(F.col("gps_lat"), F.col("gps_lon"))
    return views.frames(spark, sf_dir).where("gps_lat <> 0").select("frame_id", r3(x).alias("x"), r3(y).alias("y"))


@query("select p.frame_id from points p, (select min(ax) - 50 as x0, max(bx) + 50 as x1, min(ay) - 50 as y0, max(ay) + 50 as y1 from bridges where bridge_id % 5 = 0) b where x between x0 and x1 and y between y0 and y1", views.GRID)
def bbox_clip(spark, sf_dir):
    b = views.bridges(spark, sf_dir).where("bridge_id % 5 = 0").agg((F.min("ax") - 50).alias("x0"), (F.max("bx") + 50).alias("x1"), (F.min("ay") - 50).alias("y0"), (F.max("ay") + 50).alias("y1"))
    return views.grid_points(spark, sf_dir).join(F.broadcast(b), F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))).select("frame_id")


@query("select frame_id from points where pow(x - 121000, 2) + pow(y - 487000, 2) <= pow(5000, 2)", views.GRID)
def distance_to_centre(spark, sf_dir):
    return views.grid_points(spark, sf_dir).where(geo.planar(F.col("x"), F.col("y"), F.lit(121000.0), F.lit(487000.0)) <= 5000).select("frame_id")


@query("select pred_id from pred where coalesce(case when pred_id % 7 = 0 then null else score end, 1.0) >= 0.5", views.BOXES)
def score_default_filter(spark, sf_dir):
    p = views.pred_boxes(spark, sf_dir).withColumn("score", F.when(F.col("pred_id") % 7 != 0, F.col("score")))
    return p.where(F.coalesce("score", F.lit(1.0)) >= 0.5).select("pred_id")


@query("select count(*) as n, count(*) filter (where object_class is null) as missing, count(*) filter (where object_class not in (2, 3, 4)) as outside from detections", views.DETECTIONS)
def class_domain_check(spark, sf_dir):
    c = F.col("object_class")
    return views.detections(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if(c.isNull()).alias("missing"), F.count_if(~c.isin(2, 3, 4)).alias("outside"))


@query(f"select object_class, tracking_id, detection_id from (select *, row_number() over (partition by object_class, tracking_id order by {UNIFORM.format('detection_id', 42)}, detection_id) as k from detections) where k = 1", views.DETECTIONS)
def one_candidate_per_key(spark, sf_dir):
    return sampling.one_of_each(views.detections(spark, sf_dir), ["object_class", "tracking_id"], "detection_id").select("object_class", "tracking_id", "detection_id")


@query("""select f.frame_id, m.event_id from (select frame_id, frame_id % 10 as source, row_number() over (partition by frame_id % 10 order by frame_id) as k from frames) f
  left join (select event_id, user_id % 10 as source, row_number() over (partition by user_id % 10 order by event_id) as k from events where event_id % 4 = 1) m on f.source = m.source and f.k = m.k""", views.FRAMES)
def ordinal_match(spark, sf_dir):
    """Frames with their source's metadata record of the same ordinal; null where it has fewer, cut where it has more."""
    f = views.frames(spark, sf_dir).select("frame_id", (F.col("frame_id") % 10).alias("source"))
    m = views.table(spark, sf_dir, "events").where("event_id % 4 = 1").select("event_id", (F.col("user_id") % 10).alias("source"))
    return sampling.matched_by_ordinal(f, m, "source", ["frame_id"], ["event_id"]).select("frame_id", "event_id")


@query("select image_id, coalesce(a, 0) as n_gt, coalesce(b, 0) as n_pred from (select image_id, count(*) as a from gt group by 1) full join (select image_id, count(*) as b from pred group by 1) using (image_id) where coalesce(a, 0) <> coalesce(b, 0)", views.BOXES)
def count_mismatch(spark, sf_dir):
    g = views.gt_boxes(spark, sf_dir).groupBy("image_id").agg(F.count("*").alias("n_gt"))
    p = views.pred_boxes(spark, sf_dir).groupBy("image_id").agg(F.count("*").alias("n_pred"))
    n = g.join(p, "image_id", "full_outer").na.fill(0, ["n_gt", "n_pred"])
    return n.where("n_gt <> n_pred").select("image_id", "n_gt", "n_pred")


@query("select event_type, min(n) as least, max(n) as most, round(avg(n), 6) as mean from (select event_type, user_id, count(*) as n from events group by 1, 2) group by event_type")
def event_type_stats(spark, sf_dir):
    n = views.table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return n.groupBy("event_type").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("n"), 6).alias("mean"))


@query("select frame_id, case when keep = '' then null else keep end as kept, case when drop_ = '' then null else drop_ end as dropped from (select frame_id, coalesce(string_agg(detection_id, ',' order by detection_id) filter (where confidence >= 0.5::double), '') as keep, coalesce(string_agg(detection_id, ',' order by detection_id) filter (where confidence < 0.5::double), '') as drop_ from detections group by frame_id)", views.DETECTIONS)
def verdict_split(spark, sf_dir):
    """A frame's detections split by a verdict into two lists."""
    d = views.detections(spark, sf_dir).groupBy("frame_id").agg(F.array_sort(F.collect_list(F.struct("detection_id", "confidence"))).alias("d"))
    part = lambda f: F.nullif(F.array_join(F.transform(F.filter("d", f), lambda x: x["detection_id"].cast("string")), ","), F.lit(""))
    return d.select("frame_id", part(lambda x: x["confidence"] >= F.lit(0.5)).alias("kept"), part(lambda x: x["confidence"] < F.lit(0.5)).alias("dropped"))


@query("""select object_class, count(distinct pred_id) as tp, (select count(*) from pred p where p.object_class = m.object_class) - count(distinct pred_id) as fp, (select count(*) from gt g where g.object_class = m.object_class) - count(distinct gt_id) as fn
  from met m where w > 0 and h > 0 group by object_class""", views.BOXES, OVERLAP)
def binary_overlap_metrics(spark, sf_dir):
    g, p = views.gt_boxes(spark, sf_dir), views.pred_boxes(spark, sf_dir)
    met = evaluation.overlapping(g, p).groupBy("object_class").agg(F.countDistinct("pred_id").alias("tp"), F.countDistinct("gt_id").alias("met"))
    n = p.groupBy("object_class").agg(F.count("*").alias("np")).join(g.groupBy("object_class").agg(F.count("*").alias("ng")), "object_class")
    return met.join(n, "object_class").select("object_class", "tp", (F.col("np") - F.col("tp")).alias("fp"), (F.col("ng") - F.col("met")).alias("fn"))


@query("select count(*) filter (where d <= 20 and shared) as tp, count(*) filter (where d <= 20) - count(*) filter (where d <= 20 and shared) as fp, count(*) - count(*) filter (where d <= 20 and shared) as fn from (select frame_id, arg_min(shared, struct_pack(d := d, i := auto_id)) as shared, min(d) as d from met where d <= 50 group by frame_id)", views.FRAMES, RUN)
def run_comparison_counts(spark, sf_dir):
    """Matches within a cut-off that share a class: true; others within it: false; all others: missed."""
    m = sampling.nearest_in_run(*_runs(spark, sf_dir), 50.0).where("auto_id is not null")
    near, same = F.col("distance_m") <= 20, F.arrays_overlap("classes", "auto_classes")
    return m.agg(F.count_if(near & same).alias("tp"), (F.count_if(near) - F.count_if(near & same)).alias("fp"), (F.count("*") - F.count_if(near & same)).alias("fn"))


@query("select round(d, 3) as distance_m, count(*) over (order by round(d, 3)) as reached, round(count(*) over (order by round(d, 3)) / count(*) over (), 6) as recall from (select frame_id, min(d) as d from met where d <= 50 group by frame_id)", views.FRAMES, RUN)
def recall_by_distance(spark, sf_dir):
    """How many frames are matched at no more than each distance: counts by distance first, then a running sum."""
    m = sampling.nearest_in_run(*_runs(spark, sf_dir), 50.0).where("auto_id is not null").select(r3("distance_m").alias("distance_m"))
    run = sampling.with_running(m.groupBy("distance_m").agg(F.count("*").alias("n")), [], ["distance_m"], ["n"])
    reached = run.select("distance_m", (F.col("n") + F.col("n_before")).alias("reached"), "n")
    total = run.agg(F.sum("n").alias("total"))
    each = reached.join(F.broadcast(total)).select("distance_m", "reached", F.round(F.col("reached") / F.col("total"), 6).alias("recall"))
    return m.join(each, "distance_m")


@query("select frame_id, min(round(sqrt(pow(x - t.x0, 2) + pow(y - t.y0, 2)), 3)) as distance from points cross join terrain t where abs(x - t.x0) <= 400 and abs(y - t.y0) <= 400 and sqrt(pow(x - t.x0, 2) + pow(y - t.y0, 2)) <= 400 group by frame_id", views.GRID, views.TERRAIN)
def distance_to_set(spark, sf_dir):
    """Distance of each point to the closest corner of a set, where that is within 400 metres."""
    corners = views.terrain(spark, sf_dir).select("terrain_id", F.col("ring")[0]["x"].alias("cx"), F.col("ring")[0]["y"].alias("cy"))
    near = spatial.nearest(views.grid_points(spark, sf_dir), corners, "frame_id", "terrain_id", [], geo.planar, place=("x", "y"), right_place=("cx", "cy"), flat=True, within=400.0)
    return near.select("frame_id", r3("distance").alias("distance"))


@query("""select c, count(*) as n from (select unnest(string_split(case when p_partkey % 17 = 0 or p_partkey % 19 = 0 then '' when p_partkey % 5 = 0 then '2,3' when p_partkey % 3 = 0 then '2' when p_partkey % 3 = 1 then '3' else '4' end, ',')) as c from part) where c <> '' group by c""")
def permit_category_counts(spark, sf_dir):
    return permits.exploded(permits.with_classes(views.permits(spark, sf_dir))).groupBy(F.col("object_class").cast("string").alias("c")).agg(F.count("*").alias("n"))


@query("""select pred_id, case when ay > ax and ay > az then case when y > 0 then 4 else 5 end when ax > az then case when x > 0 then 1 else 3 end when z > 0 then 0 else 2 end as face from (
  select *, abs(x) as ax, abs(y) as ay, abs(z) as az from (select pred_id, cos(v) * sin(u) as x, sin(v) as y, cos(v) * cos(u) as z from (select pred_id, ((x0 + 0.5) / 1280 - 0.5) * 2 * pi() as u, -((y0 + 0.5) / 720 - 0.5) * pi() as v from pred)))""", views.BOXES)
def cube_faces(spark, sf_dir):
    face, _, _ = panorama.on_cube(F.col("x0"), F.col("y0"), 1280, 720, 512)
    return views.pred_boxes(spark, sf_dir).select("pred_id", face.alias("face"))


@query()
def cube_boxes(spark, sf_dir):
    return panorama.boxes_on_cube(views.pred_boxes(spark, sf_dir), "pred_id", 1280, 720, 512)


@query()
def cube_outlines(spark, sf_dir):
    """What every face shows of a panorama's boxes, by their outlines."""
    return panorama.outlines_on_cube(views.pred_boxes(spark, sf_dir), "pred_id", 1280, 720, 512)


@query("""select image_id, '{"image_id":"' || image_id || '","category_id":' || object_class || '}' as value from pred where score >= 0.5""", views.BOXES)
def coco_rows(spark, sf_dir):
    p = views.pred_boxes(spark, sf_dir).where("score >= 0.5")
    return p.select("image_id", F.to_json(F.struct(F.col("image_id").cast("string").alias("image_id"), F.col("object_class").alias("category_id"))).alias("value"))


@query()
def landing_documents(spark, sf_dir):
    """Frames and their detections as landing JSON texts."""
    d = views.detections(spark, sf_dir).join(views.frames(spark, sf_dir).select("frame_id", "image_name"), "frame_id")
    return writers.landing_documents(views.frames(spark, sf_dir), d)
