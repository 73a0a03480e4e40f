"""Registered queries: enriched objects and their map, permits from text to coordinates, evaluation reports, datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.functions import geo, text
from kerbsight.operators import detections as ops
from kerbsight.operators import evaluation, permits, sampling, spatial
from kerbsight.operators.scratch import written
from kerbsight.plans import views
from kerbsight.plans.catalogue import CHAIN, DAY, RUN, SIZED, SIZES, in_districts, query, r3, scored
from kerbsight.plans.more import X, Y, _poly
from kerbsight.sources import writers

SEGMENT = "least(1.0::double, greatest(0.0::double, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / ((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay))))"
ENRICHED = f"""grid as (select *, 155000 + {_poly(geo.TO_X, X, Y)} as x, 463000 + {_poly(geo.TO_Y, X, Y)} as y from placed),
nearby as (select detection_id, bridge_id, near_x, near_y, d as bridge_distance from (select *, row_number() over (partition by detection_id order by d, bridge_id) as nr from (
  select *, sqrt(pow(x - near_x, 2) + pow(y - near_y, 2)) as d from (select *, ax + t * (bx - ax) as near_x, ay + t * (by_ - ay) as near_y from (select *, {SEGMENT} as t from grid cross join bridges)))) where nr = 1),
enriched as (select g.*, p.lat as permit_lat, p.lon as permit_lon, n.bridge_id, n.near_x, n.near_y, n.bridge_distance,
  not exists (select 1 from terrain t where pow(greatest(t.x0 - x, 0, x - t.x0 - 60), 2) + pow(greatest(t.y0 - y, 0, y - t.y0 - 40), 2) <= 90000) as private
  from grid g join nearby n using (detection_id) join permits p on p.permit_id = g.permit_id)"""
WHOLE = (*CHAIN, views.GRID, views.TERRAIN, ENRICHED)


def enriched_objects(spark, sf_dir) -> DataFrame:
    """Objects with their nearest permit and bridge, district, score and whether they stand on private ground."""
    found = scored(spark, sf_dir).withColumnsRenamed({"near_x": "permit_lat", "near_y": "permit_lon", "distance": "permit_distance"})
    x, y = geo.rd_from_wgs84(F.col("gps_lat"), F.col("gps_lon"))
    grid = found.withColumns({"x": x, "y": y})
    near = spatial.nearest_segment(grid, views.bridges(spark, sf_dir), "detection_id", "bridge_id").withColumnRenamed("distance", "bridge_distance")
    lat, lon = geo.wgs84_from_rd(F.col("near_x"), F.col("near_y"))
    private = spatial.apart_from(near, views.terrain(spark, sf_dir), "detection_id", 300.0)
    whole = written(private.withColumnRenamed("apart", "private").withColumns({"bridge_lat": lat, "bridge_lon": lon}), "enriched")
    return in_districts(spark, sf_dir, whole, "detection_id")


@query("""select detection_id, detection_date, object_class, round(gps_lat, 6) as object_lat, round(gps_lon, 6) as object_lon, round(bridge_distance, 2) as distance_closest_bridge, cast(bridge_id as varchar) as closest_bridge_id,
  round(distance, 2) as distance_closest_permit, cast(permit_id as varchar) as closest_permit_id, round(permit_lat, 6) as closest_permit_lat, round(permit_lon, 6) as closest_permit_lon, district, district_k as district_code,
  round(score, 3) as score, private as private_terrain, 'Pending' as status from enriched""", *WHOLE)  # fmt: skip
def enriched(spark, sf_dir):
    """The enriched table: sixteen columns, by name and type."""
    r = lambda c, k, name: F.round(c, k).cast("double").alias(name)
    return enriched_objects(spark, sf_dir).select(
        "detection_id", "detection_date", "object_class", r("gps_lat", 6, "object_lat"), r("gps_lon", 6, "object_lon"), r("bridge_distance", 2, "distance_closest_bridge"), F.col("bridge_id").cast("string").alias("closest_bridge_id"),
        r("permit_distance", 2, "distance_closest_permit"), F.col("permit_id").cast("string").alias("closest_permit_id"), r("permit_lat", 6, "closest_permit_lat"), r("permit_lon", 6, "closest_permit_lon"),
        "district", F.col("k").alias("district_code"), r("score", 3, "score"), F.col("private").alias("private_terrain"), F.lit("Pending").alias("status"),
    )


@query("""select kind, detection_id, priority, colour, icon, label, round(lon, 5) as lon, round(lat, 5) as lat from (
  select *, row_number() over (order by round(score, 6) desc, detection_id) as priority from enriched where score >= 0.4) e, lateral (
  select 'object' as kind, case when private then 'gray' when score < 1 then 'yellow' else 'orange' end as colour, case object_class when 2 then 'box' when 3 then 'toilet-portable' else 'table-cells' end as icon,
    'Permit ' || permit_id || ', private ground: ' || case when private then 'yes' else 'no' end as label, gps_lon as lon, gps_lat as lat
  union all select 'permit', 'red', null, 'Permit ' || permit_id, permit_lon, permit_lat
  union all select 'permit_line', 'green', null, printf('%.1fm', distance), gps_lon, gps_lat
  union all select 'bridge_line', 'blue', null, printf('%.1fm', bridge_distance), gps_lon, gps_lat)""", *WHOLE)  # fmt: skip
def map_rows(spark, sf_dir):
    """Rows of the map of all objects of enough score; of lines the first place."""
    rows = writers.map_rows(enriched_objects(spark, sf_dir).withColumn("score", F.round("score", 6)))
    return rows.select("kind", "detection_id", "priority", "colour", "icon", "label", F.round(F.col("coordinates")[0][0], 5).alias("lon"), F.round(F.col("coordinates")[0][1], 5).alias("lat"))


@query("""select detection_id, object_class, cast(rank as integer) as rank from (select *, row_number() over (partition by object_class order by round(score, 6) desc, detection_id) as rank from enriched
  where score >= 0.4 and lower(district) = 'nation_17' and not private and detection_id % 7 <> 0) where rank <= case object_class when 2 then 4 else 3 end""", *WHOLE)
def topk_of_a_district(spark, sf_dir):
    """The best of one district, named in another case, off private ground and without those to skip."""
    objects = enriched_objects(spark, sf_dir).where(ops.in_district("Nation_17"))
    skip = views.detections(spark, sf_dir).where("detection_id % 7 = 0")
    best = ops.top_k(objects, ops.SEND_LIMITS, [], [F.desc(F.round("score", 6)), F.col("detection_id")], private="private", skip_ids=skip)
    return best.select("detection_id", "object_class", "rank")


#: A point of the Dutch grid, (121000, 487000), as EWKB with its reference system.
POINT = "01010000204071000000000000808afd400000000060b91d41"
LOCATED = f"""book as (select 'Kade' || p_partkey % 10 as street, 1 + p_partkey % 50 as number, (1000 + p_partkey % 90) || 'AB' as postcode, 119000::double + p_partkey % 1000 as x, 485000::double + p_partkey % 900 as y from part where p_partkey % 2 = 0),
asked as (select permit_id, case when permit_id % 23 = 0 then null when permit_id % 29 = 0 then 'geen adres' else 'Kade' || permit_id % 10 || ' ' || (1 + permit_id % 50) || case when permit_id % 4 = 1 then ' H' else '' end || ' ' || (1000 + permit_id % 90) || case when permit_id % 3 = 0 then ' ab' else 'AB' end || case when permit_id % 6 = 0 then ' Amsterdam' else '' end end as locatie,
  case when permit_id % 11 = 0 then '{POINT}' when permit_id % 13 = 0 then 'zz' end as geometry,
  case when permit_id % 17 = 0 or permit_id % 19 = 0 then '' when permit_id % 5 = 0 then '2,3' when permit_id % 3 = 0 then '2' when permit_id % 3 = 1 then '3' else '4' end as classes
  from permits where valid_from <= date '2024-01-10' and valid_to >= date '2024-01-10'),
least_ as (select street, number, postcode, min(struct_pack(x := x, y := y)) as a from book group by all),
spot as (select s.permit_id, s.classes, case when geometry = '{POINT}' then 121000::double else l.a.x end as x, case when geometry = '{POINT}' then 487000::double else l.a.y end as y
  from asked s left join least_ l on s.locatie like l.street || ' ' || l.number || ' %' and contains(upper(replace(s.locatie, ' ', '')), l.postcode) where s.classes <> '' and s.locatie is not null)"""
_P, _Q = "((x - 155000) * 1e-5::double)", "((y - 463000) * 1e-5::double)"


@query(f"""select permit_id, classes, round(52.15517440::double + ({_poly(geo.TO_LAT, _P, _Q)}) / 3600, 6) as lat, round(5.38720621::double + ({_poly(geo.TO_LON, _P, _Q)}) / 3600, 6) as lon, x is not null as healthy from spot""", views.PERMITS, LOCATED)
def permits_prepared(spark, sf_dir):
    """A day's permits with classes and coordinates, by geometry or else by address, healthy ones and quarantine."""
    part = views.table(spark, sf_dir, "part").where("p_partkey % 2 = 0")
    book = part.selectExpr("concat('Kade', p_partkey % 10) as street", "cast(1 + p_partkey % 50 as int) as number", "concat(1000 + p_partkey % 90, ' ab') as postcode", "119000D + p_partkey % 1000 as x", "485000D + p_partkey % 900 as y")
    place = """case when permit_id % 23 = 0 then null when permit_id % 29 = 0 then 'geen adres' else concat('Kade', permit_id % 10, ' ', 1 + permit_id % 50, if(permit_id % 4 = 1, ' H', ''), ' ', 1000 + permit_id % 90, if(permit_id % 3 = 0, ' ab', 'AB'), if(permit_id % 6 = 0, ' Amsterdam', '')) end"""
    asked = views.permits(spark, sf_dir).withColumns({"locatie": F.expr(place), "geometrie_locatie": F.expr(f"case when permit_id % 11 = 0 then '{POINT}' when permit_id % 13 = 0 then 'zz' end")})
    p = permits.prepared(asked, book, DAY)
    return p.select("permit_id", F.array_join("classes", ",").alias("classes"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "healthy")


@query("""select *, round_even(2 * precision * recall / nullif(precision + recall, 0), 3) as f_1, round_even(1.25 * precision * recall / nullif(0.25 * precision + recall, 0), 3) as f_05, round_even(5 * precision * recall / nullif(4 * precision + recall, 0), 3) as f_2 from (
  select object_class, step, tp, fp, n - tp as fn, round_even(tp / nullif(tp + fp, 0), 3) as precision, round_even(tp / nullif(n, 0), 3) as recall from (
  select t.object_class, s.step, any_value(t.n) as n, count(*) filter (where b.best >= s.step and b.t) as tp, count(*) filter (where b.best >= s.step and not b.t) as fp
  from (select object_class, count(distinct image_id) as n from gt group by 1) t cross join (select unnest(range(1, 20)) * 0.05::double as step) s
  left join (select p.object_class, p.image_id, max(score) as best, bool_or(g.image_id is not null) as t from pred p left join (select distinct image_id, object_class from gt) g on p.image_id = g.image_id and p.object_class = g.object_class group by 1, 2) b on b.object_class = t.object_class group by 1, 2))""", views.BOXES)  # fmt: skip
def image_sweep(spark, sf_dir):
    s = evaluation.image_sweep(views.gt_boxes(spark, sf_dir), views.pred_boxes(spark, sf_dir), [k * 0.05 for k in range(1, 20)])
    return s.select("object_class", "step", "tp", "fp", "fn", "precision", "recall", "f_1", "f_05", "f_2")


SEEN = """seen as (select 'i' || image_id as image_name, score as confidence from pred where object_class = 2), real_ as (select distinct 'i' || image_id as image_name from gt where object_class = 2 and image_id % 3 <> 0),
things as (select image_id // 7 as object_id, 'i' || image_id as image_name from gt where object_class = 2 and image_id % 3 <> 0)"""


@query("""select step, count(distinct s.image_name) as n_detections, count(distinct r.image_name) as n_true_positives, count(distinct t.object_id) as n_unique, round_even(count(distinct r.image_name) / nullif(count(distinct s.image_name), 0), 3) as precision,
  round_even(count(distinct r.image_name) / (select count(*) from real_), 3) as recall, round_even(count(distinct t.object_id) / (select count(distinct object_id) from things), 3) as recall_unique
  from (select unnest(range(6, 20)) * 0.05::double as step) l left join seen s on s.confidence >= l.step left join real_ r on r.image_name = s.image_name left join things t on t.image_name = r.image_name group by step""", views.BOXES, SEEN)
def object_sweep(spark, sf_dir):
    """Detected images and the objects they show, by least confidence."""
    name = F.concat(F.lit("i"), F.col("image_id")).alias("image_name")
    d = views.pred_boxes(spark, sf_dir).where("object_class = 2").select(name, F.col("score").alias("confidence"))
    real = views.gt_boxes(spark, sf_dir).where("object_class = 2 and image_id % 3 <> 0")
    return evaluation.object_sweep(d, real.select(name), real.selectExpr("image_id div 7 as object_id", "concat('i', image_id) as image_name"), [k * 0.05 for k in range(6, 20)])


@query("""select model, n_detections, n_tp as n_true_positives, round(n_tp / n_detections, 6) as precision, round(n_tp / (select count(distinct image_id) from d where t), 6) as partial_recall, round((n_detections - n_tp) / 1000.0, 6) as fnr
  from (select model, count(*) as n_detections, count(*) filter (where t) as n_tp from d group by model)""", views.BOXES,
       "d as (select distinct pred_id % 3 as model, image_id, image_id in (select image_id from gt where object_class = 2) as t from pred where object_class = 2)")
def model_comparison(spark, sf_dir):
    """Three models by image: precision, recall within the union of all models' true positives, wrong detections."""
    d = views.pred_boxes(spark, sf_dir).where("object_class = 2").selectExpr("pred_id % 3 as model", "image_id as image_name")
    truth = views.gt_boxes(spark, sf_dir).where("object_class = 2").select(F.col("image_id").alias("image_name")).distinct()
    s = evaluation.compare_models(d, d.join(truth, "image_name", "left_semi"), 1000)
    return s.select("model", "n_detections", "n_true_positives", *[F.round(c, 6).alias(c) for c in ("precision", "partial_recall", "fnr")])


@query("""select step, round(count(*) filter (where side = 'a' and d > step) / count(*) filter (where side = 'a'), 6) as fnr, round(count(*) filter (where side = 'b' and d > step) / count(*) filter (where side = 'b'), 6) as fpr
  from (select 'a' as side, frame_id, min(sqrt(pow(x - cx, 2) + pow(y - cy, 2))) as d from a cross join b group by 1, 2 union all select 'b', b_id, min(sqrt(pow(x - cx, 2) + pow(y - cy, 2))) from a cross join b group by 1, 2) cross join (select unnest(range(0, 26, 5)) * 1.0::double as step) group by step""",
       views.GRID, "a as (select frame_id, x, y from points where frame_id % 2 = 0 and frame_id % 9 = 0), b as (select frame_id as b_id, x + 7 as cx, y - 3 as cy from points where frame_id % 5 = 0)")
def distance_rates(spark, sf_dir):
    """Rates of true places without a detection nearby, and of detections without a true place, by distance."""
    p = views.grid_points(spark, sf_dir)
    a = p.where("frame_id % 2 = 0 and frame_id % 9 = 0").withColumnRenamed("frame_id", "id")
    b = p.where("frame_id % 5 = 0").select(F.col("frame_id").alias("id"), (F.col("x") + 7).alias("x"), (F.col("y") - 3).alias("y"))
    return evaluation.distance_rates(a, b, list(range(0, 26, 5))).select("step", F.round("fnr", 6).alias("fnr"), F.round("fpr", 6).alias("fpr"))


@query(f"""select split, class as "Object Class", size, tp as "True Positives", fp as "False Positives", fn as "False Negatives", round(tp / nullif(tp + fn, 0), 3) as "Recall" from (
  select coalesce(t.split, s.split) as split, case coalesce(t.object_class, s.object_class) when 2 then 'container' when 3 then 'mobile_toilet' else 'scaffolding' end as class, coalesce(t.size, s.size) as size,
    count(*) filter (where t.image_id is not null and s.image_id is not null) as tp, count(*) filter (where t.image_id is null) as fp, count(*) filter (where s.image_id is null) as fn
  from (select distinct image_id, object_class, size, case image_id % 3 when 0 then 'train' when 1 then 'val' else 'test' end as split from sized) t
  full join (select distinct image_id, object_class, size, case image_id % 3 when 0 then 'train' when 1 then 'val' else 'test' end as split from pred join sizes using (object_class)) s
  on t.image_id = s.image_id and t.object_class = s.object_class and t.size = s.size group by 1, 2, 3)""", views.BOXES, SIZED)  # fmt: skip
def split_report(spark, sf_dir):
    """Statistics by image of all splits in one plan, with a report's headings."""
    split = F.when(F.col("image_id") % 3 == 0, "train").when(F.col("image_id") % 3 == 1, "val").otherwise("test")
    g, p = (df.withColumn("split", split) for df in (views.gt_boxes(spark, sf_dir), views.pred_boxes(spark, sf_dir)))
    s = evaluation.per_image_stats(g, p, SIZES, 1280.0 * 720.0, by=("split",)).select("split", "object_class", "size", "tp", "fp", "fn", F.round("recall", 3).alias("recall"))
    return evaluation.report_rows(s, ["split", "size"]).withColumnsRenamed({"Split": "split", "Size": "size"})


@query("select object_class, count(*) as n, count(*) filter (where (x1 - x0) * (y1 - y0) > case object_class when 2 then 0.006 when 3 then 0.004 else 0.008 end * 921600) as n_large from gt group by object_class", views.BOXES)
def bound_counts(spark, sf_dir):
    return evaluation.bound_counts(views.gt_boxes(spark, sf_dir), 1280.0 * 720.0, {2: (0.002, 0.006), 3: (0.001, 0.004), 4: (0.003, 0.008)})


@query("""select d.detection_id, round(abs(epoch(f.image_timestamp) - epoch(f.gps_timestamp)), 3) as gps_delay, f.gps_lat, f.gps_lon from detections d join frames f using (frame_id)
  where confidence > 0.5::double and width * height > 0.05::double and abs(epoch(f.image_timestamp) - epoch(f.gps_timestamp)) < 4""", views.FRAMES, views.DETECTIONS)
def map_filter(spark, sf_dir):
    """Detections that a map shows as dots."""
    d = views.detections(spark, sf_dir).drop("status").join(views.frames(spark, sf_dir), "frame_id")
    return ops.shown_on_map(d, 0.5, 0.05, 4.0).select("detection_id", r3("gps_delay").alias("gps_delay"), "gps_lat", "gps_lon")


@query("""select row_number() over (order by k.new_id, a.gt_id) as annotation_id, k.new_id as image_id, a.gt_id as old_id from (select i.image_id, n.new_id from (select distinct image_id, 'img_' || image_id || '.jpg' as base from gt) i
  join (select base, min(new_id) as new_id from (select 'img_' || image_id || '.jpg' as base, 100000 + image_id * 7 % 1009 as new_id from (select distinct image_id from pred where pred_id % 3 = 0)) group by base) n using (base)) k join gt a using (image_id)""", views.BOXES)
def aligned_images(spark, sf_dir):
    """Annotations under another dataset's ids for the same base file names."""
    g, p = views.gt_boxes(spark, sf_dir), views.pred_boxes(spark, sf_dir).where("pred_id % 3 = 0")
    known = p.select("image_id").distinct().selectExpr("100000 + image_id * 7 % 1009 as image_id", "concat('https://x/y/img_', image_id, '.jpg?sig=1') as file_name")
    images = g.select("image_id").distinct().selectExpr("image_id", "concat('a/b/img_', image_id, '.jpg') as file_name")
    annotations = g.select(F.col("gt_id").alias("annotation_id"), "image_id", F.col("gt_id").alias("old_id"))
    return sampling.aligned(images, annotations, known)[1].select("annotation_id", "image_id", "old_id")


@query("""select row_number() over (order by image_id, detection_id) as id, image_id, category_id, detection_id from (select dense_rank() over (order by image_name) as image_id, image_name, detection_id, case object_class when 2 then 1 when 3 then 2 end as category_id
  from (select 'img_' || frame_id || '.jpg' as image_name, d.* from frames f left join (select detection_id, frame_id, object_class from detections where detection_id % 2 = 0) d using (frame_id) where frame_id % 5 <> 0)) where category_id is not null""", views.FRAMES, views.DETECTIONS)
def coco_dataset(spark, sf_dir):
    """Detections as annotations of a dataset with ids from 1 up; images without a file are left out."""
    f = views.frames(spark, sf_dir).select("frame_id", "image_name")
    d = views.detections(spark, sf_dir).where("detection_id % 2 = 0").join(f, "frame_id")
    _, annotations = writers.coco_dataset(f, d, f.where("frame_id % 5 <> 0"), 1280, 720, {2: 1, 3: 2}, keep=("detection_id",))
    return annotations.select("id", "image_id", "category_id", "detection_id")


@query("""select p_partkey, case when p_partkey % 3 = 0 then 'images/test/' || p_partkey % 7 when p_partkey % 3 = 1 then 'val' else '' end as folder, 'f' || p_partkey || '.png' as file from part""")
def upload_places(spark, sf_dir):
    """Folder and file below a job's input folder."""
    path = "concat(case p_partkey % 3 when 0 then concat('/mnt/job/INPUT_data/images/test/', p_partkey % 7, '/') when 1 then '/mnt/job/val/' else '/mnt/INPUT_x/' end, 'f', p_partkey, '.png')"
    folder, file = text.upload_place(F.col("path"))
    return views.table(spark, sf_dir, "part").selectExpr("p_partkey", f"{path} as path").select("p_partkey", folder.alias("folder"), file.alias("file"))


@query("select strftime(gps_timestamp, '%Y-%m-%d') as folder, count(*) as n from frames group by 1", views.FRAMES)
def day_folders(spark, sf_dir):
    return views.frames(spark, sf_dir).groupBy(text.day_folder(F.col("gps_timestamp")).alias("folder")).agg(F.count("*").alias("n"))


@query("select count(*) as n_sampled, count(*) filter (where frame_id % 4 = 0) as n_with_permit, round(100.0 * count(*) filter (where frame_id % 4 = 0) / count(*), 6) as ratio from frames where frame_id % 5 = 0", views.FRAMES)
def sampling_statistics(spark, sf_dir):
    f = views.frames(spark, sf_dir).withColumn("permit", F.col("frame_id") % 4 == 0)
    return sampling.sample_counts(f, f.where("frame_id % 5 = 0"), "frame_id", "permit").withColumn("ratio", F.round("ratio", 6))


@query("select 'n' as what, round(count(*) filter (where d <= 20) / count(*), 6) as recall from (select frame_id, min(d) as d from met where d <= 50 group by frame_id)", views.FRAMES, RUN)
def recall_within(spark, sf_dir):
    """Share of the matched frames whose match is within 20 metres."""
    from kerbsight.plans.catalogue import _runs

    m = sampling.nearest_in_run(*_runs(spark, sf_dir), 50.0).where("auto_id is not null")
    return m.agg(F.round(F.count_if(F.col("distance_m") <= 20) / F.count("*"), 6).alias("recall")).select(F.lit("n").alias("what"), "recall")
