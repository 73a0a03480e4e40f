"""Image clusters, matches by ordinal, manifests, repaired metadata, and the bodies of scheduled steps."""

import datetime
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from kerbsight.functions import text
from kerbsight.operators import detections as ops
from kerbsight.operators import evaluation, sampling
from kerbsight.operators.status_log import StatusLog
from kerbsight.plans import steps
from kerbsight.sources import writers
from kerbsight.sources.outbox import NotSent

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file


def test_best_image_of_each_cluster_and_class(spark):
    images = spark.createDataFrame([(1, 52.0, 4.0), (2, 52.00010, 4.0), (3, 52.00020, 4.0), (4, 53.0, 4.0), (5, None, 4.0), (2, 52.5, 4.0)], "image_id long, gps_lat double, gps_lon double")
    found = spark.createDataFrame([(1, 2), (2, 2), (2, 2), (3, 2), (3, 2), (3, 3), (4, 2), (5, 2), (9, 2)], "image_id long, object_class int")
    got = ops.selected_images(images, found, 20.0)
    assert sorted(map(tuple, got.collect())) == [(1, 2, 2, 2), (1, 3, 3, 1), (4, 2, 4, 1)]
    kept = ops.of_selected(found, got)
    assert sorted(r.image_id for r in kept.collect()) == [2, 2, 3, 3, 3, 4]
    assert ops.selected_images(images.limit(0), found, 20.0).count() == 0


def test_matches_by_ordinal_are_cut_and_padded(spark):
    rows = spark.createDataFrame([("a", k) for k in (3, 1, 2)] + [("b", 9), (None, 1)], "source string, frame int")
    details = spark.createDataFrame([("a", 10.0, "x"), ("a", 30.0, "z"), ("b", 1.0, "p"), ("b", 2.0, "q"), ("c", 0.0, "r")], "source string, at double, note string")
    got = {(r.source, r.frame): r.note for r in sampling.matched_by_ordinal(rows, details, "source", ["frame"], ["at"]).collect()}
    assert got == {("a", 1): "x", ("a", 2): "z", ("a", 3): None, ("b", 9): "p", (None, 1): None}


def test_usable_matches_slices_and_lookups(spark):
    m = spark.createDataFrame([("a", 5.0), ("b", 50.0), ("c", 1.0)], "image_name string, distance_m double")
    there = spark.createDataFrame([("a",), ("a",), ("b",)], "image_name string")
    assert sorted(r.image_name for r in sampling.usable_matches(m, there).collect()) == ["a", "b"]
    assert [r.image_name for r in sampling.usable_matches(m, there, 10.0).collect()] == ["a"]
    report = spark.createDataFrame([("val", "all", "box", 0.5), ("val", "small", "box", 0.1), ("test", "all", "box", 0.7), ("val", "all", "toilet", 0.9)], "Split string, Size string, `Object Class` string, Recall double")
    assert [tuple(r) for r in evaluation.report_slice(report, split="val", object_class="box").collect()] == [(0.5,)]
    assert evaluation.report_slice(report).columns == ["Split", "Object Class", "Recall"]
    assert ops.point_lookup(m, "image_name", "none").count() == 0 and ops.point_lookup(m, "image_name", "b").first().distance_m == 50.0


def test_coordinates_and_metadata_are_repaired(spark):
    texts = ["52.370.216", "52.37", "52", "-4.9.1", ".5", "5.", "north", "", None]
    got = [r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select(text.repaired(F.col("t")).alias("v")).collect()]
    assert got == [52.370216, 52.37, 52.0, -4.91, 0.5, 5.0, None, None, None]
    rows = spark.createDataFrame([(1, 2, "52.1.1", "4"), (2, None, "1", "1"), (3, 7, "1", "1"), (4, 3, "x", "1"), (5, 4, None, "1.5")], "id int, object_class int, gps_lat string, gps_lon string")
    good, refused = ops.fixed_metadata(rows)
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2, 52.11, 4.0), (5, 4, None, 1.5)]
    assert {r.id: r.reason for r in refused.collect()} == {2: "no class", 3: "unknown class", 4: "gps_lat is no number"}


def test_sampled_files_are_copied_once(spark, tmp_path):
    for d in ("a", "b", "out"):
        (tmp_path / d).mkdir()
    for name in ("a/1.jpg", "a/2.jpg", "b/2.jpg"):
        (tmp_path / name).write_text(name)
    sample = spark.createDataFrame([(str(tmp_path / n),) for n in ("a/1.jpg", "a/2.jpg", "b/2.jpg", "a/1.jpg")], "path string")
    manifest = sampling.copy_manifest(sample, str(tmp_path / "out"))
    assert [r.copied for r in writers.copy_files(manifest, lambda a, b: None).collect()] == [False] * 3

    def copy(a, b):
        import shutil

        shutil.copyfile(a, b)

    assert sorted(r.copied for r in writers.copy_files(manifest, copy, dry_run=False).collect()) == [False, True, True]
    assert sorted(os.listdir(tmp_path / "out")) == ["1.jpg", "2.jpg"] and (tmp_path / "out/2.jpg").read_text() == "a/2.jpg"


def test_relative_boxes_and_addresses(spark):
    images = spark.createDataFrame([("my run", "b.jpg", 100, 50), ("my run", "a.jpg", 100, 50)], "folder string, image_name string, width int, height int")
    labels = spark.createDataFrame([("b", 2, 0.5, 0.5, 0.2, 0.4), ("a.txt", 3, 0.25, 0.5, 0.5, 1.0), ("none", 2, 0.5, 0.5, 0.1, 0.1)], "image_name string, object_class int, x_center double, y_center double, width double, height double")
    i, a = writers.relative_coco(images, labels, "store://s/", "https://h/s/", "now")
    assert [tuple(r)[:1] + tuple(r)[3:] for r in i.orderBy("id").collect()] == [(1, "my run/a.jpg", "store://s/my run/a.jpg", "https://h/s/my%20run/a.jpg", "now"), (2, "my run/b.jpg", "store://s/my run/b.jpg", "https://h/s/my%20run/b.jpg", "now")]
    assert [(r.id, r.category_id, r.image_id, r.area, r.bbox) for r in a.orderBy("id").collect()] == [(1, 4, 1, 0.5, [0.0, 0.0, 0.5, 1.0]), (2, 3, 2, 0.08, [0.4, 0.3, 0.2, 0.4])]


# --- steps ---

DAY = datetime.date(2024, 1, 10)


def objects(spark):
    rows = [(k, 2 + k % 2, ("Centrum", "WEST", "Noord", None)[k % 4], 1 - k / 100, "Pending" if k != 8 else "Processed", DAY if k % 10 else DAY + datetime.timedelta(1)) for k in range(1, 41)]
    return spark.createDataFrame(rows, "detection_id long, object_class int, district string, score double, status string, detection_date date")


class Service:
    def __init__(self, path, die_at=None):
        self.path, self.die_at = str(path), die_at

    def calls(self):
        return sorted(map(int, open(self.path).read().split())) if os.path.exists(self.path) else []

    def send(self, row):
        if row["detection_id"] == 12:
            raise NotSent
        with open(self.path, "a") as f:
            f.write(f"{row['detection_id']}\n")
        if row["detection_id"] == self.die_at:
            os._exit(1)
        return f"S{row['detection_id']}"

    def lookup(self, row):
        return f"S{row['detection_id']}" if row["detection_id"] in self.calls() else None


CONFIG = {"centrum": steps.District({2: 2}), "West": steps.District({3: 1}), "elsewhere": steps.District()}
def order():
    return [F.desc("score"), F.col("detection_id")]


CHOSEN = [1, 4, 12]  # of Centrum the first two Pending of class 2, of West the first of class 3


@pytest.mark.parametrize("dies", [False, True])
def test_a_day_is_submitted_once(spark, tmp_path, dies):
    log, service = StatusLog(spark, f"file://{tmp_path}/log"), Service(tmp_path / "calls", die_at=4 if dies else None)
    run = lambda: steps.submit(objects(spark), log, CONFIG, service.send, f"file://{tmp_path}/outbox", DAY, order(), lookup=service.lookup, parts=2)
    if dies:
        with pytest.raises(Exception, match="exited|crashed|EOF"):
            run()
        assert log.current().count() == 0
        service.die_at = None
    sent, failed = run()
    assert sorted((r.detection_id, r.signal_id, r["rank"]) for r in sent.collect()) == [(1, "S1", 1), (4, "S4", 1)]
    assert [(r.detection_id, r.outcome) for r in failed.collect()] == [(12, "failed")]
    assert service.calls() == [1, 4]
    want = {r.detection_id for r in objects(spark).collect() if r.district in ("Centrum", "WEST") and r.detection_date == DAY and r.status == "Pending"}
    assert {r.detection_id for r in log.current().collect()} == want
    again, none = run()
    assert again.count() == none.count() == 0 and service.calls() == [1, 4]


def test_feedback_is_taken_once(spark, tmp_path):
    log = StatusLog(spark, f"file://{tmp_path}/log", "signal_id", "string")
    notifications = spark.createDataFrame([("S1", "Pending"), ("S2", "Pending"), ("S3", "Pending"), ("S4", "Processed")], "signal_id string, status string")
    states = spark.createDataFrame([("S1", "Afgehandeld", "done", "u", "2024-01-11 10:00:00"), ("S2", "Gemeld", None, None, None), ("S4", "Afgehandeld", "x", "u", "2024-01-11 10:00:00")], "signal_id string, state string, text string, user string, t string").withColumn("update_time", F.to_timestamp("t"))
    moved = steps.take_feedback(notifications, states, log)
    assert [(r.signal_id, r.status, r.text) for r in moved.collect()] == [("S1", "Afgehandeld", "done")]
    assert steps.take_feedback(notifications, states, log).count() == 0
    assert {r.signal_id: r.status for r in log.with_status(notifications).collect()} == {"S1": "Afgehandeld", "S2": "Pending", "S3": "Pending", "S4": "Processed"}


def test_only_active_districts_and_classes_are_chosen(spark):
    d = objects(spark)
    assert sorted(r.detection_id for r in steps.chosen(d.where("status = 'Pending'"), CONFIG, order()).collect() if r.detection_date == DAY)[:1] == [1]
    assert steps.chosen(d, {}, order()).count() == 0 and steps.chosen(d, {"centrum": steps.District({})}, order()).count() == 0
    every = steps.chosen(d, {"NOORD": steps.District({2: -1})}, order(), min_score=0.0).collect()
    assert {r.detection_id for r in every} == {k for k in range(1, 41) if k % 4 == 2}


def test_evaluation_of_all_splits_equals_each_alone(spark, tmp_path):
    r = random.Random(2)
    box = lambda: (x := r.randrange(60), y := r.randrange(40), x + r.randrange(2, 30), y + r.randrange(2, 30))
    gt = [(k, k // 3, 2 + k % 2, *map(float, box())) for k in range(150)]
    pred = [(k, g[1], g[2], r.randrange(8) / 8, *(c + r.randrange(-2, 3) for c in g[3:])) for k, g in enumerate(r.choices(gt, k=200))]
    cols = "x0 double, y0 double, x1 double, y1 double"
    g, p = spark.createDataFrame(gt, f"gt_id long, image_id long, object_class int, {cols}"), spark.createDataFrame(pred, f"pred_id long, image_id long, object_class int, score double, {cols}")
    name = lambda k: None if k % 10 == 9 else ("train", "val")[k % 2]
    images = spark.createDataFrame([(k, name(k)) for k in [*range(50), 3]], "image_id long, split string")
    sizes = evaluation.sizes_of(1.0, {2: (0.05, 0.2), 3: (0.04, 0.1)})
    tables = steps.evaluate(g, p, images, 90, 70, sizes)
    pixels = {n: {k: (a * 6300.0, b * 6300.0) for k, (a, b) in v.items()} for n, v in sizes.items()}
    rounded = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in df.collect())
    for split in ("train", "val"):
        keep = images.where(F.col("split") == split).select("image_id").distinct()
        a, b = g.join(keep, "image_id"), p.join(keep, "image_id")
        alone = evaluation.average_precision(evaluation.coco_match(a, b, areas=pixels), a, pixels)
        own = tables["objects"].where(F.col("split") == split).drop("split")
        assert own.columns == alone.columns and rounded(own) == rounded(alone) and own.count() > 50
        assert rounded(tables["summary"].where(F.col("split") == split).where("object_class = -1").select("metric", "value")) == rounded(evaluation.coco_summary(alone).select("metric", "value"))
    assert {x["split"] for x in tables["objects"].select("split").distinct().collect()} == {"train", "val"}
    steps.report(tables, str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out")) == ["images", "objects", "pixels", "summary"]
    assert {"True Positives", "Size"} <= set(spark.read.option("header", True).csv(str(tmp_path / "out/images")).columns)
