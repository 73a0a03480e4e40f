"""Readers, writers and the streaming ingestion."""

import json

import pytest
from pyspark.sql import functions as F

from kerbsight.sources import readers, schemas, writers
from kerbsight.streaming import ingest


def document(name, n=2, **more):
    return {"image_file_name": name, "image_file_timestamp": "2024-01-01T00:00:05Z", "gps_data": {"latitude": 52.3, "longitude": 4.9, "coordinate_time_stamp": "2024-01-01T00:00:00Z"}, "project": {"model_name": "m", "aml_model_version": 3, "project_version": "1", "customer": "c"}, "detections": [{"object_class": 2 + k, "confidence": 0.5, "tracking_id": k, "boundingBox": {"x_center": 0.1, "y_center": 0.2, "width": 0.3, "height": 0.4}} for k in range(n)], "surprise": 1} | more


def put(folder, name, text):
    (folder / f"{name}.json").write_text(text if isinstance(text, str) else json.dumps(text))


def test_landing_documents(spark, tmp_path):
    put(tmp_path, "a", document("a.jpg"))
    put(tmp_path, "b", document("b.jpg", 0, image_file_timestamp="no time"))
    put(tmp_path, "c", document("c.jpg", gps_data=None, detections=None))
    put(tmp_path, "d", '{"image_file_name": "d.jp')
    docs = readers.landing_json(spark, str(tmp_path))
    frames = {r.image_name: r for r in readers.frames_of(docs).collect()}
    assert set(frames) == {"a.jpg", "b.jpg", "c.jpg"}
    assert frames["b.jpg"].image_timestamp is None and frames["c.jpg"].gps_lat is None and frames["a.jpg"].aml_model_version == 3
    assert [r.object_class for r in readers.detections_of(docs).orderBy("object_class").collect()] == [2, 3]
    assert "gps_data_latitude" in readers.flattened(docs.drop("detections")).columns


def test_stream_twice_and_with_new_files(spark, tmp_path):
    landing, checkpoints = tmp_path / "in", str(tmp_path / "checkpoints")
    landing.mkdir()
    put(landing, "a", document("a.jpg"))
    put(landing, "bad", "{")
    run = lambda: ingest.ingest(spark, str(landing), "stream_frames", "stream_detections", checkpoints)
    assert run() == (2, 2)
    assert spark.table("stream_frames").count() == 1 and spark.table("stream_detections").count() == 2
    assert run() == (0, 0)
    put(landing, "b", document("b.jpg", 3))
    run()
    assert spark.table("stream_frames").count() == 2 and spark.table("stream_detections").where("frame_id is not null").count() == 5
    spark.sql("drop table stream_frames")
    spark.sql("drop table stream_detections")


def test_stream_drops_repeated_images(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    put(landing, "a", document("a.jpg"))
    put(landing, "b", document("a.jpg"))
    frames = ingest.unique_images(readers.frames_of(ingest.landing_stream(spark, str(landing))))
    ingest.to_table(frames, "unique_frames", str(tmp_path / "c"))
    assert spark.table("unique_frames").count() == 1
    spark.sql("drop table unique_frames")


def test_landing_round_trip(spark, tmp_path):
    put(tmp_path, "a", document("a.jpg"))
    put(tmp_path, "b", document("b.jpg", 0))
    docs = readers.landing_json(spark, str(tmp_path))
    out = writers.landing_documents(readers.frames_of(docs), readers.detections_of(docs))
    again = out.select(F.from_json("document", schemas.LANDING).alias("d")).select("d.*")
    assert sorted(r.image_name for r in readers.frames_of(again).collect()) == ["a.jpg", "b.jpg"]
    assert readers.detections_of(again).count() == 2


def test_labels_round_trip(spark, tmp_path):
    boxes = spark.createDataFrame([("a", 2, 0.5, 0.5, 0.1, 0.2), ("b", 3, 0.25, 0.5, 0.1, 0.2)], "image_name string, object_class int, x_center double, y_center double, width double, height double")
    writers.label_files(boxes, str(tmp_path / "labels"))
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "x.txt").write_text("2 0.5 0.5 0.1 0.2 0.9 7\n\nnot a box\n")
    r = readers.labels(spark, str(tmp_path / "plain")).collect()
    assert [(x.image_name, x.object_class, x.confidence, x.tracking_id) for x in r] == [("x", 2, 0.9, 7)]
    assert readers.labels(spark, str(tmp_path / "labels")).count() == 2


def test_coco_geojson_csv_and_files(spark, tmp_path):
    (tmp_path / "coco.json").write_text(json.dumps({"images": [{"id": "i", "width": 10, "height": 10, "file_name": "i.jpg"}], "annotations": [{"id": 1, "image_id": "i", "category_id": 2, "bbox": [1.9, 2, 3, 4]}, {"id": 2, "image_id": "i", "category_id": 5, "bbox": [1, 2, 3, 4]}]}))
    assert [(r.annotation_id, r.x) for r in readers.coco(spark, str(tmp_path / "coco.json"), (2,)).collect()] == [(1, 1)]
    (tmp_path / "g.geojson").write_text(json.dumps({"features": [{"geometry": {"type": "Point", "coordinates": [4, 52]}, "properties": {"rakcode": "R1"}}, {"geometry": {"type": "Point", "coordinates": [4, 52]}, "properties": {}}]}))
    assert sorted(r.feature_id for r in readers.geojson(spark, str(tmp_path / "g.geojson")).collect()) == ["1", "R1"]
    (tmp_path / "m.csv").write_text("image_name,gps_lat\na,1.5\n,2.5\n")
    assert readers.csv(spark, str(tmp_path / "m.csv"), schemas.fields({"image_name": "string", "gps_lat": "double"}), ("image_name",)).count() == 1
    (tmp_path / "2024-01-01").mkdir()
    (tmp_path / "2024-01-01" / "run_0007.JPG").write_bytes(b"x")
    assert [(r.source, r.number, r.folder) for r in readers.image_files(spark, str(tmp_path)).collect()] == [("run", 7, "2024-01-01")]


def test_delivery_and_deletion(spark, tmp_path):
    def send(row):
        if row["id"] == 2:
            raise ValueError
        return f"S{row['id']}"

    got = {r.id: (r.signal_id, r.outcome) for r in writers.deliver(spark.range(1, 4), send).collect()}
    assert got == {1: ("S1", "sent"), 2: (None, "failed"), 3: ("S3", "sent")}
    f = tmp_path / "x"
    f.write_text("x")
    manifest = spark.createDataFrame([(str(f),)], "path string")
    assert [r.deleted for r in writers.delete_files(manifest, lambda p: None).collect()] == [False]


def test_schemas():
    assert "frame_id" not in schemas.without(schemas.FRAMES, "frame_id").names
    assert "gps_data.latitude" in schemas.flat_columns(schemas.LANDING)


def test_broken_documents_are_counted(spark, tmp_path):
    put(tmp_path, "a", document("a.jpg"))
    put(tmp_path, "bad", "{")
    assert tuple(readers.broken(readers.landing_json(spark, str(tmp_path))).first()) == (2, 1)


def test_recordings_and_tracker(spark, tmp_path):
    frame = lambda t, g: {"record_timestamp": t, "image_file_timestamp": t, "gps_data": {"latitude": 52.0, "longitude": 4.0, "coordinate_time_stamp": g}}
    put(tmp_path, "rec", {"data_path": "/data/run 7/images", "frames": [frame("2024-01-01T00:00:05Z", "2024-01-01T00:00:01Z"), frame("2024-01-01T00:00:09.5Z", "2024-01-01T00:00:01Z"), frame("no", "no")]})
    got = readers.recordings(spark, str(tmp_path)).collect()
    assert [(r.recording_name, r.metadata_file, r.gps_delay, r.accept_delay) for r in got] == [("run 7", "rec.json", 4.0, True), ("run 7", "rec.json", 8.5, False), ("run 7", "rec.json", None, None)]
    t = readers.tracker(spark.createDataFrame([("a/b/x.jpg?s=1", 0)], "path string, frame int")).first()
    assert (t.image_name, t.frame) == ("x.jpg", 1)


def test_csv_without_a_required_column_is_refused(spark, tmp_path):
    (tmp_path / "m.csv").write_text("image_name\na\n")
    with pytest.raises(ValueError, match="gps_lat"):
        readers.csv(spark, str(tmp_path / "m.csv"), schemas.fields({"image_name": "string", "gps_lat": "double"}), ("gps_lat",))


def test_manual_run_and_tables(spark, tmp_path):
    put(tmp_path, "a", document("a.jpg"))
    frames, found = readers.manual_run(readers.landing_json(spark, str(tmp_path)))
    assert frames.first().gps_lat == 52.3 and sorted(r.object_class for r in found.collect()) == [2, 3]
    rows = readers.detections_of(readers.landing_json(spark, str(tmp_path)))
    writers.append(rows.withColumn("more", F.lit(1)), "appended", schemas.without(schemas.DETECTIONS, "frame_id"))
    assert "more" not in spark.table("appended").columns and spark.table("appended").count() == 2
    spark.sql("drop table appended")
    boxes = spark.createDataFrame([(1, 2, None, 1.0, 2.0, 4.0, 8.0), (1, 2, 0.1, 0.0, 0.0, 1.0, 1.0)], "image_id int, object_class int, score double, x0 double, y0 double, x1 double, y1 double")
    assert [json.loads(r.value) for r in writers.coco_predictions(boxes, 0.5).collect()] == [{"image_id": "1", "category_id": 2, "bbox": [1.0, 2.0, 3.0, 6.0], "score": 1.0}]


def test_frame_metadata_below_a_folder(spark, tmp_path):
    for folder, name in (("good", "a"), ("good", "a_copy"), ("skip", "b")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"{name}.csv").write_text("frame_id,gps_lat,gps_lon\n1,52.37,4.9\n2,,\n")
    schema = schemas.fields({"frame_id": "long", "gps_lat": "double", "gps_lon": "double"})
    got = readers.frame_metadata(spark, str(tmp_path), schema, ("skip",), ("copy",)).collect()
    assert [(r.frame_id, r.metadata_file, r.x and round(r.x, -3), r.y and round(r.y, -3)) for r in got] == [(1, "a.csv", 122000.0, 487000.0), (2, "a.csv", None, None)]


def test_windows_and_sessions(spark):
    t = lambda *m: spark.createDataFrame([("k", f"2024-01-01 00:{x:02d}:00") for x in m], "k string, t string").select("k", F.to_timestamp("t").alias("image_timestamp"))
    d = t(1, 2, 12, 30)
    assert sorted((r.start.minute, r.n) for r in ingest.counts_by_window(d).collect()) == [(0, 2), (10, 1), (30, 1)]
    assert sorted(r.n for r in ingest.counts_by_window(d, slide="5 minutes").collect()) == [1, 1, 1, 1, 2, 2]
    assert sorted((r.start.minute, r.n) for r in ingest.counts_by_session(d, "k").collect()) == [(1, 2), (12, 1), (30, 1)]


def test_metrics_by_mode_and_threshold(spark, tmp_path):
    d = spark.createDataFrame([("binary", 0.5, 0.9), ("image", 0.5, 0.8)], "mode string, threshold double, recall double")
    writers.metrics(d, str(tmp_path / "m"))
    assert sorted((r.mode, r.recall) for r in spark.read.json(str(tmp_path / "m")).collect()) == [("binary", 0.9), ("image", 0.8)]
