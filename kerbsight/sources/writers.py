"""Writers: tables by name, JSON documents, COCO, label lines, reports and deletions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbsight.functions.boxes import pixels_from_centre
from kerbsight.functions.text import label_line, stem
from kerbsight.functions.wkb import point_wkb
from kerbsight.operators.detections import MIN_SCORE
from kerbsight.operators.detections import colour as ops_colour
from kerbsight.operators.sampling import numbered


def append(df: DataFrame, table: str, schema: StructType, mode: str = "append") -> None:
    """Writes the schema's columns, by name and cast, to a catalog table."""
    df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode(mode).saveAsTable(table)


def landing_documents(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """``(image_name, document)``: a frame and its detections as one JSON text; frames without any have an empty list."""
    d = detections.groupBy("image_name").agg(F.array_sort(F.collect_list(F.struct("object_class", "confidence", "tracking_id", F.struct("x_center", "y_center", "width", "height").alias("boundingBox")))).alias("detections"))
    none = d.schema["detections"].dataType.simpleString()
    f = frames.join(d, "image_name", "left")
    gps = F.struct(F.col("gps_lat").alias("latitude"), F.col("gps_lon").alias("longitude"), F.col("gps_timestamp").cast("string").alias("coordinate_time_stamp")).alias("gps_data")
    doc = F.struct(F.col("image_name").alias("image_file_name"), F.col("image_timestamp").cast("string").alias("image_file_timestamp"), gps, F.coalesce("detections", F.expr(f"cast(array() as {none})")).alias("detections"))
    return f.select("image_name", F.to_json(doc).alias("document"))


def coco_predictions(boxes: DataFrame, min_score: float | None = None) -> DataFrame:
    """One JSON text for each prediction: image, category, pixel box, score. A missing score counts as 1."""
    b = boxes.withColumn("score", F.coalesce("score", F.lit(1.0)))
    b = b.where(F.col("score") >= min_score) if min_score else b
    box = F.array("x0", "y0", F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("bbox")
    return b.select(F.to_json(F.struct(F.col("image_id").cast("string").alias("image_id"), F.col("object_class").alias("category_id"), box, "score")).alias("value"))


def label_files(boxes: DataFrame, path: str) -> None:
    """Label text partitioned by image."""
    line = label_line(F.col("object_class"), *[F.col(c).cast("double") for c in ("x_center", "y_center", "width", "height")])
    boxes.select("image_name", line.alias("value")).write.partitionBy("image_name").text(path)


def report(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """A CSV report, one folder for each value of ``by``."""
    w = df.write.option("header", True)
    (w.partitionBy(*by) if by else w).csv(path)


def metrics(df: DataFrame, path: str, by: tuple[str, ...] = ("mode", "threshold")) -> None:
    """Metrics as JSON, one folder for each mode and threshold."""
    df.write.partitionBy(*by).json(path)


#: Icons of classes on a map.
ICONS = {2: "box", 3: "toilet-portable", 4: "table-cells"}


def map_rows(objects: DataFrame, min_score: float = MIN_SCORE, mute_private: bool = True) -> DataFrame:
    """Rows of a map of the objects of enough score: each object, its permit, and lines to its permit and its bridge.

    ``(kind, detection_id, priority, colour, icon, label, coordinates)``. Objects come with detection_id, object_class,
    score, gps_lat, gps_lon, private, permit_id, permit_lat, permit_lon, permit_distance, bridge_id, bridge_lat,
    bridge_lon and bridge_distance; what has no permit or bridge has no such rows. Priority is the place by score.
    """
    shown = numbered(objects.where(F.col("score") >= min_score), "priority", F.desc("score"), "detection_id")
    muted = F.col("private") if mute_private else F.lit(False)
    own, permit, bridge = (F.array(F.col(f"{p}_lon"), F.col(f"{p}_lat")) for p in ("gps", "permit", "bridge"))
    icon = F.coalesce(F.create_map(*[F.lit(x) for kv in ICONS.items() for x in kv])[F.col("object_class")], F.lit("info-sign"))
    row = lambda kind, colour, icon, label, *at: F.struct(F.lit(kind).alias("kind"), colour.alias("colour"), icon.alias("icon"), label.alias("label"), F.array(*at).alias("coordinates"))
    none = F.lit(None).cast("string")
    popup = F.concat(F.lit("Permit "), F.coalesce(F.col("permit_id").cast("string"), F.lit("-")), F.lit(", private ground: "), F.when(F.col("private"), "yes").otherwise("no"))
    away = lambda c: F.format_string("%.1fm", F.col(c))
    rows = [
        row("object", ops_colour(muted=muted), icon, popup, own),
        F.when(F.col("permit_id").isNotNull(), row("permit", F.lit("red"), none, F.concat(F.lit("Permit "), F.col("permit_id").cast("string")), permit)),
        F.when(F.col("permit_id").isNotNull(), row("permit_line", F.lit("green"), none, away("permit_distance"), own, permit)),
        F.when(F.col("bridge_id").isNotNull(), row("bridge_line", F.lit("blue"), none, away("bridge_distance"), own, bridge)),
    ]
    each = shown.withColumn("r", F.explode(F.array(*rows))).where("r is not null")
    return each.select("r.kind", "detection_id", "priority", "r.colour", "r.icon", "r.label", "r.coordinates")


def map_features(rows: DataFrame) -> DataFrame:
    """GeoJSON features of the rows of :func:`map_rows`: points, and lines where there are two places."""
    line = F.size("coordinates") > 1
    about = F.struct("kind", "detection_id", "priority", "colour", "icon", "label").alias("properties")
    of = lambda kind, c: F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit(kind).alias("type"), c.alias("coordinates")).alias("geometry"), about))
    return rows.select("detection_id", "kind", F.when(line, of("LineString", F.col("coordinates"))).otherwise(of("Point", F.col("coordinates")[0])).alias("value"))


def coco_dataset(images: DataFrame, detections: DataFrame, files: DataFrame, width: int, height: int, categories: dict[int, int], keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Images and annotations of a COCO dataset out of detections in centre form, with ids from 1 up.

    Images without a file, and their detections, are left out, as are detections of classes without a category. Images
    are numbered by name, annotations by image, then by detection_id; boxes are whole pixels. ``keep`` names
    columns of the detections that annotations keep.
    """
    there = images.select("image_name").distinct().join(files.select("image_name").distinct(), "image_name", "left_semi")
    i = numbered(there, "image_id", "image_name").select("image_id", F.col("image_name").alias("file_name"), F.lit(width).alias("width"), F.lit(height).alias("height"))
    category = F.create_map(*[F.lit(x) for kv in categories.items() for x in kv])[F.col("object_class")]
    box = pixels_from_centre(*[F.col(c).cast("double") for c in ("x_center", "y_center", "width", "height")], F.lit(width), F.lit(height))
    d = detections.select("image_name", *dict.fromkeys(("detection_id", *keep)), category.alias("category_id"), F.array(*box).alias("bbox")).where("category_id is not null")
    a = numbered(d.join(i.select("image_id", F.col("file_name").alias("image_name")), "image_name"), "id", "image_id", "detection_id")
    return i, a.select("id", "image_id", "category_id", "bbox", *keep)


def coco_lines(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """One JSON text for each image and annotation, by part of the dataset."""
    text = lambda df, part: df.select(F.lit(part).alias("part"), F.to_json(F.struct(*df.columns)).alias("value"))
    return text(images, "images").unionByName(text(annotations, "annotations"))


def sampling_metadata(frames: DataFrame, path: str, lat: str = "gps_lat", lon: str = "gps_lon") -> None:
    """Frames with their point as WKB (little endian), as Parquet."""
    frames.withColumn("geometry", point_wkb(F.col(lon), F.col(lat))).write.parquet(path)


def deliver(rows: DataFrame, send: Callable[[dict], str | None], id_col: str = "id") -> DataFrame:
    """``(id, signal_id, outcome)``: calls ``send`` for each row on the executors; what raises is a failure.

    Write the result before anything else reads it, so that each row is sent once.
    """

    def each(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    out.append((row[id_col], send(row), "sent"))
                except Exception:  # noqa: BLE001
                    out.append((row[id_col], None, "failed"))
            yield pd.DataFrame(out, columns=[id_col, "signal_id", "outcome"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(each, f"{id_col} {kind}, signal_id string, outcome string")


def delete_files(manifest: DataFrame, remove: Callable[[str], None], dry_run: bool = True, path_col: str = "path") -> DataFrame:
    """``(path, deleted)``: removes the manifest's files on the executors, or only lists them."""

    def each(batches: Iterator) -> Iterator:
        for pdf in batches:
            if not dry_run:
                for p in pdf[path_col]:
                    remove(p)
            yield pdf[[path_col]].assign(deleted=not dry_run)

    return manifest.select(path_col).mapInPandas(each, f"{path_col} string, deleted boolean")


def copy_files(manifest: DataFrame, copy: Callable[[str, str], None], dry_run: bool = True) -> DataFrame:
    """``(path, target, copied)``: copies a manifest's files on the executors, or only lists them; clashes aren't copied."""

    def each(batches: Iterator) -> Iterator:
        for pdf in batches:
            if not dry_run:
                for row in pdf[~pdf["clash"]].itertuples():
                    copy(row.path, row.target)
            yield pdf[["path", "target"]].assign(copied=~pdf["clash"] & (not dry_run))

    return manifest.select("path", "target", "clash").mapInPandas(each, "path string, target string, copied boolean")


def relative_coco(images: DataFrame, labels: DataFrame, prefix: str, web_prefix: str, captured: str) -> tuple[DataFrame, DataFrame]:
    """Images and annotations of a dataset for a labelling service, with boxes as shares of the image.

    ``images`` has folder, image_name, width and height; ``labels`` image_name without ending, object_class and centre
    boxes. Images are numbered by folder and name, annotations by image, then by class and box; categories count from 1.
    Addresses are a prefix and the file's name, with spaces escaped on the web; ``captured`` is the time that all carry.
    """
    file = F.concat_ws("/", "folder", "image_name")
    i = numbered(images.withColumn("file_name", file), "id", "file_name")
    web = F.concat(F.lit(web_prefix), F.replace("file_name", F.lit(" "), F.lit("%20")))
    out = i.select("id", "width", "height", "file_name", F.concat(F.lit(prefix), "file_name").alias("coco_url"), web.alias("absolute_url"), F.lit(captured).alias("date_captured"))
    x, y, w, h = (F.col(c).cast("double") for c in ("x_center", "y_center", "width", "height"))
    boxes = labels.select(stem(F.col("image_name")).alias("_stem"), (F.col("object_class") + 1).alias("category_id"), F.round(w * h, 10).alias("area"), F.array(x - w / 2, y - h / 2, w, h).alias("bbox"))
    a = boxes.join(i.select(F.col("id").alias("image_id"), stem(F.col("image_name")).alias("_stem")), "_stem")
    return out, numbered(a, "id", "image_id", "category_id", "bbox").select("id", "category_id", "image_id", "area", "bbox")
