"""Readers: landing JSON, label text, COCO JSON, GeoJSON, CSV and file listings, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbsight.functions import shapes, wkb
from kerbsight.functions.geo import rd_from_wgs84
from kerbsight.functions.text import basename, source_and_number, stem
from kerbsight.sources import rest
from kerbsight.sources.schemas import COCO, FRAMES, GEOJSON, LANDING, RECORDING, flat_columns


def pending(df: DataFrame) -> DataFrame:
    """Rows still to be processed; the predicate reaches the files."""
    return df.where(F.col("status") == "Pending")


def landing_json(spark: SparkSession, path: str) -> DataFrame:
    """One document for each image; unknown columns are ignored, documents that aren't JSON give all nulls."""
    return spark.read.schema(LANDING).option("multiLine", True).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).json(path)


def frames_of(landing: DataFrame) -> DataFrame:
    """Frames in the layout of the frames table. Times that can't be read are null."""
    time = lambda c: F.try_to_timestamp(F.col(c))
    return landing.where("image_file_name is not null").select(
        F.xxhash64("image_file_name").alias("frame_id"), F.col("image_file_name").alias("image_name"), time("image_file_timestamp").alias("image_timestamp"),
        F.col("gps_data.latitude").alias("gps_lat"), F.col("gps_data.longitude").alias("gps_lon"), time("gps_data.coordinate_time_stamp").alias("gps_timestamp"),
        "project.model_name", "project.aml_model_version", "project.project_version", "project.customer", F.lit("Pending").alias("status"),
    ).to(FRAMES)


def detections_of(landing: DataFrame) -> DataFrame:
    """One row for each detection, with an id by image and place; documents without detections give none."""
    d = landing.where("image_file_name is not null").select(F.col("image_file_name").alias("image_name"), F.posexplode("detections").alias("at", "d"))
    box = [F.col(f"d.boundingBox.{c}").alias(c) for c in ("x_center", "y_center", "width", "height")]
    return d.select(F.xxhash64("image_name", "at").alias("detection_id"), "image_name", "d.object_class", *box, "d.confidence", "d.tracking_id", F.lit("Pending").alias("status"))


def flattened(df: DataFrame) -> DataFrame:
    """All nested leaves as columns, dots in their names as underscores."""
    return df.select(*[F.col(c).alias(c.replace(".", "_")) for c in flat_columns(df.schema)])


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Label text: ``class xc yc w h [confidence] [track]``, one box a line; the image is the file's name."""
    part = F.split(F.trim("value"), r"\s+")
    get = lambda k, kind: F.get(part, F.lit(k)).try_cast(kind)
    rows = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).text(path).where(F.length(F.trim("value")) > 0)
    return rows.select(
        stem(basename(F.col("_metadata.file_path"))).alias("image_name"), get(0, "int").alias("object_class"), get(1, "double").alias("x_center"), get(2, "double").alias("y_center"),
        get(3, "double").alias("width"), get(4, "double").alias("height"), get(5, "double").alias("confidence"), get(6, "int").alias("tracking_id"),
    ).where("object_class is not null and height is not null")


def coco(spark: SparkSession, path: str, classes: tuple[int, ...] | None = None) -> DataFrame:
    """Annotations with their image's name, boxes in whole pixels truncated toward 0."""
    doc = spark.read.schema(COCO).option("multiLine", True).json(path)
    images = doc.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), "i.file_name", F.col("i.width").alias("image_width"), F.col("i.height").alias("image_height"))
    a = doc.select(F.explode("annotations").alias("a")).select(F.col("a.id").alias("annotation_id"), "a.image_id", F.col("a.category_id").alias("object_class"), *[F.col("a.bbox")[k].cast("int").alias(c) for k, c in enumerate(("x", "y", "w", "h"))])
    if classes:
        a = a.where(F.col("object_class").isin(*classes))
    return a.join(images, "image_id")


def geojson(spark: SparkSession, path: str, id_names: tuple[str, ...] = ("objectnummer", "rakcode")) -> DataFrame:
    """``(feature_id, type, coordinates, crs)``; the id is the first property there, or the feature's place in the file."""
    f = spark.read.schema(GEOJSON).option("multiLine", True).json(path).select(F.col("crs.properties.name").alias("crs"), F.posexplode("features").alias("at", "f"))
    return f.select(F.coalesce(*[F.col("f.properties")[n] for n in id_names], F.col("at").cast("string")).alias("feature_id"), F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("coordinates"), "crs")


def features(collection: DataFrame) -> DataFrame:
    """``(feature_id, rings, lines)`` on the metric grid, of the rows of :func:`geojson`.

    Rings are null for features that aren't areas, lines for points; what can't be read has neither. Collections without a
    reference system are in longitude and latitude; of systems other than that and the grid nothing is taken.
    """
    rings, lines = shapes.rings_of_geojson(F.col("type"), F.col("coordinates")), shapes.lines_of_geojson(F.col("type"), F.col("coordinates"))
    return collection.select("feature_id", shapes.on_grid(rings, F.col("crs")).alias("rings"), shapes.on_grid(lines, F.col("crs")).alias("lines"))


def public_ground(rows: DataFrame, geometry: str = "geometry", encumbered: str = "encumbered") -> DataFrame:
    """``(rings)``: the shapes of public ground, from WKB text on the metric grid.

    Rows count whose flag is false; true and null are left out, and so are geometries that can't be read or aren't areas.
    """
    return rows.where(~F.col(encumbered)).select(wkb.rings_of(F.col(geometry)).alias("rings")).where("rings is not null")


def districts(items: DataFrame, crs: str = "EPSG:28992", code: str = "code", name: str = "naam", geometry: str = "geometrie") -> DataFrame:
    """``(district_code, district, rings)`` on the metric grid, from items of the district service.

    The geometry is JSON text of a Polygon or MultiPolygon in the given system; districts without a readable one are left
    out, as nothing could lie in them.
    """
    g = F.from_json(F.col(geometry), "type string, coordinates string")
    rings = shapes.on_grid(shapes.rings_of_geojson(g["type"], g["coordinates"]), F.lit(crs))
    return items.select(F.col(code).alias("district_code"), F.col(name).alias("district"), rings.alias("rings")).where("rings is not null")


def district_service(spark: SparkSession, url: str, items: str = "_embedded.stadsdelen", **options: str) -> DataFrame:
    """The districts of a paged service, as :func:`districts` has them; options are those of ``rest.Options``."""
    spark.dataSource.register(rest.PagedJson)
    read = spark.read.format("paged_json").options(url=url, items=items, **options).schema("code string, naam string, geometrie string")
    return districts(read.load())


def csv(spark: SparkSession, paths: str | list[str], schema: StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """CSV files with a header; rows in which a required column is null are left out, and files that lack one refused."""
    if required:
        there = spark.read.option("header", True).csv(paths).columns
        if lost := [c for c in required if c not in there]:
            raise ValueError(f"missing columns: {lost}")
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(paths)
    return df.dropna(subset=list(required)) if required else df


def manual_run(landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Frames and detections of a manual run's documents."""
    frames = landing.select(F.col("image_file_name").alias("image_name"), F.col("gps_data.latitude").alias("gps_lat"), F.col("gps_data.longitude").alias("gps_lon"))
    return frames, landing.select(F.col("image_file_name").alias("image_name"), F.explode("detections.object_class").alias("object_class"))


def image_files(spark: SparkSession, path: str, ignored: tuple[str, ...] = ()) -> DataFrame:
    """Image files below a folder without their content: path, name, folder, source and number in the name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    source, number = source_and_number(F.col("image_name"))
    named = files.where(F.col("path").rlike(r"(?i)\.(jpe?g|png)$")).withColumn("image_name", F.substring_index("path", "/", -1))
    for name in ignored:
        named = named.where(~F.col("path").contains(f"/{name}/"))
    return named.withColumns({"folder": F.element_at(F.split("path", "/"), -2), "source": source, "number": number})


def recordings(spark: SparkSession, path: str, max_delay: float = 5.0) -> DataFrame:
    """Frames of recording documents ``{data_path, frames: [...]}``, with the recording's name and the position's delay.

    The name is the last folder but one of the data path. Times that can't be read are null, and so is the delay then.
    """
    doc = spark.read.schema(RECORDING).option("multiLine", True).json(path)
    f = doc.select(F.element_at(F.split("data_path", "/"), -2).alias("recording_name"), basename(F.col("_metadata.file_path")).alias("metadata_file"), F.explode("frames").alias("f"))
    time = lambda c: F.try_to_timestamp(F.col(c))
    rows = f.select("recording_name", "metadata_file", time("f.record_timestamp").alias("record_timestamp"), time("f.image_file_timestamp").alias("image_timestamp"), F.col("f.gps_data.latitude").alias("gps_lat"), F.col("f.gps_data.longitude").alias("gps_lon"), time("f.gps_data.coordinate_time_stamp").alias("gps_timestamp"))
    delay = (F.unix_micros("image_timestamp") - F.unix_micros("gps_timestamp")) / 1e6
    return rows.withColumn("gps_delay", delay).withColumn("accept_delay", F.col("gps_delay") <= max_delay)


def tracker(rows: DataFrame) -> DataFrame:
    """Tracker output (path, frame, ...) with the image's base name and frames counted from 1."""
    return rows.withColumns({"image_name": basename(F.col("path")), "frame": F.col("frame") + 1}).drop("path")


def broken(landing: DataFrame) -> DataFrame:
    """How many documents could be read and how many couldn't: ``(n, n_broken)``."""
    return landing.agg(F.count("*").alias("n"), F.count_if(F.col("image_file_name").isNull()).alias("n_broken"))


def frame_metadata(spark: SparkSession, path: str, schema: StructType, exclude_folders: tuple[str, ...] = (), exclude_files: tuple[str, ...] = ()) -> DataFrame:
    """Metadata CSV files below a folder, with each position on the metric grid (x, y) and the file's name.

    Files in an excluded folder, or with an excluded text in their name, are left out; rows without a position stay,
    with null coordinates.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    df = reader.csv(path).withColumn("_file", F.col("_metadata.file_path"))
    folder, name = F.element_at(F.split("_file", "/"), -2), F.element_at(F.split("_file", "/"), -1)
    for x in exclude_folders:
        df = df.where(folder != x)
    for x in exclude_files:
        df = df.where(~F.contains(name, F.lit(x)))
    gx, gy = rd_from_wgs84(F.col("gps_lat"), F.col("gps_lon"))
    return df.withColumns({"x": gx, "y": gy, "metadata_file": name}).drop("_file")


def jdbc(spark: SparkSession, url: str, sql: str, **options: str) -> DataFrame:
    """A database query as one partition, for results that are small by nature."""
    return spark.read.format("jdbc").options(url=url, query=sql, **options).load()


def jdbc_ranges(spark: SparkSession, url: str, sql: str, key: str, rows_each: int = 100_000, most: int = 200, **options: str) -> DataFrame:
    """A database query in ranges of an integer key, about ``rows_each`` rows a partition, at most ``most`` partitions.

    The database tells the least and largest key and the number of rows first. Rows without a key come in the first range,
    keys outside the bounds by the time of reading in the outer ones, so nothing is left out.
    """
    ends = f"select min(q.{key}) as lo, max(q.{key}) as hi, count(*) as n from ({sql}) q"
    lo, hi, n = jdbc(spark, url, ends, **options).first()
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({sql}) q", **options)
    parts = min(most, -(-int(n) // rows_each))
    if lo is None or parts < 2 or lo == hi:
        return reader.load()
    return reader.options(partitionColumn=key, lowerBound=str(lo), upperBound=str(int(hi) + 1), numPartitions=str(parts)).load()


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def jdbc_lookup(spark: SparkSession, url: str, sql: str, keys: DataFrame, batch: int = 500, most_keys: int = 20_000, range_key: str | None = None, **options: str) -> DataFrame:
    """The rows of a database query whose key columns, one or more, are among ``keys``, each once.

    Up to ``most_keys`` different keys are asked for in batches, one partition each, so the database reads by its index.
    Beyond that the query is read whole, in ranges of ``range_key`` where one is given, and joined in Spark. Null keys
    match nothing.
    """
    wanted = keys.dropna().distinct()
    names, found = keys.columns, wanted.limit(most_keys + 1).collect()
    if len(found) > most_keys:
        whole = jdbc_ranges(spark, url, sql, range_key, **options) if range_key else spark.read.format("jdbc").options(url=url, dbtable=f"({sql}) q", **options).load()
        known = {c.lower(): c for c in whole.columns}
        return whole.join(wanted.withColumnsRenamed({c: known[c.lower()] for c in names}), [known[c.lower()] for c in names], "left_semi")
    if not found:
        return spark.read.format("jdbc").options(url=url, query=f"select * from ({sql}) q where 1 = 0", **options).load()
    if len(names) == 1:
        test = lambda rows: f"{names[0]} in ({', '.join(_literal(r[0]) for r in rows)})"
    else:
        test = lambda rows: " or ".join("(" + " and ".join(f"{c} = {_literal(v)}" for c, v in zip(names, r, strict=True)) + ")" for r in rows)
    ordered = sorted(found)
    parts = [test(ordered[k : k + batch]) for k in range(0, len(ordered), batch)]
    return spark.read.jdbc(url, f"({sql}) q", predicates=parts, properties=options)
