"""Landing documents into three tables in one pass: frames, detections, and what was refused, with the reason.

One stream reads each file once. Every micro-batch is written by ``foreachBatch`` as a partition ``batch`` of each table,
replacing that partition only: Spark gives a batch that is repeated after a failure the same number and the same files,
so whatever part of it had been written before is written over, and each row is there once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbsight.sources.readers import detections_of, frames_of
from kerbsight.sources.schemas import DETECTIONS, FRAMES, LANDING, fields

CORRUPT = "_corrupt"
#: A reject: a document (``at`` null) or its ``at``-th detection, why, and its text as far as it is known.
REJECTS = fields({"path": "string", "image_name": "string", "at": "integer", "reason": "string", "document": "string"})
#: Tables have no option of their own for this; with "dynamic" only the partitions that are written are replaced.
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
#: Longest text of a refused document that is kept with its reason; the file itself stays where it is.
MOST_TEXT = 10_000


@dataclass(frozen=True)
class Tables:
    """Names of the three tables."""

    frames: str
    detections: str
    rejects: str


def checked(stream_or_batch: DataFrame) -> DataFrame:
    """Documents with their path and ``reason``, why a document as a whole is refused; null for good ones."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "not JSON of the expected types").when(F.coalesce(F.trim("image_file_name"), F.lit("")) == "", "no image name")
    reason = reason.when(F.col("image_file_timestamp").isNotNull() & F.try_to_timestamp(F.col("image_file_timestamp")).isNull(), "image time can't be read")
    gps = F.col("gps_data")
    reason = reason.when(~F.coalesce(gps["latitude"].between(-90, 90) & gps["longitude"].between(-180, 180), F.lit(True)), "position outside the earth")
    return stream_or_batch.withColumn("reason", reason)


def _fault(d: Column) -> Column:
    """Why a detection is refused; null for good ones."""
    box = d["boundingBox"]
    whole = box.isNotNull()
    for c in ("x_center", "y_center", "width", "height"):
        whole &= F.coalesce(box[c].between(0, 1), F.lit(False))
    sure = F.coalesce(d["confidence"].between(0, 1), F.lit(True))
    return F.when(d.isNull() | d["object_class"].isNull(), "no class").when(~whole, "no box within the image").when(~sure, "confidence outside 0 to 1")


def split(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frames, detections and rejects of checked documents. A document's good detections stay when others are refused.

    Of documents of one batch with the same image name that with the least path counts; the others are refused.
    """
    named = docs.where("reason is null").groupBy("image_file_name").agg(F.min("path").alias("_first"))
    ranked = docs.join(named, "image_file_name", "left").withColumn("reason", F.coalesce("reason", F.when(F.col("path") != F.col("_first"), "image name repeats"))).drop("_first")
    good = ranked.where("reason is null")
    text = F.substring(F.coalesce(CORRUPT, F.to_json(F.struct(*[f.name for f in LANDING.fields]))), 1, MOST_TEXT)
    whole = ranked.where("reason is not null").select("path", F.col("image_file_name").alias("image_name"), F.lit(None).cast("int").alias("at"), "reason", text.alias("document"))
    faulty = good.select("path", "image_file_name", F.posexplode("detections").alias("at", "d")).withColumn("reason", _fault(F.col("d"))).where("reason is not null")
    parts = faulty.select("path", F.col("image_file_name").alias("image_name"), "at", "reason", F.to_json("d").alias("document"))
    faults = F.transform("detections", _fault)
    marked = good.withColumn("detections", F.transform("detections", lambda d, i: F.when(F.get(faults, i).isNull(), d)))
    kept = detections_of(marked).where("object_class is not null").withColumn("frame_id", F.xxhash64("image_name"))
    return frames_of(good), kept, whole.unionByName(parts)


def documents(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream of documents with their path; what can't be read is in the column ``_corrupt``."""
    schema = StructType([*LANDING.fields]).add(CORRUPT, "string")
    reader = spark.readStream.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", "*.json").option("ignoreMissingFiles", True)
    found = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).json(path)
    return found.withColumn("path", F.col("_metadata.file_path"))


def _prepared(spark: SparkSession, table: str, schema: StructType) -> None:
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("long"))
        empty.write.partitionBy("batch").format("parquet").saveAsTable(table)


def put(rows: DataFrame, table: str, schema: StructType, batch: int) -> None:
    """Writes the schema's columns as the table's partition of that batch, in place of what it had."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    conf = rows.sparkSession.conf
    before = conf.get(_OVERWRITE)
    conf.set(_OVERWRITE, "dynamic")
    try:
        rows.select(*columns, F.lit(batch).cast("long").alias("batch")).write.mode("overwrite").insertInto(table)
    finally:
        conf.set(_OVERWRITE, before)


def ingest_with_rejects(spark: SparkSession, path: str, tables: Tables, checkpoint: str, max_files: int | None = None, timeout_s: int = 600) -> dict[str, int]:
    """Reads what is there now and returns how many rows the run added to each table.

    A second run adds nothing. A run that fails midway leaves part of a batch behind, which the next run replaces. Every
    document ends as a frame or as a reject, and every detection of a frame as a detection or as a reject.
    """
    added = {"frames": 0, "detections": 0, "rejects": 0}
    layout = {"frames": FRAMES, "detections": DETECTIONS, "rejects": REJECTS}
    for name, schema in layout.items():
        _prepared(spark, getattr(tables, name), schema)

    def write(batch: DataFrame, number: int) -> None:
        docs = checked(batch).persist()
        try:
            for name, rows in zip(layout, split(docs), strict=True):
                table = getattr(tables, name)
                put(rows, table, layout[name], number)
                added[name] += batch.sparkSession.table(table).where(F.col("batch") == number).count()
        finally:
            docs.unpersist()

    query = documents(spark, path, max_files).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"{path} took more than {timeout_s} s")
    for name in layout:  # batches run in a session of their own; this one may remember files that they replaced
        spark.catalog.refreshTable(getattr(tables, name))
    return added
