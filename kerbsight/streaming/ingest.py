"""Streaming ingestion of landing documents into frame and detection tables."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from kerbsight.sources.readers import detections_of, frames_of
from kerbsight.sources.schemas import LANDING


def landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New JSON documents of a folder, each once for a checkpoint; a truncated document gives an all-null row."""
    reader = spark.readStream.schema(LANDING).option("multiLine", True).option("pathGlobFilter", "*.json").option("ignoreMissingFiles", True)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).json(path)


class _Rows(StreamingQueryListener):
    """Adds up the rows that one query reads; a query itself only remembers its last hundred batches."""

    def __init__(self):
        self.rows, self.ended = {}, defaultdict(threading.Event)

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.ended[str(event.runId)].set()


def to_table(stream: DataFrame, table: str, checkpoint: str, timeout_s: int = 60) -> int:
    """Appends what is there now and returns the number of rows read; raises if that takes longer than the timeout."""
    listener, streams = _Rows(), stream.sparkSession.streams
    streams.addListener(listener)
    try:
        q: StreamingQuery = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).toTable(table)
        if not q.awaitTermination(timeout_s):
            q.stop()
            raise TimeoutError(f"{table} took more than {timeout_s} s")
        run = str(q.runId)
        if not listener.ended[run].wait(30):
            raise TimeoutError(f"no report of the end of {table}")
        return listener.rows.get(run, 0)
    finally:
        streams.removeListener(listener)


def ingest(spark: SparkSession, path: str, frames_table: str, detections_table: str, checkpoints: str, timeout_s: int = 60) -> tuple[int, int]:
    """Frames first, then detections joined with the frames that are Pending by now; returns the rows read by either.

    Each stream has its own checkpoint, so a second run adds nothing. Images of one name appear once as a frame within a
    run's files and keep their detections.
    """
    n = to_table(frames_of(landing_stream(spark, path)), frames_table, f"{checkpoints}/frames", timeout_s)
    pending = spark.table(frames_table).where("status = 'Pending'").select("frame_id", "image_name")
    detections = detections_of(landing_stream(spark, path)).join(pending, "image_name", "left")
    return n, to_table(detections, detections_table, f"{checkpoints}/detections", timeout_s)


def unique_images(stream: DataFrame, time_col: str = "image_timestamp", delay: str = "1 hour") -> DataFrame:
    """Frames with each image name once within the watermark."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["image_name"])


def counts_by_window(stream: DataFrame, time_col: str = "image_timestamp", width: str = "10 minutes", delay: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Images by tumbling window, or by windows that begin every ``slide``; later than the watermark is left out."""
    w = F.window(time_col, width, slide)
    return stream.withWatermark(time_col, delay).groupBy(w).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def counts_by_session(stream: DataFrame, key: str, time_col: str = "image_timestamp", gap: str = "5 minutes", delay: str = "1 hour") -> DataFrame:
    """Images by session of a key: runs without a gap of that length."""
    w = F.session_window(time_col, gap).alias("window")
    return stream.withWatermark(time_col, delay).groupBy(key, w).agg(F.count("*").alias("n")).select(key, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")
