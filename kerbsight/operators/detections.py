"""Validity, thresholds, representatives, scores, ranking and status of detections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbsight.functions.text import repaired
from kerbsight.operators.spatial import clusters

#: Production thresholds by class, and what makes an object suspicious.
CONFIDENCE = {2: 0.82, 3: 0.83, 4: 0.82}
BOX_AREA = {2: 0.008, 3: 0.004, 4: 0.1}
CLUSTER_METRES = {2: 10.0, 3: 10.0, 4: 10.0}
SEND_LIMITS = {2: 4, 3: 3, 4: 3}
MIN_SCORE, MAX_DELAY, NEAR_METRES, FAR_METRES = 0.4, 5, 40.0, 100.0


def delay_seconds() -> Column:
    """Whole seconds from the position's time to the image's."""
    return F.col("image_timestamp").cast("timestamp").cast("long") - F.col("gps_timestamp").cast("timestamp").cast("long")


def _has_position() -> Column:
    return F.col("gps_lat").isNotNull() & F.col("gps_lon").isNotNull() & (F.col("gps_lat") != 0) & (F.col("gps_lon") != 0)


def valid_frames(frames: DataFrame) -> DataFrame:
    """Frames with a position that is at most ``MAX_DELAY`` seconds older than the image."""
    return frames.where(_has_position() & (delay_seconds() <= MAX_DELAY))


def invalid_frames(frames: DataFrame, mode: str = "reference") -> DataFrame:
    """``reference``: frames that fail both tests. ``partition``: all that aren't valid, null times included."""
    if mode == "partition":
        return frames.where(~F.coalesce(_has_position() & (delay_seconds() <= MAX_DELAY), F.lit(False)))
    bad = F.col("gps_lat").isNull() | F.col("gps_lon").isNull() | (F.col("gps_lat") == 0) | (F.col("gps_lon") == 0)
    return frames.where(bad & (delay_seconds() > MAX_DELAY))


def above(value: str, limits: dict[int, float], class_col: str = "object_class") -> Column:
    """Whether a value exceeds its class's limit; classes without one fail, no limits at all pass everything."""
    if not limits:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [(F.col(class_col) == k) & (F.col(value) > F.lit(t)) for k, t in limits.items()])


def representatives(clustered: DataFrame, cluster: list[str], id_col: str = "detection_id") -> DataFrame:
    """Of each cluster the detection with the largest box among those of at least mean confidence; ties to the least id."""
    w = Window.partitionBy(*cluster)
    good = clustered.withColumn("_mean", F.avg("confidence").over(w)).where(F.col("confidence") >= F.col("_mean"))
    return good.withColumn("_k", F.row_number().over(w.orderBy(F.desc("area"), id_col))).where("_k = 1").drop("_mean", "_k")


def score(class_col: str = "object_class", distance: str = "distance") -> Column:
    """0 for near or unknown permits and other classes, else the distance to the permit as a share of 100 m, at most 1."""
    far = F.col(class_col).isin(2, 3, 4) & (F.col(distance) >= NEAR_METRES)
    return F.when(far, F.least(F.lit(1.0), F.col(distance) / FAR_METRES)).otherwise(F.lit(0.0))


def colour(score_col: str = "score", muted: Column | None = None) -> Column:
    """Marker colour of a score; no score is one of 0. ``muted`` rows are gray."""
    c = F.when(F.coalesce(F.col(score_col), F.lit(0.0)) < MIN_SCORE, "green").when(F.col(score_col) < 1, "yellow").when(F.col(score_col) == 1, "orange").otherwise("red")
    return F.when(F.coalesce(muted, F.lit(False)), "gray").otherwise(c) if muted is not None else c


def in_district(district: str, column: str = "district") -> Column:
    """Whether a row is of a district, in upper or lower case."""
    return F.lower(F.col(column)) == F.lower(F.lit(district))


def shown_on_map(rows: DataFrame, confidence: float, size: float, max_delay: float) -> DataFrame:
    """Detections with their frame's times that a map shows: sure and large enough, with a position near in time.

    The delay counts in either direction, in seconds with their fractions; without times a row is left out.
    """
    delay = F.abs(F.unix_micros("image_timestamp") - F.unix_micros("gps_timestamp")) / 1e6
    return rows.withColumn("gps_delay", delay).where((F.col("confidence") > confidence) & (F.col("width") * F.col("height") > size) & (F.col("gps_delay") < max_delay))


def top_k(objects: DataFrame, limits: dict[int, int], by: list[str], order: list[Column], min_score: float = MIN_SCORE, private: str | None = None, skip_ids: DataFrame | None = None, id_col: str = "detection_id") -> DataFrame:
    """The best objects of each class within each group; a negative limit means none, a class without one is left out.

    ``private`` names a column: rows where it is true, or null, are left out. ``skip_ids`` are ids not to take.
    """
    if private:
        objects = objects.where(~F.col(private))
    if skip_ids is not None:
        objects = objects.join(skip_ids.select(id_col), id_col, "left_anti")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "object_class").orderBy(*order)))
    good = objects.where(F.col("score") >= min_score)
    bounded, unbounded = {c: n for c, n in limits.items() if n >= 0}, [c for c, n in limits.items() if n < 0]
    parts = []
    if bounded:
        own = F.create_map(*[F.lit(x) for kv in bounded.items() for x in kv])[F.col("object_class")]
        # The largest limit is a literal, so Spark drops what is beyond it before it shuffles and sorts whole groups.
        parts.append(ranked(good.where(F.col("object_class").isin(*bounded))).where((F.col("rank") <= max(bounded.values())) & (F.col("rank") <= own)))
    if unbounded:
        parts.append(ranked(good.where(F.col("object_class").isin(*unbounded))))
    return reduce(DataFrame.unionByName, parts) if parts else ranked(good.limit(0))


def with_status(rows: DataFrame, log: DataFrame, id_col: str) -> DataFrame:
    """Rows with their current status by an append-only log ``(id, status, processed_at)``; without an entry, their own."""
    last = log.groupBy(id_col).agg(F.max_by("status", "processed_at").alias("_status"))
    return rows.join(last, id_col, "left").withColumn("status", F.coalesce("_status", "status")).drop("_status")


def transition(rows: DataFrame, id_col: str, only: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Log entries that mark Pending rows as Processed: all, only the given ids (none if that table is empty), or others."""
    pending = rows.where(F.col("status") == "Pending").select(id_col)
    if only is not None:
        pending = pending.join(only.select(id_col).distinct(), id_col, "left_semi")
    if exclude is not None:
        pending = pending.join(exclude.select(id_col).distinct(), id_col, "left_anti")
    return pending.select(id_col, F.lit("Processed").alias("status"))


def kept_images(images: DataFrame, enriched: DataFrame, cutoff, min_score: float = MIN_SCORE) -> DataFrame:
    """Names of images that retention keeps: those of an enriched object of enough score since the cutoff."""
    return images.join(enriched.where((F.col("detection_date") >= F.lit(cutoff)) & (F.col("score") >= min_score)).select("image_name"), "image_name", "left_semi").select("image_name").distinct()


def deletable_images(candidates: DataFrame, kept: DataFrame, files: DataFrame) -> DataFrame:
    """Candidates that aren't kept and whose file is there."""
    return candidates.select("image_name").distinct().join(kept, "image_name", "left_anti").join(files.select("image_name").distinct(), "image_name", "left_semi")


def feedback(notifications: DataFrame, states: DataFrame, first: str = "Gemeld") -> tuple[DataFrame, DataFrame]:
    """Pending tickets by their present state: rows of those that moved on, and those that stay Pending.

    ``states`` has signal_id, state, text, user and update_time; tickets it doesn't have stay Pending.
    """
    joined = notifications.where(F.col("status") == "Pending").select("signal_id").join(states, "signal_id", "left")
    moved = F.coalesce(F.col("state") != first, F.lit(False))
    return joined.where(moved).select("signal_id", F.col("state").alias("status"), "text", "user", "update_time"), joined.where(~moved).select("signal_id")


def best_images(objects: DataFrame, detections: DataFrame) -> DataFrame:
    """``(object_id, object_class, image_name)``: of an object's images that with its class's largest box there.

    ``objects`` has object_id, object_class and image_name, one row for each image; without any detection of the class
    on its images an object keeps the first of them by name. Ties go to the first name.
    """
    keys = ["object_id", "object_class"]
    d = detections.groupBy("image_name", "object_class").agg(F.max("area").alias("area"))
    order = F.struct(F.coalesce(-F.col("area"), F.lit(float("inf"))), F.col("image_name"))
    return objects.join(d, ["image_name", "object_class"], "left").groupBy(*keys).agg(F.min_by("image_name", order).alias("image_name"))


def selected_images(images: DataFrame, detections: DataFrame, metres: float = 20.0, lat: str = "gps_lat", lon: str = "gps_lon") -> DataFrame:
    """``(cluster, object_class, image_id, n)``: of each cluster of images and each class that image with most detections.

    Images are clustered by steps of at most ``metres``; one that has no position is in no cluster and isn't selected. Ties
    go to the least id. Of images that repeat an id the place with the least coordinates counts.
    """
    placed = images.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy("image_id").agg(F.min(F.struct(F.col(lat).alias("la"), F.col(lon).alias("lo"))).alias("_p"))
    placed = clusters(placed.select("image_id", "_p.la", "_p.lo"), metres, [], "image_id", "la", "lo").select("image_id", "cluster")
    n = detections.groupBy("image_id", "object_class").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("image_id"))).alias("b")
    return n.join(placed, "image_id").groupBy("cluster", "object_class").agg(best).select("cluster", "object_class", "b.image_id", (-F.col("b.less")).alias("n"))


def of_selected(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Annotations or detections on any selected image."""
    return rows.join(selected.select("image_id").distinct(), "image_id", "left_semi")


def fixed_metadata(rows: DataFrame, classes: tuple[int, ...] = (2, 3, 4), coordinates: tuple[str, ...] = ("gps_lat", "gps_lon")) -> tuple[DataFrame, DataFrame]:
    """Rows of a hand-made metadata table with coordinates as numbers, and rows that are refused, with a ``reason``.

    A row needs a class, and one of ``classes``. Coordinates are text in which dots may have been put between thousands; one
    that is there but no number is refused, a missing one stays null.
    """
    named = rows.withColumns({f"_{c}": repaired(F.col(c).cast("string")) for c in coordinates})
    reason = F.when(F.col("object_class").isNull(), "no class").when(~F.col("object_class").isin(*classes), "unknown class")
    for c in coordinates:
        reason = reason.when(F.col(c).isNotNull() & F.col(f"_{c}").isNull(), f"{c} is no number")
    judged = named.withColumn("reason", reason)
    fixed = judged.where("reason is null").select(*[F.col(f"_{c}").alias(c) if c in coordinates else F.col(c) for c in rows.columns])
    return fixed, judged.where("reason is not null").select(*rows.columns, "reason")


def point_lookup(rows: DataFrame, key: str, value, *order: Column | str) -> DataFrame:
    """The first row of a key in the given order, any without one, or none; the predicate reaches the files."""
    found = rows.where(F.col(key) == F.lit(value))
    return (found.orderBy(*order) if order else found).limit(1)
