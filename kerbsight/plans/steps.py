"""The bodies of scheduled steps as plans over tables: sending what was found, taking over what became of it, evaluating."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.operators import detections as ops
from kerbsight.operators import evaluation
from kerbsight.operators.scratch import written
from kerbsight.operators.status_log import StatusLog
from kerbsight.sources import writers
from kerbsight.sources.outbox import SENT, deliver_once


@dataclass(frozen=True)
class District:
    """What is sent of a district: the most objects of each class; a negative number means all."""

    limits: dict[int, int] = field(default_factory=lambda: dict(ops.SEND_LIMITS))


def chosen(objects: DataFrame, config: dict[str, District], order: list[Column], private: str | None = None, skip_ids: DataFrame | None = None, min_score: float = ops.MIN_SCORE) -> DataFrame:
    """The best objects of every district that is active, with their rank; districts are told apart without their case.

    Districts of the same limits are one plan, so there are as many plans as different limits, not as districts.
    """
    parts: dict[tuple, list[str]] = {}
    for name, d in config.items():
        if d.limits:
            parts.setdefault(tuple(sorted(d.limits.items())), []).append(name.lower())
    named = lambda names: objects.where(F.lower("district").isin(*names)).withColumn("_district", F.lower("district"))
    best = [ops.top_k(named(names), dict(limits), ["_district"], order, min_score, private, skip_ids).drop("_district") for limits, names in parts.items()]
    return reduce(DataFrame.unionByName, best) if best else objects.limit(0).withColumn("rank", F.lit(0))


def submit(objects: DataFrame, log: StatusLog, config: dict[str, District], send: Callable[[dict], str | None], outbox: str, day, order: list[Column], processed_at: Column | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Sends the best Pending objects of a day: ``(notifications, quarantine)``, and a log entry for all that was Pending.

    ``objects`` has detection_id, object_class, district, score, status and detection_date. Everything Pending of the day in
    active districts becomes Processed, sent or not. A step that died is run again as it was: what was sent before is
    answered from the outbox, so nothing is sent twice, and the log gets its entries once the results are written.
    ``options`` are those of :func:`chosen` and ``deliver_once``.
    """
    kept = {k: options[k] for k in ("private", "skip_ids", "min_score") if k in options}
    active = [name.lower() for name in config]
    today = objects.where((F.col("detection_date") == F.lit(day)) & F.lower("district").isin(*active))
    pending = written(log.with_status(today).where("status = 'Pending'"), "pending")
    best = written(chosen(pending, config, order, **kept), "chosen")
    results = deliver_once(best, send, outbox, id_col="detection_id", **{k: v for k, v in options.items() if k not in kept})
    told = written(best.join(results, "detection_id"), "told")
    log.append(pending.select("detection_id", F.lit("Processed").alias("status"), (processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at")))
    return told.where(F.col("outcome") == SENT), told.where(F.col("outcome") != SENT)


def take_feedback(notifications: DataFrame, states: DataFrame, log: StatusLog, first: str = "Gemeld") -> DataFrame:
    """Rows of tickets that moved on, for the feedback table; the log gets their new status, at the time it changed.

    Tickets that the service doesn't know, or that are where they began, stay Pending. A second run adds nothing, as tickets
    with an entry aren't Pending any more.
    """
    known = log.with_status(notifications)
    moved, _ = ops.feedback(known, states, first)
    moved = written(moved, "feedback")
    if not moved.isEmpty():
        log.append(moved.select(F.col("signal_id").alias(log.id_col), "status", F.col("update_time").alias("processed_at")))
    return moved


def evaluate(gt: DataFrame, pred: DataFrame, images: DataFrame, width: int, height: int, sizes: evaluation.Areas, by: str = "split") -> dict[str, DataFrame]:
    """All statistics of a model for every split at once, by name: images, pixels, objects and summary.

    Boxes have image_id, object_class and corners, predictions a score; ``images`` has image_id and the split. ``sizes`` are
    shares of an image. Images without a split are left out. Splits are a column of each plan, so
    there is no loop over them.
    """
    scale = float(width * height)
    split = images.select("image_id", by).where(F.col(by).isNotNull()).dropDuplicates(["image_id"])
    g, p = gt.join(split, "image_id"), pred.join(split, "image_id")
    pixels = {name: {k: (a * scale, b * scale) for k, (a, b) in r.items()} if isinstance(r, dict) else (r[0] * scale, r[1] * scale) for name, r in sizes.items()}
    objects = written(evaluation.average_precision(evaluation.coco_match(gt, pred, areas=pixels), gt, pixels, images=split), "objects")
    every = evaluation.coco_summary(objects, (by,)).withColumn("object_class", F.lit(-1))
    return {
        "images": evaluation.report_rows(evaluation.per_image_stats(g, p, sizes, scale, by=(by,)), [by, "size"]),
        "pixels": evaluation.report_rows(evaluation.pixel_stats(g, p, width, height, sizes, by=(by,)), [by, "size"]),
        "objects": objects,
        "summary": evaluation.coco_summary(objects, (by, "object_class")).unionByName(every),
    }


def report(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table as CSV in a folder of its name."""
    for name, df in tables.items():
        writers.report(df, f"{folder}/{name}")
