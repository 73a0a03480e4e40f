"""Detection quality: matching, COCO average precision, per-image and per-pixel statistics, sweeps, reports.

Statistics are by class, and by whatever other columns ``by`` names (a split, a model), in one plan for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbsight.functions.boxes import intersection, iou
from kerbsight.functions.geo import planar
from kerbsight.operators.scratch import written
from kerbsight.operators.spatial import nearest

#: IoU thresholds, numbers of detections and the levels of recall of a COCO evaluation.
IOUS = tuple(round(0.5 + 0.05 * k, 2) for k in range(10))
MAX_DETECTIONS = (1, 10, 500)
RECALL_STEPS = 100
#: Names of classes, and bounds of small, medium and large boxes by class, as shares of the image.
CLASS_NAMES = {0: "person", 1: "license_plate", 2: "container", 3: "mobile_toilet", 4: "scaffolding"}
SIZE_BOUNDS = {0: (0.000665, 0.003397), 1: (0.000108, 0.000436), 2: (0.003424, 0.022598), 3: (0.000854, 0.004376), 4: (0.010298, 0.125452)}
#: Areas by name, either one range or one for each class.
Areas = dict[str, tuple[float, float] | dict[int, tuple[float, float]]]


def sizes_of(scale: float = 1.0, bounds: dict[int, tuple[float, float]] = SIZE_BOUNDS) -> Areas:
    """The four sizes of boxes by class, as shares of the image or, with its area as ``scale``, in pixels."""
    ranges = {"all": lambda a, b: (0.0, 1.0), "small": lambda a, b: (0.0, a), "medium": lambda a, b: (a, b), "large": lambda a, b: (b, 1.0)}
    return {name: {k: tuple(scale * x for x in f(*ab)) for k, ab in bounds.items()} for name, f in ranges.items()}


def _areas_of(areas: Areas, share: Column | None = None) -> Column:
    """Names of the ranges that are for a row's class and, if given, hold its share, both ends included."""
    rows = []
    for name, r in areas.items():
        for k, (a, b) in r.items() if isinstance(r, dict) else [(None, r)]:
            rows.append(F.struct(F.lit(name).alias("area"), F.lit(k).cast("int").alias("class"), F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high")))
    fits = lambda x: F.coalesce(x["class"] == F.col("object_class"), F.lit(True)) & (F.lit(True) if share is None else share.between(x["low"], x["high"]))
    return F.transform(F.filter(F.array(*rows), fits), lambda x: x["area"])


def in_ranges(boxes: DataFrame, areas: Areas, scale: float = 1.0) -> DataFrame:
    """Each box (corner form, area divided by ``scale``) once for every range that holds it, by ``area``."""
    share = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / scale
    return boxes.withColumn("area", F.explode(_areas_of(areas, share)))


BOX = ("x0", "y0", "x1", "y1")


def _box(prefix: str) -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))


def _side(df: DataFrame, prefix: str, id_col: str, *more: str) -> DataFrame:
    return df.select("image_id", "object_class", id_col, *more, *[F.col(c).alias(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1")])


def overlapping(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """Pairs of ground truth and prediction of one image and class that share any area, with their IoU."""
    pairs = _side(gt, "g_", "gt_id").join(_side(pred, "p_", "pred_id", "score"), ["image_id", "object_class"])
    return pairs.where(intersection(_box("g_"), _box("p_")) > 0).withColumn("iou", iou(_box("g_"), _box("p_")))


def false_positives(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """Predictions that overlap no ground truth of their image and class."""
    return pred.join(overlapping(gt, pred).select("pred_id"), "pred_id", "left_anti")


def false_negatives(gt: DataFrame, pred: DataFrame) -> DataFrame:
    return gt.join(overlapping(gt, pred).select("gt_id"), "gt_id", "left_anti")


def best_match(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """For each prediction the ground truth of the largest IoU, ties to the least id; without overlap no row."""
    return overlapping(gt, pred).groupBy("pred_id").agg(F.max_by(F.struct("gt_id", "iou"), F.struct("iou", -F.col("gt_id"))).alias("m")).select("pred_id", "m.gt_id", F.col("m.iou").alias("iou"))


_MATCHED = "image_id long, object_class int, pred_id long, score double, place int, area string, gt_ids array<long>, ignored array<boolean>"


#: Numbers that the arrays of images and classes which are matched together hold at most, beyond a single one's.
_TOGETHER = 1 << 21


def _boxes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of a column of arrays of structs where each begins, its size, and all their fields one behind the other."""
    flat = column.flatten()
    size = np.array(column.value_lengths().fill_null(0)).astype(np.int64)
    return np.cumsum(size) - size, size, [flat.field(k).to_numpy(zero_copy_only=False) for k in range(flat.type.num_fields)]


def _padded(corners: list[np.ndarray]) -> np.ndarray:
    """Boxes as rows, and an empty one behind them."""
    return np.concatenate([np.stack([c.astype(float) for c in corners], axis=1), np.zeros((1, 4))])


def _places(start: np.ndarray, size: np.ndarray, n: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the ``n`` first entries of each array are, and whether it has them; else that is the last place of all."""
    inside = np.arange(n) < size[:, None]
    return np.where(inside, start[:, None] + np.arange(n), last - 1), inside


def _alike(n: np.ndarray, m: np.ndarray, times: int) -> Iterator[np.ndarray]:
    """Rows with predictions, in groups of like numbers of predictions and ground truth."""
    rows, most = [], 1
    for k in np.lexsort((m, n)):
        if n[k]:
            wider = max(most, m[k])
            if rows and (len(rows) + 1) * (times * (n[k] + wider) + n[k] * wider) > _TOGETHER:
                yield np.array(rows)
                rows, wider = [], max(m[k], 1)
            rows.append(k)
            most = wider
    if rows:
        yield np.array(rows)


def _greedy(overlap: np.ndarray, outside: np.ndarray, ious: np.ndarray) -> np.ndarray:
    """By image, area, prediction (best first) and IoU threshold the ground truth that a prediction takes, or -1.

    ``overlap`` is by image, prediction and ground truth, -1 where there is none; ``outside`` by image, area and truth.
    """
    (images, n, m), areas = overlap.shape, outside.shape[1]
    hit, free = np.full((images, areas, n, len(ious)), -1), np.ones((images, areas, len(ious), m), bool)
    for i in range(n):
        own = overlap[:, i, None, None]
        fits = free & (own >= ious[:, None])
        inner = fits & ~outside[:, :, None]
        fits = np.where(inner.any(axis=3, keepdims=True), inner, fits)
        best = m - 1 - np.where(fits, own, -1.0)[..., ::-1].argmax(axis=3)
        some = fits.any(axis=3)
        hit[:, :, i] = np.where(some, best, -1)
        free &= ~(some[..., None] & (np.arange(m) == best[..., None]))
    return hit


def coco_match(gt: DataFrame, pred: DataFrame, ious: tuple[float, ...] = IOUS, areas: Areas | None = None, most: int = MAX_DETECTIONS[-1]) -> DataFrame:
    """Greedy matching of an image's predictions, best score first, for each class, area range and IoU threshold.

    A prediction takes the free ground truth of the largest IoU that reaches the threshold, one within the area range
    before one outside. Matched to one outside, or unmatched and itself outside, it is ignored. One row for each
    prediction and area range, with ``gt_ids`` (null where nothing matched) and ``ignored`` by IoU threshold, and its
    ``place`` among its image's predictions. Equal scores keep the order of ids. Boxes of one image and class, at most
    ``most`` predictions, meet in one row; images are scattered over all tasks.
    """
    areas = areas or {"all": (0.0, float("inf"))}
    thresholds, names = np.minimum(np.array(ious), 1 - 1e-10), list(areas)
    keys, box = ["image_id", "object_class"], ["x0", "y0", "x1", "y1"]
    g = gt.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("gt_id", *box))).alias("g"))
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "pred_id", *box)))
    p = pred.groupBy(*keys).agg(F.slice(best, 1, most).alias("p"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("object_class").to_numpy(zero_copy_only=False)
            g_from, g_size, gs = _boxes_of(batch.column("g"))
            p_from, p_size, ps = _boxes_of(batch.column("p"))
            a, b = (_padded(x[-4:]) for x in (gs, ps))
            ids, preds, minus = np.append(gs[0], 0).astype(np.int64), np.append(ps[1], 0).astype(np.int64), np.append(ps[0], 0.0).astype(float)
            for rows in _alike(p_size, g_size, len(areas) * len(thresholds)):
                n, m = p_size[rows].max(), max(g_size[rows].max(), 1)
                p_at, p_in = _places(p_from[rows], p_size[rows], n, len(preds))
                g_at, g_in = _places(g_from[rows], g_size[rows], m, len(ids))
                x, y = a[g_at], b[p_at]
                w = np.clip(np.minimum(y[:, :, None, 2], x[:, None, :, 2]) - np.maximum(y[:, :, None, 0], x[:, None, :, 0]), 0, None)
                h = np.clip(np.minimum(y[:, :, None, 3], x[:, None, :, 3]) - np.maximum(y[:, :, None, 1], x[:, None, :, 1]), 0, None)
                ga, pa_ = ((z[..., 2] - z[..., 0]) * (z[..., 3] - z[..., 1]) for z in (x, y))
                union = pa_[:, :, None] + ga[:, None] - w * h
                overlap = np.divide(w * h, union, out=np.zeros_like(union), where=union > 0)
                overlap[~(p_in[:, :, None] & g_in[:, None])] = -1.0
                bounds = np.array([[r.get(k, (np.inf, -np.inf)) if isinstance(r, dict) else r for r in areas.values()] for k in kinds[rows]])
                beyond = lambda z: (z[:, None] < bounds[:, :, :1]) | (z[:, None] > bounds[:, :, 1:])  # noqa: B023, E731
                outside = beyond(ga)
                hit = _greedy(overlap, outside, thresholds)
                found = np.maximum(hit, 0)
                taken = np.take_along_axis(outside[:, :, None], found, axis=3)
                ignored = np.where(hit >= 0, taken, beyond(pa_)[..., None])
                row, area, k = np.nonzero(np.broadcast_to(p_in[:, None], hit.shape[:3]))
                own = np.where(hit >= 0, ids[g_at[np.arange(len(rows))[:, None, None, None], found]], -1)[row, area, k].ravel()
                at = pa.array(np.arange(len(row) + 1, dtype=np.int32) * len(thresholds))
                lists = [pa.ListArray.from_arrays(at, pa.array(own, mask=own < 0)), pa.ListArray.from_arrays(at, pa.array(ignored[row, area, k].ravel()))]
                of, place = pa.array(rows[row]), p_at[row, k]
                first = [batch.column("image_id").take(of), batch.column("object_class").take(of), pa.array(preds[place]), pa.array(-minus[place]), pa.array((k + 1).astype(np.int32)), pa.array(names).take(pa.array(area))]
                yield pa.RecordBatch.from_arrays([*first, *lists], names=[c.split()[0] for c in _MATCHED.split(", ")])

    typed = [F.col("image_id").cast("long").alias("image_id"), F.col("object_class").cast("int").alias("object_class")]
    return p.join(g, keys, "left").select(*typed, "g", "p").mapInArrow(match, _MATCHED)


_JUDGED = "object_class int, area string, score double, image_id long, pred_id long, place int, hits long, counted long"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each prediction with one bit for each threshold at which it hits, and one for each at which it counts."""
    for b in batches:
        n = b.num_rows
        hit = np.array(b.column("gt_ids").flatten().is_valid()).reshape(n, -1)
        counted = ~b.column("ignored").flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(n, -1)
        weight = 1 << np.arange(hit.shape[1], dtype=np.int64)
        own = [b.column(c) for c in ("object_class", "area", "score", "image_id", "pred_id", "place")]
        yield pa.RecordBatch.from_arrays([*own, pa.array((hit & counted) @ weight), pa.array(counted @ weight)], names=[x.split()[0] for x in _JUDGED.split(", ")])


def _bit(column: str, k: int) -> Column:
    return F.shiftright(column, k).bitwiseAND(F.lit(1))


def _best_points(before: dict, truth: dict, n: int):
    """The best precision at each level of recall that a range of one class and area reaches, by threshold."""

    def fold(rows: pa.Table) -> pa.Table:
        kind, area, part = (rows[c][0].as_py() for c in ("object_class", "area", "_part"))
        out: dict[str, list[np.ndarray]] = {"_t": [], "level": [], "p": []}
        score, image, pred = (rows[c].to_numpy() for c in ("score", "image_id", "pred_id"))
        order = np.lexsort((pred, image, -score))
        hits, counted = (rows[c].to_numpy()[order] for c in ("hits", "counted"))
        for t in range(n if (kind, area) in truth else 0):
            hit = (hits >> t) & 1
            tp, seen = (np.cumsum(x) + y for x, y in zip((hit, (counted >> t) & 1), before[kind, area, part][:, t], strict=True))
            at = np.flatnonzero(hit)
            if len(at):
                level = np.floor(RECALL_STEPS * tp[at] / truth[kind, area]).astype(np.int32)
                first = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))
                out["_t"].append(np.full(len(first), t, np.int32))
                out["level"].append(level[first])
                out["p"].append(np.maximum.reduceat(tp[at] / seen[at], first))
        columns = [np.concatenate(x) if x else np.zeros(0, np.int32) for x in out.values()]
        m = len(columns[0])
        return pa.table([pa.array([kind] * m, pa.int32()), pa.array([area] * m, pa.string()), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.float64()), strict=True))], names=["object_class", "area", *out])

    return fold


#: Stands between the values of a group and the name of an area.
_SEPARATOR = "\x1f"


def average_precision(matched: DataFrame, gt: DataFrame, areas: Areas | None = None, ious: tuple[float, ...] = IOUS, images: DataFrame | None = None) -> DataFrame:
    """``(object_class, area, iou, n_gt, ap, recall_M...)`` for all classes, areas and thresholds that have ground truth.

    ``images`` names what images are told apart by, such as their split: image_id and further columns, which come first in
    the result, each value with a table of its own in the same plan; images that it lacks are left out.

    ``ap`` is the mean of the best precision at or beyond each of 101 levels of recall; ``recall_M`` the recall of each
    image's first M predictions. A prediction is one row for all thresholds. Rows are dealt out by ranges of class, area
    and score; counts of the ranges before one are added to running counts within it, so no task holds all predictions of
    a class, and a range hands on no more than 101 levels for each threshold.
    """
    areas, n, by = areas or {"all": (0.0, float("inf"))}, len(ious), [c for c in (images.columns if images is not None else []) if c != "image_id"]
    named = lambda df: df.join(images, "image_id").withColumn("area", F.concat_ws(_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by], "area")) if by else df
    matched = named(matched)
    pair, group = ["object_class", "area"], ["object_class", "area", "_t"]
    steps = F.posexplode(F.array(*[F.lit(t) for t in ious])).alias("_t", "iou")
    counts = written(named(in_ranges(gt, areas)).groupBy(*pair).agg(F.count("*").alias("n_gt")).select(F.col("object_class").cast("int").alias("object_class"), "area", "n_gt"), "truth")
    truth = counts.select("*", steps)
    partitions = int(gt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written first, as dealing out by ranges reads its rows twice: for a sample, and to move them.
    rows = written(matched.mapInArrow(_judged, _JUDGED).where("counted <> 0"), "judged")
    dealt = written(rows.repartitionByRange(partitions, *pair, F.desc("score"), "image_id", "pred_id").withColumn("_part", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy(*pair, "_part").agg(*[F.array(*[F.sum(_bit(c, t)) for t in range(n)]).alias(c) for c in ("hits", "counted")]).orderBy(*pair, "_part").collect()
    before, run = {}, {}
    for r in sums:  # one row for each range and what begins in it
        key = r["object_class"], r["area"]
        run.setdefault(key, np.zeros((2, n), np.int64))
        before[*key, r["_part"]] = run[key].copy()
        run[key] += np.array([r["hits"], r["counted"]])
    known = {(r["object_class"], r["area"]): r["n_gt"] for r in counts.collect()}
    curve = dealt.select(*pair, "_part", "score", "image_id", "pred_id", "hits", "counted").groupBy(*pair, "_part").applyInArrow(_best_points(before, known, n), "object_class int, area string, _t int, level int, p double")
    points = curve.groupBy(*group, "level").agg(F.max("p").alias("p")).groupBy(*group).agg(F.collect_list(F.struct("level", "p")).alias("points"))
    best = F.transform(F.sequence(F.lit(0), F.lit(RECALL_STEPS)), lambda k: F.coalesce(F.array_max(F.transform(F.filter("points", lambda x: x["level"] >= k), lambda x: x["p"])), F.lit(0.0)))
    mean = F.aggregate(best, F.lit(0.0), lambda a, b: a + b) / (RECALL_STEPS + 1)
    found = dealt.groupBy(*pair).agg(*[F.array(*[F.sum(F.when(F.col("place") <= m, _bit("hits", t)).otherwise(0)) for t in range(n)]).alias(f"_{m}") for m in MAX_DETECTIONS])
    out = truth.join(points.select(*group, mean.alias("ap")), group, "left").join(found, pair, "left")
    recalls = [(F.coalesce(F.get(f"_{m}", F.col("_t")), F.lit(0)) / F.col("n_gt")).alias(f"recall_{m}") for m in MAX_DETECTIONS]
    part = F.split("area", _SEPARATOR)
    of = [F.nullif(part[k], F.lit("")).cast(images.schema[c].dataType).alias(c) for k, c in enumerate(by)]
    return out.select(*of, "object_class", F.element_at(part, -1).alias("area"), "iou", "n_gt", F.coalesce("ap", F.lit(0.0)).alias("ap"), *recalls)


def coco_summary(table: DataFrame, by: tuple[str, ...] = (), decimals: int = 3) -> DataFrame:
    """The twelve values of a COCO report, as ``(*by, metric, value)``, over the rows of :func:`average_precision`.

    AP and AR over all thresholds, at 0.75 and at 0.5, and at 0.5 for small, medium and large boxes, each with the largest
    number of detections. A value without any ground truth is -1.
    """
    which = {"": F.lit(True), "_75": F.col("iou") == 0.75, "_50": F.col("iou") == 0.5} | {f"_50_{a}": F.col("iou") == 0.5 for a in ("small", "medium", "large")}
    area = lambda k: F.col("area") == (k.rsplit("_", 1)[1] if k.count("_") == 2 else "all")
    values = {f"{name}{k}": F.round(F.coalesce(F.avg(F.when(fits & area(k), F.col(column))), F.lit(-1.0)), decimals) for name, column in (("AP", "ap"), ("AR", f"recall_{MAX_DETECTIONS[-1]}")) for k, fits in which.items()}
    wide = table.groupBy(*by).agg(*[v.alias(k) for k, v in values.items()])
    return wide.unpivot(list(by), list(values), "metric", "value")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a / F.nullif(b, F.lit(0))


def f_beta(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    return F.bround(ratio((1 + beta**2) * precision * recall, beta**2 * precision + recall), 3)


def per_image_stats(gt: DataFrame, pred: DataFrame, areas: Areas | None = None, scale: float = 1.0, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and rates of images by class and size: does an image with truth of the class have a prediction of it.

    The size restricts the ground truth only. The universe is the images with any ground truth; predictions on other
    images are false positives all the same. Where the size isn't ``all``, precision, fpr and tnr say nothing and are
    null. Without ``areas`` there is no size. ``by`` are further columns of both sides, such as the split.
    """
    keys = [*by, "image_id", "object_class"]
    universe = gt.select(*by, "image_id").distinct().groupBy(*by).agg(F.count("*").alias("n"))
    sized = in_ranges(gt, areas or {"all": (0.0, float("inf"))}, scale)
    truth = sized.groupBy(*keys, "area").agg(F.lit(1).alias("t"))
    known = gt.select(*by, "image_id").distinct().withColumn("known", F.lit(1))
    said = pred.select(*keys).distinct().join(known, [*by, "image_id"], "left").withColumn("p", F.lit(1))
    said = said.withColumn("area", F.explode(_areas_of(areas or {"all": (0.0, float("inf"))}))).select(*keys, "area", "known", "p")
    flags = truth.join(said, [*keys, "area"], "full_outer")
    c = lambda x: F.count_if(x).alias
    t, p = F.col("t").isNotNull(), F.col("p").isNotNull()
    counts = flags.groupBy(*by, "object_class", F.col("area").alias("size")).agg(c(t & p)("tp"), c(~t & p)("fp"), c(t & ~p)("fn"), c(t | F.col("known").isNotNull())("_in"))
    s = _beside(counts, universe, by).withColumn("tn", F.col("n") - F.col("_in"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    every = lambda x: F.when(F.col("size") == "all", x)
    negative = F.col("n") - tp - fn
    rates = {"precision": every(ratio(tp, tp + fp)), "recall": ratio(tp, tp + fn), "fpr": every(ratio(fp, negative)), "fnr": ratio(fn, fn + tp), "tnr": every(ratio(tn, negative))}
    return s.select(*by, "object_class", "size", "tp", "fp", "fn", "tn", *[v.alias(k) for k, v in rates.items()])


def _beside(counts: DataFrame, totals: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Counts with the totals of their group; without groups the totals are one row."""
    return counts.join(totals, list(by)) if by else counts.join(F.broadcast(totals))


def covered(boxes: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, image_id, both, first, second)``: areas that boxes of kind ``k`` = 1 and 2 cover, together and alone.

    Cells between all edges of an image's boxes are summed, so no pixel is ever made; an area counts once however many
    boxes cover it.
    """
    of = [*by, "image_id"]
    image = boxes.groupBy(*of).agg(F.collect_list(F.struct("k", "x0", "y0", "x1", "y1")).alias("b"))
    edges = lambda lo, hi: F.array_sort(F.array_distinct(F.concat(F.transform("b", lambda r: r[lo]), F.transform("b", lambda r: r[hi]))))
    spans = lambda e: F.transform(F.sequence(F.lit(1), F.greatest(F.size(e) - 1, F.lit(1))), lambda i: F.struct(F.element_at(e, i).alias("a"), F.get(e, i).alias("z")))
    strips = image.withColumn("xs", edges("x0", "x1")).withColumn("ys", edges("y0", "y1")).withColumn("x", F.explode(spans(F.col("xs")))).where("x.z is not null")
    strips = strips.withColumn("b", F.filter("b", lambda r: (r["x0"] <= F.col("x.a")) & (r["x1"] >= F.col("x.z")))).withColumn("y", F.explode(spans(F.col("ys")))).where("y.z is not null")
    on = lambda k: F.exists("b", lambda r: (r["k"] == k) & (r["y0"] <= F.col("y.a")) & (r["y1"] >= F.col("y.z")))
    cells = strips.select(*of, ((F.col("x.z") - F.col("x.a")) * (F.col("y.z") - F.col("y.a"))).alias("_cell"), on(1).alias("g"), on(2).alias("p"))
    total = lambda c, name: F.coalesce(F.sum(F.when(c, F.col("_cell"))), F.lit(0.0)).cast("long").alias(name)
    g, p = F.col("g"), F.col("p")
    return cells.groupBy(*of).agg(total(g & p, "both"), total(g & ~p, "first"), total(~g & p, "second"))


def _pixels(boxes: DataFrame, width: int, height: int, padding: float = 0.0, upper_half: bool = False) -> DataFrame:
    """Boxes with whole pixel edges, padded, clamped to the image; with ``upper_half`` only their upper halves."""
    clip = lambda c, most: F.least(F.lit(float(most)), F.greatest(F.lit(0.0), c))
    y1 = F.floor((F.col("y0") + F.col("y1")) / 2).cast("double") if upper_half else F.col("y1")
    cut = {"x0": clip(F.col("x0") - padding, width), "y0": clip(F.col("y0") - padding, height), "x1": clip(F.col("x1") + padding, width), "y1": clip(y1 + padding, height)}
    return boxes.withColumns(cut)


def pixel_stats(gt: DataFrame, pred: DataFrame, width: int, height: int, areas: Areas | None = None, by: tuple[str, ...] = (), upper_half: bool = False) -> DataFrame:
    """Pixels by class and size that truth, prediction or both cover, on the images that have any ground truth.

    The size, a range of shares of the image, restricts the ground truth only; where it isn't ``all``, false positives,
    true negatives, precision and F1 say nothing and are null. Predictions on other images count nowhere.
    """
    areas = areas or {"all": (0.0, float("inf"))}
    images = gt.select(*by, "image_id").distinct()
    total = images.groupBy(*by).agg(F.count("*").alias("n"))
    keys = [*by, "image_id", "object_class", "area"]
    truth = in_ranges(gt, areas, float(width * height)).withColumn("k", F.lit(1))
    said = pred.join(images, [*by, "image_id"], "left_semi").withColumn("area", F.explode(_areas_of(areas))).withColumn("k", F.lit(2))
    both = _pixels(truth.select(*keys, "k", *BOX).unionByName(said.select(*keys, "k", *BOX)), width, height, upper_half=upper_half)
    c = covered(both, [*by, "object_class", "area"]).groupBy(*by, "object_class", F.col("area").alias("size"))
    s = _beside(c.agg(F.sum("both").alias("tp"), F.sum("second").alias("fp"), F.sum("first").alias("fn")), total, by)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    every = lambda x: F.when(F.col("size") == "all", x)
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    f1 = F.when((precision > 0) & (recall > 0), 2 * precision * recall / (precision + recall))
    rates = {"precision": every(precision), "recall": recall, "f1_score": every(f1)}
    return s.select(*by, "object_class", "size", "tp", every(fp).alias("fp"), "fn", every(F.col("n") * width * height - tp - fp - fn).alias("tn"), *[v.alias(k) for k, v in rates.items()])


def visible_pixels(missed: DataFrame, shown: DataFrame, width: int, height: int, padding: float = 25.0) -> DataFrame:
    """``(object_class, visible, missed)``: pixels of missed boxes, and how many of them padded detections leave visible.

    ``shown`` are the detections around which an image isn't blurred, whatever their class.
    """
    keys = ["image_id", "object_class"]
    windows = shown.drop("object_class").join(missed.select(*keys).distinct(), "image_id")
    boxes = _pixels(missed, width, height).select(*keys, F.lit(1).alias("k"), *BOX).unionByName(_pixels(windows, width, height, padding).select(*keys, F.lit(2).alias("k"), *BOX))
    c = covered(boxes, ["object_class"]).groupBy("object_class")
    return c.agg(F.sum("both").alias("visible"), (F.sum("both") + F.sum("first")).alias("missed"))


def sweep(rows: DataFrame, value: str, steps: list[float], by: list[str], truth: Column) -> DataFrame:
    """For each step: how many rows have a value of at least it, and how many of those are true."""
    levels = rows.sparkSession.createDataFrame([(float(x),) for x in steps], "step double")
    hit = rows.withColumn("_t", truth).join(F.broadcast(levels), F.col(value) >= F.col("step"))
    return hit.groupBy(*by, "step").agg(F.count("*").alias("n"), F.count_if("_t").alias("tp"))


def image_sweep(gt: DataFrame, pred: DataFrame, steps: list[float]) -> DataFrame:
    """``(object_class, step, tp, fp, fn, precision, recall, f_1, f_05, f_2)`` of images, by least score of a prediction.

    An image's best score of a class decides from which step on it has no prediction, so each is counted once, by the
    last step that it reaches, and the counts of later steps are added up.
    """
    keys = ["image_id", "object_class"]
    truth = gt.select(*keys).distinct().withColumn("t", F.lit(True))
    reached = F.size(F.filter(F.array(*[F.lit(float(x)) for x in sorted(steps)]), lambda x: F.col("best") >= x))
    said = pred.groupBy(*keys).agg(F.max("score").alias("best")).withColumn("k", reached).where("k > 0")
    n = truth.groupBy("object_class").agg(F.count("*").alias("n"))
    counts = said.join(truth, keys, "left").groupBy("object_class", "k").agg(F.count_if(F.col("t")).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"))
    levels = gt.sparkSession.createDataFrame([(k, float(x)) for k, x in enumerate(sorted(steps), 1)], "j int, step double")
    at = counts.join(F.broadcast(levels), F.col("k") >= F.col("j")).groupBy("object_class", "step").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    precision, recall = F.bround(ratio(F.col("tp"), F.col("tp") + F.col("fp")), 3), F.bround(ratio(F.col("tp"), F.col("n")), 3)
    every = n.crossJoin(F.broadcast(levels.select("step"))).join(at, ["object_class", "step"], "left").na.fill(0, ["tp", "fp"])
    rates = every.select("object_class", "step", "tp", "fp", (F.col("n") - F.col("tp")).alias("fn"), precision.alias("precision"), recall.alias("recall"))
    return rates.select("*", *[f_beta(F.col("precision"), F.col("recall"), b).alias(name) for name, b in (("f_1", 1.0), ("f_05", 0.5), ("f_2", 2.0))])


def object_sweep(detections: DataFrame, truth: DataFrame, objects: DataFrame, steps: list[float]) -> DataFrame:
    """``(step, n_detections, n_true_positives, n_unique, precision, recall, recall_unique)`` by least confidence.

    ``detections`` has image_name and confidence, ``truth`` the image names that do show an object, ``objects`` object_id
    and image_name. An object is found if any of its true images is detected.
    """
    levels = detections.sparkSession.createDataFrame([(k, float(x)) for k, x in enumerate(sorted(steps), 1)], "j int, step double")
    reached = F.size(F.filter(F.array(*[F.lit(float(x)) for x in sorted(steps)]), lambda x: F.col("best") >= x))
    real = truth.select("image_name").distinct().withColumn("t", F.lit(True))
    images = detections.groupBy("image_name").agg(F.max("confidence").alias("best")).join(real, "image_name", "left").withColumn("k", reached)
    found = objects.select("object_id", "image_name").join(images.where("t"), "image_name").groupBy("object_id").agg(F.max("k").alias("k"))
    counts = images.groupBy("k").agg(F.count("*").alias("d"), F.count_if(F.col("t")).alias("t")).join(found.groupBy("k").agg(F.count("*").alias("u")), "k", "full_outer")
    at = levels.join(counts, F.col("k") >= F.col("j"), "left").groupBy("step").agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(name) for x, name in (("d", "n_detections"), ("t", "n_true_positives"), ("u", "n_unique"))])
    totals = real.agg(F.count("*").alias("_n")).join(objects.agg(F.countDistinct("object_id").alias("_o")))
    share = lambda a, b: F.bround(ratio(F.col(a), F.col(b)), 3)
    rates = [share("n_true_positives", "n_detections").alias("precision"), share("n_true_positives", "_n").alias("recall"), share("n_unique", "_o").alias("recall_unique")]
    return at.join(F.broadcast(totals)).select("step", "n_detections", "n_true_positives", "n_unique", *rates)


def distance_rates(gt: DataFrame, pred: DataFrame, steps: list[float]) -> DataFrame:
    """``(step, fnr, fpr)``: shares of true places without a detection within so many metres, and the other way round.

    Both sides have id, x and y. Without any place on the other side nothing is within reach.
    """
    levels = gt.sparkSession.createDataFrame([(float(x),) for x in steps], "step double")

    def beyond(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        near = nearest(a, b.withColumnRenamed("id", "other"), "id", "other", [], planar, place=("x", "y"), right_place=("x", "y"), flat=True, keep_unmatched=True)
        counts = near.join(F.broadcast(levels), F.coalesce(F.col("distance"), F.lit(float("inf"))) > F.col("step")).groupBy("step").agg(F.count("*").alias("_far"))
        total = a.agg(F.count("*").alias("_n"))
        return levels.join(counts, "step", "left").join(F.broadcast(total)).select("step", ratio(F.coalesce("_far", F.lit(0)), F.col("_n")).alias(name))

    return beyond(gt, pred, "fnr").join(beyond(pred, gt, "fpr"), "step")


def bound_counts(boxes: DataFrame, area: float, bounds: dict[int, tuple[float, float]] = SIZE_BOUNDS) -> DataFrame:
    """``(object_class, n, n_large)``: boxes by class, and those beyond the class's bound of large ones."""
    large = F.create_map(*[F.lit(x) for k, (_, b) in bounds.items() for x in (k, b * area)])[F.col("object_class")]
    size = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return boxes.groupBy("object_class").agg(F.count("*").alias("n"), F.count_if(size > large).alias("n_large"))


def compare_models(detected: DataFrame, true: DataFrame, total_images: int) -> DataFrame:
    """``(model, n_detections, n_true_positives, precision, partial_recall, fnr)`` of image names by model.

    Recall is partial: of the images that any model got right. ``fnr`` is the share of all images with a wrong detection.
    """
    d = detected.select("model", "image_name").distinct()
    t = true.select("model", "image_name").distinct().withColumn("t", F.lit(1))
    union = t.agg(F.countDistinct("image_name").alias("_all"))
    n = d.join(t, ["model", "image_name"], "left").groupBy("model").agg(F.count("*").alias("n_detections"), F.count("t").alias("n_true_positives"))
    wrong = (F.col("n_detections") - F.col("n_true_positives")) / total_images
    return n.join(F.broadcast(union)).select("model", "n_detections", "n_true_positives", ratio(F.col("n_true_positives"), F.col("n_detections")).alias("precision"), ratio(F.col("n_true_positives"), F.col("_all")).alias("partial_recall"), wrong.alias("fnr"))


def report_rows(stats: DataFrame, keys: list[str], names: dict[int, str] = CLASS_NAMES) -> DataFrame:
    """A table of statistics with the headings of a report: "True Positives" for tp, FPR for fpr; classes by name."""
    headings = {"tp": "True Positives", "fp": "False Positives", "tn": "True Negatives", "fn": "False Negatives"}
    heading = lambda c: headings.get(c) or (c.upper() if c in ("fpr", "fnr", "tpr", "tnr") else " ".join(x.capitalize() for x in c.split("_")))
    name = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("object_class")], F.col("object_class").cast("string"))
    columns = [c for c in stats.columns if c not in keys and c != "object_class"]
    return stats.select(*[F.col(k).alias(heading(k)) for k in keys], name.alias("Object Class"), *[F.col(c).alias(heading(c)) for c in columns])


def report_slice(report: DataFrame, size: str = "all", split: str | None = None, object_class: str | None = None) -> DataFrame:
    """Rows of a report of one size, and of one split and class name where they are given; keys that are fixed go."""
    fixed = {"Size": size} | ({"Split": split} if split is not None else {}) | ({"Object Class": object_class} if object_class is not None else {})
    out = report
    for c, value in fixed.items():
        out = out.where(F.col(f"`{c}`") == F.lit(value))
    return out.drop(*fixed)


def greedy_overlap(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """One-to-one matches by any overlap, predictions in the order of ids, each taking the first free ground truth."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g_from, g_size, gs = _boxes_of(batch.column("g"))
            p_from, p_size, ps = _boxes_of(batch.column("p"))
            a, b = (np.stack([c.astype(float) for c in x[1:]], axis=1) for x in (gs, ps))
            taker, taken, row = [], [], []
            for k in np.flatnonzero((g_size > 0) & (p_size > 0)):
                g, ids = a[g_from[k] : g_from[k] + g_size[k]], gs[0][g_from[k] : g_from[k] + g_size[k]]
                free = np.ones(len(g), bool)
                for i in range(p_from[k], p_from[k] + p_size[k]):
                    x0, y0, x1, y1 = b[i]
                    fits = free & (np.minimum(x1, g[:, 2]) > np.maximum(x0, g[:, 0])) & (np.minimum(y1, g[:, 3]) > np.maximum(y0, g[:, 1]))
                    j = fits.argmax()
                    if fits[j]:
                        free &= ids != ids[j]
                        row.append(k)
                        taker.append(ps[0][i])
                        taken.append(ids[j])
            of = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("image_id").take(of), batch.column("object_class").take(of), pa.array(taker, pa.int64()), pa.array(taken, pa.int64())], names=["image_id", "object_class", "pred_id", "gt_id"])

    keys = [F.col("image_id").cast("long").alias("image_id"), F.col("object_class").cast("int").alias("object_class")]
    boxes = lambda df, name: df.select(*keys, F.struct(F.col(f"{name}_id").cast("long").alias("id"), *BOX).alias(name))
    both = boxes(gt, "gt").unionByName(boxes(pred, "pred"), allowMissingColumns=True)
    met = both.groupBy("image_id", "object_class").agg(F.array_sort(F.collect_list("gt")).alias("g"), F.array_sort(F.collect_list("pred")).alias("p"))
    return met.where((F.size("g") > 0) & (F.size("p") > 0)).mapInArrow(match, "image_id long, object_class int, pred_id long, gt_id long")
