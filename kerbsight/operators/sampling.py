"""Samples that don't depend on partitioning, thinning, path lengths, and comparisons of tables and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbsight.functions.geo import COMPARE_RADIUS, haversine
from kerbsight.functions.text import basename
from kerbsight.operators.scratch import written
from kerbsight.operators.spatial import nearest_by_place


def uniform(*keys: str, seed: int = 0) -> Column:
    """A number in (0, 1) by MD5 of the keys: the same in every run, on every partitioning and in any SQL engine."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(2**52)


def with_running(rows: DataFrame, by: list[str], order: list[Column | str], sums: list[str]) -> DataFrame:
    """Adds ``c_before`` for each of the columns: its sum over the rows of the group that come before, in the given order.

    Rows are dealt out by ranges of group and order, so no task holds all rows of a group; the sums of the ranges before
    one are added to running sums within it. Ties in the order stay in some order.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(rows.repartitionByRange(partitions, *by, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(*by, "_part").agg(*[F.sum(c).alias(c) for c in sums])
    parts = parts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_of"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in sums])
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    run = dealt.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    same = F.col("_part") == F.col("_of")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    out = run.join(parts, same).withColumns({f"{c}_before": F.col(f"{c}_before") + F.col(f"_{c}") for c in sums})
    return out.select(*rows.columns, *[f"{c}_before" for c in sums])


def numbered(rows: DataFrame, name: str, *order: Column | str, by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``name``: 1, 2, 3, ... in the given order, of all rows or within groups, without a task that holds them all."""
    run = with_running(rows.withColumn("_one", F.lit(1)), list(by), list(order), ["_one"])
    return run.withColumn(name, F.col("_one_before") + 1).drop("_one", "_one_before")


def _by_value(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """``(*by, value, n, n_before)``: how many rows of a group have each value, and how many a lesser one."""
    return with_running(rows.groupBy(*by, value).agg(F.count("*").alias("n")), by, [value], ["n"])


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """``(*by, name...)``: exact quantiles with linear interpolation, null without values.

    From counts by value, so a group's values are never gathered: each wanted place lies in the run of one value.
    """
    counts = _by_value(rows.where(F.col(value).isNotNull()), by, value)
    total = counts.groupBy(*by).agg(F.sum("n").alias("_total"))
    joined = counts.join(total, by)

    def at(k: Column) -> Column:
        return F.max(F.when((k >= F.col("n_before")) & (k < F.col("n_before") + F.col("n")), F.col(value)))

    ends, place = [], {name: (F.col("_total") - 1) * p for name, p in shares.items()}
    for name in shares:
        ends += [at(F.floor(place[name])).alias(f"_{name}_low"), at(F.ceil(place[name])).alias(f"_{name}_high")]
    found = joined.groupBy(*by, "_total").agg(*ends)
    between = lambda name: F.col(f"_{name}_low") + (place[name] - F.floor(place[name])) * (F.col(f"_{name}_high") - F.col(f"_{name}_low"))
    return found.select(*by, *[between(name).alias(name) for name in shares])


def cumulative_share(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the rank of a row's value in its group, ties at the least, as a share of the group."""
    counts = _by_value(rows, by, value)
    total = counts.groupBy(*by).agg(F.sum("n").alias("_total"))
    share = counts.join(total, by).select(*by, value, ((F.col("n_before") + 1) / F.col("_total")).alias(name))
    return rows.join(share, [*by, value])


def dense_numbers(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: 1 for a group's least value, 2 for the next one, and so on."""
    return rows.join(numbered(rows.select(*by, value).distinct(), name, value, by=tuple(by)), [*by, value])


def sample_counts(frames: DataFrame, sample: DataFrame, id_col: str, permit: str) -> DataFrame:
    """``(n_sampled, n_with_permit, ratio)``: how many of the sampled frames lie in a permit's zone, and in percent."""
    flagged = frames.join(sample.select(id_col), id_col, "left_semi")
    n = flagged.agg(F.count("*").alias("n_sampled"), F.count_if(permit).alias("n_with_permit"))
    return n.withColumn("ratio", 100 * F.col("n_with_permit") / F.nullif(F.col("n_sampled"), F.lit(0)))


def aligned(images: DataFrame, annotations: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Images and annotations of one dataset under the ids that another one has for the same base file names.

    ``images`` and ``known`` have image_id and file_name, ``annotations`` annotation_id and image_id. Images that the
    other lacks, and their annotations, are left out; annotations are numbered anew, by image, then by their old id. Of
    several ids for one name the least counts.
    """
    name = lambda df: df.withColumn("base", basename(F.col("file_name")))
    ids = name(known).groupBy("base").agg(F.min("image_id").alias("new_id"))
    kept = name(images).join(ids, "base").select("image_id", "new_id", F.col("base").alias("file_name"))
    moved = numbered(annotations.join(kept.select("image_id", "new_id"), "image_id"), "new_annotation_id", "new_id", "annotation_id")
    return kept.select(F.col("new_id").alias("image_id"), "file_name").distinct(), moved.withColumns({"image_id": F.col("new_id"), "annotation_id": F.col("new_annotation_id")}).drop("new_id", "new_annotation_id")


def weighted_sample(rows: DataFrame, n: int, weight: str, *keys: str, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, by the largest ln(u) / weight; all rows of positive weight if they are fewer."""
    return rows.where(F.col(weight) > 0).withColumn("_k", F.log(uniform(*keys, seed=seed)) / F.col(weight)).orderBy(F.desc("_k"), *keys).limit(n).drop("_k")


def one_of_each(rows: DataFrame, by: list[str], *keys: str, n: int = 1, seed: int = 42) -> DataFrame:
    """``n`` rows of each group in hash order."""
    w = Window.partitionBy(*by).orderBy(uniform(*keys, seed=seed), *keys)
    return rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def thinned(rows: DataFrame, fps: float, recording: str, time: str, id_col: str) -> DataFrame:
    """About ``fps`` rows a second of each recording: the first within each unit of time, numbered from 0.

    Times are shifted to 0, scaled, freed of the first half interval and rounded half to even.
    """
    w = Window.partitionBy(recording)
    unit = (F.col(time) - F.min(time).over(w)) * fps
    kept = rows.withColumn("_u", unit).where("_u >= 0.5").withColumn("_u", F.bround("_u"))
    first = kept.withColumn("_k", F.row_number().over(Window.partitionBy(recording, "_u").orderBy(time, id_col))).where("_k = 1")
    return first.withColumn("new_frame_id", F.row_number().over(w.orderBy("_u")) - 1).drop("_u", "_k")


def path_stats(rows: DataFrame, recording: str, time: str, id_col: str, lat: str = "gps_lat", lon: str = "gps_lon") -> DataFrame:
    """Length in metres, seconds, number of points, points and metres a second of each recording's path."""
    w = Window.partitionBy(recording).orderBy(time, id_col)
    step = haversine(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon))
    s = rows.withColumn("_s", step).groupBy(recording).agg(F.coalesce(F.sum("_s"), F.lit(0.0)).alias("metres"), (F.max(F.unix_micros(time)) - F.min(F.unix_micros(time))).alias("_us"), F.count("*").alias("points"))
    return s.select(recording, "metres", (F.col("_us") / 1e6).alias("seconds"), "points", *[(F.col(c) / F.nullif(F.col("_us") / 1e6, F.lit(0.0))).alias(k) for c, k in (("points", "fps"), ("metres", "speed"))])


def differences(a: DataFrame, b: DataFrame, all_rows: bool = False) -> DataFrame:
    """Rows of either table that the other lacks, by ``side``; with ``all_rows`` repeated rows count.

    Tables of different columns or types aren't compared.
    """
    kinds = lambda df: [(f.name, f.dataType) for f in df.schema.fields]
    if kinds(a) != kinds(b):
        raise ValueError(f"different columns: {a.schema.simpleString()} and {b.schema.simpleString()}")
    less = (lambda x, y: x.exceptAll(y)) if all_rows else (lambda x, y: x.subtract(y))
    return less(a, b).withColumn("side", F.lit("only_a")).unionByName(less(b, a).withColumn("side", F.lit("only_b")))


def compared(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many keys are in a only, in b only and in both."""
    one = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(1))
    where = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").otherwise("both")
    return one(a, "_a").join(one(b, "_b"), key, "full_outer").groupBy(where.alias("side")).agg(F.count("*").alias("n"))


def nearest_in_run(manual: DataFrame, auto: DataFrame, metres: float, shared_class: bool = False) -> DataFrame:
    """For each manual frame the closest automatic one within ``metres``; ties to the least id.

    Both have frame_id, gps_lat, gps_lon and classes; with ``shared_class`` the two must have a class in common.
    """
    on = ["_class"] if shared_class else []
    by_class = lambda df: df.withColumn("_class", F.explode(F.array_distinct("classes"))) if shared_class else df
    there = " and ".join(f"{c} is not null" for c in ["_x", "_y", *on])
    place = [F.col("gps_lat").alias("_x"), F.col("gps_lon").alias("_y")]
    a = by_class(manual).select("frame_id", *on, *place).where(there)
    b = by_class(auto).select(*on, F.col("frame_id").alias("_rid"), *place, F.col("classes").alias("auto_classes")).where(there)
    hits = nearest_by_place(a, b, on, lambda *p: haversine(*p, COMPARE_RADIUS), within=metres)
    best = a.join(hits, [*on, "_x", "_y"]).groupBy("frame_id").agg(F.min(F.struct("_n", *on)).alias("m"))
    best = best.select("frame_id", F.col("m._n.r.id").alias("_rid"), F.col("m._n.r.x").alias("_x"), F.col("m._n.r.y").alias("_y"), F.col("m._n.d").alias("distance_m"), *[f"m.{c}" for c in on])
    known = b.groupBy("_rid", "_x", "_y", *on).agg(F.min("auto_classes").alias("auto_classes"))
    best = best.join(known, ["_rid", "_x", "_y", *on]).select("frame_id", F.col("_rid").alias("auto_id"), "distance_m", "auto_classes")
    return manual.join(best, "frame_id", "left").select(*manual.columns, "auto_id", "distance_m", "auto_classes")


def matched_by_ordinal(rows: DataFrame, details: DataFrame, source: str, rows_order: list[Column | str], details_order: list[Column | str]) -> DataFrame:
    """Each row with the detail record of the same source that has the same place in its order; nulls where there is none.

    Records beyond a source's number of rows are left out. Numbers come from ranges, so one source may hold most rows.
    Columns of ``details`` other than the source must not be among those of ``rows``.
    """
    a = numbered(rows, "_k", *rows_order, by=(source,))
    b = numbered(details, "_k", *details_order, by=(source,))
    return a.join(b, [source, "_k"], "left").select(*rows.columns, *[c for c in details.columns if c != source])


def usable_matches(matches: DataFrame, images: DataFrame, metres: float | None = None, name: str = "image_name") -> DataFrame:
    """Matches within a distance, if one is given, whose image is there."""
    near = matches if metres is None else matches.where(F.col("distance_m") <= metres)
    return near.join(images.select(name).distinct(), name, "left_semi")


def copy_manifest(sample: DataFrame, folder: str, path: str = "path") -> DataFrame:
    """``(path, target, clash)``: where each sampled file is to be copied; files of one name clash but for the first path."""
    named = sample.select(F.col(path).alias("path")).distinct().withColumn("_name", F.substring_index("path", "/", -1))
    first = named.groupBy("_name").agg(F.min("path").alias("_first"))
    return named.join(first, "_name").select("path", F.concat(F.lit(folder.rstrip("/") + "/"), "_name").alias("target"), (F.col("path") != F.col("_first")).alias("clash"))
