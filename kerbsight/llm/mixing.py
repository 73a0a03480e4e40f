"""Mixing sources to target weights by systematic sampling.

1. Each source's target is its weight's share of the whole; what exceeds ``most`` times the source goes to the others by
   weight. Sources stand in order of size by weight, so those that are full come first, and running sums give the level
   at which the rest is shared.
2. Every document of a source expects the same number of copies, target by size. The prefix sum of expected copies, plus
   one random offset for the source, crosses an integer once for each copy that the mix takes. Expected copies are kept
   in units of 2**-24, so sums are exact and nothing gets more than ``most`` copies.
3. Documents stand by size, every second one from the other end, so sizes rise and fall once. What sampling errs on the
   way up it takes back on the way down, and a source's total misses its target by little more than gaps between sizes.

Places come from :func:`with_running`, so no task holds a whole source, however large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.llm.runtime import unused
from kerbsight.operators.sampling import numbered, with_running
from kerbsight.operators.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
#: Expected copies and offsets are kept in units of 2**-UNIT_BITS; prefix sums of up to 2**37 documents fit a long.
UNIT_BITS = 24


def n_words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source_col: str, size_col: str, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``(source, source_size, n_docs, target)``: what the mix should take of each source, in the unit of the sizes.

    Sources take the weights in turn, by code point, null last. The targets add up to the sizes of all documents, and
    none is above ``most`` times its source. Without any size all targets are 0; an empty table gives no rows.
    """
    sources = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size"), F.count("*").alias("n_docs"))
    sources = numbered(sources.withColumn("_null", F.col("source").isNull()), "_k", "_null", "source")
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("_k") - 1) % len(weights) + 1).cast("int"))
    sources = sources.withColumn("_w", turn.cast("long")).withColumns({"_full": F.col("source_size") * most, "_ratio": F.col("source_size").cast("double") / F.col("_w")})
    run = written(with_running(sources, [], ["_ratio", "_k"], ["_full", "_w"]), "sources")
    size, weight = run.agg(F.sum("source_size"), F.sum("_w")).first()
    exact = lambda c: c.cast("decimal(38,0)")
    left, rest = F.lit(size or 0) - F.col("_full_before"), F.lit(weight or 1) - F.col("_w_before")
    level = run.where(exact(F.col("_full")) * exact(rest) >= exact(left) * exact(F.col("_w"))).orderBy("_ratio", "_k").select(left.alias("left"), rest.alias("rest")).first() or (0, 1)
    share = (F.col("_w") * F.lit(level[0])).cast("double") / F.lit(level[1]).cast("double")
    return run.select("source", "source_size", "n_docs", F.least(F.col("_full").cast("double"), share).alias("target"))


def mixed(docs: DataFrame, size_col: str, id_col: str = "doc_id", source_col: str = "source", weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """Every row with ``(_copies, _source_size, _target)``: how often the mix takes it, and what holds for its source.

    No row is taken more than ``most`` times. Sizes are integers of 0 or more; null counts as 0. A null source is one of
    its own, the last. Rows of the same source, size and id are interchangeable: the number of copies of all of them is
    the same in every run, on any partitioning. Null ids stand first among rows of one size. An empty table gives an
    empty result; other columns come along whatever their names (the three new ones get underscores behind where needed).
    """
    n_copies, n_source, n_target = unused(docs.columns, "_copies", "_source_size", "_target")
    cell, source, size, row, key = unused(docs.columns, "_cell", "_src", "_size", "_row", "_key")
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(cell), F.col(source_col).alias(source), F.coalesce(F.col(size_col).cast("long"), F.lit(0)).alias(size), F.col(id_col).alias(key), F.monotonically_increasing_id().alias(row))
    sized = written(plain, "sized")
    targets = source_targets(sized, source, size, weights, most)
    unit = 1 << UNIT_BITS
    rate = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size") * F.lit(float(unit))), F.lit(most * unit))).otherwise(F.lit(0)).cast("long")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit(""))).cast("binary"))
    offset = F.conv(F.substring(digest, 1, UNIT_BITS // 4), 16, 10).cast("long")
    targets = targets.select(F.col("source").alias("_of"), "source_size", "n_docs", "target", rate.alias("_rate"), offset.alias("_offset"))
    ranked = numbered(sized, "_rank", size, key, row, by=(source,)).join(targets, F.col(source).eqNullSafe(F.col("_of")))
    k = F.col("_rank") - 1
    place = F.when(k % 2 == 0, F.floor(k / 2)).otherwise(F.col("n_docs") - F.floor((k + 1) / 2)).cast("long")
    crossed = lambda at: F.shiftright(F.col("_offset") + at * F.col("_rate"), UNIT_BITS)
    copies = (crossed(place + 1) - crossed(place)).cast("int")
    return ranked.select(f"{cell}.*", copies.alias(n_copies), F.col("source_size").alias(n_source), F.col("target").alias(n_target))


def mixture(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as the mix takes it, with ``_copy`` from 1.

    Rows are numbered and written once; what decides is worked out on sizes and ids alone, and texts are shuffled once, to
    meet their number of copies.
    """
    size, row, copy = unused([*docs.columns, "_copies"], "_words", "_row", "_copy")
    rows = written(docs.withColumns({size: n_words(F.col(text_col)), row: F.monotonically_increasing_id()}), "docs")
    narrow = rows.select(*dict.fromkeys((id_col, source_col)), size, row)
    taken = mixed(narrow, size, id_col, source_col, weights, most, seed)
    copies = next(c for c in taken.columns if c not in narrow.columns)
    taken = taken.where(F.col(copies) > 0).select(F.col(row).alias(f"{row}_of"), F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy))
    return rows.join(taken, F.col(row) == F.col(f"{row}_of")).select(*docs.columns, copy)
