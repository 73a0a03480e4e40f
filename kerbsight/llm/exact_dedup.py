"""Exact deduplication by progressive refinement, in DataFrame functions only.

Rows are grouped by the length of their normalised text and within it by a hash of its first characters; one scan gives
both counts. Only rows whose prefix group has company are read in full for the full hash. A bitmap of those groups marks
them in the second scan, so no text is shuffled. Every grouping is a partial aggregate, so a group that holds a third of
all rows is counted before it is shuffled; the join back is an ordinary one that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.llm.runtime import flagged
from kerbsight.operators.scratch import written

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes the empty string."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, digest_col: str | None = None) -> DataFrame:
    """Returns ``(id, keep_id, group_size, kept)``, one row for each input row, and its SHA-256 where ``digest_col`` is given.

    Of rows with equal normalised text the one with the smallest id stays. Null texts count as empty, and empty texts
    are equal to each other. A null id is larger than any other; where all ids of a group are null, so is ``keep_id``.
    Rows that repeat an id are rows of their own: of several with a group's smallest id, one stays. The digest is that of
    the normalised text in UTF-8, of all rows, so with it the second scan reads all texts. Other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    text = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
    sized = text.select("_id", "_text", F.length("_text").alias("_len"), F.xxhash64(F.substring("_text", 1, prefix_chars)).alias("_head"))
    heads = written(sized.groupBy("_len", "_head").agg(F.count("*").alias("_n")).where("_n > 1").select("_len", "_head"), "heads")
    full = F.sha2("_text", 256)
    read = full if digest_col else F.when(F.col("_alike"), full)
    rows = flagged(sized, heads, ["_len", "_head"], "_alike").select("_id", "_alike", read.alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    rows = written(rows, "hashes")
    alike, alone = rows.where("_alike"), rows.where("not _alike")
    least = F.min(F.struct(F.col("_id").isNull(), "_id", "_row"))
    groups = written(alike.groupBy("_hash").agg(least.alias("_least"), F.count("*").alias("_size")), "groups")
    named = lambda df, keep, size, kept: df.select(F.col("_id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), *([F.col("_hash").alias(digest_col)] if digest_col else []))
    return named(alone, F.col("_id"), F.lit(1).cast("long"), F.lit(True)).unionByName(named(alike.join(groups, "_hash"), F.col("_least._id"), F.col("_size"), F.col("_least._row") == F.col("_row")))
