"""Removal of lines that recur on many pages of one site, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.llm.runtime import unused
from kerbsight.operators.scratch import written


def line_key(line: Column) -> Column:
    """A line's 64-bit key, without the white space around it."""
    return F.xxhash64(F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))


def frequent_lines(docs: DataFrame, host_col: str, text_col: str, ratio: float, min_pages: int) -> DataFrame:
    """``(_host, _drop)``: for each site that has some, the keys of its boilerplate lines.

    A site's pages are its different texts: copies of a page count once. As a page's lines are counted once, a site has
    at most (mean number of lines of its pages) / ratio such lines, which bounds the array.
    """
    lines = F.array_distinct(F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1), line_key))
    pages = docs.select(F.coalesce(F.col(host_col), F.lit("")).alias("_host"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_page"), lines.alias("_lines"))
    pages = pages.groupBy("_host", "_page").agg(F.first("_lines").alias("_lines"))
    totals = pages.groupBy("_host").agg(F.count("*").alias("_total"))
    counts = pages.select("_host", F.explode("_lines").alias("_key")).where(F.col("_key") != F.xxhash64(F.lit(""))).groupBy("_host", "_key").agg(F.count("*").alias("_pages")).where(F.col("_pages") >= min_pages)
    return counts.join(totals, "_host").where(F.col("_pages") > ratio * F.col("_total")).groupBy("_host").agg(F.sort_array(F.collect_list("_key")).alias("_drop"))


def drop_frequent_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.05, min_pages: int = 5, count_col: str = "_n_dropped") -> DataFrame:
    """All columns and rows of ``docs``, with the text freed of its site's boilerplate lines, and ``count_col``.

    A line is boilerplate if more than ``ratio`` of its site's pages have it, and at least ``min_pages`` do; lines are
    compared without white space at their ends. Empty lines stay, the order of lines too. A null site counts as the
    empty one, a null text stays null with nothing dropped. Repeated rows are treated alike; an empty table gives an
    empty result. ``count_col`` replaces a column of that name; all other columns pass through, whatever their names.
    Line keys have 64 bits.

    Two partial aggregates over (site, page) and (site, line), then one join of the pages with the sites' short arrays,
    which are written first so that the planner knows their true size.
    """
    host, drop = unused(docs.columns, "_host", "_drop")
    found = written(frequent_lines(docs, host_col, text_col, ratio, min_pages), "lines").select(F.col("_host").alias(host), F.col("_drop").alias(drop))
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(drop), line_key(x)))
    joined = docs.withColumn(host, F.coalesce(F.col(host_col), F.lit(""))).join(found, host, "left")
    changed = F.when(F.col(drop).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    gone = F.when(F.col(drop).isNull() | F.col(text_col).isNull(), 0).otherwise(F.size(lines) - F.size(kept))
    own = [c for c in docs.columns if c.lower() != count_col.lower()]
    return joined.select(*[(changed.alias(c) if c == text_col else F.col(c)) for c in own], gone.cast("long").alias(count_col))
