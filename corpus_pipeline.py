"""A corpus pipeline: quality, boilerplate lines, near duplicates, benchmark leaks, then tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return the columns of
documents; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.llm.decontaminate import contaminated
from kerbsight.llm.jaccard_join import jaccard_components
from kerbsight.llm.line_dedup import drop_frequent_lines
from kerbsight.llm.quality import fit, score_quality
from kerbsight.llm.queries import PIECES, QUALITY_CUT
from kerbsight.llm.runtime import table, unused
from kerbsight.llm.sentencepiece_codec import encode
from kerbsight.operators.scratch import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are judged as empty ones, repeated rows alike, and a null id is as good as any. Without labels
    all documents stay; an empty table stays empty. All columns pass through, whatever their names.
    """
    (score,) = unused(docs.columns, "_score")
    scored = score_quality(docs, fit(docs, table(spark, sf_dir, "labels")), score_col=score)
    return scored.where(F.col(score) >= QUALITY_CUT).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; the documents stay.

    Null texts stay null, with a null ``n_chars``; empty ones stay empty; a null source is one source. Repeated rows are
    cleaned alike. All columns pass through, whatever their names; a column ``n_chars`` follows the text if there is one.
    """
    (gone,) = unused(docs.columns, "_n_dropped")
    cleaned = drop_frequent_lines(docs, count_col=gone)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id.

    Texts without words, null ones too, are no one's duplicates and stay, and so do rows with a null id. Rows that repeat
    an id stay or go together; of such rows with one text one stays. All columns pass through, whatever their names.
    """
    kept = jaccard_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    (text,) = unused(docs.columns, "_text")
    named = docs.join(kept, "doc_id", "left_semi").withColumn(text, F.xxhash64("text"))
    return named.dropDuplicates(["doc_id", text]).select(*docs.columns).unionByName(docs.where("doc_id is null"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none; rows with a null id stay; of rows that repeat an id all go if one holds an item. With
    an empty benchmark all stay. All columns pass through, whatever their names.
    """
    leaks = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left as piece ids, and whether they decode to its text.

    Null and empty texts have no ids, and that is a round trip; repeated rows and null ids are rows like others; other
    columns aren't returned; an empty table gives an empty result.
    """
    coded = encode(docs.select("doc_id", "text"), PIECES, check=True)
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks), ("tokens", tokens)]

#: No stage but the second can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
