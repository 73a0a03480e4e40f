"""URL rules in a trie over reversed host labels and path segments, with longest-match precedence."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rule set up to this many rules is broadcast as one trie; a larger one is joined instead.
TRIE_RULES = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def build_trie(rules: Iterable[Rule]) -> dict:
    """Nested dicts. A host node has its child labels and, under the key ``None``, its path trie.

    A path node has its child segments and, under ``None``, the rules that end there: pairs of the rule's unfinished
    last segment and the rule. The path ``/en/`` is the segments ``''``, ``en`` and an empty unfinished one.
    """
    root: dict = {}
    for r in rules:
        node = root
        for label in reversed(r.host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(None, {})
        *whole, rest = r.path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        node.setdefault(None, []).append((rest, r))
    return root


def longest(trie: dict, host: str, path: str) -> Rule | None:
    """The matching rule with the most characters; of equal ones that with the longer host, then a block."""
    best, key = None, None
    host_node, labels, segments = trie, host.split("."), path.split("/")
    for label in reversed(labels):
        host_node = host_node.get(label)
        if host_node is None:
            break
        node = host_node.get(None)
        for segment in segments:
            if node is None:
                break
            for rest, rule in node.get(None, ()):
                k = (len(rule.name), len(rule.host), rule.verdict == "block")
                if segment.startswith(rest) and (key is None or k > key):
                    best, key = rule, k
            node = node.get(segment)
    return best


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow", trie_rules: int = TRIE_RULES) -> DataFrame:
    """Returns ``(id, host, path, rule, verdict)``, one row for each input row.

    A rule fits its host and all subdomains if the url's path starts with the rule's; the longest fitting rule decides,
    and without one the verdict is ``default`` and the rule null. A null url, or one without ``://``, has an empty host
    and path. Repeated rows and ids each get their own row; other columns are ignored. An empty rule set leaves every
    url at ``default``. Rules beyond ``trie_rules`` aren't broadcast: each url's host suffixes and path prefixes are
    joined to the rule table, with the same result.
    """
    urls = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")).select("_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    rules = list(dict.fromkeys(rules))
    if len(rules) > trie_rules:
        return _joined(urls, rules, default).withColumnRenamed("_id", id_col)
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [longest(trie.value, h, p) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame({"rule": [r and r.name for r in found], "verdict": [r.verdict if r else default for r in found]}, dtype=object)

    return urls.withColumn("_j", judge("host", "path")).select(F.col("_id").alias(id_col), "host", "path", F.col("_j.rule").alias("rule"), F.col("_j.verdict").alias("verdict"))


def _joined(urls: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    spark = urls.sparkSession
    table = spark.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in rules], "_h string, _p string, _rule string, _verdict string")
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.sequence(F.lit(0), F.length("path")), lambda i: F.substring(F.col("path"), F.lit(1), i))
    distinct = urls.select("host", "path").distinct()
    fits = distinct.withColumn("_h", F.explode(suffixes)).withColumn("_p", F.explode(prefixes)).join(table, ["_h", "_p"])
    order = F.struct(F.length("_rule"), F.length("_h"), (F.col("_verdict") == "block"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict")), order).alias("_j"))
    return urls.join(best, ["host", "path"], "left").select("_id", "host", "path", F.col("_j.rule").alias("rule"), F.coalesce("_j.verdict", F.lit(default)).alias("verdict"))
