"""Chat formatting, line dedup, exact dedup and URL rules: SQL parity, brute force and odd rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import parity
import pytest

from kerbsight.llm import chat_format, exact_dedup, line_dedup, queries, url_filter

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    assert parity.compare(spark, parity.connect(SF), name, SF).startswith("same")


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op8_exact_dedup"])
def test_no_python_in_the_plan(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def turns(spark, data):
    return spark.createDataFrame(data, "pair_id long, side string, turn int, role string, text string, prompt string")


def test_prefix_and_spans(spark):
    both = [(0, "system", "s"), (1, "user", "hi")]
    data = [(1, side, *t, "x") for side in ("chosen", "rejected") for t in both]
    data += [(1, "chosen", 2, "assistant", "good", "x"), (1, "chosen", 3, "user", "more", "x"), (1, "chosen", 4, "assistant", "ok", "x"), (1, "rejected", 2, "assistant", "bad", "x"), (1, "other", 2, "assistant", "?", "x"), (None, "chosen", 0, "user", "?", "x")]
    (r,) = chat_format.format_preferences(turns(spark, data)).collect()
    assert r.n_common == 2 and r.prompt == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n"
    assert "".join(r.chosen[s.start : s.end] for s in r.chosen_spans) == "good<|end|>\nok<|end|>\n"
    assert [r.rejected[s.start : s.end] for s in r.rejected_spans] == ["bad<|end|>\n"]


def test_odd_conversations(spark):
    data = [(1, "chosen", 0, None, None, "x"), (1, "rejected", 0, "", "", "x"), (2, "chosen", 0, "user", "a", "x"), (3, "chosen", 0, "user", "a", "x"), (3, "chosen", 0, "user", "a", "x"), (3, "rejected", 0, "user", "a", "x"), (4, "chosen", None, "user", "null first", "x"), (4, "chosen", -5, "user", "b", "x"), (4, "rejected", 0, "user", "c", "x")]
    got = {r.pair_id: r for r in chat_format.format_preferences(turns(spark, data)).collect()}
    assert (got[1].n_common, got[1].chosen, got[1].rejected) == (1, "", "")
    assert (got[2].n_common, got[2].prompt, got[2].rejected) == (0, "", "")
    assert (got[3].n_common, got[3].chosen, got[3].rejected) == (1, "<|user|>\na<|end|>\n", "")
    assert got[4].chosen.index("null first") < got[4].chosen.index("b<")
    assert chat_format.format_preferences(turns(spark, [])).count() == 0


def documents(spark, texts, ids=None, schema="doc_id long, text string, keep_id string, _id int"):
    ids = ids or range(1, len(texts) + 1)
    return spark.createDataFrame([(i, t, "clash", 5) for i, t in zip(ids, texts, strict=True)], schema)


def test_exact_groups(spark):
    r = random.Random(1)
    texts = [r.choice(["a b", "a  b", "a\tb", "a b ", "", None, " ", "x" * 500, "x" * 499 + "y", "ä b", "long " * 3000]) for _ in range(200)]
    got = {x.doc_id: x for x in exact_dedup.exact_dedup(documents(spark, texts)).collect()}
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for i, t in enumerate(norm, 1):
        same = [j for j, u in enumerate(norm, 1) if u == t]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (same[0], len(same), same[0] == i)


def test_exact_odd_rows(spark):
    d = documents(spark, ["a", "a", "a", "b", "a", "c", "c"], [3, None, 3, 4, 9, None, None])
    got = Counter((x.doc_id, x.keep_id, x.group_size, x.kept) for x in exact_dedup.exact_dedup(d).collect())
    assert got == Counter([(None, 3, 4, False), (3, 3, 4, True), (3, 3, 4, False), (4, 4, 1, True), (9, 3, 4, False), (None, None, 2, True), (None, None, 2, False)])
    assert exact_dedup.exact_dedup(documents(spark, [])).count() == 0


def test_exact_query_on_odd_rows_equals_sql(spark, tmp_path):
    texts = ["x", "x", "x ", "y", "one", "two", None, "", "long " * 5000, "long  " * 5000, "x"]
    d = documents(spark, texts, [1, 1, None, 2, 3, 3, 7, 7, 8, None, 1])
    d.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(queries.ORACLE["op8_exact_dedup"])
    got = queries.op8_exact_dedup(spark, str(tmp_path))
    order = sorted(got.columns)
    assert Counter(tuple(r[c] for c in order) for r in got.collect()) == Counter(tuple(dict(zip(want.columns, r, strict=True))[c] for c in order) for r in want.fetchall())
    assert got.count() == len(texts)


def test_digest_is_that_of_the_normalised_text(spark):
    row = queries.op8_exact_dedup(spark, SF).first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    assert row.text_sha256 == hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text).encode()).hexdigest()


URLS = [None, "", "no host", "http://net", "http://net/", "https://A.B.NET/x", "http://internet/x", "http://example.net/en/1", "http://www.example.net/en", "http://x.example.net/en/?q#f", "ftp://example.com/de/", "http://a.org/fr/#x", "http://a.org/fr?x=/", "http://u@example.com:80/de/", "x://y://z.net/", "http://example.com/de/\nnext", "http://.net/", "http://net./"]


def expected(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.name), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and best.name, best.verdict if best else "allow"


@pytest.mark.parametrize("trie_rules", [1000, 0])
def test_url_rules(spark, trie_rules):
    rules = [*queries.RULES, url_filter.Rule("net", "/x", "allow"), url_filter.Rule("b.net", "/x", "block"), url_filter.Rule("example.com", "", "allow"), url_filter.Rule("com", "/d", "block")]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate([*URLS, URLS[4]])], "page_id long, url string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules, trie_rules=trie_rules).collect()}
    assert got == {i: expected(u, rules) for i, u in enumerate([*URLS, URLS[4]])}
    assert {r.verdict for r in url_filter.filter_urls(pages, []).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def test_lines_odd_rows(spark):
    texts = [f"menu \n\nunique {i}\n  foot" for i in range(10)] + ["menu\nfoot"] * 30 + [None, "", "menu"]
    sites = ["a"] * 10 + ["b"] * 30 + ["a", None, "c"]
    d = spark.createDataFrame([(i, t, s, 7, "x") for i, (t, s) in enumerate(zip(texts, sites, strict=True))], "doc_id long, text string, source string, _n int, _host string")
    d = d.withColumn("_drop", d._n).withColumn("_n_dropped", d._host)
    out = line_dedup.drop_frequent_lines(d, ratio=0.5, min_pages=3)
    assert out.columns == [*d.columns[:-1], "_n_dropped"] and {(r._n, r._host, r._drop) for r in out.collect()} == {(7, "x", 7)}
    got = {r.doc_id: (r.text, r._n_dropped) for r in out.collect()}
    assert all(got[i] == (f"\nunique {i}", 2) for i in range(10))
    assert got[10] == ("menu\nfoot", 0)  # thirty copies are one page
    assert got[40] == (None, 0) and got[41] == ("", 0) and got[42] == ("menu", 0)
    assert line_dedup.drop_frequent_lines(d.limit(0)).count() == 0
