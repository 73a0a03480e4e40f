"""Classifiers by held-out accuracy, the piece codec by round trips, the pipeline by its stages."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbsight.llm import quality, queries, toxicity
from kerbsight.llm import sentencepiece_codec as codec

SF, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.001"
needs_pieces = pytest.mark.skipif(not os.path.exists(queries.PIECES), reason="no vocabulary file")


def accuracy(df, spark, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = df.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    y = np.array([r[1] for r in rows])
    p = np.array([r[0] for r in rows])
    return (p[y == 1] == 1).mean(), (p[y == 0] == 1).mean()


def test_quality_held_out(spark):
    hit, false = accuracy(queries.op3_quality_classifier(spark, SF), spark, "quality")
    assert hit > 0.98 and false < 0.1


def test_toxicity_held_out(spark):
    hit, false = accuracy(queries.op6_toxicity(spark, SF), spark, "toxic")
    assert hit > 0.9 and false < 0.05


def test_scores_do_not_depend_on_batches_or_parts(monkeypatch):
    texts = ["", None, "a", "short text", "Et " * 300, "word%%% other*** " * 2000, "normal words in a row. " * 4000]
    net = quality.new_network()
    whole = quality.scores(net, pa.array(texts))
    assert np.allclose(whole, [quality.scores(net, pa.array([t]))[0] for t in texts]) and ((whole >= 0) & (whole <= 1)).all()
    monkeypatch.setattr(quality, "PIECE", 1 << 12)
    assert np.allclose(whole, quality.scores(net, pa.array(texts)), atol=1e-6)


def plain_score(net, text):
    """The network over one text, byte by byte, without any of the code that it is made of."""
    b = (text or "").encode()
    symbols = [x + 256 * (k + 8 <= len(b) and len(b) >= 10 and any(b[j : j + 8] == b[k : k + 8] for j in range(max(0, k - quality.REACH), k))) for k, x in enumerate(b)]
    starts = [0]
    while starts[-1] + net.chunk < len(b):
        starts.append(starts[-1] + net.stride)
    responses = []
    for s in starts:
        chunk = (symbols[s : s + net.chunk] + [quality.PADDING] * net.chunk)[: net.chunk]
        x = [float(v) for c in chunk for v in net.vectors[c]]
        responses.append([math.tanh(sum(a * float(w) for a, w in zip(x, net.filters[:, f], strict=True)) + float(net.biases[f])) for f in range(net.filters.shape[1])])
    top = [max(r[f] for r in responses) for f in range(net.filters.shape[1])]
    mean = [sum(r[f] for r in responses) / (len(responses) + quality.PRIOR) for f in range(net.filters.shape[1])]
    z = sum(a * float(w) for a, w in zip([*top, *mean], net.output, strict=True)) + float(net.bias[0])
    return 1 / (1 + math.exp(-z))


def test_scores_equal_a_plain_convolution():
    r = random.Random(3)
    texts = [None, "", "a", "abcdefgh", "abcdefghi" * 2, "ééé words and 東京 more", *("".join(r.choice("abcd ef\n") for _ in range(r.randrange(1, 400))) for _ in range(40)), "spam spam " * 60]
    net = quality.new_network()
    net.bias[:] = 0.3
    got = quality.scores(net, pa.array(texts))
    assert np.allclose(got, [plain_score(net, t) for t in texts], atol=1e-5)
    one = [quality.scores(net, pa.array([t]))[0] for t in texts]
    assert np.allclose(got, one, atol=1e-6)


def test_gradients_match_differences():
    net = quality.new_network(chunk=4, stride=2, width=2, filters=3)
    for k in net.names():
        setattr(net, k, getattr(net, k).astype(np.float64))
    texts, y, w = [b"abcdefgh", b"xyz", b"aaaaaaaaaaaaaaaaaaaa"], np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        p = quality.probability(net, *quality.pooled(net, quality.symbols(data, offsets), offsets))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = quality._gradients(net, texts, y, w)
    for name in ("filters", "output", "bias", "vectors", "biases"):
        x = getattr(net, name)
        at = np.unravel_index(np.abs(grads[name]).argmax(), x.shape)
        old = x[at]
        x[at] = old + 1e-4
        up = loss()
        x[at] = old - 1e-4
        down = loss()
        x[at] = old
        assert abs((up - down) / 2e-4 - grads[name][at]) < 2e-3, name


def test_gradients_of_a_long_text_in_pieces(monkeypatch):
    r = random.Random(8)
    text = " ".join(r.choice(["word", "Wörter", "same", "x1"]) for _ in range(900)).encode()
    net, y, w = quality.new_network(), np.array([1.0]), np.array([1.0])
    whole = quality._gradients(net, [text], y, w)
    monkeypatch.setattr(quality, "PIECE", 512)
    for name, x in quality._gradients(net, [text], y, w).items():
        assert np.allclose(x, whole[name], atol=1e-6), name


def odd(spark, kind="int"):
    docs = spark.createDataFrame([(1, "you idiot"), (2, "fine day"), (3, None), (4, ""), (4, ""), (5, "!?"), (None, "fine")], "doc_id long, text string")
    return docs, spark.createDataFrame([(1, 1), (2, 0), (2, 0), (9, None), (3, 7), (8, 1)], f"doc_id long, toxic {kind}")


def test_toxicity_odd_rows(spark):
    docs, labels = odd(spark)
    got = toxicity.score_toxicity(docs.withColumn("score", F.lit("clash")), labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert {r.n_words for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert len(toxicity.score_toxicity(docs, labels.limit(0)).collect()) == 7
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def plain_words(text):
    runs = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")
    cut = [x for run in runs for x in re.findall(r"[\u3000-\U0010ffff]|[^\u3000-\U0010ffff]+", run)]
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in cut]


def plain_ratios(texts, y, counted, d=toxicity.DISCOUNT):
    """The models in plain Python, with the likelihoods of both classes."""
    n = [Counter(), Counter()]
    for k in counted:
        w = plain_words(texts[k])
        n[y[k]].update(set(zip(["^", *w], w)))  # noqa: B905
    by_word, by_context = [Counter(), Counter()], [Counter(), Counter()]
    for c in (0, 1):
        for (v, w), x in n[c].items():
            by_word[c][w] += x
            by_context[c][v] += max(x - d, 0)
    both, words_, after = n[0] + n[1], by_word[0] + by_word[1], Counter(w for _, w in n[0] | n[1])
    given, size = Counter(), Counter()
    for (v, _), x in both.items():
        given[v] += min(x, d)
        size[v] += x
    share = sum(min(x, d) for x in words_.values()) / sum(words_.values())
    kept = [sum(max(x - d, 0) for x in by_word[c].values()) for c in (0, 1)]

    def log_p(c, v, w):
        p = (1 - share) * max(by_word[c][w] - d, 0) / kept[c] + share * (after[w] or 1e-3) / sum(after.values())
        if by_context[0][v] and by_context[1][v]:
            l = given[v] / size[v]  # noqa: E741
            p = (1 - l) * max(n[c][v, w] - d, 0) / by_context[c][v] + l * p
        return math.log(p)

    out = []
    for t in texts:
        w = plain_words(t)
        out.append(sum(log_p(1, a, b) - log_p(0, a, b) for a, b in zip(["^", *w], w)) / max(len(w), 1))  # noqa: B905
    return out


@pytest.mark.parametrize("broadcast_mb", [64, 0])
def test_likelihoods_equal_a_plain_model(spark, broadcast_mb):
    r = random.Random(2)
    vocabulary = [*(f"word{k}" for k in range(25)), "Ähre", "a" * 40, "idiot", "東", "京", "12"]
    texts = ["".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "-"]) for _ in range(r.randrange(1, 60))) for _ in range(50)] + ["", None, "字林山水悪口", "new words only"]
    y = [k % 2 for k in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    counted = [k for k in range(len(texts)) if zlib.crc32(str(k).encode()) % 5 not in (0, 4)]
    got = {x.doc_id: x for x in toxicity.score_toxicity(docs, labels, broadcast_mb=broadcast_mb).collect()}
    want = plain_ratios(texts, y, counted)
    assert len(got) == len(texts) and max(map(abs, want)) > 0.1
    assert all(abs(got[k].ratio - want[k]) < 1e-9 and got[k].n_words == len(plain_words(texts[k])) for k in got)


def test_toxicity_model_in_slices(spark, monkeypatch):
    """A model of several slices gives the scores of one, also of repeated rows and null ids, and no text is written or shuffled."""
    r, keep, columns = random.Random(4), toxicity.written, []
    monkeypatch.setattr(toxicity, "written", lambda df, name: (columns.extend(df.columns), keep(df, name))[1])
    monkeypatch.setattr(toxicity, "HOT", 2, raising=False)
    texts = [" ".join(r.choice(["one", "two", "three", "idiot", "five"]) for _ in range(r.randrange(1, 40))) for _ in range(60)]
    rows = [*enumerate(texts), (3, texts[3]), (3, texts[4]), (None, texts[5]), (None, texts[5]), (None, None), (70, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")

    def scores(mb):
        found = toxicity.score_toxicity(docs, labels, broadcast_mb=mb)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(((-1 if x.doc_id is None else x.doc_id), x.n_words, x.ratio, x.score) for x in found.collect())
        return got, plan

    one, _ = scores(64)
    cut, plan = scores(80e-6)
    assert len(one) == len(rows) and "_text" not in columns and "_text" not in plan
    assert all(a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-9) for a, b in zip(one, cut, strict=True))
    assert len({round(x[2], 6) for x in one}) > 20


def test_toxic_expressions_of_ordinary_words(spark):
    r = np.random.default_rng(5)
    some = lambda k: list(r.choice([f"w{k}" for k in range(30)], k))
    rows = [(i, " ".join([*some(20), *(["drop", "dead"] if i % 2 else ["dead", "drop"]), *some(20), *(["dead", "drop"] if i % 4 == 3 else ["dead", "calm", "drop", "off"])])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score_toxicity(docs, docs.select("doc_id", (docs.doc_id % 2).cast("int").alias("toxic"))).collect()
    assert np.mean([(x.score > 0.5) == (x.doc_id % 2 == 1) for x in got]) > 0.95


def test_toxicity_of_scripts_without_spaces(spark):
    texts = {1: "字林山水" * 3 + "悪口言葉" * 3, 0: "字林山水" * 3 + "良薬苦口" * 3}
    docs = spark.createDataFrame([(i, texts[i % 2]) for i in range(400)], "doc_id long, text string")
    got = toxicity.score_toxicity(docs, docs.select("doc_id", (docs.doc_id % 2).cast("int").alias("toxic"))).collect()
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in got)


def test_toxicity_of_one_word_and_of_nothing_but_toxic_words(spark):
    r = np.random.default_rng(3)
    plain, bad = [f"{a}{b}" for a in ("hou", "gar", "tab", "win", "riv") for b in ("se", "den", "le", "dow", "er")], ["idiot", "moron", "scumbag"]
    rows = [(i, " ".join([*r.choice(plain, 30), *(r.choice(bad, 3) if i % 2 else r.choice(plain, 3))])) for i in range(1000)]
    odd = {2000: "idiot", 2001: "idiot " * 50, 2002: "moron scumbag idiot", 2003: "house", 2004: "garden " * 50, 2005: ""}
    docs = spark.createDataFrame([*rows, *odd.items()], "doc_id long, text string")
    got = {x.doc_id: x.score for x in toxicity.score_toxicity(docs, docs.where("doc_id < 1000").select("doc_id", (docs.doc_id % 2).cast("int").alias("toxic"))).collect()}
    assert all(got[k] > 0.5 for k in (2000, 2001, 2002)) and all(got[k] < 0.5 for k in (2003, 2004, 2005)), {k: got[k] for k in odd}


def test_toxicity_spread_over_many_words(spark):
    r = np.random.default_rng(4)
    words = np.array([f"{a}{b}" for a in ("hou", "gar", "tab", "win", "riv") for b in ("se", "den", "le", "dow", "er")])
    often = np.array([np.where(np.arange(25) < 12, 1.0, 1.3), np.where(np.arange(25) < 12, 1.3, 1.0)])
    rows = [(i, " ".join(r.choice(words, 500, p=often[i % 2] / often[i % 2].sum()))) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score_toxicity(docs, docs.select("doc_id", (docs.doc_id % 2).cast("int").alias("toxic"))).collect()
    right = np.mean([(x.score > 0.5) == (x.doc_id % 2 == 1) for x in got])
    assert right > 0.8, right


def test_quality_odd_rows(spark):
    docs, labels = odd(spark)
    labels = labels.withColumnRenamed("toxic", "quality")
    out = quality.score_quality(docs.withColumn("score", F.lit("clash")).withColumn("_score", F.lit("clash")), quality.fit(docs, labels))
    got = out.collect()
    assert out.columns == ["doc_id", "text", "score", "_score"]
    assert len(got) == 7 and all(0 <= r._score <= 1 for r in got)
    assert {r._score for r in quality.score_quality(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}


TEXTS = ["Hello world", " leading", "two  spaces ", "line\nbreak\n\n", "", None, "Zürich 東京 🙂", "x" * 1000, "\t", " ", "ab" * 300 + " é" * 200, "Hello world", "internationalisierung" * 400]


@needs_pieces
def test_round_trips_and_both_ways_of_looking_up(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, word string")
    a = codec.encode(docs, queries.PIECES, check=True)
    b = codec.encode(docs, queries.PIECES, check=True, broadcast_mb=0)
    assert all(r.round_trip for r in [*a.collect(), *b.collect()])
    ids = {r.doc_id: r.ids for r in a.collect()}
    assert ids == {r.doc_id: r.ids for r in b.collect()}
    back = {r.doc_id: r.decoded for r in codec.decode(a, queries.PIECES).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert codec.encode(docs.limit(0), queries.PIECES).count() == 0


@needs_pieces
def test_best_path_equals_plain_viterbi(spark):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    score = {m.id_to_piece(i): (m.get_score(i), i) for i in range(m.get_piece_size()) if not m.is_byte(i) and not m.is_control(i) and not m.is_unknown(i)}
    words = ["▁hello", "▁internationalization", "▁xqzt", "▁the,", "▁"]
    pieces, _, zero, _ = codec.piece_table(spark, queries.PIECES)
    got = {r.word: r.ids for r in codec.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), pieces, zero).collect()}
    for w in words:
        best = [(0.0, [])]
        for j in range(1, len(w) + 1):
            best.append(max((best[i][0] + score[w[i:j]][0], [*best[i][1], score[w[i:j]][1]]) for i in range(max(0, j - 16), j) if w[i:j] in score))
        assert got[w] == best[-1][1], w


def plain_viterbi(word, score, zero):
    """Best path by the same rule, one place after another: of equal sums the longer last piece."""
    worst = min(s for s, _ in score.values()) - codec.BYTE_PENALTY
    best = [(0.0, 0, [])]
    for j in range(1, len(word) + 1):
        raw = word[j - 1].encode()
        into = [(best[i][0] + score[word[i:j]][0], j - i, i, [score[word[i:j]][1]]) for i in range(max(0, j - 16), j) if word[i:j] in score]
        into = into or [(best[j - 1][0] + len(raw) * worst, 1, j - 1, [zero + x for x in raw])]
        s, k, i, ids = max(into)
        best.append((s, k, (i, ids)))
    out, j = [], len(word)
    while j:
        i, ids = best[j][2]
        out[:0], j = ids, i
    return out


@needs_pieces
def test_words_of_any_length_equal_plain_viterbi(spark):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    score = {m.id_to_piece(i): (m.get_score(i), i) for i in range(m.get_piece_size()) if not m.is_byte(i) and not m.is_control(i) and not m.is_unknown(i)}
    r = np.random.default_rng(6)
    letters = np.array(list("etaoinshrdluABC_/=-é東"))
    words = ["".join(r.choice(letters, n)) for n in (63, 64, 65, 79, 80, 127, 128, 129, 143, 144, 200, 1000, 5000)]
    words += ["x" * 1000, "=" * 777, "internationalization" * 60, "\t" * 300, "aab" * 100, "▁" * 200, "東" * 130]
    pieces, _, zero, _ = codec.piece_table(spark, queries.PIECES)
    got = {r.word: r.ids for r in codec.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), pieces, zero).collect()}
    assert len(got) == len(words)
    for w in words:
        assert got[w] == plain_viterbi(w, score, zero), (len(w), w[:40])


@needs_pieces
def test_columns_pass_through_both_ways(spark):
    docs = spark.createDataFrame([(t, "a", "b", "c", "d", "e", "f") for t in TEXTS], "text string, IDS string, round_trip string, _row string, _h string, _ids string, word string")
    for mb in (96, 0):
        out = codec.encode(docs, queries.PIECES, check=True, broadcast_mb=mb)
        assert out.columns == ["text", "_row", "_h", "_ids", "word", "ids", "round_trip"]
        assert {(r._row, r._h, r._ids, r.word, r.round_trip) for r in out.collect()} == {("c", "d", "e", "f", True)} and out.count() == len(TEXTS)


@needs_pieces
def test_tables_round_trip(spark):
    assert queries.op9_sentencepiece(spark, SMALL).where("not round_trip").count() == 0


@needs_pieces
def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = p.quality(spark, docs, SMALL)
    assert good.columns == docs.columns
    lost = known.where("quality = 1").join(docs, "doc_id").join(good.select("doc_id"), "doc_id", "left_anti").count()
    assert lost <= 3
    kept = p.near_duplicates(spark, docs, SMALL)
    comp = queries.op10_jaccard_join(spark, SMALL)
    assert kept.count() == comp.select("component_id").distinct().count() and kept.columns == docs.columns
    clean = p.benchmark_leaks(spark, docs, SMALL)
    leaks = {r.doc_id for r in queries.op5_decontamination(spark, SMALL).collect()}
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean.collect()} == leaks
    lines = p.lines(spark, docs, SMALL)
    assert lines.count() == docs.count() and lines.where("n_chars <> length(text)").count() == 0


@pytest.fixture
def odd_corpus(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows and columns with clashing names, with labels and items."""
    names = "_score _drop _host _n_dropped _text _row _at ids round_trip component_id keep_id c n word"
    leak = "what is the name of the old man who lives near the river in a small red house"
    texts = ["fine words in a row here", "fine words in a row here", None, "", "long text " * 30000, f"so {leak} he said", "other text of a few words", "x"]
    ids = [1, 1, 2, None, 3, 4, None, 5]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{x} string" for x in names.split())
    rows = [(i, t, None, [None, "a"][k % 2], 3, *["clash"] * len(names.split())) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (5, 1, 0), (None, 0, 0), (2, None, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, leak), (1, leak), (None, "x"), (3, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


@needs_pieces
def test_pipeline_stages_on_odd_rows(spark, odd_corpus):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{odd_corpus}/documents.parquet")
    texts = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    every = texts(docs)
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, docs, odd_corpus)
        assert out.columns == docs.columns and {r._score for r in out.collect()} <= {"clash"}
        assert stage(spark, docs.limit(0), odd_corpus).count() == 0
    assert texts(p.lines(spark, docs, odd_corpus)) == every
    once = Counter(every)
    once[1, "fine words in a row here"] -= 1
    assert texts(p.near_duplicates(spark, docs, odd_corpus)) == once
    assert every - texts(p.benchmark_leaks(spark, docs, odd_corpus)) == Counter({k: 1 for k in every if k[0] == 4})
    coded = p.tokens(spark, docs, odd_corpus).collect()
    assert len(coded) == len(texts(docs)) + 1 and all(r.round_trip for r in coded) and sum(r.n_pieces == 0 for r in coded) == 2
    assert p.run(spark, odd_corpus).where("not round_trip").count() == 0


@needs_pieces
def test_pipeline_runs(spark):
    import corpus_pipeline as p

    out = p.run(spark, SMALL)
    assert out.where("not round_trip").count() == 0 and out.count() > 100
