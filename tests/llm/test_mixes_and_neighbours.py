"""Spelling variants, source mixes and hard negatives against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from kerbsight.llm import bytescan, hard_negatives, mixing, queries, spelling

# --- spelling variants ---


def plain_counts(rows, min_points=7, every=None):
    counts = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            if every and (h := zlib.crc32(f"{'' if i is None else i}:{w}".encode())) % every == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            if len(w) >= min_points:
                counts[w] += 1
    return dict(counts)


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts, min_count=2, ratio=10):
    words = {w: n for w, n in counts.items() if n >= min_count}
    out, form = {}, {}
    for w, n in words.items():
        near = sorted((-words[v], v) for v in words if are_near(w, v))
        form[w] = near[0][1] if near and -near[0][0] >= ratio * n else None
        out[w] = [n, len(near)]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], out[w][1], words.get(form[w]))
    return out


def variants(spark, counts, **options):
    rows = spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), **options).collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def spoilt(r, word, letters="abé÷"):
    k = r.randrange(len(word) + 1)
    return r.choice([word[:k] + r.choice(letters) + word[k:], word[:k] + word[k + 1 :], word[:k] + r.choice(letters) + word[k + 1 :]])


def vocabulary(seed):
    r, words = random.Random(seed), {}
    for _ in range(30):
        w = "".join(r.choice("abÿé÷") for _ in range(r.choice([1, 2, 3, 8, 12])))
        n = r.choice([10**5, 10**3, 50, 3])
        words[w] = n
        for _ in range(r.choice([0, 3, 12])):
            w = spoilt(r, w) or "a"
            n = max(1, n // r.choice([1, 9, 10, 11, 100]))
            words.setdefault(w, n)
    return words


@pytest.mark.parametrize("seed", range(4))
def test_variants_equal_plain_ones(spark, seed):
    words = vocabulary(seed)
    assert variants(spark, words) == plain_variants(words)
    assert variants(spark, words, min_count=1, ratio=2) == plain_variants(words, 1, 2)


def test_long_chains_runs_of_letters_and_ties(spark):
    chain = {"abcdefg" + "x" * k: 2 * 10**k for k in range(16)}
    runs = {"aaaaaaa": 5, "aaaaaaaa": 50, "aaaaaaab": 50, "baaaaaaa": 500, "aaaaaaaaa": 50}
    long = {"q" * 3000: 30, "q" * 2999: 2, "q" * 1500 + "r" + "q" * 1499: 300}
    for words in (chain, runs, long):
        assert variants(spark, words) == plain_variants(words)
    assert variants(spark, {}) == {}
    assert variants(spark, {None: 7, "abcdefg": 2}) == {"abcdefg": (None, "abcdefg", 2, 0, None)}
    with pytest.raises(ValueError, match="ratio"):
        spelling.spelling_variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_shared_hashes_dont_make_words_near(spark, monkeypatch):
    """Hashes of four bits: nearly all words meet, and the strings part them."""
    words = list(vocabulary(9)) + ["".join(random.Random(k).choices("abcdef", k=9)) for k in range(40)]
    h, owner, place = spelling.deletion_keys(words)
    keys = spelling._company(h >> np.uint64(60), owner, place)
    import pyarrow as pa

    table = pa.table({"_row": keys["_row"], "_range": np.zeros(len(keys["_row"]), np.int32), "_place": keys["_place"], "word": [words[k] for k in keys["_row"]], "n": np.arange(len(words))[keys["_row"]]})
    got = defaultdict(int)
    for r in spelling._near(table).to_pylist():
        got[words[r["_row"]]] += r["near"]
    assert {w: got[w] for w in words} == {w: sum(are_near(w, v) for v in words) for w in words}


def odd_texts(seed):
    r = random.Random(seed)
    words = ["Information", "INFORMATIEN", "Größeres", "straßenbahn", "naïveté", "×÷×÷×÷×÷", "ÀÉÎÕÜàéîõü", "kurz", "中文字母很多字母", "abcdefgЖhijklmn", "x" * 200]
    texts = [" ".join(r.choices(words, k=r.choice([1, 5, 40]))) + r.choice(["", ".", "\n", "!"]) for _ in range(60)]
    return texts + [None, "", "é", "ÿ" * 7, "a" * 6, "7", texts[0], texts[0]]


def test_counts_equal_plain_ones(spark):
    texts = odd_texts(3)
    ids = [*range(len(texts) - 4), 5, 5, None, None]
    docs = spark.createDataFrame([(i, t, 1, "clash", 2) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, n long, word string, _text int")
    for every in (None, 31, 2):
        got = {r["word"]: r["n"] for r in spelling.word_counts(docs, every=every).collect()}
        assert got == plain_counts(zip(ids, texts, strict=True), every=every)
    assert spelling.word_counts(docs.limit(0)).count() == 0


def test_very_long_texts_are_cut_between_words(spark, monkeypatch):
    r = random.Random(1)
    text = " ".join("".join(r.choices("abcÉé", k=r.choice([3, 7, 9]))) for _ in range(3000)) + "ü" * 9000
    monkeypatch.setattr(bytescan, "CHUNK", 1000)
    import pyarrow as pa

    got = Counter()
    for words in spelling._words_of([7], pa.array([text]), 7, 5):
        got.update(words.to_pylist())
    assert dict(got) == plain_counts([(7, text)], 7, 5)


# --- source mixes ---


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * w[s] / (sum(w[x] for x in open_) or 1) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {**{s: float(v) for s, v in full.items()}, **share}
        full |= {s: most * sizes[s] for s in over}


def mix_rows(spark, rows, **options):
    df = spark.createDataFrame([(i, s, t, "clash", 1) for i, s, t in rows], "doc_id long, source string, text string, _copies string, _part int")
    sized = df.withColumn("size", mixing.n_words(df["text"]))
    return mixing.mixed(sized, "size", **options)


def some_documents(seed, n=400):
    r = random.Random(seed)
    sources = ["b", "a", "Z", "é", "\U0001f600", "", None]
    rows = [(i, r.choices(sources, [30, 5, 5, 5, 2, 1, 3])[0], " ".join(["w"] * int(r.lognormvariate(3, 1.2)))) for i in range(n)]
    return rows + [(n, "a", None), (n + 1, "hollow", ""), (n + 2, "hollow", " \t"), (3, "b", "w w"), (3, "b", "w w"), (None, "b", "w"), (None, "b", "w")]


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_what_is_taken(spark, seed):
    rows = some_documents(seed)
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, s, t in rows:
        n = len((t or "").split())
        sizes[s] += n
        largest[s] = max(largest[s], n)
    want = plain_targets(sizes)
    got = mix_rows(spark, rows).collect()
    assert len(got) == len(rows)
    assert math.isclose(sum(want.values()), sum(sizes.values()))
    taken = defaultdict(int)
    for r in got:
        assert r["_source_size"] == sizes[r["source"]] and math.isclose(r["_target"], want[r["source"]], rel_tol=1e-12, abs_tol=1e-9)
        rate = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert math.floor(rate - 1e-6) <= r["_copies_"] <= min(3, math.ceil(rate + 1e-6))
        taken[r["source"]] += r["_copies_"] * r["size"]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = mix_rows(spark, rows[::-1]).repartition(7).collect()
    assert Counter((r["doc_id"], r["size"], r["_copies_"]) for r in again) == Counter((r["doc_id"], r["size"], r["_copies_"]) for r in got)


def test_prefix_sums_cross_integers_as_plain_ones_do(spark):
    rows = [(i, "s", " ".join(["w"] * (i % 7))) for i in range(50)] + [(100 + i, "t", " ".join(["w"] * 40)) for i in range(20)]
    got = {r["doc_id"]: r for r in mix_rows(spark, rows).collect()}
    import hashlib

    for source in "st":
        docs = sorted((len(t.split()), i) for i, s, t in rows if s == source)
        order = docs[::2] + docs[1::2][::-1]
        size = sum(n for n, _ in docs)
        rate = min(3 << 24, math.floor(got[docs[0][1]]["_target"] / size * (1 << 24)))
        at = int(hashlib.md5(f"mix:{source}".encode()).hexdigest()[:6], 16)
        for _, i in order:
            assert got[i]["_copies_"] == (at + rate) // (1 << 24) - at // (1 << 24)
            at += rate


def test_mix_of_nothing_and_the_mix_itself(spark):
    assert mix_rows(spark, []).count() == 0
    hollow = mix_rows(spark, [(1, None, None), (2, "a", "")]).collect()
    assert [(r["_copies_"], r["_target"]) for r in hollow] == [(0, 0.0)] * 2
    one = mix_rows(spark, [(k, "a", "w w") for k in range(5)]).collect()
    assert [r["_copies_"] for r in one] == [1] * 5
    rows = some_documents(5, 100)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = Counter({(r["doc_id"], r["text"]): 0 for r in []})
    for r in mix_rows(spark, rows).collect():
        want[r["doc_id"], r["text"]] += r["_copies_"]
    out = mixing.mixture(df)
    assert out.columns == ["doc_id", "source", "text", "_copy"]
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == +want


# --- hard negatives ---


def plain_negatives(rows, k=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    later = lambda i: (i is None, i or 0)
    out = []
    for a, (i, q, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        scored = sorted(((sum(x * y for x, y in zip(q, v, strict=False)), j, m) for b, (j, v, m) in enumerate(kept) if b != a), key=lambda x: (-x[0], later(x[1])))
        for s, j, _ in [x for x in scored if x[2] == label][:k]:
            hits = [x for x in scored if x[2] != label and 80 * s <= 100 * x[0] <= 100 * s][:k]
            out += [(i, j, n + 1, h[1], s, h[0]) for n, h in enumerate(hits)]
    return Counter(out)


def mined(spark, rows):
    df = spark.createDataFrame([(i, v, label, 1, "clash", 2.0) for i, v, label in rows], "vec_id long, embedding array<float>, label int, _row int, _score string, _vec double")
    return Counter(tuple(r) for r in hard_negatives.hard_negatives(df).collect())


def vectors(seed, n=900, dim=6, copies=True):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, dim))
    rows = [(i, [float(x) for x in centres[r.integers(8)] + r.normal(size=dim) * r.choice([0.05, 0.5])], int(r.integers(4))) for i in range(n)]
    if copies:
        rows += [(2000 + i, rows[0][1], int(i % 3)) for i in range(300)]
    odd = [(700, None, 1), (800, rows[3][1], None), (801, [math.nan] * dim, 1), (802, [math.inf] + [0.0] * (dim - 1), 1), (803, [None] * dim, 1), (900, [], 2), (300, rows[5][1], 1), (300, rows[5][1], 1), (None, rows[0][1], 1), (None, rows[7][1], 2), (901, rows[9][1][:3], 0)]
    return rows + odd


@pytest.mark.parametrize(("seed", "block"), [(0, 64), (1, 200), (2, 8192)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "PORTION", 5)
    rows = vectors(seed)
    want = plain_negatives(rows)
    assert len(want) > 100 and mined(spark, rows) == want


def test_negatives_of_nothing_of_one_label_and_of_large_numbers(spark):
    assert mined(spark, []) == Counter()
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == Counter()
    assert mined(spark, [(100, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, [-1.0, 2.0], 1)]) == Counter()
    assert mined(spark, [(100, [], 1), (2, [], 1), (3, [], 2)]) == Counter({(100, 2, 1, 3, 0, 0): 1})
    big = [(100 * i, [float(2**20 + i), float(2**19 - 3 * i)], i % 2) for i in range(12)]
    assert mined(spark, big) == plain_negatives(big)
    huge = [(100 * i, [float(2.0**60 * i), 1.0], i % 2) for i in range(6)]
    assert sum(mined(spark, huge).values()) >= 0


def test_bounds_hold_and_skip_buckets(monkeypatch):
    """Every row lies within its leaf's bounds, and clustered rows leave most buckets unseen."""
    r = np.random.default_rng(4)
    v = r.normal(size=(64, 5))[r.integers(64, size=4000)] + r.normal(size=(4000, 5)) * 0.01
    v = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None])
    m = float((v**2).sum(1).max())
    ids, none = np.arange(4000), np.zeros(4000, bool)
    block = hard_negatives.Block(ids, none, ids, np.zeros(4000, np.int64), v, m)
    q = v[::100]
    near, far = block.tree.bounds(hard_negatives.asking(q))
    d = hard_negatives.distances(hard_negatives.asking(q), hard_negatives.augmented(block.vectors, m))
    leaf = np.repeat(np.arange(block.tree.leaves), np.diff(block.edges))
    assert (d >= near[:, leaf] - 1e-3).all() and (d <= far[:, leaf] + 1e-3).all()
    seen, look = [], block._look
    monkeypatch.setattr(block, "_look", lambda want, least, who, bucket: seen.append(len(who)) or look(want, least, who, bucket))
    n = len(q)
    found = block.search(hard_negatives.Wanted(q, ids[::100], np.zeros(n, np.int64), True, np.full(n, -np.inf), np.full(n, np.inf), 5))
    s = q @ block.vectors.T
    for k in range(n):
        others = np.where(block.rows == 100 * k, -np.inf, s[k])
        assert sorted(found["s"][found["q"] == k])[::-1] == sorted(others)[::-1][:5]
    assert sum(seen) < 0.6 * n * block.tree.leaves


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_source_mixing", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    import parity

    sf = "/root/testdata/sf0.001"
    assert name in queries.ORACLE and parity.compare(spark, parity.connect(sf), name, sf).startswith("same")
