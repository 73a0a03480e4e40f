"""Near duplicates, repeated passages and benchmark leaks against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kerbsight.llm import decontaminate, jaccard_join, suffix_dedup

SCHEMA = "doc_id long, text string, n long, component_id string, _id int"


def frame(spark, texts, ids=None):
    ids = ids if ids is not None else range(1, len(texts) + 1)
    return spark.createDataFrame([(i, t, 1, "clash", 2) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def words(r, n, vocabulary=400):
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts, ids):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(texts)):
        least[find(i)] = min(least.get(find(i), 1 << 60), ids[i])
    return {ids[i]: (len(sets[i]), least[find(i)]) for i in range(len(texts))}


def near_copies(seed, families=12, passage=True):
    r, texts = random.Random(seed), []
    common = " ".join(words(r, 40))
    for k in range(families):
        w = words(r, r.choice([3, 6, 20, 60, 150]))
        for _ in range(r.choice([1, 2, 5, 9])):
            v = list(w)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                v[r.randrange(len(v))] = r.choice(["New", "w1", "ä"])
            texts.append(r.choice([" ", "  ", "\n"]).join(v) + (f" {common}" if passage and k % 3 == 0 else ""))
    return texts + ["", None, " \t", "one two", "One  two", "ÄB c d e f", "äb c d e f"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    texts = near_copies(seed)
    ids = random.Random(seed).sample(range(1000), len(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark, texts, ids)).collect()}
    assert got == components(texts, ids)


def test_long_posting_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    texts = near_copies(7, 25)
    ids = list(range(1, len(texts) + 1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark, texts)).collect()}
    assert got == components(texts, ids)


def linked(texts):
    """Components of many texts: their shared shingles as a matrix, all pairs by products of its rows."""
    sets = [shingles(t) for t in texts]
    often = Counter(x for s in sets for x in s)
    place = {x: k for k, x in enumerate(x for x, n in often.items() if n > 1)}
    has = np.zeros((len(texts), len(place)), np.float32)
    for i, s in enumerate(sets):
        has[i, [place[x] for x in s if x in place]] = 1
    size, parent = np.array([len(s) for s in sets]), list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(len(texts)):
        both = has[:i] @ has[i]
        for j in np.flatnonzero((both > 0) & (100 * both >= 80 * (size[:i] + size[i] - both))):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return {i + 1: (int(size[i]), find(i) + 1) for i in range(len(texts))}


def test_list_of_thousands_at_the_real_limit(spark):
    """A passage that five thousand texts share, around the similarity of a link, and drifting copies of it."""
    r = random.Random(11)
    passage = words(r, 60, 10**6)
    texts, drift = [], list(passage)
    for k in range(5000):
        v = list(passage)
        for _ in range(r.choice([0, 1, 1, 2, 2, 3])):
            v[r.randrange(60)] = f"x{k}"
        texts.append(" ".join([*v, *words(r, r.choice([0, 2, 5, 8, 12, 20]), 10**6)]))
    for _ in range(200):
        drift[r.randrange(60)] = f"y{r.randrange(10**6)}"
        texts.append(" ".join(drift))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(frame(spark, texts)).collect()}
    assert got == linked(texts)


def test_blocks_of_a_long_list_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    r = random.Random(12)
    passage = words(r, 40, 10**6)
    texts = [" ".join([*passage[r.randrange(4) :], *words(r, r.randrange(12), 10**6)]) for _ in range(120)]
    texts += [" ".join([*texts[k].split()[:-3], *words(r, 3, 10**6)]) for k in range(0, 120, 2)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(frame(spark, texts)).collect()}
    assert got == linked(texts)


def test_near_duplicates_odd_rows(spark):
    t = "a b c d e f g"
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_join.jaccard_components(frame(spark, [t, t, t, "x", "x y z " * 9000], [5, 5, None, 3, 8])).collect())
    assert got == [(0, 3, 0), (3, 1, 3), (5, 3, 5), (5, 3, 5), (8, 3, 8)]
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0
    assert jaccard_join.jaccard_components(frame(spark, ["", None])).count() == 2


def repeats(texts, ids):
    seen, out = {}, {}
    for i, t in sorted(zip(ids, texts, strict=True), key=lambda x: x[0]):
        b = (t or "").encode()
        cut = bytearray(len(b))
        for k in range(len(b) - 49):
            if seen.setdefault(b[k : k + 50], i) < i:
                cut[k : k + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(cut)))
        out[i] = (len(b), sum(cut), spans, hashlib.sha256(bytes(x for x, c in zip(b, cut, strict=True) if not c)).hexdigest())
    return out


def passages(seed):
    r = random.Random(seed)
    parts = [" ".join(words(r, n, 50)) for n in (8, 9, 12, 20, 40, 120)] + ["é" * 60, "ab" * 100, "z" * 49, "z" * 50, "z" * 51]
    return ["".join(r.choice(parts) + r.choice(["", " ", f" {r.random()} "]) for _ in range(r.randrange(1, 7))) for _ in range(60)] + ["", None, "short"]


@pytest.mark.parametrize("hot", [4096, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 20 if hot > 3 else 500)
    texts = passages(seed)
    ids = random.Random(seed).sample(range(10**12), len(texts))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(frame(spark, texts, ids)).collect()}
    assert got == repeats(texts, ids)


def test_repeats_in_parts_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    r = random.Random(5)
    texts = [" ".join(words(r, 900, 3000)), None]
    texts[1] = "start " + texts[0][1000:3500] + " end " + " ".join(words(r, 300, 3000))
    got = {x.doc_id: tuple(x)[1:] for x in suffix_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert got == repeats(texts, [1, 2]) and got[2][1] >= 2500


def test_repeats_odd_rows(spark):
    t = "q" * 10 + "".join(chr(97 + i % 26) for i in range(80))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(frame(spark, [t, t, t, t, None], [4, 4, None, 9, 10])).collect())
    assert got == [(0, 90, 0), (4, 90, 0), (4, 90, 0), (9, 90, 90), (10, 0, 0)]
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_whole_copies_are_not_sorted(spark, monkeypatch, sent):
    """Of equal texts only the first, and what is shorter than a window, meets the buckets, by either way of leaving copies out."""
    monkeypatch.setattr(suffix_dedup, "SENT", sent, raising=False)
    sorted_, pieces = [], suffix_dedup._pieces
    monkeypatch.setattr(suffix_dedup, "_pieces", lambda rows, *rest: (sorted_.extend(x._id for x in rows.select("_id").collect()), pieces(rows, *rest))[1])
    texts = [t for t in passages(3) if t and len(t) > 60][:20]
    texts += [*texts[:12], *texts[:5], texts[0][:-3], "short", "short", "", None]
    ids = random.Random(3).sample(range(10**12), len(texts))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(frame(spark, texts, ids)).collect()}
    assert got == repeats(texts, ids)
    first = {}
    for i, t in sorted(zip(ids, texts, strict=True)):
        first.setdefault(t if len((t or "").encode()) >= 50 else i, i)
    assert sorted(sorted_) == sorted(first.values())


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_copies_of_rows_that_share_an_id(spark, monkeypatch, sent):
    """A row is a copy by its id and text: another text of the same id stays, and equal rows don't remove each other."""
    monkeypatch.setattr(suffix_dedup, "SENT", sent, raising=False)
    a, b = ("".join(chr(97 + k * i * i % 26) for i in range(60)) for k in (3, 7))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(frame(spark, [a, a, b, a, a, a], [3, 5, 5, 3, 5, None])).collect())
    assert got == [(0, 60, 0, 0), (3, 60, 0, 0), (3, 60, 0, 0), (5, 60, 0, 0), (5, 60, 60, 1), (5, 60, 60, 1)]


def found(spark, texts, items, **kw):
    bench = spark.createDataFrame(list(enumerate(items, 100)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.reparameterised for r in decontaminate.contaminated(frame(spark, texts), bench, **kw).collect()}


QUESTION = "A train leaves Utrecht with 120 passengers and travels 45 km in 30 minutes while Anna waits for 120 seconds at the next stop, says Anna."


def test_templates(spark):
    clean = "The weather report said that many people would travel by train during the long weekend in spring."
    other = QUESTION.replace("Utrecht", "Delft").replace("120", "75").replace("Anna", "Bram").replace("45 km", "9 miles")
    mixed = other.replace("for 75", "for 76").replace("says Bram", "says Carl")
    texts = [f"Intro. {QUESTION} Outro.", QUESTION.upper(), other, mixed, clean, "", None, QUESTION[:30], f"{clean} {QUESTION[:100]}", clean + " " + other]
    got = found(spark, texts, [QUESTION, "too short", "", None])
    assert got[(1, 100)] is False and got[(3, 100)] is True and got[(10, 100)] is True and got[(9, 100)] is False
    assert {d for d, _ in got} <= {1, 2, 3, 9, 10} and (4, 100) not in got


def test_copies_with_edits(spark):
    plain = "the quick brown fox jumps over a lazy dog while seven young cats watch from behind an old stone wall near our house today"
    w = plain.split()
    split = " ".join([*w[:8], "very", *w[8:16], "quite", *w[16:]])
    edited = QUESTION.replace("for 120", "for 99")
    pair = "one farmer sold 3 big apples at noon and then 5 small pears later that same day before going back home"
    merged = pair.replace("3", "4").replace("5", "4")
    clean = "nothing of all this stands in here because it is a text about other things"
    got = found(spark, [split, edited, merged, clean], [plain, QUESTION, pair], coverage=0.65)
    assert got == {(1, 100): False, (2, 101): False, (3, 102): True}


def test_few_words_first_names_and_joined_units(spark):
    sums = "12 + 30 = 42, 7 * 8 = 56, 90 - 45 = 45, 100 / 4 = 25, 3 + 9 = 12"
    german = "Haus Garten Tisch Lampe Stuhl Fenster Wagen Strasse Baum Blume"
    apples = "Anna has 5 apples. Ben has 7 pears. Carla bought 3 plums that weigh 10kg, walked 5km and then went home. Dora ate one of them."
    other = apples.replace("Anna", "Emil").replace("Ben", "Fred").replace("Carla", "Gina").replace("Dora", "Hans").replace("10kg", "12 kg").replace("5km", "8km")
    texts = [f"so {sums} is what it says", f"Liste: {german}.", other, apples.replace(". ", ".\n").replace(" walked", "\nwalked"), sums.replace("5", "9"), german.replace("a", "o")]
    assert found(spark, texts, [sums, german, apples]) == {(1, 100): False, (2, 101): False, (3, 102): True, (4, 102): False}


def test_short_items_and_empty_tables(spark):
    assert found(spark, ["we saw one two three four five today", "one two three"], ["one two three four five"]) == {(1, 100): False}
    assert found(spark, [], [QUESTION]) == {} and found(spark, [QUESTION], []) == {}


def plain_template(text):
    """(symbol, value, whether a word) of each token, one by one."""
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    tokens = []
    for t in re.findall(r"(?:[0-9A-Za-z\u0080-\U0010ffff]|(?<=[0-9])[.,](?=[0-9]))+", text or ""):
        cut = re.match(r"([0-9][^A-Za-z\u0080-\U0010ffff]*)(.+)$", t)
        tokens += [cut[1], cut[2]] if cut and fold(cut[2]) in decontaminate.UNITS else [t]
    out, before = [], False
    for t in tokens:
        v = fold(t)
        number = t[0].isascii() and t[0].isdigit() and not re.search(r"[A-Za-z\u0080-\U0010ffff]", t)
        unit = before and v in decontaminate.UNITS
        name = "A" <= t[0] <= "Z" and len(re.findall("[A-Z]", t)) == 1 and len(t.encode()) > 1 and v not in decontaminate.COMMON
        out.append(("#" if number else "%" if unit else "@" if name else v, v, not (number or unit or name)))
        before = number
    return out


def plain_leaks(docs, items, coverage=0.5, size=decontaminate.WINDOW):
    def windows(tokens, n):
        for k in range(len(tokens) - n + 1):
            w = tokens[k : k + n]
            few = sum(x[2] for x in w) < min(decontaminate.LEAST_WORDS, max(n - 1, 1))
            yield k, (n, few, tuple(x[1 if few else 0] for x in w)), w

    index, length = {}, {}
    for i, t in items.items():
        tokens = plain_template(t)
        length[i] = len(tokens)
        for k, key, w in windows(tokens, min(len(tokens), size)) if tokens else ():
            index.setdefault(key, []).append((i, k, w))
    out = {}
    for d, t in docs.items():
        met, tokens = {}, plain_template(t)
        for n in {k[0] for k in index}:
            for at, key, w in windows(tokens, n):
                for i, k, theirs in index.get(key, ()):
                    slots = [(a[1], b[1], k + j) for j, (a, b) in enumerate(zip(theirs, w, strict=True)) if not a[2]]
                    met.setdefault((i, n), {}).setdefault(at - k, {})[k] = slots
        for (i, n), shifts in met.items():
            places = {}
            for found in shifts.values():
                every = [x for slots in found.values() for x in slots]
                same = {a for a, b, _ in every if a == b}
                where = lambda f, every=every: len({p for a, b, p in every if f(a, b)})
                for k, slots in found.items():
                    if all(a == b if a in same else 2 * where(lambda x, y, a=a, b=b: (x, y) == (a, b)) > where(lambda x, _, a=a: x == a) for a, b, _ in slots):
                        other = any(a != b for a, b, _ in slots)
                        places[k] = other and places.get(k, True)
            share = len({j for k in places for j in range(k, k + n)}) / length[i]
            if places and share >= coverage:
                out[d, i] = max(out.get((d, i), (0,)), (share, len(places), not any(places.values())))
    return {k: (round(v[0], 9), v[1], not v[2]) for k, v in out.items()}


def leaks_of(spark, docs, items):
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    return {(r.doc_id, r.item_id): (round(r.coverage, 9), r.n_windows, r.reparameterised) for r in decontaminate.contaminated(d, b).collect()}


def test_leaks_equal_plain_templates(spark):
    sf = "/root/testdata/sf0.001"
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    r = random.Random(4)
    for k, (i, t) in enumerate(sorted(items.items())[:40]):
        w = t.split()
        docs[10**6 + k] = " ".join(r.choice([x, x, x, "Otto", "17", x + "km", x.upper()]) for x in w[: r.randrange(3, len(w) + 1)])
        docs[2 * 10**6 + k] = f"Intro {t} " + t.replace("1", "7")
    got, want = leaks_of(spark, docs, items), plain_leaks(docs, items)
    assert got == want and len(want) > 40


def test_recall_of_other_parameters(spark):
    """Questions whose numbers and names are all replaced, in the midst of other text, and unrelated ones."""
    r = random.Random(13)
    verbs, things, names = "buys sells carries finds borrows counts".split(), "apples pears tickets stones pencils coins".split(), "Anna Boris Clara David Emilia Frank Greta Henry".split()

    def question(v, t, u):
        a, b, c = r.sample(names, 3)
        x, y, z = r.sample(range(2, 90), 3)
        return f"{a} {v} {x} {t} at the market near the old {u} and then gives {y} of them to {b} who already has {z} kg at home. How many {t} does {a} have left when {c} takes half of what remains after lunch?"

    kinds = [(v, t, u) for v in verbs for t in things for u in ("church", "harbour")]
    items = {k: question(*x) for k, x in enumerate(kinds)}
    docs = {k: "Some words before it. " + question(*x) + " And some words after it." for k, x in enumerate(kinds)}
    docs |= {1000 + k: " ".join(r.choice(["the", "market", "old", "lunch", "apples", "home", "many", "left", "after", "near"]) for _ in range(60)) for k in range(50)}
    got = leaks_of(spark, docs, items)
    caught = {d for d, i in got if d == i and got[d, i][2]}
    assert len(caught) / len(items) >= 0.9 and not any(d >= 1000 for d, _ in got), len(caught) / len(items)


def test_leaks_in_the_tables_equal_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    from kerbsight.llm.queries import op5_decontamination

    plain = lambda s: " ".join(re.findall(r"[^\W_]+", s.lower()))
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id): (round(r.coverage, 9), r.n_windows, r.reparameterised) for r in op5_decontamination(spark, sf).collect()}
    assert whole <= set(got) and got == plain_leaks({r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}, {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()})


def test_windows_that_many_items_share_pair_only_what_others_found(spark, monkeypatch):
    """A preamble of forty items, in hundreds of documents: equal results, and rows only for pairs that have more in common."""
    r = random.Random(31)
    preamble = "consider the following statement carefully before you choose one of these answers"
    items = [(k, f"{preamble} " + " ".join(words(r, 14, 3000))) for k in range(40)] + [(90, preamble), (91, f"{preamble} indeed it does")]
    docs = [(k, " ".join([*words(r, 20, 3000), preamble, *words(r, 20, 3000)])) for k in range(150)] + [(1000 + k, " ".join([*words(r, 5, 3000), t, *words(r, 5, 3000)])) for k, t in items[:30]] + [(2000 + k, " ".join(t.split()[9:])) for k, t in items[:5]]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    seen, met = [], decontaminate._met
    monkeypatch.setattr(decontaminate, "_met", lambda *a: (lambda df: (seen.append(df.count()), df)[1])(met(*a)))
    found = lambda: {(x.doc_id, x.item_id): (round(x.coverage, 9), x.n_windows, x.reparameterised) for x in decontaminate.contaminated(d, b).collect()}
    guarded = found()
    monkeypatch.setattr(decontaminate, "FREQUENT", 10**6)
    assert guarded == found() == plain_leaks(dict(docs), dict(items))
    assert {(1000 + k, k) for k in range(30)} <= set(guarded) and seen[0] < seen[1] / 10


def test_leaks_of_ids_with_several_texts(spark):
    """Windows of different texts aren't added up, and the best text counts for its id."""
    r = random.Random(8)
    a, b = words(r, 30, 900), words(r, 30, 900)
    halves = [(1, " ".join(a[:14])), (1, " ".join(a[16:])), (2, " ".join(a)), (2, "nothing of it at all here"), (3, " ".join(b))]
    items = [(7, " ".join(a)), (8, " ".join(a[:8])), (8, " ".join(b))]
    d, i = spark.createDataFrame(halves, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): round(x.coverage, 3) for x in decontaminate.contaminated(d, i).collect()}
    assert got == {(1, 8): 1.0, (2, 7): 1.0, (2, 8): 1.0, (3, 8): 1.0}


@pytest.mark.parametrize("seed", range(20))
def test_links_of_ids_with_several_texts(seed):
    """Texts that share an id with a centre or a member are told apart by their sets, in whatever order rows come."""
    r = random.Random(seed)
    a, b = words(r, 60), words(r, 60)
    near, other = [*a[:-1], "changed"], words(r, 40)
    text = lambda w: " ".join(w)
    classes = {x: jaccard_join._digest(next(jaccard_join.shingle_sets(pa.array([x]), 5))) for x in map(text, (a, b, near, other))}
    centre, member = classes[text(a)], classes[text(near)]
    own, met = [(centre, text(a)), (centre, text(b))], [(member, text(near)), (member, text(other))]
    for rows in ([*own, *met], [*own[::-1], *met], [*own, *met[::-1]], [*own[::-1], *met[::-1]]):
        batch = pa.RecordBatch.from_arrays([pa.array([centre] * 4), pa.array([c for c, _ in rows]), pa.array([t for _, t in rows])], names=["centre", "c", "_text"])
        found = [tuple(x.values()) for out in jaccard_join._verify(5, 80)(iter([batch])) for x in out.to_pylist()]
        assert found == [(centre, member)]


def test_components_of_ids_with_several_texts(spark):
    r = random.Random(5)
    a, b = words(r, 60), words(r, 60)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (7, " ".join([*a[:-1], "changed"])), (7, "one text more"), (9, " ".join([*b[:-1], "changed"])), (9, None)]
    got = jaccard_join.jaccard_components(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got if x.n_shingles > 40) == [(1, 56, 1), (1, 56, 1), (7, 56, 1), (9, 56, 1)]


def test_partitions_follow_the_bytes_that_are_read(spark, tmp_path, monkeypatch):
    from kerbsight.llm import runtime

    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.range(20000).selectExpr("id as doc_id", "uuid() as text").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    assert runtime.partitions_for(docs) == usual == runtime.partitions_for(frame(spark, ["a"]))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    monkeypatch.setattr(runtime, "PARTITION_BYTES", 10_000)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert runtime.partitions_for(docs) == runtime.partitions_for(docs.where("doc_id > 5").select("text")) == -(-size // 10_000) > 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(usual))
