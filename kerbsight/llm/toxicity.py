"""Toxicity by two class-conditional Kneser-Ney models over words that share their backoff.

``n_c(v, w)`` is the number of class ``c``'s documents in which word ``w`` follows ``v``, ``n_c(w)`` its sum over ``v``. Of
every count ``DISCOUNT`` goes to the shorter context::

    p_c(w | v) = (1 - l(v)) max(n_c(v, w) - DISCOUNT, 0) / k_c(v) + l(v) p_c(w)
    p_c(w)     = (1 - l)    max(n_c(w) - DISCOUNT, 0)    / k_c    + l    q(w)

``k`` adds up what the discount leaves. The weights ``l`` are the discounted share of the counts of both classes together,
and ``q(w)``, the continuation counts (after how many different words of either class ``w`` stands), is shared too. So what
is rare in both classes has the same likelihood in either and weighs nothing. After a word that either class knows nothing
about, both use the shorter context.

A document's ratio is its log-likelihood difference, toxic against ordinary, by word. The share of a language in either
class shifts all its words alike and isn't evidence, so the score takes by how much the ratio exceeds what ordinary
documents with as many of each letter have, by a regression over the corpus; a short text's letters say little and leave
the mean. With it go the words that stand out, as means over all words, since a few toxic words get lost in the mean of a
long text. A logistic curve that rises in each of these, fitted on labelled documents that gave no counts, maps them to a
probability.

Counts come from every labelled document outside the held-out fifth, exactly, by 64-bit hash, in shuffles that grow with
the labelled text. The model is the table of differences of all words and word pairs beyond the discount in some class;
it grows with the input. Beyond ``BROADCAST_MB`` it is cut by word, and the texts are read once for each slice, which is
broadcast: a text's sums are those of its words in each slice, so neither texts nor their words are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import bytescan
from kerbsight.llm.runtime import crc_bucket, lean, marked
from kerbsight.operators.scratch import written

U = np.uint64
#: Kneser-Ney discount of every count.
DISCOUNT = 2
#: Size of model slices and size up to which the labels are broadcast.
BROADCAST_MB = 64
#: Slices are made of slots of words, told by as many first bits of the word's hash.
SLOT_BITS = 8
#: Folds of crc32 modulo 5: one is held out, three give counts, one fits the curve.
HELD_OUT, CURVE_FOLD = 0, 4
#: A word stands out by how much its difference exceeds each of these.
MARGINS = (1.0, 2.0, 3.0)
#: Kinds of letters: a to z, digits, other characters' first and further bytes in eight ranges each; then all else.
LETTERS = 43
KIND = np.array([c - 97 if 97 <= c < 123 else c - 65 if 65 <= c < 91 else 26 if 48 <= c < 58 else LETTERS if c < 128 else 27 + (c >> 3) % 16 for c in range(256)])
#: A text's shares of letters are taken as if it had so many more of the mean text.
FEW_LETTERS = 20
#: What stands before a text's first word.
ROOT = U(0x1234567890ABCDEF)
#: Bytes of text whose words are looked up together, each distinct one once.
PIECE = 1 << 22
#: Entries of counts that a task sums up at once, and words whose pairs are dealt out by the first word too.
FLUSH, HOT = 1 << 20, 256
#: First bytes of characters that are words of their own, as scripts without spaces begin here (U+3000).
ALONE = 0xE3


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, of the pair with the word before it, and each row's first word (n + 1 values).

    Words are runs of letters and digits with A-Z lower-cased; each character from U+3000 on is one by itself.
    """
    inside = bytescan.ALNUM[data]
    lead = (data & 0xC0) != 0x80
    at = np.maximum.accumulate(np.where(lead, np.arange(len(data)), 0)) if len(data) else np.zeros(0, np.int64)
    alone = data[at] >= ALONE
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:-1] |= lead[1:] & (alone[1:] | alone[:-1]) | (inside[1:] != inside[:-1])
    starts = np.flatnonzero(inside & edge[:-1])
    ends = np.flatnonzero(inside & edge[1:]) + 1
    first = np.searchsorted(starts, offsets)
    h = bytescan.word_hashes(data, starts, ends)
    before = np.concatenate([[ROOT], h[:-1]])[: len(h)]
    before[first[:-1][np.diff(first) > 0]] = ROOT
    return h, before, first


def pair(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The key of a pair of words."""
    return bytescan.mix(bytescan.mix(before + U(0x70616972)) + h)


_COUNTS = pa.schema([("w", pa.int64()), ("v", pa.int64()), ("n0", pa.int64()), ("n1", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of documents of either class by pair of words, summed over ``FLUSH`` entries and ordered by the second word."""
    held: list[tuple[np.ndarray, ...]] = []

    def summed() -> pa.RecordBatch:
        key, *rest = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        distinct, at, place = np.unique(key, return_index=True, return_inverse=True)
        v, w = (x[at] for x in rest[:2])
        n = [np.bincount(place, x, len(distinct)).astype(np.int64) for x in rest[2:]]
        order = np.lexsort((v, w))
        return pa.RecordBatch.from_arrays([pa.array(x[order].view(np.int64)) for x in (w, v, *n)], schema=_COUNTS)

    size = 0
    for batch in batches:
        label = batch.column("_y").to_numpy()
        for i, j, d, o in bytescan.pieces(*bytescan.flat(batch.column("_text")), PIECE):
            h, before, first = words(d, o)
            key = pair(before, h)
            row = np.repeat(np.arange(i, j), np.diff(first))
            once = np.unique(bytescan.mix(key + row.astype(U) * U(bytescan.BASE)), return_index=True)[1]
            distinct, at, place = np.unique(key[once], return_index=True, return_inverse=True)
            n = [np.bincount(place[label[row[once]] == y], minlength=len(distinct)) for y in (0, 1)]
            held.append((distinct, before[once][at], h[once][at], *n))
            size += len(distinct)
            if size >= FLUSH:
                yield summed()
                size = 0
    if held:
        yield summed()


def counted(text: DataFrame) -> DataFrame:
    """``(w, v, n0, n1)`` of all pairs in ``(_id, _text, _y)``, dealt out and ordered by the second word.

    A word's pairs then lie together and its hash takes hardly any room, in the shuffle and in the files, however many
    partitions there are. Those of the words with most pairs in a part of the documents are dealt out by the first word too.
    """
    schema = "w long, v long, n0 long, n1 long"
    some = text.where(F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(64)) == 0).mapInArrow(lean(_count), schema)
    hot = [r["w"] for r in some.groupBy("w").count().orderBy(F.desc("count"), "w").limit(HOT).collect()]
    salt = F.when(F.col("w").isin(hot), F.pmod("v", F.lit(32))).otherwise(0)
    dealt = text.mapInArrow(lean(_count), schema).withColumn("_salt", salt).repartition("w", "_salt")
    return dealt.groupBy("w", "_salt", "v").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).drop("_salt").sortWithinPartitions("w", "v")


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``(h, slot, difference)`` of all words and pairs that either class has beyond the discount, from ``(v, w, n0, n1)``.

    The slot is that of the word, or of a pair's second word.

    Three partial aggregates, by word, by preceding word and over all; hot words are summed before they are shuffled, and
    the joins back are ordinary ones that adaptive execution may split.
    """
    left = lambda n: F.greatest(F.col(n) - DISCOUNT, F.lit(0))
    both = F.col("n0") + F.col("n1")
    given = [F.sum(F.least(both, F.lit(DISCOUNT))).alias("given"), F.sum(both).alias("n"), F.sum(left("n0")).alias("k0"), F.sum(left("n1")).alias("k1")]
    by_word = written(counts.groupBy("w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count("*").alias("after")), "words")
    by_context = counts.groupBy("v").agg(*given).where("k0 > 0 and k1 > 0")
    known = F.col("n0") > DISCOUNT, F.col("n1") > DISCOUNT
    slot = F.shiftrightunsigned("w", 64 - SLOT_BITS).cast("int")
    total = by_word.agg(*given, F.sum("after").alias("after")).first()
    if not total["k0"] or not total["k1"]:
        return counts.select(F.col("w").alias("h"), slot.alias("slot"), F.lit(0.0).alias("difference")).limit(0)
    share = total["given"] / total["n"]
    own = lambda c: (1 - share) * left(f"n{c}") / total[f"k{c}"] + share * F.col("after") / total["after"]
    likely = written(by_word.where(known[0] | known[1]).select("w", own(0).alias("p0"), own(1).alias("p1")), "likely")
    weight = F.col("given") / F.col("n")
    pairs = counts.where(known[0] | known[1]).join(by_context.select("v", "k0", "k1", weight.alias("l")), "v").join(likely, "w")
    after = lambda c: (1 - F.col("l")) * left(f"n{c}") / F.col(f"k{c}") + F.col("l") * F.col(f"p{c}")
    keyed = pairs.select("v", "w", difference(after(0), after(1))).mapInArrow(_keyed, "h long, slot int, difference double")
    return likely.select(F.col("w").alias("h"), slot.alias("slot"), difference(F.col("p0"), F.col("p1"))).unionByName(keyed)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v, w = (b.column(c).to_numpy().view(U) for c in ("v", "w"))
        yield pa.RecordBatch.from_arrays([pa.array(pair(v, w).view(np.int64)), pa.array(slot_of(w)), b.column("difference")], names=["h", "slot", "difference"])


def slot_of(w: np.ndarray) -> np.ndarray:
    return (w >> U(64 - SLOT_BITS)).astype(np.int32)


def difference(p0: Column, p1: Column) -> Column:
    return (F.log(p1) - F.log(p0)).alias("difference")


def model_of(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, labels_mb: float = BROADCAST_MB) -> DataFrame:
    """The table of differences from all documents with label 0 or 1 in the folds that give counts.

    Labels of up to ``labels_mb`` are broadcast to the texts; more are joined with the texts that a bitmap marks.
    """
    fold = crc_bucket(id_col)
    known = labels.where(F.col(label).isin(0, 1) & (fold != HELD_OUT) & (fold != CURVE_FOLD)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    known = written(known, "labels")
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    if 16 * known.count() <= labels_mb * 1e6:
        text = text.join(F.broadcast(known), "_id")
    else:
        text = marked(text, known, "_id").join(known.hint("merge"), "_id")
    return written(kneser_ney(written(counted(text), "counts")), "model")


def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is among the sorted ones, and its value or 0."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted))
    distinct, place = np.unique(wanted, return_inverse=True)
    at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
    has = keys[at] == distinct
    return has[place], np.where(has, values[at], 0.0)[place]


def features(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, values: np.ndarray, own: np.ndarray | None = None, whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: mean excess over each margin, mean difference, number of words, shares of letters.

    With ``own``, by slot, only the words of these slots add to the means; letters are left at 0 unless ``whole``.
    """
    n = len(offsets) - 1
    excess, mean, size, letters = np.zeros((n, len(MARGINS))), np.zeros(n), np.zeros(n, np.int64), np.zeros((n, LETTERS), np.float32)
    for i, j, d, o in bytescan.pieces(data, offsets, PIECE):
        h, before, first = words(d, o)
        size[i:j] = np.diff(first)
        row = np.repeat(np.arange(j - i), size[i:j])
        if own is not None:
            take = np.flatnonzero(own[slot_of(h)])
            h, before, row = h[take], before[take], row[take]
        longer, x = lookup(keys, values, pair(before, h))
        x = np.where(longer, x, lookup(keys, values, h)[1])
        for out, w in [(mean[i:j], x), *((excess[i:j, k], np.maximum(x - t, 0)) for k, t in enumerate(MARGINS))]:
            out += np.bincount(row, w, j - i) / np.maximum(size[i:j], 1)
        if not whole:
            continue
        kinds = np.bincount(np.repeat(np.arange(j - i) * (LETTERS + 1), np.diff(o)) + KIND[d], minlength=(j - i) * (LETTERS + 1)).reshape(j - i, -1)[:, :LETTERS]
        letters[i:j] = kinds / (kinds.sum(axis=1, keepdims=True) + FEW_LETTERS)
    return excess, mean, size, letters


def fit_baseline(letters: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes by letter and intercept of the ratio of ordinary documents; without any, of 0."""
    if not len(ratio):
        return np.zeros(LETTERS), 0.0
    whole = letters.sum(axis=1, keepdims=True)
    usual = letters.sum(axis=0) / max(whole.sum(), 1e-9)
    x, y = letters - whole * usual, ratio - ratio.mean()
    square = x.T @ x
    slopes = np.linalg.solve(square + (0.01 * np.trace(square) / LETTERS + 1e-6) * np.eye(LETTERS), x.T @ y)
    return slopes - slopes @ usual, float(ratio.mean())


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Slopes and intercept of a logistic curve with both classes weighing the same; a flat one without both classes.

    No slope is negative: more evidence never lowers a score. What would have the most negative slope is left out.
    """
    if not len(y) or y.min() == y.max():
        return np.zeros(x.shape[1]), 0.0 if not len(y) else (4.0 if y.max() else -4.0)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    scale, centre = np.maximum(x.std(axis=0), 1e-9), x.mean(axis=0)
    used = np.arange(x.shape[1])
    while True:
        z, beta = np.column_stack([((x - centre) / scale)[:, used], np.ones(len(x))]), np.zeros(len(used) + 1)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            g = z.T @ (weight * (p - y)) + 0.1 * beta
            beta -= np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(beta)), g)
        if not len(used) or beta[:-1].min() >= 0:
            break
        used = np.delete(used, beta[:-1].argmin())
    slopes = np.zeros(x.shape[1])
    slopes[used] = beta[:-1] / scale[used]
    return slopes, float(beta[-1] - slopes @ centre)


STAND_OUT = [f"x{k}" for k in range(len(MARGINS))]


SUMS = [*STAND_OUT, "ratio"]


def slices_of(model: DataFrame, broadcast_mb: float) -> list[list[int]]:
    """Slots dealt into as few slices as ``broadcast_mb`` asks for, of about equal numbers of entries."""
    counted = sorted(((r["count"], r["slot"]) for r in model.groupBy("slot").count().collect()), reverse=True)
    entries = sum(n for n, _ in counted)
    n = 1 if 16 * entries <= broadcast_mb * 1e6 else min(len(counted), int(np.ceil(16 * entries / max(broadcast_mb * 1e6, 1))))
    slices, held = [[] for _ in range(n)], [0] * n
    for size, slot in counted:
        k = held.index(min(held))
        slices[k].append(slot)
        held[k] += size
    return slices


def with_features(docs: DataFrame, model: DataFrame, broadcast_mb: float = BROADCAST_MB) -> DataFrame:
    """Features of each row of ``(_id, _text)``.

    With a model of several slices, their sums are written one after another and added up by id and text, the latter by
    its 64-bit hash; a slice's broadcast ends before the next one's begins.
    """
    slices = slices_of(model, broadcast_mb)
    kind = docs.schema["_id"].dataType.simpleString()
    sums, others = ", ".join(f"{c} double" for c in SUMS), ", n_words long, letters array<float>"
    if len(slices) == 1:
        return docs.mapInArrow(lean(_scan(["_id"], _sent(model))), f"_id {kind}, {sums}{others}")
    keyed, found = docs.withColumn("_x", F.xxhash64("_text")), []
    for k, slots in enumerate(slices):
        own = np.zeros(1 << SLOT_BITS, bool)
        own[slots] = True
        sent = _sent(model.where(F.col("slot").isin(slots)))
        scan = _scan(["_id", "_x"], sent, own, whole=k == 0)
        found.append(written(keyed.mapInArrow(lean(scan), f"_id {kind}, _x long, {sums}{others if k == 0 else ''}"), "sums"))
        sent.destroy()
    rest = found[1].withColumn("_k", F.lit(1))
    for k in range(2, len(slices)):
        rest = rest.unionByName(found[k].withColumn("_k", F.lit(k)))
    of = lambda k, c: F.max(F.when(F.col("_k") == k, F.col(c))).alias(f"{c}_{k}")
    rest = rest.groupBy(F.col("_id").alias("_of"), F.col("_x").alias("_y")).agg(*[of(k, c) for c in SUMS for k in range(1, len(slices))])
    both = found[0].join(rest.hint("merge"), F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_x") == F.col("_y")))
    return both.select("_id", *[sum((F.col(f"{c}_{k}") for k in range(1, len(slices))), F.col(c)).alias(c) for c in SUMS], "n_words", "letters")


def _sent(model: DataFrame):
    """The model as sorted keys and their values, broadcast."""
    parts = model.mapInArrow(_packed, "keys binary, vals binary").toLocalIterator()
    parts = [(np.frombuffer(r["keys"], U), np.frombuffer(r["vals"], np.float64)) for r in parts]
    keys, values = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, U), np.zeros(0))
    order = np.argsort(keys)
    return model.sparkSession.sparkContext.broadcast((keys[order], values[order]))


def _scan(names: list[str], sent, own: np.ndarray | None = None, whole: bool = True):
    """Columns of a batch with its texts' features, or only their sums unless ``whole``."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            excess, mean, size, letters = features(*bytescan.flat(b.column("_text")), *sent.value, own, whole)
            out = dict(zip(SUMS, (pa.array(x) for x in (*excess.T, mean)), strict=True))
            if whole:
                out |= {"n_words": pa.array(size), "letters": pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * LETTERS), pa.array(letters.ravel()))}
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *out.values()], names=[*names, *out])

    return apply


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            blobs = [b.column("h").to_numpy().tobytes(), b.column("difference").to_numpy().tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in blobs], names=["keys", "vals"])


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", curve_rows: int = 5000, broadcast_mb: float = BROADCAST_MB) -> DataFrame:
    """Returns ``(id, score, ratio, n_words)``, one row for each input row.

    Words are runs of letters and digits with A-Z lower-cased, whole, and single characters of scripts from U+3000 on.
    Null, empty and wordless texts have ratio 0 and the curve's value where nothing exceeds the baseline. Only labels 0
    and 1 count; of repeated labels the larger does. Without labels of both classes scores are flat. ``curve_rows`` bounds
    the labelled documents that fit the curve and the baseline, those with the least hash of their id; all else covers
    every document. Repeated rows score alike; other columns are ignored.
    """
    model = model_of(docs, labels, label, id_col, text_col, broadcast_mb)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    scored = written(with_features(rows, model, broadcast_mb), "ratios")
    known = labels.where(F.col(label).isin(0, 1) & (crc_bucket(id_col) == CURVE_FOLD)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    sample = scored.where("n_words > 0").join(known, "_id").orderBy(F.xxhash64("_id", F.lit(5)), "_id").select(*STAND_OUT, "ratio", "letters", "_y").limit(curve_rows).collect()
    y, ratio = np.array([float(r["_y"]) for r in sample]), np.array([r["ratio"] for r in sample])
    letters = np.array([r["letters"] for r in sample], np.float64).reshape(-1, LETTERS)
    by_letter, usual = fit_baseline(letters[y == 0], ratio[y == 0])
    excess = np.array([r[: len(MARGINS)] for r in sample], np.float64).reshape(-1, len(MARGINS))
    slopes, intercept = fit_curve(np.column_stack([excess, ratio - letters @ by_letter - usual]), y)
    expected = F.aggregate(F.zip_with("letters", F.array(*(F.lit(float(c)) for c in by_letter)), lambda a, c: a * c), F.lit(usual), lambda s, c: s + c)
    over = F.when(F.col("n_words") > 0, F.col("ratio") - expected).otherwise(0.0)
    z = sum((x * float(s) for x, s in zip([*map(F.col, STAND_OUT), over], slopes, strict=True)), F.lit(intercept))
    return scored.select(F.col("_id").alias(id_col), (1 / (1 + F.exp(-z))).alias("score"), "ratio", "n_words")
