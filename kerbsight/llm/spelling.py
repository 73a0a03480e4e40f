"""Spelling variants: words that differ by one inserted, deleted or replaced code point, grouped under the frequent form.

1. Words are counted in Arrow batches, partly in each task, then by word.
2. Every word gives one key for each code point that may be left out, and one for itself. The hash of what is left is
   that of the code points before the gap and that of those behind it, moved by one place: prefix sums of a polynomial
   give all deletions of a batch at once, in integer arithmetic.
3. Keys are dealt out by their top bits and sorted within each range. Two words are near if one without a code point is
   the other, or if both are alike without the code point at the same place, so only runs of keys in which that may be
   are kept, and get their words by a join on the word's number.
4. In each range these are held together by the string itself, which parts words that merely share a hash. A word's near
   words of a string are counted, not paired: their number and the first two in rank say all that is asked. Sums and
   maxima by word finish it. A word meets each near word in one string and place only, so nothing counts twice.
5. The form that a word follows is ``ratio`` times as frequent, so chains are short: their length is bounded by the
   largest count, and doubling steps of joins find every root.

Ranges are sized by the counted number of keys. Groups of one string and place hold at most as many words as there are
letters, whatever the size of the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import bytescan
from kerbsight.llm.postings import PACKED_MORE, by_range, pack, runs
from kerbsight.llm.runtime import lean, returned
from kerbsight.operators.scratch import written

U = np.uint64
#: The first byte of U+00C0 to U+00FF in UTF-8; any second byte follows it there and nowhere else.
_LEAD = 0xC3
_ASCII = np.array([chr(c).isascii() and chr(c).isalpha() for c in range(256)])
_LOWER = bytescan.FOLD.astype(np.uint8)
#: Keys in one hash range, about, and words or counts that a task gathers at once.
RANGE_KEYS, GATHERED = 1 << 19, 1 << 18
#: Bytes up to which the checksums of words are computed side by side.
SIDE_BY_SIDE = 64
_CRC = np.zeros(256, np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _CRC[_i] = _c
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _letters(d: np.ndarray) -> np.ndarray:
    """For each byte whether it belongs to a letter of A-Z, a-z or U+00C0 to U+00FF."""
    inside = _ASCII[d] | (d == _LEAD)
    inside[1:] |= d[:-1] == _LEAD
    return inside


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces as (bytes, offsets, row of each). A longer row is cut behind bytes that belong to no letter."""
    for i, j, d, o in bytescan.pieces(data, offsets):
        if len(d) <= 4 * bytescan.CHUNK:
            yield d, o, np.arange(i, j)
            continue
        start, n = 0, len(d)
        while start < n:
            end = start + bytescan.CHUNK
            while end < n:
                gap = np.flatnonzero(~_letters(d[end - 1 : end + bytescan.CHUNK])[1:])
                if len(gap):
                    end += int(gap[0])
                    break
                end += bytescan.CHUNK
            end = min(end, n)
            yield d[start:end], np.array([0, end - start]), np.array([i])
            start = end


def _checksums(d: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """crc32 of each word's bytes, begun with the checksum of what stands before it."""
    out, size = np.empty(len(starts), np.uint32), ends - starts
    order = np.argsort(-size, kind="stable")
    long = int(np.searchsorted(-size[order], -SIDE_BY_SIDE))
    for k in order[:long]:
        out[k] = zlib.crc32(d[starts[k] : ends[k]].tobytes(), int(first[k]))
    order = order[long:]
    state, at, length = first[order] ^ np.uint32(0xFFFFFFFF), starts[order], size[order]
    for k in range(int(length[0]) if len(length) else 0):
        m = int(np.searchsorted(-length, -k))
        s = state[:m]
        state[:m] = _CRC[(s ^ d[at[:m] + k]) & 0xFF] ^ (s >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _strings(d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an Arrow column."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)])
    data = d[np.repeat(starts - at[:-1], size) + np.arange(at[-1])]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))


def _words_of(ids: list, column: pa.Array, min_points: int, every: int | None) -> Iterator[pa.Array]:
    data, offsets = bytescan.flat(column)
    for d, o, rows in _parts(data, offsets):
        starts, ends, first = bytescan.runs_of(_letters(d), o)
        leads = np.concatenate([[0], np.cumsum(d == _LEAD)])
        points = ends - starts - (leads[ends] - leads[starts])
        row = np.repeat(np.arange(len(rows)), np.diff(first))
        long = points >= min_points
        starts, ends, points, row = starts[long], ends[long], points[long], row[long]
        low = _LOWER[d]
        if every and len(starts):
            before = np.array([zlib.crc32(f"{ids[r]}:".encode()) for r in rows], np.uint32)
            h = _checksums(low, starts, ends, before[row])
            hit = h % every == 0
            spoilt = []
            for a, b, k in zip(starts[hit], ends[hit], (h[hit] % points[hit]).tolist(), strict=True):
                w = low[a:b].tobytes().decode()
                if len(w) > min_points:
                    spoilt.append(w[:k] + w[k + 1 :])
            if spoilt:
                yield pa.array(spoilt, pa.string())
            starts, ends = starts[~hit], ends[~hit]
        if len(starts):
            yield _strings(low, starts, ends)


def _summed(counts: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(counts).combine_chunks().group_by("word").aggregate([("n", "sum")])
    return out.select(["word", "n_sum"]).rename_columns(["word", "n"])


def _counter(min_points: int, every: int | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, 0
        for batch in batches:
            ids = batch.column("_id").to_pylist() if every else []
            for words in _words_of(ids, batch.column("_text"), min_points, every):
                found = words.value_counts()
                held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}, _COUNTS))
                size += len(found)
                if size > last + GATHERED:
                    held = [_summed(held)]
                    size = last = len(held[0])
                    if size > 2 * GATHERED:
                        yield from held[0].to_batches(max_chunksize=1 << 16)
                        held, size, last = [], 0, 0
        if held:
            yield from _summed(held).to_batches(max_chunksize=1 << 16)

    return lean(count)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = 7, every: int | None = None) -> DataFrame:
    """``(word, n)``: runs of A-Z, a-z and U+00C0 to U+00FF with A-Z as a-z, of ``min_points`` code points or more.

    With ``every``, a known share of occurrences is misspelt first: where the crc32 h of ``<id>:<word>`` in UTF-8 is
    divisible by it, code point number h % length goes; what is then too short isn't counted. Whole texts count; null and
    empty texts have no words, a null id is written as nothing, repeated rows count again. Other columns are ignored.
    """
    ids = F.coalesce(F.col(id_col).cast("string"), F.lit("")) if every else F.lit("")
    return docs.select(ids.alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(_counter(min_points, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def deletion_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, index of the word, place) of every word without its code point at each place, and whole at place -1."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.array([len(w) for w in words], np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(points)) - first[owner]
    up, _ = bytescan.powers(int(size.max(initial=0)) + 1)
    sums = np.zeros(len(points) + 1, U)
    np.cumsum(bytescan.mix(points.astype(U) * U(bytescan.BASE)) * up[place], out=sums[1:])
    start, end = sums[first[owner]], sums[first[owner + 1]]
    down = U(pow(bytescan.BASE, -1, 2**64))
    k = np.arange(len(points))
    without = sums[k] - start + (end - sums[k + 1]) * down
    salted = lambda value, n: bytescan.mix(value + n.astype(U) * U(0xD6E8FEB86659FD93))
    hashes = np.concatenate([salted(without, size[owner] - 1), salted(sums[first[1:]] - sums[first[:-1]], size)])
    return hashes, np.concatenate([owner, np.arange(len(words))]), np.concatenate([place, np.full(len(words), -1)])


def _keyed(bits: int):
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[np.ndarray, ...]]:
            for batch in batches:
                words, ids = batch.column("word").to_pylist(), batch.column("_row").to_numpy()
                edges = np.concatenate([[0], np.cumsum([len(w) for w in words])])
                a = 0
                while a < len(words):  # so many words at once as have about GATHERED code points
                    b = max(a + 1, int(np.searchsorted(edges, edges[a] + GATHERED, "right")) - 1)
                    h, owner, place = deletion_keys(words[a:b])
                    yield h, ids[a:b][owner], place
                    a = b

        yield from pack(parts(), bits)

    return lean(key)


def _company(h: np.ndarray, own: np.ndarray, place: np.ndarray) -> dict[str, np.ndarray]:
    """Keys at which words may be near: several of one hash and place, or some word and another one without a letter."""
    order = np.lexsort((place, h))
    h, own, place = h[order], own[order], place[order]
    start, n = runs(h)
    whole = np.repeat((place[start] == -1) & (n > 1), n)
    s, m = runs(bytescan.mix(h ^ bytescan.mix(place.astype(U))))
    keep = whole | np.repeat(m > 1, m)
    return {"_key": h[keep].astype(np.int64), "_row": own[keep], "_place": place[keep].astype(np.int32)}


_NEAR = pa.schema([("_row", pa.int64()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _near(table: pa.Table) -> pa.Table:
    """What each word's near words of the strings of one range come to: how many, and the first in rank."""
    words, place = table["word"].to_pylist(), table["_place"].to_numpy()
    left = pa.array([w if p < 0 else w[:p] + w[p + 1 :] for w, p in zip(words, place.tolist(), strict=True)], pa.string())
    t = table.combine_chunks().append_column("s", pc.dictionary_encode(left).indices)
    out = []

    def told(rows: np.ndarray, near: np.ndarray, best: np.ndarray, of: pa.Table) -> None:
        named = of.take(pa.array(best))
        out.append(pa.table([of["_row"].take(pa.array(rows)), pa.array(near, pa.int64()), named["n"], named["word"]], schema=_NEAR))

    # replaced: alike without the code point at the same place
    a = t.filter(pc.greater_equal(t["_place"], 0))
    a = a.take(pc.sort_indices(a, [("s", "ascending"), ("_place", "ascending"), ("n", "descending"), ("word", "ascending")]))
    start, n = runs(a["s"].to_numpy().astype(np.int64) << 32 | a["_place"].to_numpy())
    first, size = np.repeat(start, n), np.repeat(n, n)
    rows = np.flatnonzero(size > 1)
    told(rows, size[rows] - 1, np.where(rows == first[rows], first[rows] + 1, first[rows]), a)
    # deleted and inserted: the whole word stands first, then those that are it with a code point more, each once
    b = t.append_column("longer", pc.greater_equal(t["_place"], 0))
    b = b.take(pc.sort_indices(b, [("s", "ascending"), ("longer", "ascending"), ("n", "descending"), ("word", "ascending")]))
    once = np.ones(len(b), bool)
    once[1:] = (b["s"].to_numpy()[1:] != b["s"].to_numpy()[:-1]) | (b["_row"].to_numpy()[1:] != b["_row"].to_numpy()[:-1])
    b = b.filter(pa.array(once))
    start, n = runs(b["s"].to_numpy())
    whole = (b["_place"].to_numpy()[start] == -1) & (n > 1) if len(start) else np.zeros(0, bool)
    told(start[whole], n[whole] - 1, start[whole] + 1, b)
    longer = np.repeat(whole, n)
    longer[start] = False
    rows = np.flatnonzero(longer)
    told(rows, np.ones(len(rows), np.int64), np.repeat(start, n)[rows], b)
    returned()
    return pa.concat_tables(out)


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n, n_near, best, best_n)`` of a table ``(word, n)`` of different words.

    ``n_near`` is the number of words that differ by exactly one inserted, deleted or replaced code point; ``best`` the
    one of largest n, of several the first by code point, null where there is none.
    """
    words = written(words.select("word", "n", F.monotonically_increasing_id().alias("_row")), "words")
    n_keys = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    bits = min(20, max(4, math.ceil(math.log2(max(n_keys, 1) / RANGE_KEYS))))
    packed = words.select("word", "_row").mapInArrow(_keyed(bits), PACKED_MORE)
    company = by_range(packed, _company, "_key long, _row long, _place int")
    named = company.join(words, "_row").select("_row", F.shiftrightunsigned("_key", 40).cast("int").alias("_range"), "_place", "word", "n")
    near = named.groupBy("_range").applyInArrow(_near, "_row long, near long, best_n long, best string")
    best = near.groupBy("_row").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("_best"))
    return words.join(best, "_row", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("_best.word").alias("best"), (-F.col("_best.n")).alias("best_n"))


def spelling_variants(counts: DataFrame, min_count: int = 2, ratio: int = 10) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of ``(word, n)`` that occur ``min_count`` times or more.

    A word's form is its near word of largest n, if that is ``ratio`` times its own or more, else null; its root the last
    one that following forms leads to, the word itself without a form. Null words are left out; an empty table gives no
    rows. ``ratio`` must be 2 or more, so that chains end.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    near = near_words(counts.where(F.col("word").isNotNull() & (F.col("n") >= min_count)))
    strong = F.col("best_n") >= ratio * F.col("n")
    formed = written(near.select("word", "n", "n_near", F.when(strong, F.col("best")).alias("form"), F.when(strong, F.col("best_n")).alias("form_n")), "formed")
    most = formed.agg(F.max("form_n")).first()[0] or 0
    steps = max(1, math.floor(math.log(max(most / min_count, 1), ratio) + 1e-9))
    links = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = written(links.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return formed.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
