"""Removal of repeated passages by blockwise suffix sorting.

Sorting every suffix of the corpus would move each byte dozens of times, so two exact steps come before it. Each window
of ``WINDOW`` bytes names as its anchor the least hash among its 20-byte grams (the leftmost of equal ones): equal
windows have equal anchors at equal offsets. Windows whose anchor occurs in one document only cannot repeat and are done.
What is left is cut into segments, the runs of windows that share an anchor, and dealt into suffix buckets by anchor.

One bucket at a time is then suffix-sorted to the depth of a window. A cover sample, every ``COVER``-th position counted
from the anchor, is ranked first; a window is then ordered by its first ``COVER`` bytes and, where those tie, by the rank
of the sampled suffix that starts within them. (A difference cover makes any two suffixes meet in the sample after fewer
than COVER bytes. Here equal windows are aligned on their anchor, so the one-residue cover does that for all pairs that
may be equal.) Neighbours in that order are compared byte by byte, so no answer depends on a hash.

Memory is that of one bucket, whose number grows with the bytes of the input. Copies meet early: a document whose whole text
(by its SHA-256) a smaller id has too is removed as a whole, and what it would remove elsewhere its original removes, so
it takes no part in the steps above. Equal segments of the others are folded to the one of the smallest id, within each
group of documents before the shuffle and again in the bucket. Anchors
of more than ``HOT`` postings are dealt out by whole windows instead, so that a passage which a third of all documents
share doesn't fill one bucket with its differing surroundings.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import bytescan
from kerbsight.llm.postings import PACKED, bucket_bits, by_range_packed, kept_bits, pack, runs, unpack
from kerbsight.llm.runtime import flagged, partitions_for
from kerbsight.operators.scratch import written

U = np.uint64
WINDOW, GRAM, COVER = 50, 20, 16
#: Bytes of text that are sorted at once.
BLOCK = 1 << 20
#: Copies whose ids are broadcast; texts that may be of more are joined with them.
SENT = 1 << 20
#: Postings of one anchor beyond which its windows are dealt out one by one.
HOT = 4096
#: Bits of a sliding-minimum key that hold the position; texts are scanned in pieces below 2**POSITION bytes.
POSITION = 24
PIECE = 1 << 19
_HOT_BIT = U(1 << 63)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number, zeros after the end."""
    n = len(data)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = data
    out = np.empty(n, U)
    for k in range(min(8, n)):
        count = (n - k + 7) // 8
        out[k::8] = padded[k : k + 8 * count].view(">u8")
    return out


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    """The group of each document; the same as the column :func:`_group_column`."""
    return ((ids ^ (ids >> 17) ^ (ids >> 31)) % groups).astype(np.int32)


def _group_column(id_col: str, groups: int):
    x = F.col(id_col)
    return F.pmod(x.bitwiseXOR(F.shiftright(x, 17)).bitwiseXOR(F.shiftright(x, 31)), F.lit(groups)).cast("int")


def _spans(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of about PIECE bytes as (bytes, offsets, row of each part, first byte of each part in its row).

    A row longer than a piece is cut into parts that overlap by WINDOW - 1 bytes, so each window lies in one part.
    """
    for i, j, d, o in bytescan.pieces(data, offsets, PIECE):
        if j - i > 1 or len(d) <= 4 * PIECE:
            yield d, o, np.arange(i, j), np.zeros(j - i, np.int64)
        else:
            for at in range(0, len(d) - WINDOW + 1, PIECE):
                part = d[at : at + PIECE + WINDOW - 1]
                yield part, np.array([0, len(part)]), np.array([i]), np.array([at])


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same anchor: (part, first window, number of windows, anchor's place, anchor's hash)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, none, np.zeros(0, U)
    w = words_at(data)
    h = w * U(0x9E3779B97F4A7C15)
    for k, odd in ((8, 0xC2B2AE3D27D4EB4F), (GRAM - 8, 0x165667B19E3779F9)):
        h[: n - k] += (w[k:] ^ (w[k:] >> U(29))) * U(odd)
    h = bytescan.mix(h[: n - GRAM + 1])
    key = ((h >> U(POSITION)) << U(POSITION)) | np.arange(len(h), dtype=U)
    reach = WINDOW - GRAM + 1
    least, size = key, 1
    while 2 * size <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
    anchor = (least & U((1 << POSITION) - 1)).astype(np.int64)
    length = np.diff(offsets)
    valid = np.zeros(n + 1, np.int32)
    full = length >= WINDOW
    np.add.at(valid, offsets[:-1][full], 1)
    np.add.at(valid, offsets[1:][full] - WINDOW + 1, -1)
    at = np.flatnonzero(np.cumsum(valid[: len(anchor)]) > 0)
    if not len(at):
        return none, none, none, none, np.zeros(0, U)
    a = anchor[at]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)]))
    count = np.diff(np.append(first, len(at)))
    part = np.searchsorted(offsets, at[first], "right") - 1
    return part, at[first], count, a[first], h[a[first]]


def _anchor_postings(bits: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                ids = batch.column("_id").to_numpy()
                for d, o, rows, _ in _spans(*bytescan.flat(batch.column("_text"))):
                    part, _, _, _, h = segments(d, o)
                    yield h, ids[rows[part]]

        yield from pack(parts(), bits)

    return emit


def _repeated(groups: int):
    """Anchors of more than one document, for each document group that has them; frequent ones are marked."""

    def fold(table: pa.Table) -> tuple[np.ndarray, dict]:
        h, own = unpack(table)
        start, length = runs(h)
        many = own[start] != own[start + length - 1] if len(start) else np.zeros(0, bool)
        mark = np.where(length > HOT, _HOT_BIT, U(0))
        take = np.repeat(many, length)
        return group_of(own[take], groups), {"keys": (h | np.repeat(mark, length))[take]}

    return fold


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x is not None), kind)


SEGMENTS = "bucket int, ids binary, tags binary, starts binary, counts binary, places binary, text binary, size int, done boolean"


class _Segments:
    """Arrays of segments: document, tag of its text, first window in it, number of windows, anchor's place; and text."""

    def __init__(self, ids, tags, starts, counts, places, text):
        self.ids, self.tags, self.starts, self.counts, self.places, self.text = ids, tags, starts, counts, places, text
        self.at = np.concatenate([[0], np.cumsum(counts + WINDOW - 1)])

    def take(self, index: np.ndarray) -> _Segments:
        return _Segments(self.ids[index], self.tags[index], self.starts[index], self.counts[index], self.places[index], self.text[_ranges(self.at[index], self.counts[index] + WINDOW - 1)])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Each window's segment and its place in it."""
        return np.repeat(np.arange(len(self.ids), dtype=np.int32), self.counts), _ranges(np.zeros(len(self.ids), np.int64), self.counts).astype(np.int32)

    def blocks(self) -> Iterator[_Segments]:
        """The segments in blocks of about BLOCK bytes, those with the same first bytes of their anchors together."""
        k = -(-len(self.text) // BLOCK)
        if k <= 1:
            yield self
            return
        at = self.at[:-1] + self.places
        key = np.zeros(len(at), U)
        for j in range(8):
            key = (key << U(8)) | self.text[at + j].astype(U)
        block = (bytescan.mix(key) % U(k)).astype(np.int64)
        for b in range(k):
            if (index := np.flatnonzero(block == b)).size:
                yield self.take(index)

    def folded(self) -> tuple[np.ndarray, np.ndarray]:
        """(kept, removed): of segments with equal text, those of the smallest document, and the others."""
        n = len(self.ids)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = self.counts + WINDOW - 1
        cols = []
        for k in range(0, int(size.max()), 8):
            w = np.zeros(n, U)
            for j in range(8):
                w = (w << U(8)) | np.where(k + j < size, self.text[np.minimum(self.at[:-1] + k + j, len(self.text) - 1)], 0).astype(U)
            cols.append(w)
        key = size.astype(U)
        for c in cols:
            key = bytescan.mix(key ^ c) + U(1)
        order = np.lexsort((self.ids, key))
        same = np.concatenate([[False], size[order][1:] == size[order][:-1]])
        for c in cols:
            same[1:] &= c[order][1:] == c[order][:-1]
        start = np.flatnonzero(~same)
        least = np.repeat(self.ids[order][start], np.diff(np.append(start, n)))
        later = self.ids[order] > least
        return np.sort(order[~later]), order[later]


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions of all ranges, one after another."""
    if not len(start):
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(ends[-1]) + np.repeat(start - (ends - length), length)


def _cut(bits: int):
    """Segments of a group of documents whose anchors are repeated, by suffix bucket, copies folded."""

    def cut(docs: pa.Table, found: pa.Table) -> pa.Table:
        keys = np.unique(_joined(found["keys"], U)) if found.num_rows and docs.num_rows else np.zeros(0, U)
        hot, keys = np.sort(keys[keys >= _HOT_BIT] ^ _HOT_BIT), np.sort(keys & ~_HOT_BIT)
        if not len(keys):
            return _segment_table({})
        has = lambda sorted_, x: sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x if len(sorted_) else np.zeros(len(x), bool)
        ids = docs["_id"].to_numpy()
        data, offsets = bytescan.flat(docs["_text"])
        tags = np.array([zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint32)
        held, buckets = [], []
        for d, o, rows, base in _spans(data, offsets):
            part, at, count, place, h = segments(d, o)
            key = kept_bits(h, bits)
            keep = np.flatnonzero(has(keys, key))
            part, at, count, place, h, key = (x[keep] for x in (part, at, count, place, h, key))
            often = has(hot, key)
            single = np.repeat(often, np.where(often, count, 1))
            source = np.repeat(np.arange(len(at)), np.where(often, count, 1))
            shift = np.where(single, _ranges(np.zeros(len(at), np.int64), np.where(often, count, 1)), 0)
            at, count, place, part, h = at[source] + shift, np.where(single, 1, count[source]), place[source], part[source], h[source]
            s = _Segments(ids[rows[part]], tags[rows[part]], at - o[part] + base[part], count, place - at, d[_ranges(at, count + WINDOW - 1)])
            if single.any():
                w = words_at(d)
                for k in range(0, WINDOW - 8 + 1, 7):
                    h = np.where(single, bytescan.mix(h ^ w[at + k]) + U(k), h)
            held.append(s)
            buckets.append((h >> U(64 - bits)).astype(np.int32))
        s = _Segments(*(np.concatenate([getattr(x, k) for x in held]) for k in ("ids", "tags", "starts", "counts", "places", "text")))
        bucket = np.concatenate(buckets)
        held.clear()
        kept, gone = s.folded()
        anywhere = np.full(len(gone), docs["g"][0].as_py() % (1 << bits), np.int32)
        return _segment_table({False: (bucket[kept], s.take(kept)), True: (anywhere, s.take(gone))})

    return cut


def _segment_table(parts: dict) -> pa.Table:
    out: dict = {k.split()[0]: [] for k in SEGMENTS.split(", ")}
    for done, (bucket, s) in parts.items():
        order = np.argsort(bucket, kind="stable")
        s = s.take(order)
        start, length = runs(bucket[order])
        for a, b in zip(start, start + length, strict=True):
            out["bucket"].append(int(bucket[order[a]]))
            out["done"].append(done)
            for name, kind in (("ids", "<i8"), ("tags", "<u4"), ("starts", "<i4"), ("counts", "<u2"), ("places", "<u2")):
                out[name].append(getattr(s, name)[a:b].astype(kind).tobytes())
            out["text"].append(b"" if done else pa.compress(s.text[s.at[a] : s.at[b]].tobytes(), "zstd", asbytes=True))
            out["size"].append(int(s.at[b] - s.at[a]))
    kinds = {"bucket": pa.int32(), "size": pa.int32(), "done": pa.bool_()}
    return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()})


RANGES = "g int, ids binary, tags binary, starts binary, stops binary"


def repeated_windows(s: _Segments) -> np.ndarray:
    """For each window of the segments, in their order, whether an equal window belongs to a smaller document."""
    seg, j = s.windows()
    at = (s.at[:-1].astype(np.int32))[seg] + j
    place = s.places.astype(np.int32)[seg] - j
    w = words_at(np.concatenate([s.text, np.zeros(2 * WINDOW, np.uint8)]))
    sampled = at + place % COVER
    sample = np.zeros(len(w), bool)
    sample[sampled] = True
    sample = np.flatnonzero(sample)
    rank = np.zeros(len(w), np.int32)
    rank[sample[np.lexsort([w[sample + k] for k in range(WINDOW - WINDOW % 8, -1, -8)])]] = np.arange(len(sample))
    ids = s.ids[seg]
    order = np.lexsort((rank[sampled], place, w[at + 8], w[at]))
    x = at[order]
    same = np.concatenate([[False], w[x[1:] + WINDOW - 8] == w[x[:-1] + WINDOW - 8]])
    for k in range(0, WINDOW - 8, 8):
        same[1:] &= w[x[1:] + k] == w[x[:-1] + k]
    start = np.flatnonzero(~same)
    least = np.repeat(np.minimum.reduceat(ids[order], start), np.diff(np.append(start, len(x))))
    out = np.zeros(len(at), bool)
    out[order] = ids[order] > least
    return out


def _sort_bucket(groups: int):
    def sort(table: pa.Table) -> tuple[np.ndarray, dict]:
        done = table["done"].to_numpy()
        ranges = []
        for finished in (True, False):
            t = table.filter(pa.array(done == finished))
            ids, tags, starts, counts, places = (_joined(t[k], kind).astype(np.int64) for k, kind in (("ids", "<i8"), ("tags", "<u4"), ("starts", "<i4"), ("counts", "<u2"), ("places", "<u2")))
            if not len(ids):
                continue
            if finished:
                ranges.append((ids, tags, starts, starts + counts + WINDOW - 1))
                continue
            text = b"".join(pa.decompress(x, size, "zstd", asbytes=True) for x, size in zip(t["text"].to_pylist(), t["size"].to_pylist(), strict=True))
            s = _Segments(ids, tags, starts, counts, places, np.frombuffer(text, np.uint8))
            kept, gone = s.folded()
            ranges.append((ids[gone], tags[gone], starts[gone], starts[gone] + counts[gone] + WINDOW - 1))
            for block in s.take(kept).blocks():
                hit = repeated_windows(block)
                seg, j = block.windows()
                first = np.flatnonzero(hit & np.concatenate([[True], ~hit[:-1] | (seg[1:] != seg[:-1])]))
                last = np.flatnonzero(hit & np.concatenate([~hit[1:] | (seg[1:] != seg[:-1]), [True]]))
                ranges.append((block.ids[seg[first]], block.tags[seg[first]], block.starts[seg[first]] + j[first], block.starts[seg[last]] + j[last] + WINDOW))
        ids, tags, starts, stops = (np.concatenate(x) for x in zip(*ranges, strict=True)) if ranges else [np.zeros(0, np.int64)] * 4
        return group_of(ids, groups), {"ids": ids.astype("<i8"), "tags": tags.astype("<u4"), "starts": starts.astype("<i4"), "stops": stops.astype("<i4")}

    return sort


RESULT = "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(docs: pa.Table, found: pa.Table | None) -> dict:
    """Byte counts and the digest of what stays of each document, given the ranges to remove."""
    data, offsets = bytescan.flat(docs["_text"])
    raw = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    ids = docs["_id"].to_pylist()
    cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    if found is not None and found.num_rows:
        own, tags, starts, stops = (_joined(found[k], kind).astype(np.int64) for k, kind in (("ids", "<i8"), ("tags", "<u4"), ("starts", "<i4"), ("stops", "<i4")))
        order = np.lexsort((starts, tags, own))
        own, tags, starts, stops = own[order], tags[order], starts[order], stops[order]
        edge = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (tags[1:] != tags[:-1])]))
        for a, b in zip(edge, np.append(edge[1:], len(own)), strict=True):
            reach = np.maximum.accumulate(stops[a:b])
            new = np.flatnonzero(np.concatenate([[True], starts[a + 1 : b] > reach[:-1]]))
            cuts[(int(own[a]), int(tags[a]))] = starts[a:b][new], reach[np.append(new[1:] - 1, b - a - 1)]
    out: dict = {"_id": pa.array(ids, pa.int64()), "n_bytes": np.diff(offsets), "n_removed": [], "n_spans": [], "kept_sha256": []}
    for key, text in zip(ids, raw, strict=True):
        starts, stops = cuts.get((key, zlib.crc32(text)), ((), ())) if cuts else ((), ())
        digest, at = hashlib.sha256(), 0
        for a, b in zip(starts, stops, strict=True):
            digest.update(text[at:a])
            at = b
        digest.update(text[at:])
        out["n_removed"].append(int(sum(stops) - sum(starts)))
        out["n_spans"].append(len(starts))
        out["kept_sha256"].append(digest.hexdigest())
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns ``(id, n_bytes, n_removed, n_spans, kept_sha256)``, one row for each input row.

    Texts are UTF-8 bytes, null ones empty. Every byte that lies in a 50-byte string which also starts in a document
    with a smaller id is removed; matches don't cross documents and are judged on the input. Texts below 50 bytes stay
    whole, as do rows with a null id, which remove nothing elsewhere either. Rows that repeat an id don't remove each
    other. Ids must be integers; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    known = rows.where("_id is not null")
    copies = whole_copies(known)
    result = _pieces(without(known, copies), known, _digest)
    gone = copies.select("_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256"))
    nulls = rows.where("_id is null").mapInArrow(lambda it: (pa.RecordBatch.from_pydict(_plain(_digest(pa.Table.from_batches([b]), None))) for b in it), RESULT)
    return result.unionByName(gone).unionByName(nulls).withColumnRenamed("_id", id_col)


def whole_copies(rows: DataFrame) -> DataFrame:
    """``(_id, _x, n_bytes)`` of each row of ``(_id, _text)`` whose text, of a window or more, a smaller id has too."""
    texts = rows.select("_id", F.xxhash64("_text").alias("_x"), F.octet_length("_text").cast("long").alias("n_bytes"), F.unhex(F.sha2("_text", 256)).alias("_digest"))
    texts = written(texts.where(F.col("n_bytes") >= WINDOW), "digests")
    # Written, so that a join of many copies of one text can be split.
    first = written(texts.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).where("_first < _last"), "firsts")
    return written(texts.join(first, "_digest").where("_id > _first").select("_id", "_x", "n_bytes"), "copies")


def without(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows of ``(_id, _text)`` that are not among the copies. Beyond ``SENT`` of them only texts that a bitmap marks are shuffled."""
    n, keys = copies.count(), ["_id", "_x"]
    if not n:
        return rows
    keyed, gone = rows.withColumn("_x", F.xxhash64("_text")), copies.select(*keys)
    if n <= SENT:
        return keyed.join(F.broadcast(gone), keys, "left_anti").drop("_x")
    maybe = flagged(keyed, gone, keys, "_maybe")
    kept = maybe.where("_maybe").join(gone.hint("merge"), keys, "left_anti")
    return maybe.where("not _maybe").unionByName(kept).drop("_x", "_maybe")


def _plain(columns: dict) -> dict:
    return {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()}


def _pieces(rows: DataFrame, sized: DataFrame, finish) -> DataFrame:
    """The whole plan; the texts are shuffled once, into groups that are used both before and after the sort.

    Partitions follow the bytes of ``sized``, the rows as they are read.
    """
    partitions = partitions_for(sized)
    groups, bits = 2 * partitions + 1, bucket_bits(sized, 9, 2)
    packed = rows.mapInArrow(_anchor_postings(bits), PACKED)
    found = by_range_packed(packed, _repeated(groups), "g int, keys binary", partitions, "keys")
    texts = rows.withColumn("g", _group_column("_id", groups))
    cut = texts.groupBy("g").cogroup(found.groupBy("g")).applyInArrow(_cut(bits), SEGMENTS)
    ranges = by_range_packed(cut, _sort_bucket(groups), RANGES, partitions)
    return texts.groupBy("g").cogroup(ranges.groupBy("g")).applyInArrow(lambda d, r: pa.table(finish(d, r)), RESULT)
