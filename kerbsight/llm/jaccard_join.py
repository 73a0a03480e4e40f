"""Similarity self-join on word shingles by prefix filters under several global token orders.

1. Each text becomes a set of 64-bit shingle hashes; texts with equal sets form one class, so copies cost one row each.
2. A fixed-size count sketch over all texts tells frequent shingles from rare ones. A global token order sorts by that
   frequency level first and by a hash second; another hash gives another order. Any total order makes prefix filtering
   exact, so the sketch's error can cost candidates but never a link.
3. Two sets with Jaccard similarity t share a token within the first n - ceil(t n) + 1 tokens under every order. The
   prefixes of two orders are shuffled as packed postings, with the size of the set and the token's place in it; classes
   that meet in one are candidates. Of a posting list beyond ``SMALL`` classes, those of a band of sizes meet one of them
   only, that whose token stands first.
4. The filters of the orders are intersected: under each, the prefix tokens that a pair shares, those that it may share
   in long lists and all that can follow the shorter prefix must reach the overlap that a link needs. What is left gets
   its texts and is verified by the exact size of the intersection.
5. Components of the links. A link that is still missing joins two components and has its first common token, under
   either order, in a long list. What follows that token bounds the overlap, so a member's size and the token's place
   give it a range of sizes to look for. A pair must be in such ranges under both orders before it is verified. Pairs
   inside a component can no longer change the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import bytescan
from kerbsight.llm.postings import PACKED_MORE, bucket_bits, by_range, pack, runs
from kerbsight.llm.runtime import batches_of, lean, marked, partitions_for
from kerbsight.operators.components import connected_components
from kerbsight.operators.scratch import written

U = np.uint64
#: Counters of the frequency sketch (2**22) and the number of rows in which they are summed.
SKETCH_BITS, SKETCH_ROWS = 22, 64
_PART_BYTES = 4 * (1 << SKETCH_BITS) // SKETCH_ROWS
#: Posting lists up to this length give all their pairs at once.
SMALL = 64
#: Members that one task compares with the same centre.
MEMBERS = 128
#: Hash keys of the token orders. The first sorts by all frequency levels, the second only tells chance from more.
ORDERS = (0, 0x51ED270B7F4A7C15)
#: Places of tokens are kept in so many steps of a set's size, rounded towards its beginning, so no bound gets too low.
STEPS = 1000
#: Postings that a task gathers at once, and texts of an Arrow batch.
GATHERED, BATCH_ROWS = 1 << 18, 1000
#: Members of a long list, in one block, that are compared across components with those of another block.
BLOCK = 1 << 16


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = bytescan.flat(column)
    for _, _, d, o in bytescan.pieces(data, offsets):
        starts, ends, first = bytescan.words(d, o)
        values, at = bytescan.shingles(bytescan.word_hashes(d, starts, ends), first, size)
        for a, b in zip(at[:-1], at[1:], strict=True):
            s = np.sort(values[a:b])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def _digest(s: np.ndarray) -> int:
    """A set's class."""
    with np.errstate(over="ignore"):
        return int((np.add.reduce(bytescan.mix(s ^ U(0xA5A5A5A5A5A5A5A5))) ^ U(len(s))).astype(np.int64))


def _slot(s: np.ndarray) -> np.ndarray:
    return (bytescan.mix(s) >> U(64 - SKETCH_BITS)).astype(np.int64)


def levels_of(parts: list[bytes]) -> np.ndarray:
    """Frequency level of each counter: 0 up to what chance puts there, then the binary logarithm of the excess."""
    counts = lambda x: np.frombuffer(pa.decompress(x, _PART_BYTES, "zstd", asbytes=True), np.uint32)
    mean = sum(int(counts(x).sum(dtype=np.int64)) for x in parts) / (1 << SKETCH_BITS)
    out = []
    for x in parts:
        excess = counts(x).astype(np.float32) - np.float32(mean + 4 * np.sqrt(mean) + 4)
        out.append(np.where(excess > 0, np.ceil(np.log2(np.maximum(excess, 1) + 1)), 0).astype(np.uint8))
    return np.concatenate(out)


def prefix(s: np.ndarray, levels: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The tokens of a set within its prefix under one order, first ones first."""
    n = len(s)
    p = n - -(-percent * n // 100) + 1
    rank = bytescan.mix(s ^ U(ORDERS[order])) if ORDERS[order] else s
    level = levels[_slot(s)]
    key = ((np.minimum(level, 1) if order else level).astype(U) << U(56)) | (rank >> U(8))
    first = np.argpartition(key, p - 1)[:p] if p < n else np.arange(n)
    return s[first[np.argsort(key[first])]]


_SCAN = pa.schema([("_id", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("part", pa.int32()), ("counts", pa.binary())])
_SCANNED = "_id long, n long, c long, part int, counts binary"


def _scan(size: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << SKETCH_BITS, np.uint32), set()
        for batch in batches:
            n, c = [], []
            for s in shingle_sets(batch.column("_text"), size):
                key = _digest(s)
                n.append(len(s))
                c.append(key)
                if key not in seen:
                    seen.add(key)
                    np.add.at(counts, _slot(s), 1)
            nulls = [pa.nulls(len(n), t) for t in (pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n, pa.int64()), pa.array(c, pa.int64()), *nulls], schema=_SCAN)
        if seen:
            none = pa.nulls(SKETCH_ROWS, pa.int64())
            blobs = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in np.split(counts, SKETCH_ROWS)]
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(range(SKETCH_ROWS), pa.int32()), pa.array(blobs, pa.binary())], schema=_SCAN)

    return lean(scan)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            x = np.frombuffer(pa.decompress(blob, _PART_BYTES, "zstd", asbytes=True), np.uint32).astype(np.int64)
            total[part] = total[part] + x if part in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([pa.compress(np.minimum(x, 2**32 - 1).astype(np.uint32).tobytes(), "zstd", asbytes=True) for x in total.values()], pa.binary())], names=["part", "total"])


def _postings(size: int, percent: int, bits: int, levels):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lv = np.frombuffer(levels.value, np.uint8)

        def parts():
            seen = set()
            for batch in batches:
                for s in shingle_sets(batch.column("_text"), size):
                    if len(s) and (c := _digest(s)) not in seen:
                        seen.add(c)
                        for k in range(len(ORDERS)):
                            p = prefix(s, lv, k, percent)
                            at = np.arange(len(p)) * STEPS // len(s)
                            # size and place go in one value: no set has 2**48 tokens
                            yield (bytescan.mix(p) >> U(1)) | U(k << 63), np.full(len(p), c), (len(s) << 16) + at

        yield from pack(parts(), bits, GATHERED)

    return lean(emit)


def _shared(h: np.ndarray, c: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
    """Postings of tokens that more than one class has, once for each class."""
    if len(h):
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
        h, c, x = h[new], c[new], x[new]
    _, length = runs(h)
    many = np.repeat(length > 1, length)
    return {"h": h[many].astype(np.int64), "c": c[many], "n": x[many] >> 16, "at": (x[many] & 0xFFFF).astype(np.int32), "size": np.repeat(length, length)[many]}


def band(n: np.ndarray, percent: int) -> np.ndarray:
    """Bands of sizes; the smallest of one has at least ``percent`` % of its largest's size."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / min(percent, 99)) + 1e-9).astype(np.int64)


_COUNTED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("k0", pa.int64()), ("k1", pa.int64())])


def _first_pairs(percent: int, bits: int):
    """All pairs of short posting lists, and those with one class of each band of long ones, if sizes allow a link.

    Rows come ordered by h. k0 and k1 count the short lists in which a pair meets under either order.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, c, n, at in _whole_groups(batches, ("h", "c", "n", "at")):
            size = (lambda length: np.repeat(length, length))(runs(h)[1])
            long, out = np.flatnonzero(size > SMALL), []
            if len(long):
                bands = band(n[long], percent)
                long = long[np.lexsort((c[long], at[long], bands, h[long]))]
                bands = band(n[long], percent)
                new = np.concatenate([[True], (h[long][1:] != h[long][:-1]) | (bands[1:] != bands[:-1])])
                hub = long[np.maximum.accumulate(np.where(new, np.arange(len(long)), 0))]
                none = np.zeros(int((~new).sum()), np.int64)
                out.append(_ordered(c, hub[~new], long[~new], none, none))
            i = np.flatnonzero(size <= SMALL)
            for k in range(1, SMALL):
                i = i[i + k < len(h)]
                i = i[h[i] == h[i + k]]
                if not len(i):
                    break
                a = i[(100 * n[i] >= percent * n[i + k]) & (100 * n[i + k] >= percent * n[i])]
                second = (h[a] >> (bits + 39)).astype(np.int64)
                out.append(_ordered(c, a, a + k, 1 - second, second))
            x = np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)
            if not x.shape[1]:
                continue
            x = x[:, np.lexsort(x[1::-1])]
            first = np.flatnonzero(np.concatenate([[True], (x[:2, 1:] != x[:2, :-1]).any(axis=0)]))
            yield pa.RecordBatch.from_arrays([pa.array(x[0][first]), pa.array(x[1][first]), *(pa.array(np.add.reduceat(x[k], first)) for k in (2, 3))], schema=_COUNTED)

    return lean(emit)


def _ordered(c: np.ndarray, i: np.ndarray, j: np.ndarray, *counts: np.ndarray) -> np.ndarray:
    return np.stack([np.minimum(c[i], c[j]), np.maximum(c[i], c[j]), *counts])


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], keys: int = 1) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of rows ordered by the first ones, cut so that the rows of one value of these ``keys`` come together."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        cols = [batch.column(x).to_numpy() for x in names]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
        if not len(cols[0]):
            continue
        other = np.flatnonzero(np.any([x != x[-1] for x in cols[:keys]], axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0
        rest = [x[cut:] for x in cols]
        if cut:
            yield tuple(x[:cut] for x in cols)
    if rest is not None and len(rest[0]):
        yield tuple(rest)


def reach(n: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The sizes of sets that a set of ``n`` can link with if their first common token is its ``at``-th in STEPS.

    At most n less the place is common, and a link needs percent * (n + m) / (100 + percent) common tokens.
    """
    rest = n - -(-at.astype(np.int64) * n // STEPS)
    return -(-percent * n // 100), np.minimum((100 + percent) * rest // percent - n, 100 * n // percent)


_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("order", pa.int32())])


def _cross_pairs(percent: int, bits: int, step: int = 1 << 18):
    """Pairs of classes in one block of a long list whose components differ and that are in each other's reach.

    Rows come ordered by (h, s, t); left and right tell on which side of the block a class stands. Of each block only
    classes outside its largest component look for others, so one that is mostly settled costs its length.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("h", "s", "t", "comp", "c", "n", "at", "salt")
        for cols in _whole_groups(batches, names, keys=3):
            key = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in cols[:3]], axis=0)])
            edges = np.append(np.flatnonzero(key), len(key))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                h, s, t = (int(x[lo]) for x in cols[:3])
                yield from _block(*(x[lo:hi] for x in cols[3:]), s, t, h >> (bits + 39))

    def _block(comp, c, n, at, salt, s, t, order) -> Iterator[pa.RecordBatch]:
        by_size = np.argsort(n, kind="stable")
        comp, c, n, at, salt = (x[by_size] for x in (comp, c, n, at, salt))
        low, high = reach(n, at, percent)
        values, inverse, count = np.unique(comp, return_inverse=True, return_counts=True)
        minor = inverse != count.argmax()
        seekers = np.flatnonzero(minor & (high >= low))
        first, last = np.searchsorted(n, low[seekers]), np.searchsorted(n, high[seekers], "right")
        total = np.concatenate([[0], np.cumsum(last - first)])
        i = 0
        while i < len(seekers):
            j = max(i + 1, int(np.searchsorted(total, total[i] + step, "right")) - 1)
            width = (last - first)[i:j]
            a = np.repeat(seekers[i:j], width)
            b = np.repeat(first[i:j] - (total[i:j] - total[i]), width) + np.arange(len(a))
            ok = (comp[a] != comp[b]) & (low[b] <= n[a]) & (n[a] <= high[b]) & (~minor[b] | (a < b))
            if s != t:
                ok &= salt[a] != salt[b]
            if ok.any():
                x = np.unique(_ordered(c, a[ok], b[ok]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1]), pa.array(np.full(x.shape[1], order), pa.int32())], schema=_MET)
            i = j

    return lean(emit)


def _verify(size: int, percent: int):
    """Rows ordered by (centre, salt, centre's own row first)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, None
        for batch in batches:
            a, b = [], []
            rows = zip(batch.column("centre").to_pylist(), batch.column("c").to_pylist(), shingle_sets(batch.column("_text"), size), strict=True)
            for key, c, s in rows:
                if _digest(s) != c:  # another text of an id that repeats
                    continue
                if key == c:
                    centre, own = key, s
                elif key == centre:
                    at = np.minimum(np.searchsorted(own, s), len(own) - 1)
                    both = int((own[at] == s).sum())
                    if 100 * both >= percent * (len(own) + len(s) - both):
                        a.append(key)
                        b.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_PAIRS)

    return lean(emit)


def links(docs: DataFrame, size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """``(members, edges)`` of a table ``(_id long, _text string)``.

    Members: ``_id, n, c``, the size of the set and its class. Edges: ``a, b``, links between classes that join all
    classes of a component; pairs that other links already join need not be there.
    """
    spark = docs.sparkSession
    partitions = partitions_for(docs)
    scanned = written(docs.mapInArrow(_scan(size), _SCANNED), "sets")
    members = scanned.where("part is null").select("_id", "n", "c")
    sketch = scanned.where("part is not null").select("part", "counts").repartition(min(partitions, SKETCH_ROWS), "part")
    found = {row["part"]: bytes(row["total"]) for row in sketch.mapInArrow(_sum_counts, "part int, total binary").collect()}
    none = pa.compress(bytes(_PART_BYTES), "zstd", asbytes=True)
    levels = spark.sparkContext.broadcast(levels_of([found.get(k, none) for k in range(SKETCH_ROWS)]).tobytes())
    bits = bucket_bits(docs) + 1
    packed = docs.mapInArrow(_postings(size, percent, bits, levels), PACKED_MORE)
    shared = written(by_range(packed, _shared, "h long, c long, n long, at int, size long"), "postings")
    second = F.shiftright("h", bits + 39)
    long_lists = shared.where(F.col("size") > SMALL)
    in_long = long_lists.groupBy("c").agg(F.sum(1 - second).alias("l0"), F.sum(second).alias("l1"))
    sized = members.where("n > 0").groupBy("c").agg(F.min("_id").alias("doc"), F.min("n").alias("n"))
    in_both = [F.coalesce(x, F.lit(0)).alias(x) for x in ("l0", "l1")]
    classes = written(sized.join(in_long, "c", "left").select("c", "doc", "n", *in_both), "classes")
    meet = shared.select("h", "c", "n", "at").repartition(partitions, "h").sortWithinPartitions("h", "c")
    meet = meet.mapInArrow(_first_pairs(percent, bits), "a long, b long, k0 long, k1 long")
    counted = meet.groupBy("a", "b").agg(F.sum("k0").alias("k0"), F.sum("k1").alias("k1"))
    tried = written(_sized(counted, classes, percent), "pairs")
    edges = written(_verified(tried, docs, size, percent), "links")
    cross = _crossing(long_lists, connected_components(edges), percent, bits)
    untried = cross.join(tried.select("a", "b"), ["a", "b"], "left_anti").withColumns({k: F.lit(None).cast("long") for k in ("k0", "k1")})
    more = written(_sized(untried, classes, percent), "pairs")
    return members, edges.unionByName(_verified(more, docs, size, percent))


def _crossing(long_lists: DataFrame, comps: DataFrame, percent: int, bits: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components that meet in long lists of both orders, within each other's reach.

    A list is cut in blocks of about ``BLOCK`` classes by a hash, and each two blocks are one group of rows.
    """
    partitions = partitions_for(long_lists)
    placed = long_lists.drop("size").join(comps.withColumnRenamed("node", "c"), "c", "left").withColumn("comp", F.coalesce("component", "c"))
    lists = placed.groupBy("h").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.ceil(F.count("*") / BLOCK).cast("int").alias("salts"))
    # Written, so that the join can split the rows of a long list.
    lists = written(lists.where("x < y").select("h", "salts"), "lists")
    salted = placed.join(lists, "h").withColumn("salt", F.pmod(F.xxhash64("c"), F.col("salts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("other")
    blocks = salted.select("h", "comp", "c", "n", "at", "salt", other).withColumns({"s": F.least("salt", "other"), "t": F.greatest("salt", "other")})
    ordered = blocks.repartition(partitions, "h", "s", "t").sortWithinPartitions("h", "s", "t")
    met = ordered.mapInArrow(_cross_pairs(percent, bits), "a long, b long, order int")
    return met.groupBy("a", "b").agg(F.min("order").alias("x"), F.max("order").alias("y")).where("x < y").select("a", "b")


def _sized(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Adds the documents of both classes; leaves out pairs whose sizes or, where known, counts rule a link out.

    With p tokens in a prefix of a set of n, an overlap is at most the tokens shared within both prefixes and the n - p
    beyond the one that ends first.
    """
    of = lambda x: classes.select(F.col("c").alias(x), *(F.col(k).alias(f"{k}_{x}") for k in ("doc", "n", "l0", "l1")))
    big, total = F.greatest("n_a", "n_b"), F.col("n_a") + F.col("n_b")
    keep = (100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a"))
    for k in ("0", "1"):
        most = F.col(f"k{k}") + F.least(f"l{k}_a", f"l{k}_b") + F.floor((percent * big + 99) / 100) - 1
        keep &= F.col(f"k{k}").isNull() | ((100 + percent) * most >= percent * total)
    return pairs.join(of("a"), "a").join(of("b"), "b").where(keep).select("a", "b", "doc_a", "doc_b")


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose sets are similar enough. Each centre's members are split over salts of ``MEMBERS``."""
    partitions = partitions_for(docs)
    groups = pairs.groupBy("a", "doc_a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("salts"))
    spokes = pairs.join(groups.select("a", "salts"), "a").select(F.col("doc_b").alias("_id"), F.col("a").alias("centre"), F.col("b").alias("c"), F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    hubs = groups.select(F.col("doc_a").alias("_id"), F.col("a").alias("centre"), F.col("a").alias("c"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    wanted = written(spokes.unionByName(hubs), "wanted")
    texts = marked(docs, wanted, "_id").join(wanted.hint("merge"), "_id").select("centre", "salt", "c", "_text").repartition(partitions, "centre", "salt").sortWithinPartitions("centre", "salt", F.col("c") != F.col("centre"))
    return texts.mapInArrow(_verify(size, percent), "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Returns ``(id, n_shingles, component_id)``, one row for each input row.

    Words are runs of characters other than ASCII white space, with A-Z lower-cased; a text's set is its distinct
    ``size``-word shingles, or its whole sequence of words if it has fewer. Two texts link when
    100 * intersection >= percent * union. The component is named by its smallest id. Null texts, and texts without
    words, have an empty set, link with nothing and are their own component. Ids must be integers; a row with a null id
    gets a null component and links with nothing. Rows that repeat an id have their own sets and all count for that id.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    with batches_of(docs.sparkSession, BATCH_ROWS):
        members, edges = links(rows.where("_id is not null"), size, percent)
        comps = connected_components(edges)
        own = members.where("n > 0").groupBy("c").agg(F.min("_id").alias("doc"))
        named = own.join(comps, own["c"] == comps["node"], "left").select("c", "doc", F.coalesce("component", "c").alias("comp"))
        # Written, so that the join can split the rows of a large component.
        least = written(named.groupBy("comp").agg(F.min("doc").alias("least")), "least")
        of_class = written(named.join(least, "comp").select(F.col("c").alias("_c"), "least"), "named")
    out = members.join(of_class, (members["c"] == of_class["_c"]) & (members["n"] > 0), "left").select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "_id").alias("component_id"))
    nulls = rows.where("_id is null").mapInArrow(_scan(size), _SCANNED).where("part is null")
    return out.unionByName(nulls.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("_id").alias("component_id")))
