"""SentencePiece encoding and decoding as relations.

Spaces become U+2581 and one more goes before the text, which is then cut into words wherever no piece holds the two
characters on either side: no path crosses such a place, so the best path is made of the words' best paths. Every
distinct word is encoded once. Its substrings of bounded length are exploded and joined to the piece table, which gives
the edges of its lattice; a character without a piece of its own gets an edge of byte pieces. Edges are grouped by word
and a Viterbi pass over them, a higher-order ``aggregate``, keeps the best path to each place. Texts then look their words
up. All pieces and scores come from the model's file; nothing is trained.

A word of more than ``LONG`` characters is cut into blocks, and pieces may cross the cuts. A path enters a block at one of
its first places, as many as the longest piece has characters. Each block's lattice gives the best scores from every
entry to every entry of the next block; one fold over a word's blocks gives the best score at each entry, with which each
block finds its own paths; a second fold, from the end, picks one of every block. The result is that of a Viterbi pass
over the whole word, but no row holds more than a block's lattice.

The path is the one with the largest sum of the model's piece scores. For a unigram model that is SentencePiece's own
result; a BPE model's merges can come to another segmentation of the same text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructType

from kerbsight.llm import bytescan
from kerbsight.llm.runtime import lean, partitions_for, unused
from kerbsight.operators.scratch import written

U = np.uint64
SPACE = "▁"
_SPACE = np.frombuffer(SPACE.encode(), np.uint8)
#: Characters of a block, and of the longest word that has a single lattice.
LONG = 64
#: The dictionary of words is broadcast up to this size; a larger one is joined.
BROADCAST_MB = 96
#: What an edge of byte pieces scores below the worst piece, for each byte.
BYTE_PENALTY = 10.0
PIECE = 1 << 17
#: Partitions of the distinct words at least. A vocabulary grows more slowly than its corpus, so that of a small input is
#: large for its shuffle partitions, and a task sorts the edges of all its words.
WORD_PARTITIONS = 48


class Joints:
    """Which two characters stand next to each other within any piece."""

    def __init__(self, pieces: list[str]):
        pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.chars = "".join(sorted({c for p in pairs for c in p}))
        place = {c: k for k, c in enumerate(self.chars, 1)}
        self.joined = np.zeros((len(place) + 1,) * 2, bool)
        for a, b in pairs:
            self.joined[place[a], place[b]] = True

    def cuts(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function that tells for each code point of a text whether a word begins there."""
        place = np.zeros(0x110000, np.uint16)
        place[[ord(c) for c in self.chars]] = np.arange(1, len(self.chars) + 1)

        def cut(points: np.ndarray) -> np.ndarray:
            k = place[points]
            out = np.ones(len(k), bool)
            out[1:] = ~self.joined[k[:-1], k[1:]]
            return out

        return cut


def piece_table(spark: SparkSession, model_path: str) -> tuple[DataFrame, list[bytes], int, Joints]:
    """``(piece, id, score)`` of the pieces that stand for text, the bytes of every id, the id of byte 0, the joints.

    Its rows are as many as the model's vocabulary has, which bounds the broadcast side of the join.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rows: dict[str, list] = {"piece": [], "id": [], "score": []}
    raw, zero = [], -1
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            zero = i if piece == "<0x00>" else zero
            raw.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            for column, x in zip(rows.values(), (piece, i, float(model.get_score(i))), strict=True):
                column.append(x)
            raw.append(piece.replace(SPACE, " ").encode())
    if zero < 0:
        raise ValueError("the model has no byte pieces")
    # An Arrow table needs no Python worker to become a DataFrame, where a list starts more of them on executors.
    table = pa.table({"piece": pa.array(rows["piece"]), "id": pa.array(rows["id"], pa.int32()), "score": pa.array(rows["score"])})
    return spark.createDataFrame(table), raw, zero, Joints(rows["piece"])


def marked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with each space, and the start of each text that has any bytes, as U+2581."""
    size = np.diff(offsets)
    space = data == 0x20
    width = np.where(space, 3, 1)
    at = np.concatenate([[0], np.cumsum(width)])
    lead = np.where(size > 0, 3, 0)
    moved = np.repeat(np.cumsum(lead), size)
    out_offsets = np.concatenate([[0], np.cumsum(lead + at[offsets[1:]] - at[offsets[:-1]])])
    out = np.empty(out_offsets[-1], np.uint8)
    to = at[:-1] + moved
    out[to[~space]] = data[~space]
    begin = np.concatenate([to[space], out_offsets[:-1][size > 0]])
    for k in range(3):
        out[begin + k] = _SPACE[k]
    return out, out_offsets


def word_starts(data: np.ndarray, offsets: np.ndarray, cut: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all words of marked texts, and each text's first word (n + 1 values)."""
    n = len(data)
    begin = np.zeros(n, bool)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begin[np.flatnonzero((data & 0xC0) != 0x80)[cut(points)]] = True
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begin)
    return starts, np.searchsorted(starts, offsets)


def _words_of(column: pa.Array, cut: Callable[[np.ndarray], np.ndarray]):
    """For each piece of a batch: rows, marked bytes, starts and ends of words, their hashes, each row's first word."""
    for i, j, d, o in bytescan.pieces(*bytescan.flat(column), PIECE):
        data, offsets = marked(d, o)
        starts, first = word_starts(data, offsets, cut)
        ends = np.append(starts[1:], len(data))
        yield i, j, data, starts, ends, bytescan.word_hashes(data, starts, ends, fold=False), first


def _distinct_words(joints: Joints):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, cut = np.zeros(0, U), joints.cuts()
        for b in batches:
            for _, _, data, starts, ends, h, _ in _words_of(b.column("_text"), cut):
                h, at = np.unique(h, return_index=True)
                new = seen[np.minimum(np.searchsorted(seen, h), len(seen) - 1)] != h if len(seen) else np.ones(len(h), bool)
                seen = np.concatenate([seen, h[new]])
                seen.sort(kind="stable")  # a merge of two sorted runs
                s, e = starts[at[new]], ends[at[new]]
                if len(s):
                    offsets = np.concatenate([[0], np.cumsum(e - s)]).astype(np.int32)
                    index = np.arange(offsets[-1]) + np.repeat(s - offsets[:-1], e - s)
                    yield pa.RecordBatch.from_arrays([pa.StringArray.from_buffers(len(s), pa.py_buffer(offsets), pa.py_buffer(data[index]))], names=["word"])

    return emit


def _edges(spans: DataFrame, pieces: DataFrame, worst: float, begin: Column) -> DataFrame:
    """Adds ``edge`` to rows of ``(piece, s, k)``: the lattice's edge over the ``k`` characters from the ``s``-th on.

    Its id is the piece's, or minus the place in the word, from 1 up, of a character that is to become byte pieces.
    """
    edges = spans.join(F.broadcast(pieces), "piece", "left").where("id is not null or k = 1 or k is null")
    score = F.coalesce("score", F.length(F.encode("piece", "UTF-8")) * F.lit(worst - BYTE_PENALTY))
    edge = F.struct((F.col("s") - 1).alias("at"), F.col("k").alias("k"), score.alias("score"), F.coalesce("id", -(begin + F.col("s"))).cast("int").alias("id"))
    return edges.withColumn("edge", F.when(F.col("k").isNotNull(), edge))


def _with_bytes(ids: Column, word: Column, zero: int) -> Column:
    """Ids with the byte pieces of the characters that negative ones stand for."""
    raw = lambda i: F.encode(F.substring(word, -i, F.lit(1)), "UTF-8")
    each = lambda c: F.transform(F.sequence(F.lit(1), F.length(c)), lambda k: F.conv(F.hex(F.substring(c, k, F.lit(1))), 16, 10).cast("int") + zero)
    spelled = F.flatten(F.transform(ids, lambda i: F.when(i < 0, each(raw(i))).otherwise(F.array(i))))
    return F.when(F.exists(ids, lambda i: i < 0), spelled).otherwise(ids)


def encode_words(words: DataFrame, pieces: DataFrame, zero: int, long: int = LONG) -> DataFrame:
    """``(word, ids)`` for a table of distinct words.

    Where the words are dealt out by word, exploding, the join with the broadcast pieces and the grouping keep to that.
    """
    longest, worst = pieces.agg(F.max(F.length("piece")), F.min("score")).first()
    n = F.length("word")
    spans = words.withColumn("s", F.explode_outer(F.when(n <= long, F.sequence(F.lit(1), n))))
    spans = spans.withColumn("k", F.explode_outer(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("s") + 1))))
    spans = spans.withColumn("piece", F.substring(F.col("word"), F.col("s"), F.col("k")))
    lattice = _edges(spans, pieces, worst, F.lit(0)).groupBy("word").agg(F.collect_list("edge").alias("edges"))
    paths = lattice.select("word", F.when(n <= long, viterbi(F.col("edges"), n)).alias("ids"))
    table = written(paths.select("word", _with_bytes(F.col("ids"), F.col("word"), zero).alias("ids")), "words")
    few = table.where("ids is null").select("word")
    if few.isEmpty():
        return table
    return table.where("ids is not null").unionByName(written(_long_words(few, pieces, zero, long, longest, worst), "words"))


def viterbi(edges: Column, n: Column) -> Column:
    """The ids on the best path from place 0 to ``n``; of equally good ones that with the longer last piece."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("k"), F.expr("cast(array() as array<int>)").alias("ids")))

    def to(best: Column, place: Column) -> Column:
        into = F.filter(edges, lambda e: e["at"] + e["k"] == place)
        paths = F.transform(into, lambda e: F.struct((F.element_at(best, e["at"] + 1)["score"] + e["score"]).alias("score"), e["k"].alias("k"), F.concat(F.element_at(best, e["at"] + 1)["ids"], F.array(e["id"])).alias("ids")))
        return F.concat(best, F.array(F.array_max(paths)))

    return F.aggregate(F.sequence(F.lit(1), n), start, to, lambda best: F.element_at(best, n + 1)["ids"])


def _long_words(words: DataFrame, pieces: DataFrame, zero: int, block: int, width: int, worst: float) -> DataFrame:
    """The same for words of more than ``block`` characters.

    A block is the places from its start to ``block`` behind it, where the next one begins, and ``width`` - 1 more, the
    entries of the next one that an edge from this block can reach. The last block takes what is left.
    """
    size = F.length("word")
    named = written(words.select("word", F.sha2("word", 256).alias("key"), F.greatest(F.floor(size / block), F.lit(1)).cast("int").alias("blocks")), "long")
    each = named.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    last = F.col("b") == F.col("blocks") - 1
    begin = F.col("b") * block
    text = F.substring(F.col("word"), begin + 1, F.when(last, size - begin).otherwise(F.least(F.lit(block + width - 1), size - begin)))
    each = each.select("key", "b", text.alias("text"), F.when(last, size - begin).otherwise(block).cast("int").alias("own"))
    n = F.length("text")
    spans = each.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("own")))).withColumn("k", F.explode(F.sequence(F.lit(1), F.least(F.lit(width), n - F.col("s") + 1))))
    spans = spans.withColumn("piece", F.substring(F.col("text"), F.col("s"), F.col("k")))
    edges = _edges(spans, pieces, worst, F.col("b") * block).groupBy("key", "b", "own", "text").agg(F.collect_list("edge").alias("edges"))
    into = F.transform(F.sequence(F.lit(1), n), lambda p: F.filter("edges", lambda e: e["at"] + e["k"] == p))
    lattice = written(edges.select("key", "b", "own", n.alias("n"), into.alias("into")), "blocks")

    lost = F.struct(F.lit(float("-inf")).alias("score"), F.lit(0).alias("k"))
    none = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("k"))
    entries = F.sequence(F.lit(0), F.lit(width - 1))
    best_of = lambda paths: F.coalesce(F.array_max(paths), lost)

    def further(best: Column, place: Column) -> Column:
        of = lambda e: F.transform(F.element_at("into", place), lambda x: F.struct((F.element_at(F.element_at(best, x["at"] + 1), e + 1)["score"] + x["score"]).alias("score"), x["k"].alias("k")))
        return F.concat(best, F.array(F.transform(entries, lambda e: F.when(e == place, none).otherwise(best_of(of(e))))))

    start = F.array(F.transform(entries, lambda e: F.when(e == 0, none).otherwise(lost)))
    places = F.sequence(F.lit(1), F.col("n"))
    across = lattice.select("key", "b", F.aggregate(places, start, further, lambda best: F.slice(best, F.col("own") + 1, F.col("n") - F.col("own") + 1)).alias("across"))
    folded = across.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("b", "across"))).alias("blocks"))

    def over(state: Column, x: Column) -> Column:
        entry = F.element_at(state, -1)
        reached = F.transform(x["across"], lambda exits: best_of(F.zip_with(entry, exits, lambda a, m: F.struct((a["score"] + m["score"]).alias("score"), m["k"].alias("k")))))
        return F.concat(state, F.array(F.concat(reached, F.array_repeat(lost, width - F.size(reached)))))

    entry = folded.select("key", F.posexplode(F.aggregate("blocks", F.array(start[0]), over)).alias("b", "entry"))
    here = written(lattice.join(entry, ["key", "b"]), "entries")

    def path(best: Column, place: Column) -> Column:
        inner = F.transform(F.element_at("into", place), lambda x: F.struct((F.element_at(best, x["at"] + 1)["score"] + x["score"]).alias("score"), x["k"].alias("k"), F.element_at(best, x["at"] + 1)["entry"].alias("entry"), F.concat(F.element_at(best, x["at"] + 1)["ids"], F.array(x["id"])).alias("ids")))
        crossing = F.when(place < width, F.array(entered(place))).otherwise(F.slice(inner, 1, 0))
        nowhere = F.struct(F.lit(float("-inf")).alias("score"), F.lit(0).alias("k"), F.lit(0).alias("entry"), F.expr("cast(array() as array<int>)").alias("ids"))
        return F.concat(best, F.array(F.coalesce(F.array_max(F.concat(inner, crossing)), nowhere)))

    def entered(place: Column) -> Column:
        e = F.element_at("entry", place + 1)
        return F.struct(e["score"].alias("score"), e["k"].alias("k"), place.alias("entry"), F.expr("cast(array() as array<int>)").alias("ids"))

    exits = F.aggregate(places, F.array(entered(F.lit(0))), path, lambda best: F.transform(F.slice(best, F.col("own") + 1, F.col("n") - F.col("own") + 1), lambda x: F.struct(x["entry"].alias("entry"), x["ids"].alias("ids"))))
    paths = here.select("key", "b", exits.alias("exits")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("b", "exits")), asc=False).alias("blocks"))
    back = F.struct(F.lit(0).alias("exit"), F.expr("cast(array() as array<array<int>>)").alias("ids"))

    def pick(state: Column, x: Column) -> Column:
        taken = F.element_at(x["exits"], state["exit"] + 1)
        return F.struct(taken["entry"].alias("exit"), F.concat(state["ids"], F.array(taken["ids"])).alias("ids"))

    ids = paths.select("key", F.aggregate("blocks", back, pick, lambda x: F.flatten(F.reverse(x["ids"]))).alias("ids"))
    return named.join(ids, "key").select("word", _with_bytes(F.col("ids"), F.col("word"), zero).alias("ids"))


_BLOB = pa.schema([("hashes", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            data, offsets = bytescan.flat(b.column("word"))
            ids = b.column("ids")
            h = bytescan.word_hashes(data, offsets[:-1], offsets[1:], fold=False)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (h, np.diff(ids.offsets.to_numpy()).astype(np.uint32), ids.flatten().to_numpy().astype(np.int32))], schema=_BLOB)


class Bytes:
    """The bytes that ids stand for."""

    def __init__(self, raw: list[bytes]):
        self.flat, self.size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw])
        self.start = np.cumsum(self.size) - self.size

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of the ids, one after another, and where each id's end."""
        n = self.size[ids]
        ends = np.cumsum(n)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - (ends - n), n)], ends


def _same(decoded: np.ndarray, ends: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row whether its ids' bytes are a space and its text; an empty text has none. U+2581 counts as a space."""
    stop = np.concatenate([[0], ends])[at]
    out = np.zeros(len(offsets) - 1, bool)
    for k in range(len(out)):
        text, back = data[offsets[k] : offsets[k + 1]], decoded[stop[k] : stop[k + 1]]
        if not len(text):
            out[k] = not len(back)
        elif len(back) == len(text) + 1:
            out[k] = back[0] == 0x20 and np.array_equal(back[1:], text)
        else:
            out[k] = back.tobytes() == b" " + text.tobytes().replace(_SPACE.tobytes(), b" ")
    return out


def encode(docs: DataFrame, model_path: str, text_col: str = "text", check: bool = False, broadcast_mb: float = BROADCAST_MB, ids_col: str = "ids", check_col: str = "round_trip") -> DataFrame:
    """All columns and rows of ``docs``, and ``ids_col``, the ids of the text's pieces.

    With ``check`` there is also ``check_col``: whether the ids, decoded in the same pass, give the text back. Both replace
    a column of their name; all others pass through, whatever their names. Null and empty texts have no ids. Repeated rows
    are encoded alike; an empty table gives an empty result. Words may be of any length, so texts without spaces too.
    """
    spark = docs.sparkSession
    pieces, raw, zero, joints = piece_table(spark, model_path)
    partitions = max(WORD_PARTITIONS, partitions_for(docs))
    new = [ids_col, *[check_col] * check]
    docs = docs.select(*[c for c in docs.columns if c.lower() not in [x.lower() for x in new]])
    words = docs.select(F.col(text_col).alias("_text")).mapInArrow(lean(_distinct_words(joints)), "word string").repartition(partitions, "word").distinct()
    table = encode_words(words, pieces, zero)
    size = table.agg(F.coalesce(F.sum(F.lit(12) + 4 * F.size("ids")), F.lit(0))).first()[0]
    if size > broadcast_mb * 1e6:
        return _looked_up(docs, table, text_col, joints, raw, new)
    narrow = np.uint16 if len(raw) <= 1 << 16 else np.int32
    packed = table.mapInArrow(_pack, "hashes binary, sizes binary, ids binary").toLocalIterator()
    parts = [(np.frombuffer(r["hashes"], U), np.frombuffer(r["sizes"], np.uint32), np.frombuffer(r["ids"], np.int32).astype(narrow)) for r in packed]
    h, sizes, ids = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, U), np.zeros(0, np.uint32), np.zeros(0, narrow))
    parts.clear()
    order = np.argsort(h)
    at = (np.cumsum(sizes, dtype=np.int64) - sizes)[order].astype(np.uint32)
    # The ids in the order of the hashes, so that a word's ids end where the next one's begin.
    ends = np.concatenate([[0], np.cumsum(sizes[order], dtype=np.int64)]).astype(np.uint32)
    index = np.repeat(at - ends[:-1], sizes[order]) + np.arange(len(ids), dtype=np.uint32)
    known = [spark.sparkContext.broadcast(x) for x in (h[order], ends, ids[index])]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ends, ids = (x.value for x in known)
        cut, back = joints.cuts(), Bytes(raw)
        for b in batches:
            data, offsets = bytescan.flat(b.column(text_col))
            for i, j, _, _, _, h, first in _words_of(b.column(text_col), cut):
                distinct, place = np.unique(h, return_inverse=True)
                entry = np.searchsorted(hashes, distinct)[place]
                start = ends[entry].astype(np.int64)
                count = ends[entry + 1] - start
                total = np.concatenate([[0], np.cumsum(count)])
                values = ids[np.arange(total[-1]) + np.repeat(start - total[:-1], count)].astype(np.int32)
                bounds = total[first]
                out = [*b.slice(i, j - i).columns, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))]
                if check:
                    d, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                    out.append(pa.array(_same(*back.of(values), bounds, d, o)))
                yield pa.RecordBatch.from_arrays(out, names=[*b.schema.names, *new])

    return docs.mapInArrow(lean(look_up), _with_ids(docs, new))


def _with_ids(docs: DataFrame, new: list[str]) -> StructType:
    schema = StructType([*docs.schema.fields]).add(new[0], ArrayType(IntegerType()))
    return schema.add(new[1], BooleanType()) if new[1:] else schema


def _looked_up(docs: DataFrame, table: DataFrame, text_col: str, joints: Joints, raw: list[bytes], new: list[str]) -> DataFrame:
    """The same by a shuffled join of the words with the dictionary, for one that is too large to broadcast.

    A text sends each of its distinct words once, as a hash; what comes back is put in the words' order beside the text.
    """
    passed = docs.columns
    row, h, ids = unused(passed, "_row", "_h", "_ids")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = joints.cuts()
        for b in batches:
            for i, _, _, _, _, hashes, first in _words_of(b.column("text"), cut):
                for k in range(len(first) - 1):
                    x = np.unique(hashes[first[k] : first[k + 1]])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), b.column("row")[i + k].as_py())), pa.array(x.view(np.int64))], names=["row", "h"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = bytescan.flat(b.column("word"))
            x = bytescan.word_hashes(data, offsets[:-1], offsets[1:], fold=False)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), b.column("ids")], names=["h", "ids"])

    known = written(table.mapInArrow(keyed, "h long, ids array<int>"), "hashed")
    asked = numbered.select(F.col(row).alias("row"), F.col(text_col).alias("text")).mapInArrow(lean(split), "row long, h long")
    told = asked.join(known.hint("merge"), "h").groupBy(F.col("row").alias(row)).agg(F.collect_list("h").alias(h), F.collect_list("ids").alias(ids))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, back = joints.cuts(), Bytes(raw)
        for b in batches:
            for i in range(b.num_rows):
                own = b.slice(i, 1)
                data, offsets = bytescan.flat(own.column(text_col))
                values = np.zeros(0, np.int32)
                if len(data):
                    hashes = own.column(h).flatten().to_numpy().view(U)
                    lists = own.column(ids).flatten()
                    order = np.argsort(hashes)
                    words = np.concatenate([x[5] for x in _words_of(own.column(text_col), cut)])
                    values = lists.take(pa.array(order[np.searchsorted(hashes[order], words)])).flatten().to_numpy().astype(np.int32)
                bounds = np.array([0, len(values)])
                columns = [*own.select(passed).columns, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))]
                if new[1:]:
                    columns.append(pa.array(_same(*back.of(values), bounds, data, offsets)))
                yield pa.RecordBatch.from_arrays(columns, names=[*passed, *new])

    return numbered.join(told.hint("merge"), row, "left").drop(row).mapInArrow(lean(put), _with_ids(docs, new))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the text of each row's ids: the pieces' bytes, without the space that encoding put before the text.

    Control and unknown ids have no text; null ids give null, an id outside the vocabulary an error. Bytes that aren't
    UTF-8 become U+FFFD. A text with U+2581 in it comes back with spaces there, as SentencePiece does.
    """
    _, raw, _, _ = piece_table(encoded.sparkSession, model_path)
    pieces = encoded.sparkSession.sparkContext.broadcast(raw)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        back = Bytes(pieces.value)
        for column in batches:
            yield pd.Series([None if ids is None else back.of(np.asarray(ids, np.int64))[0].tobytes().decode("utf-8", "replace").removeprefix(" ") for ids in column], dtype=object)

    return encoded.withColumn(out_col, text_of(ids_col))
