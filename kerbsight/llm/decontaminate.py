"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Both sides are cut into windows of ``WINDOW`` template tokens and hash-joined. Windows that match are aligned, document
against item, and the values that stood in the placeholders are compared: an item that was only re-parameterised maps
each of its values to one other value. Windows whose values contradict their alignment's mapping are left out; what the
others cover is added up over all alignments, so inserted or deleted words split a copy but don't hide it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbsight.llm import bytescan
from kerbsight.llm.runtime import lean, partitions_for
from kerbsight.operators.scratch import written

U = np.uint64
WINDOW = 8
#: Of a window's tokens at least so many must be words, or all but one in a shorter window, to match by template. Other
#: windows match by their values.
LEAST_WORDS = 4
#: Items that may share a window before it has to wait for pairs that other windows find.
FREQUENT = 16
#: Bits of a window's hash that address the bitmap of benchmark windows, which takes 1 MB.
BITMAP_BITS = 23
NUMBER, UNIT, NAME = (U(x) for x in (0x6E756D626572, 0x756E6974, 0x6E616D65))
#: Words that are units after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t ton tons lb lbs oz pound pounds ml cl dl l "
    "litre litres liter liters gallon gallons ms s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years hz khz mhz ghz w kw mw kwh v a j kj mj cal kcal n pa kpa k c f degrees degree percent usd eur "
    "gbp dollar dollars euro euros cent cents kmh mph kb mb gb tb"
).split()
#: Words that aren't names when capitalised.
COMMON = (
    "a about after again all also although always among an and another any are as at be because been before being below between both but by calculate "
    "can choose compute consider could determine did do does during each either every explain few find first for from given had has have he her here his "
    "how however i if in into is it its last let many may me might more most much must my name new next no not now of off on once one only or other our "
    "out over please prove second she should show since so solve some such suppose than that the their them then there these they third this those though "
    "through to two three four five six seven eight nine ten under until up upon us very was we were what when where whether which while who whom whose why will with would write yes you your "
    "aber alle als am an auch auf aus bei berechne bestimme bis da das dass dein dem den denn der des die dies diese dieser dieses doch du durch ein eine "
    "einem einen einer er es finde für gegeben hat hier ich ihr im in ist ja jede jeder kein man mein mit nach nein nicht noch nun nur ob oder ohne sei sein sich sie "
    "sind so über um und uns unser unter viele vom von vor wann war warum was weil welche welcher wenn wer werden wie wieviel wir wird wo zu zum zur zwei drei "
    "al algunos antes aquí así aunque calcule como con cuando cuál cuántos de del desde después donde dos el ella ellos en entre era es esta este estos ha hay "
    "la las le los me mi muy nada ni no nos o otra otro para pero por porque qué que quién se según si sin sobre son su sus también tiene tres un una y ya yo "
    "après au aucun aussi autre aux avant avec avec ce cela ces cette chaque combien comme comment dans depuis des deux donc du elle elles est et être eux il "
    "ils je là leur lui ma mais même mon ne nous on ont où ou par parce pas plus pour pourquoi quand que quel quelle qui sa sans ses si soit son sont sous sur "
    "ta te tous tout trois très tu une vos votre vous à"
).split()


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return np.sort(bytescan.word_hashes(data, *bytescan.words(data, np.array([0, len(data)]))[:2]))


def _among(value: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value


_UNIT_HASHES, _COMMON_HASHES = _hashes(UNITS), _hashes(COMMON)
_DIGIT = np.array([48 <= c < 58 for c in range(256)])
_UPPER = np.array([65 <= c < 91 for c in range(256)])
_LOWER = np.array([97 <= c < 123 or c >= 128 for c in range(256)])


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row's tokens the symbol (a word's hash or a placeholder), the value's hash and whether it is a word.

    Tokens are runs of letters and digits, and numbers with points and commas between digits. All digits: a number. A
    unit's name after a number, or joined to it: a unit. Capitalised, not all in capitals and not a common word: a name,
    wherever it stands.
    """
    n = len(data)
    digit = _DIGIT[data]
    inside = bytescan.ALNUM[data]
    if n > 2:
        inside[1:-1] |= ((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]
    starts, ends, first = bytescan.runs_of(inside, offsets)
    if not len(starts):
        return np.zeros(0, U), np.zeros(0, U), np.zeros(0, bool), first
    letter = np.flatnonzero(_LOWER[data] | _UPPER[data])
    cut = np.append(letter, n)[np.searchsorted(letter, starts)]
    joined = np.flatnonzero(digit[starts] & (cut < ends))
    joined = joined[_among(bytescan.word_hashes(data, cut[joined], ends[joined]), _UNIT_HASHES)]
    if len(joined):
        starts, ends = np.sort(np.append(starts, cut[joined])), np.sort(np.append(ends, cut[joined]))
        first = np.searchsorted(starts, offsets)
    value = bytescan.word_hashes(data, starts, ends)
    count = lambda mask: (lambda c: c[ends] - c[starts])(np.concatenate([[0], np.cumsum(mask)]))
    number = digit[starts] & (count(_LOWER[data] | _UPPER[data]) == 0)
    follows = np.zeros(len(starts), bool)
    follows[1:] = number[:-1]
    follows[first[:-1][np.diff(first) > 0]] = False
    unit = follows & _among(value, _UNIT_HASHES)
    name = _UPPER[data[starts]] & (count(_UPPER[data]) == 1) & (ends - starts > 1) & ~_among(value, _COMMON_HASHES)
    symbol = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
    return symbol, value, ~(number | unit | name), first


def windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``size`` tokens: (hash, row, place in the row), and value and kind of all tokens, and first tokens.

    The hash is that of the template, or of the values where the template has too few words.
    """
    symbol, value, word, first = template(data, offsets)
    h, at = bytescan.shingles(symbol, first, size, short=False)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    place = np.arange(len(h)) - at[row]
    words = np.concatenate([[0], np.cumsum(word)])
    start = first[row] + place
    few = words[start + size] - words[start] < min(LEAST_WORDS, max(size - 1, 1))
    exact, _ = bytescan.shingles(value, first, size, short=False)
    return np.where(few, bytescan.mix(exact + U(0x6578616374)), h), row, place, value, word, first


WINDOWS = "_h long, _row long, _id long, _at int, _n int, _size int, _slots array<long>, _spots array<int>"
_WINDOWS = pa.schema([("_h", pa.int64()), ("_row", pa.int64()), ("_id", pa.int64()), ("_at", pa.int32()), ("_n", pa.int32()), ("_size", pa.int32()), ("_slots", pa.list_(pa.int64())), ("_spots", pa.list_(pa.int32()))])


def _rows(numbers: np.ndarray, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, size: int, keep) -> pa.RecordBatch | None:
    h, row, place, value, word, first = windows(data, offsets, size)
    h = bytescan.mix(h + U(size))
    take = keep(h, np.diff(first)[row])
    h, row, place = h[take], row[take], place[take]
    if not len(h):
        return None
    index = (first[row] + place)[:, None] + np.arange(size)
    slot = ~word[index]
    at = np.concatenate([[0], np.cumsum(slot.sum(axis=1))]).astype(np.int32)
    slots = pa.ListArray.from_arrays(pa.array(at), pa.array(value[index][slot].view(np.int64)))
    spots = pa.ListArray.from_arrays(pa.array(at), pa.array((place[:, None] + np.arange(size))[slot].astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(numbers[row]), pa.array(ids[row]), pa.array(place, pa.int32()), pa.array(np.diff(first)[row], pa.int32()), pa.array(np.full(len(h), size), pa.int32()), slots, spots], schema=_WINDOWS)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = bytescan.flat(b.column("_text"))
        numbers, ids = (b.column(c).to_numpy() for c in ("_row", "_id"))
        for size in range(1, WINDOW + 1):
            keep = (lambda h, n, size=size: (n == size) if size < WINDOW else np.ones(len(h), bool))
            if (out := _rows(numbers, ids, data, offsets, size, keep)) is not None:
                yield out


def _document_windows(bitmap, sizes: list[int]):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)

        def keep(h: np.ndarray, _: np.ndarray) -> np.ndarray:
            slot = (h >> U(64 - BITMAP_BITS)).astype(np.int64)
            return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

        for b in batches:
            numbers, ids = (b.column(c).to_numpy() for c in ("_row", "_id"))
            for i, j, d, o in bytescan.pieces(*bytescan.flat(b.column("_text"))):
                for size in sizes:
                    if (out := _rows(numbers[i:j], ids[i:j], d, o, size, keep)) is not None:
                        yield out

    return emit


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << BITMAP_BITS, bool)
    for b in batches:
        bits[(b.column("_h").to_numpy().view(U) >> U(64 - BITMAP_BITS)).astype(np.int64)] = True
    if bits.any():
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["bits"])


def _union(table: pa.Table) -> pa.Table:
    total = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for x in table["bits"]:
        total |= np.frombuffer(x.as_py(), np.uint8)
    return pa.table({"bits": pa.array([total.tobytes()], pa.binary())})


def _covered(places: Column, size: Column) -> Column:
    """How many tokens the windows of one size at these sorted places cover."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to"))
    return F.aggregate(places, start, lambda s, p: F.struct((s["n"] + size - F.greatest(F.lit(0), s["to"] - p)).alias("n"), (p + size).alias("to")), lambda s: s["n"])


def _met(found: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """Windows of documents with the equal ones of items.

    A window that more than ``FREQUENT`` items share would pair each of them with every document that has it. Such windows
    wait for the pairs that others find: an item of which they cover less than ``coverage`` can't be held by a document
    without one of its other windows. Items that they cover further are joined by all their windows.
    """
    window = ["_h", "_item", "_of", "_in", "_tokens", "_theirs", "_spots"]
    item = items.select("_h", F.col("_row").alias("_item"), F.col("_id").alias("_of"), F.col("_at").alias("_in"), F.col("_n").alias("_tokens"), F.col("_slots").alias("_theirs"), "_spots", "_size")
    own = found.select("_h", "_row", "_id", "_at", "_size", "_slots")
    shared = written(items.groupBy("_h").agg(F.countDistinct("_row").alias("n")).where(F.col("n") > FREQUENT).select("_h"), "shared")
    if shared.isEmpty():
        return own.join(item.select(*window), "_h").distinct()
    often = item.join(shared, "_h", "left_semi")
    places = often.groupBy("_item", "_tokens", "_size").agg(F.sort_array(F.collect_set("_in")).alias("p"))
    whole = places.where(_covered(F.col("p"), F.col("_size")) / F.col("_tokens") >= coverage).select("_item")
    waiting = often.join(whole, "_item", "left_anti").select(*window)
    first = own.join(item.select(*window).join(waiting.select("_h", "_item", "_in"), ["_h", "_item", "_in"], "left_anti"), "_h").distinct()
    first = written(first, "met")
    pairs = first.select("_row", "_item").distinct()
    rest = own.join(shared, "_h", "left_semi").join(pairs, "_row").join(waiting, ["_h", "_item"])
    return first.unionByName(rest.select(*first.columns).distinct())


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", coverage: float = 0.5) -> DataFrame:
    """Returns ``(id, item_id, coverage, n_windows, reparameterised)``: one row for each document and item that it holds.

    Windows of 8 template tokens of either side are joined by hash; an item of fewer tokens is one window. A document
    holds an item if matching windows cover at least ``coverage`` of the item's tokens, over all alignments together. On an
    alignment an item's value stands for itself, where it occurs at all, or else for the value that stands at more than
    half of its places; windows with any other value in its place don't count. ``n_windows`` counts places of windows in
    the item, ``reparameterised`` tells whether any of them matches with other values only. Windows with fewer than 4 words, or with fewer than all but one in items
    below 8 tokens, match with equal values only.

    Ids must be integers; rows with a null id or text and texts without words match nothing. Rows that repeat an id, of
    documents or items, are compared each by its own text, and the best of them counts for the id. Other columns are
    ignored; either table may be empty.
    """
    spark = docs.sparkSession
    partitions = partitions_for(benchmark)
    own = lambda df, a, b: df.select(F.monotonically_increasing_id().alias("_row"), F.col(a).cast("long").alias("_id"), F.col(b).alias("_text")).where("_id is not null and _text is not null")
    items = written(own(benchmark, item_col, item_text_col).mapInArrow(lean(_item_windows), WINDOWS), "items")
    maps = items.repartition(min(partitions, 64), "_h").mapInArrow(lean(_bitmaps), "bits binary").groupBy().applyInArrow(_union, "bits binary").collect()
    bitmap = spark.sparkContext.broadcast(bytes(maps[0]["bits"]) if maps else bytes(1 << (BITMAP_BITS - 3)))
    sizes = [r[0] for r in items.select("_size").distinct().collect()]
    found = written(own(docs, id_col, text_col).mapInArrow(lean(_document_windows(bitmap, sizes)), WINDOWS), "found")
    met = _met(found, items, coverage)
    value = F.arrays_zip(F.col("_theirs").alias("a"), F.col("_slots").alias("b"), F.col("_spots").alias("at"))
    pair = ["_row", "_item", "_id", "_of", "_tokens", "_size"]
    shift = [*pair, "_shift"]
    slots = met.repartition("_row", "_item").select(*pair, (F.col("_at") - F.col("_in")).alias("_shift"), "_in", F.explode_outer(value).alias("_v"))
    of = Window.partitionBy(*shift, "_v.a")
    slots = slots.withColumn("_b", F.size(F.collect_set("_v.at").over(Window.partitionBy(*shift, "_v.a", "_v.b")))).withColumn("_all", F.size(F.collect_set("_v.at").over(of))).withColumn("_same", F.max(F.col("_v.a") == F.col("_v.b")).over(of))
    fits = F.col("_v").isNull() | F.when(F.col("_same"), F.col("_v.a") == F.col("_v.b")).otherwise(2 * F.col("_b") > F.col("_all"))
    kept = slots.groupBy(*shift, "_in").agg(F.every(fits).alias("_fits"), F.coalesce(F.max(F.col("_v.a") != F.col("_v.b")), F.lit(False)).alias("_other")).where("_fits")
    placed = kept.groupBy(*pair, "_in").agg(F.min("_other").alias("_other"))
    covering = placed.groupBy(*pair).agg(F.sort_array(F.collect_list("_in")).alias("_places"), F.max("_other").alias("other"))
    share = _covered(F.col("_places"), F.col("_size")) / F.col("_tokens")
    hits = covering.select("_id", "_of", share.alias("share"), F.size("_places").cast("long").alias("n"), "other").where(F.col("share") >= coverage)
    best = hits.groupBy("_id", "_of").agg(F.max(F.struct("share", "n", ~F.col("other"))).alias("m"))
    return best.select(F.col("_id").alias(id_col), F.col("_of").alias(item_col), F.col("m.share").alias("coverage"), F.col("m.n").alias("n_windows"), (~F.col("m.col3")).alias("reparameterised"))
