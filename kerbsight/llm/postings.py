"""Packed postings: (hash, owner) pairs in blobs by hash range, a tenth of the rows and half the bytes of plain rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kerbsight.llm.runtime import partitions_for, returned

U = np.uint64
#: Entries that a task gathers before it hands on one blob for each hash range.
FLUSH = 1 << 20
PACKED = "bucket int, hashes binary, owners binary"
#: With one more 64-bit value for each entry.
PACKED_MORE = f"{PACKED}, more binary"
_KEY_BYTES = 5


def bucket_bits(df: DataFrame, least: int = 8, each: int = 4) -> int:
    """Ranges: ``each`` for a partition of the input, whose number follows its bytes, or more."""
    return max(least, int(np.ceil(np.log2(each * partitions_for(df)))))


def pack(parts: Iterable[tuple[np.ndarray, ...]], bits: int, most: int = FLUSH) -> Iterator[pa.RecordBatch]:
    """Blobs of (hash, owner) arrays, or (hash, owner, value). Of each hash its top ``bits`` and last 40 bits are kept.

    Beyond ``most`` entries what is gathered is handed on.
    """
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        h, *rest = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        bucket = (h >> U(64 - bits)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keys = np.ascontiguousarray(h[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES])
        edges = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
        full = np.flatnonzero(np.diff(edges))
        blobs = lambda x: pa.array([x[edges[k] : edges[k + 1]].tobytes() for k in full], pa.binary())
        columns = [pa.array(full.astype(np.int32)), blobs(keys), *(blobs(x[order].astype("<i8")) for x in rest)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "hashes", "owners", "more"][: len(columns)])

    n = 0
    for entry in parts:
        held.append(entry)
        n += len(entry[0])
        if n >= most:
            yield from flush()
            n = 0
    yield from flush()


def unpack(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Hashes (range and last 40 bits), owners and values of all blobs of one range, ordered by hash, then owner."""
    bucket = table["bucket"][0].as_py()
    raw = np.frombuffer(b"".join(table["hashes"].to_pylist()), np.uint8).reshape(-1, _KEY_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :_KEY_BYTES] = raw
    h = wide.view("<u8").ravel() | (U(bucket) << U(8 * _KEY_BYTES))
    own, *more = (np.frombuffer(b"".join(table[x].to_pylist()), "<i8") for x in table.column_names[2:])
    order = np.lexsort((own, h))
    return h[order], own[order], *(x[order] for x in more)


def kept_bits(h: np.ndarray, bits: int) -> np.ndarray:
    """A hash as :func:`unpack` gives it back."""
    return ((h >> U(64 - bits)) << U(8 * _KEY_BYTES)) | (h & U((1 << (8 * _KEY_BYTES)) - 1))


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.diff(np.concatenate([starts, [len(keys)]]))


def by_range(packed: DataFrame, fold: Callable[..., dict[str, np.ndarray]], schema: str) -> DataFrame:
    """Applies ``fold`` to the hashes, owners and values of each hash range."""

    def each(table: pa.Table) -> pa.Table:
        out = pa.table(fold(*unpack(table)))
        returned()
        return out

    return packed.groupBy("bucket").applyInArrow(each, schema)


def by_range_packed(packed: DataFrame, fold: Callable[[pa.Table], tuple[np.ndarray, dict[str, np.ndarray]]], schema: str, partitions: int, unique: str = "") -> DataFrame:
    """Applies ``fold`` to the rows of each bucket, dealt out to ``partitions``, and packs what it gives, (group, columns), by group.

    A task goes through its buckets one at a time and hands on one blob for each group, or more beyond FLUSH values.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for table in _ranges_of(batches):
            held.append(fold(table))
            n += len(held[-1][0])
            if n >= FLUSH:
                yield _merged(held, unique)
                held, n = [], 0
        if n:
            yield _merged(held, unique)
        returned()

    return packed.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(apply, schema)


def _ranges_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come ordered by bucket, one table for each bucket."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        start, length = runs(batch.column("bucket").to_numpy())
        for a, n in zip(start, length, strict=True):
            if held and held[0].column("bucket")[0] != batch.column("bucket")[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, n))
    if held:
        yield pa.Table.from_batches(held)


def _merged(held: list, unique: str) -> pa.RecordBatch:
    columns = {k: np.concatenate([c[k] for _, c in held]) for k in held[0][1]}
    return pa.RecordBatch.from_pydict(dealt(np.concatenate([g for g, _ in held]), columns, unique))


def dealt(group: np.ndarray, columns: dict[str, np.ndarray], unique: str = "") -> dict:
    """One row for each group, with each column's values as a blob; those of ``unique`` once."""
    order = np.argsort(group, kind="stable")
    start, length = runs(group[order])
    out: dict = {"g": pa.array(group[order][start].astype(np.int32))}
    for name, x in columns.items():
        x = x[order]
        out[name] = pa.array([(np.unique(x[a : a + n]) if name == unique else x[a : a + n]).tobytes() for a, n in zip(start, length, strict=True)], pa.binary())
    return out
