"""Reading WKB and EWKB hex text into coordinates."""

from __future__ import annotations

import struct

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StringType, StructType

POINT_TYPE = StructType().add("x", DoubleType()).add("y", DoubleType())
POINT, LINE, POLYGON, MULTI_POINT, MULTI_LINE, MULTI_POLYGON = 1, 2, 3, 4, 5, 6


def parse(hex_text: str | None) -> tuple[int, list[list[tuple[float, float]]]] | None:
    """(type, parts): a point is one part of one vertex, a polygon its rings, outer first. None if it can't be read."""
    try:
        raw = bytes.fromhex(hex_text)
        kind, parts, end = _geometry(raw, 0)
        return (kind, parts) if end == len(raw) else None
    except (TypeError, ValueError, IndexError, struct.error, KeyError, RecursionError):
        return None


def _geometry(raw: bytes, at: int):
    order = {0: ">", 1: "<"}[raw[at]]
    (code,) = struct.unpack_from(f"{order}I", raw, at + 1)
    at += 5 + 4 * bool(code & 0x20000000)
    size = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
    kind = code & 0xFF

    def vertices(at: int, n: int):
        flat = struct.unpack_from(f"{order}{n * size}d", raw, at)
        return list(zip(flat[::size], flat[1::size], strict=True)), at + 8 * n * size

    def count(at: int):
        return struct.unpack_from(f"{order}I", raw, at)[0], at + 4

    if kind == POINT:
        part, at = vertices(at, 1)
        return kind, [part], at
    n, at = count(at)
    if kind == LINE:
        part, at = vertices(at, n)
        return kind, [part], at
    parts = []
    for _ in range(n):
        if kind == POLYGON:
            m, at = count(at)
            part, at = vertices(at, m)
            parts.append(part)
        elif kind in (MULTI_POINT, MULTI_LINE, MULTI_POLYGON):
            _, inner, at = _geometry(raw, at)
            parts += inner
        else:
            raise ValueError(kind)
    return kind, parts, at


def centroid(kind: int, parts: list) -> tuple[float, float] | None:
    """Of points their mean, of polygons the centre of area with holes left out; None for lines."""
    if kind in (POINT, MULTI_POINT):
        flat = [v for p in parts for v in p]
        return sum(x for x, _ in flat) / len(flat), sum(y for _, y in flat) / len(flat)
    if kind not in (POLYGON, MULTI_POLYGON):
        return None
    area = cx = cy = 0.0
    for ring in parts:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            cross = x0 * y1 - x1 * y0
            area += cross
            cx += (x0 + x1) * cross
            cy += (y0 + y1) * cross
    return (cx / (3 * area), cy / (3 * area)) if area else None


@F.pandas_udf(POINT_TYPE)
def point_of(column: pd.Series) -> pd.DataFrame:
    """A point's coordinates or a polygon's centroid; nulls for other types and for text that can't be read."""
    found = [(p := parse(x)) and centroid(*p) for x in column]
    return pd.DataFrame({"x": [f[0] if f else None for f in found], "y": [f[1] if f else None for f in found]}, dtype=float)


@F.pandas_udf(ArrayType(ArrayType(POINT_TYPE)))
def parts_of(column: pd.Series) -> pd.Series:
    """All parts of a geometry as vertex arrays; null where it can't be read."""
    return pd.Series([(p := parse(x)) and [[{"x": a, "y": b} for a, b in part] for part in p[1]] for x in column], dtype=object)


@F.pandas_udf(ArrayType(ArrayType(POINT_TYPE)))
def rings_of(column: pd.Series) -> pd.Series:
    """The rings of polygons and multipolygons, holes and parts side by side, without the vertex that repeats the first.

    Null for other types, for rings of fewer than three vertices and for text that can't be read.
    """

    def rings(text: str | None):
        found = parse(text)
        if not found or found[0] not in (POLYGON, MULTI_POLYGON):
            return None
        open_ = [part[:-1] if len(part) > 1 and part[0] == part[-1] else part for part in found[1]]
        if not open_ or min(map(len, open_)) < 3:
            return None
        return [[{"x": x, "y": y} for x, y in part] for part in open_]

    return pd.Series([rings(x) for x in column], dtype=object)


@F.arrow_udf(StringType())
def polygon_hex(column: pa.Array) -> pa.Array:
    """Shapes, arrays of rings, as WKB text of one polygon, little endian, each ring closed; null stays null."""

    def text(rings) -> str | None:
        if rings is None:
            return None
        out = struct.pack("<BII", 1, POLYGON, len(rings))
        for ring in rings:
            flat = [c for v in [*ring, ring[0]] for c in (v["x"], v["y"])]
            out += struct.pack(f"<I{len(flat)}d", len(flat) // 2, *flat)
        return out.hex()

    return pa.array([text(x) for x in column.to_pylist()], pa.string())


@F.pandas_udf(BinaryType())
def point_wkb(x: pd.Series, y: pd.Series) -> pd.Series:
    """A point as WKB, little endian; null without coordinates."""
    return pd.Series([None if pd.isna(a) or pd.isna(b) else struct.pack("<BIdd", 1, POINT, a, b) for a, b in zip(x, y, strict=True)], dtype=object)
