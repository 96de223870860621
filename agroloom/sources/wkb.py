"""Polygons as well-known binary, a batch of Arrow buffers at a time."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
_POLYGONS = T.ArrayType(T.ArrayType(T.ArrayType(_PLACE)))
#: The codes of polygons and multipolygons, and the flag and offset of heights and measures.
POLYGON, MULTIPOLYGON = 3, 6
HEIGHT, MEASURE, CODE = 0x80000000, 0x40000000, 0x20000000
# End of fixed values.


def _counts(array: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """How many items each list has, a null one none, and the items."""
    if not len(array):  # its offsets may be missing
        return np.zeros(0, "i8"), array.values.slice(0, 0)
    return array.value_lengths().fill_null(0).to_numpy().astype("i8"), array.flatten()


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def _scatter(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """The bytes of each row of ``values`` to the places from ``at`` on."""
    if not at.size:
        return
    raw = np.ascontiguousarray(values).view("u1").reshape(at.size, -1)
    out[at[:, None] + np.arange(raw.shape[1])] = raw


def encoded(polygons: pa.ListArray) -> pa.Array:
    """Lists of polygons as geometries: one polygon as such, others as a multipolygon."""
    parts, rings = _counts(polygons)  # of each geometry
    ring_counts, points = _counts(rings)  # of each polygon
    point_counts, places = _counts(points)  # of each ring
    xy = np.stack([places.field("x").to_numpy(zero_copy_only=False), places.field("y").to_numpy(zero_copy_only=False)], 1)
    ring_bytes = 4 + 16 * point_counts
    of_polygon = _starts(ring_counts)
    polygon_bytes = 9 + np.diff(_starts(ring_bytes)[of_polygon])
    many = parts != 1
    of_geometry = _starts(parts)
    geometry_bytes = np.where(many, 9, 0) + np.diff(_starts(polygon_bytes)[of_geometry])
    null = ~np.asarray(polygons.is_valid())
    geometry_bytes[null] = 0
    starts = _starts(geometry_bytes)
    out = np.zeros(starts[-1], "u1")

    def headers(at: np.ndarray, kind: int, counts: np.ndarray) -> None:
        out[at] = 1
        _scatter(out, at + 1, np.stack([np.full(at.size, kind, "<u4"), counts.astype("<u4")], 1))

    def within(counts: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where each item begins, given where those of each owner do."""
        before = _starts(sizes)
        return before[:-1] - np.repeat(before[_starts(counts)[:-1]], counts) + np.repeat(first, counts)

    valid = ~null
    headers(starts[:-1][many & valid], MULTIPOLYGON, parts[many & valid])
    polygon_at = within(parts, polygon_bytes, starts[:-1] + np.where(many, 9, 0))
    headers(polygon_at, POLYGON, ring_counts)
    ring_at = within(ring_counts, ring_bytes, polygon_at + 9)
    _scatter(out, ring_at, point_counts.astype("<u4")[:, None])
    point_at = within(point_counts, np.full(len(xy), 16), ring_at + 4)
    _scatter(out, point_at, xy.astype("<f8"))
    mask = pa.array(null) if null.any() else None
    binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype("i8")), pa.py_buffer(out)])
    binary = pa.compute.if_else(mask, pa.scalar(None, pa.large_binary()), binary) if mask is not None else binary
    return binary.cast(pa.binary())


class _Headers:
    """Where the rings of a batch's geometries are: their polygons, points and byte order."""

    def __init__(self, data: memoryview):
        self.data = data
        self.rings: list[tuple[int, int, int, bool]] = []  # first byte, points, bytes a point, big-endian
        self.ring_counts: list[int] = []

    def polygon(self, at: int, end: int) -> int:
        order = "<" if self.data[at] == 1 else ">"
        kind, count = struct.unpack_from(f"{order}II", self.data, at + 1)
        base, width = _kind(kind)
        if base != POLYGON:
            raise ValueError(f"not a polygon: kind {kind} of geometry")
        at += 9 + 4 * bool(kind & CODE)
        if kind & CODE:
            (count,) = struct.unpack_from(f"{order}I", self.data, at - 4)
        for _ in range(count):
            (n,) = struct.unpack_from(f"{order}I", self.data, at)
            self.rings.append((at + 4, n, 8 * width, order == ">"))
            at += 4 + 8 * width * n
        if at > end:
            raise ValueError("a geometry ends before its last point")
        self.ring_counts.append(count)
        return at

    def geometry(self, at: int, end: int) -> int:
        """The number of polygons of the geometry in these bytes."""
        order = "<" if self.data[at] == 1 else ">"
        kind, count = struct.unpack_from(f"{order}II", self.data, at + 1)
        if _kind(kind)[0] != MULTIPOLYGON:
            self.polygon(at, end)
            return 1
        at += 9 + 4 * bool(kind & CODE)
        if kind & CODE:
            (count,) = struct.unpack_from(f"{order}I", self.data, at - 4)
        for _ in range(count):
            at = self.polygon(at, end)
        return count


def _kind(kind: int) -> tuple[int, int]:
    """The plain code, and how many numbers a point has."""
    plain = kind & ~(HEIGHT | MEASURE | CODE)
    more = bool(kind & HEIGHT) + bool(kind & MEASURE) + (0, 1, 1, 2)[min(plain // 1000, 3)]
    return plain % 1000, 2 + more


def decoded(geometries: pa.Array) -> pa.Array:
    """Lists of polygons from geometries; null stays null. Heights and measures are left out."""
    geometries = geometries.cast(pa.large_binary())
    offsets = np.frombuffer(geometries.buffers()[1], "i8")[geometries.offset : geometries.offset + len(geometries) + 1]
    data = memoryview(geometries.buffers()[2] or b"")
    headers, counts, null = _Headers(data), [], ~np.asarray(geometries.is_valid())
    for at, end, missing in zip(offsets[:-1].tolist(), offsets[1:].tolist(), null.tolist(), strict=True):
        counts.append(0 if missing else headers.geometry(at, end))
    rings = np.array(headers.rings, "i8").reshape(-1, 4)
    first = np.repeat(rings[:, 0], rings[:, 1])
    nth = np.arange(first.size) - np.repeat(_starts(rings[:, 1])[:-1], rings[:, 1])
    at = first + nth * np.repeat(rings[:, 2], rings[:, 1])
    raw = np.frombuffer(data, "u1")[at[:, None] + np.arange(16)] if at.size else np.zeros((0, 16), "u1")
    xy = np.ascontiguousarray(raw).view("<f8")
    swapped = np.repeat(rings[:, 3].astype(bool), rings[:, 1])
    xy[swapped] = xy[swapped].byteswap()
    places = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
    of_ring = pa.ListArray.from_arrays(pa.array(_starts(rings[:, 1]), pa.int32()), places)
    of_polygon = pa.ListArray.from_arrays(pa.array(_starts(np.array(headers.ring_counts, "i8")), pa.int32()), of_ring)
    starts = pa.array(_starts(np.array(counts, "i8")), pa.int32(), mask=np.append(null, False))
    return pa.ListArray.from_arrays(starts, of_polygon)


@F.arrow_udf(T.BinaryType())
def _encoded(polygons: pa.Array) -> pa.Array:
    return encoded(polygons)


@F.arrow_udf(_POLYGONS)
def _decoded(geometry: pa.Array) -> pa.Array:
    return decoded(geometry)


def to_wkb(polygons: Column) -> Column:
    """Polygons as well-known binary: one as a polygon, others as a multipolygon; null stays null."""
    return _encoded(polygons)


def from_wkb(geometry: Column) -> Column:
    """Polygons from well-known binary; null stays null, another kind of geometry is an error."""
    return _decoded(geometry)
