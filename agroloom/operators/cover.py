"""Polygons as cells of a quadtree, each with what it takes to tell its points inside from those outside."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of one level have sides of four to the power of minus the level; a level has 16 children a cell.
FANOUT = 4
LEVELS = range(-16, 17)
#: A cell with more edges is divided, as long as the polygon has at most so many cells.
EDGES, CAP = 16, 512
#: Edges this near to a cell, as a share of its side, are compared exactly.
_MARGIN = 1e-6
_ROW = (
    "level int, cx bigint, cy bigint, inner boolean, odd boolean, turns array<double>, "
    "edges array<struct<ax:double,ay:double,bx:double,by:double>>"
)


class Cell(NamedTuple):
    """A cell: its edges; whether an odd number of the edges to the east are at its southern side's height, and where that turns."""

    level: int
    cx: int
    cy: int
    edges: np.ndarray
    odd: bool
    turns: np.ndarray


def side(level: int) -> float:
    return float(FANOUT) ** -level


def _within(level: int, cx: int, cy: int, edges: np.ndarray, odd: bool, turns: np.ndarray) -> Cell | None:
    """The cell, given edges that may concern it and those known to be east; None if all of it is outside.

    A ray from a point to the east crosses an edge at heights from its lower end to below its upper one.
    Edges that pass the cell to the east are crossed by rays of all its points at such heights, so
    only the heights at which their number becomes odd or even are kept: where edges follow each
    other these cancel out. Edges that pass to the west are never crossed.
    """
    size = side(level)
    west, south = cx * size, cy * size
    east, north, margin = west + size, south + size, size * _MARGIN
    ax, ay, bx, by = edges.T
    low, high = np.minimum(ay, by), np.maximum(ay, by)
    edges, low, high = (v[(high >= south) & (low <= north)] for v in (edges, low, high))
    ax, ay, bx, by = edges.T
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.where(by == ay, 0.0, (bx - ax) / (by - ay))
    first = np.where(by == ay, ax, ax + (np.clip(south, low, high) - ay) * slope)
    last = np.where(by == ay, bx, ax + (np.clip(north, low, high) - ay) * slope)
    passes_east = np.minimum(first, last) > east + margin
    passes_west = np.maximum(first, last) < west - margin
    ends = np.concatenate((low[passes_east], high[passes_east]))
    odd ^= bool((np.count_nonzero(turns <= south) + np.count_nonzero(ends <= south)) % 2)
    heights, times = np.unique(np.concatenate((turns, ends)), return_counts=True)
    turns = heights[(times % 2 == 1) & (heights > south) & (heights <= north)]
    own = edges[~passes_east & ~passes_west]
    return Cell(level, cx, cy, own, odd, turns) if own.size or turns.size or odd else None


def cover(edges: np.ndarray, cap: int = CAP, most: int = EDGES) -> list[Cell]:
    """The cells of a polygon, given the rows (ax, ay, bx, by) of its rings' edges: ``cap`` of them at most.

    The coarsest are as large as the polygon, so that there are four at most. Cells with more than
    ``most`` edges are divided, those with the most first, as long as there is room.
    """
    if not edges.size or not np.isfinite(edges).all():
        return []
    xs, ys = edges[:, ::2], edges[:, 1::2]
    extent = max(np.ptp(xs), np.ptp(ys))
    level = max((k for k in LEVELS if side(k) >= extent), default=LEVELS[0])
    size = side(level)
    columns = range(int(np.floor(xs.min() / size)), int(np.floor(xs.max() / size)) + 1)
    rows = range(int(np.floor(ys.min() / size)), int(np.floor(ys.max() / size)) + 1)
    none = np.zeros(0)
    cells = [c for x in columns for y in rows if (c := _within(level, x, y, edges, False, none))]
    done = []
    while cells:
        cells.sort(key=lambda c: len(c.edges))
        cell = cells.pop()
        if len(cell.edges) <= most or cell.level == LEVELS[-1] or len(cells) + len(done) + FANOUT * FANOUT > cap:
            done.append(cell)
            continue
        x, y = cell.cx * FANOUT, cell.cy * FANOUT
        children = ((x + i, y + j) for i in range(FANOUT) for j in range(FANOUT))
        cells += [c for at in children if (c := _within(cell.level + 1, *at, cell.edges, cell.odd, cell.turns))]
    return done


def _rings_edges(points: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows (ax, ay, bx, by) of the edges of rings that lie one after the other in ``points``."""
    inside = np.ones(len(points), bool)
    ends = np.cumsum(counts)
    inside[ends[counts > 0] - 1] = False
    at = np.flatnonzero(inside)
    return np.concatenate((points[at], points[at + 1]), 1)


def covers(polygons: DataFrame, name: str, cap: int = CAP) -> DataFrame:
    """Rows (name, level, cx, cy, inner, odd, turns, edges): the cells of polygons (name, rings).

    Rows without a name or rings have none. All points of an ``inner`` cell are inside; in others
    :func:`holds` decides, from the edges of that cell alone. No polygon has more than ``cap`` cells.
    """
    rows = polygons.select(F.col(name), "rings").where(F.col(name).isNotNull() & F.col("rings").isNotNull())
    names = rows.select(name).schema[name].dataType.simpleString()

    def divide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            out: list[tuple] = []
            for k, rings in enumerate(batch.column("rings")):
                ring_values = rings.values
                points = ring_values.flatten()
                xy = np.stack([points.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y")], 1).astype("f8")
                counts = np.diff(ring_values.offsets.to_numpy())
                for c in cover(_rings_edges(xy, counts), cap):
                    inner = c.odd and not c.edges.size and not c.turns.size
                    out.append((k, c.level, c.cx, c.cy, inner, c.odd, c.turns, c.edges))
            at, level, cx, cy, inner, odd, turns, edges = zip(*out, strict=True) if out else [()] * 8
            flat = np.concatenate(edges) if edges else np.zeros((0, 4))
            corners = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(v)) for v in flat.T], ["ax", "ay", "bx", "by"])
            offsets = np.concatenate(([0], np.cumsum([len(e) for e in edges]))).astype("i4")
            columns = {
                name: batch.column(name).take(pa.array(at, pa.int64())), "level": pa.array(level, pa.int32()),
                "cx": pa.array(cx, pa.int64()), "cy": pa.array(cy, pa.int64()), "inner": pa.array(inner, pa.bool_()),
                "odd": pa.array(odd, pa.bool_()), "turns": pa.array(turns, pa.list_(pa.float64())),
                "edges": pa.ListArray.from_arrays(pa.array(offsets), corners),
            }
            schema = schema or pa.schema([(c, v.type) for c, v in columns.items()])
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=schema)

    return rows.mapInArrow(divide, f"`{name}` {names}, {_ROW}")


def holds(x: Column, y: Column) -> Column:
    """Whether a point of a cell (columns of :func:`covers`) is inside: as by all edges, from the cell's own."""
    turned = F.size(F.filter("turns", lambda h: h <= y)) % 2
    crossed = F.size(
        F.filter(
            "edges",
            lambda e: ((e["ay"] > y) != (e["by"] > y))
            & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"]),
        )
    )
    return F.col("inner") | ((F.col("odd").cast("int") + turned + crossed) % 2 == 1)


def cells_of(x: Column, y: Column, levels: list[int]) -> Column:
    """The cells (level, cx, cy) that a point is in, one for each of the levels."""
    places = [
        F.struct(F.lit(k).cast("int").alias("level"), F.floor(x / side(k)).alias("cx"), F.floor(y / side(k)).alias("cy"))
        for k in levels
    ]
    return F.array(*places)
