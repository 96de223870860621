"""Spatial joins and tile grids over plain columns."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import mgrs_to_epsg
from ..session import cut
from ..sources.writers import write_counted
from . import cover

#: Offset of tile columns in projections by metre.
METRE_OFFSET = 500_000.0


_BOX = ["west", "south", "east", "north"]


def _cells(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def polygons_column(df: DataFrame) -> Column:
    """The polygons of a table that has them as such (``polygons``), or one each (``rings``); null stays null."""
    if "polygons" in df.columns:
        return F.col("polygons")
    return F.when(F.col("rings").isNotNull(), F.array("rings"))


def _inside(points: DataFrame, polygons: DataFrame, name: str) -> DataFrame:
    """``points`` (lon, lat, …) with ``name`` of each polygon that holds them, a row for each.

    Polygons become cells of a quadtree, at most :data:`cover.CAP` each, with the edges near each cell
    only. Points meet the cells by an equi join, at each level that there are cells of.
    """
    parts = polygons.select(name, F.explode(polygons_column(polygons)).alias("rings"))
    cells = cut(cover.covers(parts, name))
    levels = [r["level"] for r in cells.select("level").distinct().collect()]  # a few of the quadtree's levels
    if not levels:
        return points.withColumn(name, F.lit(None)).where("false")
    at = F.explode(cover.cells_of(F.col("lon"), F.col("lat"), sorted(levels)))
    placed = points.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumn("__at", at)
    placed = placed.withColumns({c: F.col("__at")[c] for c in ("level", "cx", "cy")}).drop("__at")
    hits = placed.join(cells, ["level", "cx", "cy"]).where(cover.holds(F.col("lon"), F.col("lat")))
    return hits.select(*points.columns, name)


def point_in_polygon(points: DataFrame, polygons: DataFrame, name: str, key: str = "point_id") -> DataFrame:
    """All points (with ``lon``, ``lat``) with ``name`` of the polygon that holds each, else null.

    ``polygons`` has ``rings``, or ``polygons`` where a name stands for several. Points and polygons
    meet in cells of a quadtree, so that a country and a field cost what their borders need; inside
    of a cell its own edges decide, as ray casting over all edges would. Of several polygons the
    smallest name wins. Points without coordinates and polygons without a name or shape meet nothing.
    """
    hits = _inside(points.select(key, "lon", "lat"), polygons, name)
    return points.join(hits.groupBy(key).agg(F.min(name).alias(name)), key, "left")


def border_edges(borders: DataFrame) -> DataFrame:
    """Rows (a, b): the edges of all rings of polygons, a row each."""
    rings = borders.select(F.explode(F.flatten(polygons_column(borders))).alias("r")).where("size(r) > 1")
    pairs = F.arrays_zip(F.slice("r", F.lit(1), F.size("r") - 1).alias("a"), F.slice("r", F.lit(2), F.size("r") - 1).alias("b"))
    return rings.select(F.explode(pairs).alias("e")).select("e.a", "e.b")


def _dealt(edges: DataFrame, size: float) -> DataFrame:
    """Each edge in every cell of a grid that it crosses: row by row, the columns that it has there."""
    a, b = F.col("a"), F.col("b")
    low, high = F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"])
    rows = edges.withColumn("__cy", F.explode(_cells(low, high, size)))
    slope = (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
    bottom, top = F.greatest(low, F.col("__cy") * size), F.least(high, (F.col("__cy") + 1) * size)
    first = F.coalesce(a["x"] + (bottom - a["y"]) * slope, a["x"])
    last = F.coalesce(a["x"] + (top - a["y"]) * slope, b["x"])
    spare = size * 1e-6
    columns = _cells(F.least(first, last) - spare, F.greatest(first, last) + spare, size)
    return rows.withColumn("__cx", F.explode(columns))


def tiles_meeting(tiles: DataFrame, borders: DataFrame, size: float) -> DataFrame:
    """Tiles (west, south, east, north) that share a point with a polygon of ``borders`` (rings or polygons).

    Edges are dealt to the cells that they cross, of a grid near the tiles' ``size``, and tiles to those
    that they cover; an edge that meets a tile's box keeps it. A tile that no edge meets is all inside or
    all outside, as its corner is. So no tile carries a border, however long that is.
    """
    boxes = tiles.select(*_BOX).distinct()
    near = boxes.withColumn("__cx", F.explode(_cells(F.col("west"), F.col("east"), size)))
    near = near.withColumn("__cy", F.explode(_cells(F.col("south"), F.col("north"), size)))
    met = near.join(_dealt(border_edges(borders), size), ["__cx", "__cy"])
    met = met.where(geo.edge_meets_box(F.col("a"), F.col("b"), F.struct(*_BOX))).select(*_BOX)
    corners = boxes.withColumns({"lon": F.col("west"), "lat": F.col("south")})
    named = borders.select(F.lit(1).alias("__n"), polygons_column(borders).alias("polygons"))
    hits = met.unionByName(_inside(corners, named, "__n").select(*_BOX)).distinct()
    return tiles.join(hits, _BOX, "left_semi").select(*tiles.columns)


def nearest(points: DataFrame, known: DataFrame, attributes: list[str], radius: float | None = None, crowd: int = 32) -> DataFrame:
    """Points (point_id, lon, lat) with the attributes of the nearest known point, however far it is.

    ``known`` has known_id, lon and lat; of equally near ones the smallest id wins. With a ``radius``
    farther ones don't count. Points and known ones without coordinates meet nothing.

    Most points have a known one in the cells around them, of a grid with one known point a cell on
    average. The others, and those in cells with a crowd, go down a pyramid of cells: from one cell for
    all to cells without a crowd, each with the box of its known points. At each level a point leaves
    the cells whose boxes are all farther than some box's farthest corner, so it searches a ring that
    narrows, and few cells at a time.
    """
    spots = known.where("lon is not null and lat is not null").groupBy("lon", "lat").agg(
        F.min(F.struct("known_id", *attributes)).alias("__known")
    )
    spots = cut(spots.select(F.col("lon").alias("__lon"), F.col("lat").alias("__lat"), "__known"))
    extent = spots.agg(
        F.count("*").alias("n"), F.min("__lon").alias("w"), F.max("__lon").alias("e"), F.min("__lat").alias("s"), F.max("__lat").alias("t")
    ).first()
    place = points.select("point_id", "lon", "lat").where("lon is not null and lat is not null")
    if not extent["n"]:
        found = place.select("point_id").where("false").join(spots.select("__known"), F.lit(False), "left")
        return points.join(found.select("point_id", "__known.*"), "point_id", "left")
    width = max(extent["e"] - extent["w"], extent["t"] - extent["s"])
    fine = max((k for k in cover.LEVELS if cover.side(k) >= math.sqrt(width * width / extent["n"])), default=cover.LEVELS[0])
    found, rest = _around(place, spots, fine, crowd)
    if not rest.isEmpty():
        top = max((k for k in cover.LEVELS if cover.side(k) >= width), default=cover.LEVELS[0])
        found = found.unionByName(_descended(rest, spots, top, crowd))
    found = found.where(F.col("__d2") <= radius * radius) if radius is not None else found
    return points.join(found.select("point_id", "__known.*"), "point_id", "left")


def _squared() -> Column:
    """The squared distance from a point to a known one."""
    dx, dy = F.col("lon") - F.col("__lon"), F.col("lat") - F.col("__lat")
    return dx * dx + dy * dy


def _best(pairs: DataFrame) -> DataFrame:
    """The nearest known point of each point: rows (point_id, lon, lat, __d2, __known)."""
    best = F.min(F.struct(_squared().alias("__d2"), F.col("__known"))).alias("__b")
    return pairs.groupBy("point_id", "lon", "lat").agg(best).select("point_id", "lon", "lat", "__b.*")


def _gridded(df: DataFrame, x: str, y: str, level: int, around: bool = False) -> DataFrame:
    """Rows with the cell (cx, cy) of a place, or with each of the nine around it."""
    size, steps = cover.side(level), F.array(F.lit(-1), F.lit(0), F.lit(1))
    if not around:
        return df.withColumns({"cx": F.floor(F.col(x) / size), "cy": F.floor(F.col(y) / size)})
    df = df.withColumn("__i", F.explode(steps)).withColumn("__j", F.explode(steps))
    return df.withColumns({"cx": F.floor(F.col(x) / size) + F.col("__i"), "cy": F.floor(F.col(y) / size) + F.col("__j")}).drop("__i", "__j")


def _around(place: DataFrame, spots: DataFrame, level: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """The points whose nearest is nearer than any beyond the nine cells around them, and the others.

    Cells with a crowd take no part: points around them are among the others.
    """
    counted = _gridded(spots, "__lon", "__lat", level)
    crowded = cut(counted.groupBy("cx", "cy").count().where(F.col("count") > crowd).select("cx", "cy"))
    members = counted.join(crowded, ["cx", "cy"], "left_anti")
    near = _gridded(place, "lon", "lat", level, around=True)
    blocked = near.join(crowded, ["cx", "cy"], "left_semi").select("point_id").distinct()
    best = _best(near.join(members, ["cx", "cy"]).select("point_id", "lon", "lat", "__lon", "__lat", "__known"))
    sure = best.where(F.col("__d2") < cover.side(level) ** 2).join(blocked, "point_id", "left_anti")
    sure = cut(sure)
    return sure, cut(place.join(sure.select("point_id"), "point_id", "left_anti"))


def _descended(place: DataFrame, spots: DataFrame, top: int, crowd: int) -> DataFrame:
    """The nearest known point of each point, by a pyramid of cells from the level ``top`` down."""
    box = [F.min("__lon").alias("w"), F.max("__lon").alias("e"), F.min("__lat").alias("s"), F.max("__lat").alias("t"), F.count("*").alias("n")]
    level, alive = top, None
    out = []
    while True:
        last = level == cover.LEVELS[-1]
        cells = _gridded(spots, "__lon", "__lat", level).groupBy("cx", "cy").agg(*box)
        if alive is None:  # four cells at most hold all known points
            pairs = place.join(F.broadcast(cells))
        else:
            up = cells.withColumns({"__px": F.floor(F.col("cx") / cover.FANOUT), "__py": F.floor(F.col("cy") / cover.FANOUT)})
            alive = alive.select("point_id", "lon", "lat", F.col("cx").alias("__px"), F.col("cy").alias("__py"))
            pairs = alive.join(up, ["__px", "__py"]).drop("__px", "__py")
        lon, lat, zero = F.col("lon"), F.col("lat"), F.lit(0.0)
        dx, dy = F.greatest(F.col("w") - lon, lon - F.col("e"), zero), F.greatest(F.col("s") - lat, lat - F.col("t"), zero)
        fx, fy = F.greatest(F.abs(lon - F.col("w")), F.abs(lon - F.col("e"))), F.greatest(F.abs(lat - F.col("s")), F.abs(lat - F.col("t")))
        pairs = pairs.withColumns({"__low": dx * dx + dy * dy, "__high": fx * fx + fy * fy})
        bound = pairs.groupBy("point_id").agg(F.min("__high").alias("__bound"))
        kept = cut(pairs.join(bound, "point_id").where("__low <= __bound").select("point_id", "lon", "lat", "cx", "cy", "n"))
        crowds = kept.where(F.col("n") > crowd).select("point_id").distinct()
        done = kept if last else kept.join(crowds, "point_id", "left_anti")
        members = _gridded(spots, "__lon", "__lat", level)
        out.append(_best(done.join(members, ["cx", "cy"]).select("point_id", "lon", "lat", "__lon", "__lat", "__known")))
        alive = kept.join(crowds, "point_id", "left_semi")
        if last or alive.isEmpty():
            return reduce(DataFrame.unionByName, out)
        level += 1


def align_crs(left: DataFrame, right: DataFrame, x: str = "x", y: str = "y", epsg: str = "epsg") -> DataFrame:
    """``right`` with its coordinates in the code of ``left``, which must be one for the whole table.

    Rows whose code is that one stay as they are; other known ones are moved.
    """
    codes = [r[0] for r in left.select(epsg).distinct().limit(2).collect()]
    if len(codes) != 1 or codes[0] is None:
        raise ValueError(f"the left table needs one code, not {codes}")
    target = F.lit(codes[0])
    moved = right.withColumn("__p", geo.reprojected(F.col(x), F.col(y), F.col(epsg), target))
    return moved.withColumns({x: F.col("__p.x"), y: F.col("__p.y"), epsg: target}).drop("__p")


def tile_cover(boxes: DataFrame, size: float, in_metres: bool = False) -> DataFrame:
    """A row for each tile of each box (west, south, east, north), clipped to the box.

    Adds x and y, the tile's column and row; tiles are dealt column by column from the offset on.
    """
    offset = METRE_OFFSET if in_metres else 0.0
    xs = F.sequence(F.floor((F.col("west") - offset) / size), F.ceil((F.col("east") - offset) / size) - 1)
    ys = F.sequence(F.floor(F.col("south") / size), F.ceil(F.col("north") / size) - 1)
    rows = boxes.withColumn("x", F.explode(xs)).withColumn("y", F.explode(ys))
    return rows.withColumns(
        {
            "west": F.greatest(F.col("x") * size + offset, F.col("west")),
            "south": F.greatest(F.col("y") * size, F.col("south")),
            "east": F.least((F.col("x") + 1) * size + offset, F.col("east")),
            "north": F.least((F.col("y") + 1) * size, F.col("north")),
        }
    )


def block_names(tiles: DataFrame, prefix: str) -> DataFrame:
    """``tiles`` with ``tile_name``: numbered from 0 by column x, then by row y.

    Rows are numbered within their column; a running count over the columns gives each its start.
    """
    columns = tiles.groupBy("x").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(F.floor(F.col("x") / 1024)).orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    groups = columns.groupBy(F.floor(F.col("x") / 1024).alias("__g")).agg(F.sum("__n").alias("__gn"))
    # one row for 1024 columns of tiles: small enough for a running sum in one place
    group_starts = groups.withColumn(
        "__gs", F.coalesce(F.sum("__gn").over(Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    starts = columns.withColumns(
        {"__s": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__g": F.floor(F.col("x") / 1024)}
    )
    starts = starts.join(group_starts, "__g").select("x", (F.col("__s") + F.col("__gs")).alias("__s"))
    number = F.row_number().over(Window.partitionBy("x").orderBy("y")) - 1 + F.col("__s")
    named = tiles.join(starts, "x").withColumn("__i", number)
    digits = F.when(F.col("__i") < 1000, F.lpad(F.col("__i").cast("string"), 3, "0")).otherwise(F.col("__i").cast("string"))
    return named.withColumn("tile_name", F.concat(F.lit(f"{prefix}_"), digits)).drop("__i", "__s")


def country_grid(boxes: DataFrame, borders: DataFrame, size: float, prefix: str, in_metres: bool = False) -> DataFrame:
    """Named tiles over a country: cover, keep those that meet the border, number them."""
    return block_names(tiles_meeting(tile_cover(boxes, size, in_metres), borders, size), prefix)


def country_grid_job(borders: DataFrame, country: str, epsg: int, size: float, prefix: str) -> DataFrame:
    """Rows (tile_name, west, south, east, north, rings) of a country's tiles, in metres.

    The country's rows of ``borders`` (name, polygons) are found by name; the first polygon of each, moved
    from longitude and latitude to the UTM zone, gives the box that tiles cover and the border that
    they have to meet. No row of that name is an error; several make one grid.
    """
    found = borders.where(F.col("name") == country).select(geo.first_polygon(F.col("polygons")).alias("first"))
    code = F.lit(epsg)
    found = found.select(geo.mapped(F.col("first"), lambda x, y: geo.utm(x, y, code)).alias("rings"))
    if found.isEmpty():
        raise ValueError(f"no border of {country!r}")
    boxes = found.select(geo.bounds(F.col("rings")).alias("b")).select("b.*")
    boxes = boxes.agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))
    named = country_grid(boxes, found, size, prefix, in_metres=True)
    return named.withColumn("rings", geo.rectangle(*[F.col(c) for c in _BOX]))


def utm_enriched(units: DataFrame, tiles: DataFrame, key: str, web_mercator: bool = False) -> DataFrame:
    """Units (key, and rings or polygons) with their MGRS tile, its UTM code and their text in that zone.

    The centroid of all parts, taken in Web Mercator, picks the tile, of several the smallest; units
    without one get nulls. Each unit is one row, and rows that share a key share its smallest tile.
    ``web_mercator`` also adds the text in that projection.
    """
    polygons = polygons_column(units)
    points = units.select(key, geo.centroid_of_by_mercator(polygons).alias("__p"))
    points = points.select(key, F.col("__p.x").alias("lon"), F.col("__p.y").alias("lat"))
    found = _inside(points, tiles, "tile").groupBy(key).agg(F.min("tile").alias("tile"))
    rows = units.join(found, key, "left").withColumn("epsg_utm", mgrs_to_epsg(F.col("tile")))

    def moved(place) -> Column:
        return geo.polygons_to_wkt(F.transform(polygons, lambda rings: geo.mapped(rings, place)))

    utm = moved(lambda x, y: geo.utm(x, y, F.col("epsg_utm")))
    rows = rows.withColumn("geometry_utm_wkt", F.when(F.col("epsg_utm").isNotNull(), utm))
    if web_mercator:
        flat = moved(lambda x, y: geo.point(geo.mercator_x(x), geo.mercator_y(y)))
        rows = rows.withColumn("geometry_mercator_wkt", flat)
    return rows


def enrich_job(units: DataFrame, tiles: DataFrame, key: str, path: str, web_mercator: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """:func:`utm_enriched`, written to ``path``, and how many units (rows) were left without_shape, without_tile and without_code.

    Counted in the pass that writes. A unit without a shape has no tile, one without a tile no code.
    """
    rows = utm_enriched(units, tiles, key, web_mercator)
    lost = {"without_shape": polygons_column(units).isNull(), "without_tile": F.col("tile").isNull(), "without_code": F.col("epsg_utm").isNull()}
    return write_counted(rows, path, **lost)
