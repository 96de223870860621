"""Geometry as nested columns, and projections in closed form, as column expressions.

A polygon is ``rings``: an array of rings, the outer one first, each an array of points (x, y)
whose last equals its first. A multipolygon is an array of polygons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The WGS84 ellipsoid, and the grid scale and false eastings and northings of UTM.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0
# End of fixed values.

_N = FLATTENING / (2 - FLATTENING)
#: Radius of the rectifying sphere, and the coefficients of Krüger's series to the third order: from
#: the sphere, back to it, and from its latitudes to those of the ellipsoid.
_RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
)
_ECC = 2 * math.sqrt(_N) / (1 + _N)
WGS84, WEB_MERCATOR = 4326, 3857


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def rectangle(west: Column, south: Column, east: Column, north: Column) -> Column:
    """A polygon of four corners, from the south-west one on."""
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return F.array(F.array(*[point(x, y) for x, y in corners]))


def box_rectangle(box: Column) -> Column:
    """The polygon of a box (west, south, east, north)."""
    return rectangle(*[box[c] for c in ("west", "south", "east", "north")])


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * SEMI_MAJOR


def mercator_y(lat: Column) -> Column:
    return F.ln(F.tan(math.pi / 4 + F.radians(lat) / 2)) * SEMI_MAJOR


def mercator_lon(x: Column) -> Column:
    return F.degrees(x / SEMI_MAJOR)


def mercator_lat(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / SEMI_MAJOR)) - math.pi / 2)


def utm_zone(epsg: Column) -> Column:
    return epsg % 100


def utm(lon: Column, lat: Column, epsg: Column) -> Column:
    """(x, y) in the UTM zone of each row's own code; null for other codes."""
    away = F.radians(lon - (utm_zone(epsg) * 6 - 183))
    sine = F.sin(F.radians(lat))

    def conformal(s: Column) -> Column:
        t = _bound(F.sinh(F.atanh(s["sine"]) - _ECC * F.atanh(_ECC * s["sine"])))
        return t(lambda t: point(F.atanh(F.sin(s["away"]) / F.sqrt(1 + t * t)), F.atan2(t, F.cos(s["away"]))))

    def projected(p: Column) -> Column:
        east, north = _series(p, _ALPHA)
        scale = UTM_SCALE * _RECTIFYING
        return point(FALSE_EASTING + scale * east, _false_north(epsg) + scale * north)

    start = _bound(F.struct(away.alias("away"), sine.alias("sine")))
    return F.when(_in_utm(epsg), _bound(start(conformal))(projected))


def utm_lonlat(x: Column, y: Column, epsg: Column) -> Column:
    """(longitude, latitude) as (x, y) from the UTM zone of each row's own code; null for other codes."""
    scale = UTM_SCALE * _RECTIFYING
    flat = _bound(point((x - FALSE_EASTING) / scale, (y - _false_north(epsg)) / scale))

    def sphere(p: Column) -> Column:
        east, north = _series(p, [-b for b in _BETA])
        return point(east, north)

    def angles(p: Column) -> Column:
        latitude = _bound(F.asin(F.sin(p["y"]) / F.cosh(p["x"])))
        lat = latitude(
            lambda c: sum((d * F.sin(2 * j * c) for j, d in enumerate(_DELTA, 1)), c)
        )
        lon = F.degrees(F.atan2(F.sinh(p["x"]), F.cos(p["y"]))) + (utm_zone(epsg) * 6 - 183)
        return point(lon, F.degrees(lat))

    return F.when(_in_utm(epsg), _bound(flat(sphere))(angles))


def _bound(value: Column):
    """A function that gives ``use(value)``, in which ``value`` is computed once however often it is used."""
    return lambda use: F.transform(F.array(value), use)[0]


def _series(p: Column, factors) -> tuple[Column, Column]:
    """Krüger's series at (x, y), with these factors."""
    east, north = p["x"], p["y"]
    for j, a in enumerate(factors, 1):
        east = east + a * F.cos(2 * j * p["y"]) * F.sinh(2 * j * p["x"])
        north = north + a * F.sin(2 * j * p["y"]) * F.cosh(2 * j * p["x"])
    return east, north


def _false_north(epsg: Column) -> Column:
    return F.when(epsg > 32700, FALSE_NORTHING).otherwise(0.0)


def _in_utm(epsg: Column) -> Column:
    return epsg.between(32601, 32660) | epsg.between(32701, 32760)


def reprojected(x: Column, y: Column, source: Column, target: Column) -> Column:
    """(x, y) from one code to another: WGS84, Web Mercator or a UTM zone; null for other codes."""
    lonlat = (
        F.when(source == WGS84, point(x, y))
        .when(source == WEB_MERCATOR, point(mercator_lon(x), mercator_lat(y)))
        .otherwise(utm_lonlat(x, y, source))
    )

    def onward(p: Column) -> Column:
        return (
            F.when(target == WGS84, p)
            .when(target == WEB_MERCATOR, point(mercator_x(p["x"]), mercator_y(p["y"])))
            .otherwise(utm(p["x"], p["y"], target))
        )

    return F.when(source == target, point(x, y)).otherwise(_bound(lonlat)(onward))


def mapped(rings: Column, place) -> Column:
    """The polygon with every point moved by ``place(x, y)``, which gives a point."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: place(p["x"], p["y"])))


def _ring_edges(ring: Column) -> Column:
    """The edges of a ring, relative to its start, each with its cross product."""
    x0, y0 = ring[0]["x"], ring[0]["y"]
    n = F.size(ring)

    def edge(a, b):
        ax, ay, bx, by = a["x"] - x0, a["y"] - y0, b["x"] - x0, b["y"] - y0
        return F.struct((ax * by - bx * ay).alias("cross"), (ax + bx).alias("x"), (ay + by).alias("y"))

    return F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), edge)


def centroid_of(polygons: Column) -> Column:
    """The planar centroid of polygons together, weighted by area, by the shoelace sums; holes count against it.

    Without an area it is the first point. Parts count where they overlap as often as they do. Sums
    start at the first point, and edges weigh by their share of the area: so the middle of a rectangle
    comes out as the mean of its sides does, to the last bit, and on a tile's border stays there.
    """
    rings = F.transform(
        F.flatten(F.transform(polygons, lambda rings: F.transform(rings, lambda r, i: F.struct(r.alias("r"), i.alias("i"))))),
        lambda e: F.struct(
            _ring_edges(e["r"]).alias("edges"), F.when(e["i"] == 0, 1.0).otherwise(-1.0).alias("sign"), e["r"][0].alias("p")
        ),
    )
    twice = _bound(rings)(
        lambda rings: F.transform(
            rings,
            lambda e: F.struct(
                e["edges"].alias("edges"), e["sign"].alias("sign"), e["p"].alias("p"),
                F.aggregate(e["edges"], F.lit(0.0), lambda s, c: s + c["cross"]).alias("a"),
            ),
        )
    )
    start, zero = polygons[0][0][0], point(F.lit(0.0), F.lit(0.0))

    def away(parts: Column, area: Column) -> Column:
        """From the first point to the centroid."""

        def add(s, e):
            way, share = e["sign"] * F.signum(e["a"]), e["sign"] * F.abs(e["a"]) / area
            moment = F.aggregate(
                e["edges"], zero, lambda m, c: point(m["x"] + way * c["cross"] / area * c["x"], m["y"] + way * c["cross"] / area * c["y"])
            )
            return _bound(moment)(
                lambda m: point(
                    s["x"] + (m["x"] / 3 + share * (e["p"]["x"] - start["x"])), s["y"] + (m["y"] / 3 + share * (e["p"]["y"] - start["y"]))
                )
            )

        return F.aggregate(parts, zero, add)

    def middle(parts: Column) -> Column:
        area = _bound(F.aggregate(parts, F.lit(0.0), lambda s, e: s + e["sign"] * F.abs(e["a"])))
        return area(
            lambda a: F.when(a != 0, _bound(away(parts, a))(lambda d: point(start["x"] + d["x"], start["y"] + d["y"]))).otherwise(
                point(start["x"], start["y"])
            )
        )

    return F.when(F.size(polygons) > 0, _bound(twice)(middle))


def centroid(rings: Column) -> Column:
    """The planar centroid of one polygon."""
    return centroid_of(F.array(rings))


def centroid_of_by_mercator(polygons: Column) -> Column:
    """The centroid of polygons together in Web Mercator, as longitude and latitude.

    Its x is longitude times a number, which moves no centroid: so longitudes stay as they are.
    """
    planar = _bound(centroid_of(F.transform(polygons, lambda rings: mapped(rings, lambda x, y: point(x, mercator_y(y))))))
    return planar(lambda p: point(p["x"], mercator_lat(p["y"])))


def centroid_by_mercator(rings: Column) -> Column:
    """The centroid of one polygon in Web Mercator, as longitude and latitude."""
    return centroid_of_by_mercator(F.array(rings))


def bounds_of(polygons: Column) -> Column:
    """(west, south, east, north) over all points of polygons."""
    return bounds(F.flatten(polygons))


def bounds(rings: Column) -> Column:
    """(west, south, east, north) over all points."""
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("west"), F.array_min(ys).alias("south"),
        F.array_max(xs).alias("east"), F.array_max(ys).alias("north"),
    )


def first_polygon(polygons: Column) -> Column:
    return F.get(polygons, F.lit(0))


def snapped(value: Column, step: int) -> Column:
    """To the nearest multiple, halves to the even one."""
    return F.bround(value / step) * step


def _number(value: Column) -> Column:
    text = F.replace(F.format_number(F.bround(value, 6), 6), F.lit(","), F.lit(""))
    return F.regexp_replace(F.regexp_replace(text, r"0+$", ""), r"\.$", "")


def _polygon_text(rings: Column) -> Column:
    texts = F.transform(
        rings,
        lambda r: F.concat(
            F.lit("("),
            F.array_join(F.transform(r, lambda p: F.concat_ws(" ", _number(p["x"]), _number(p["y"]))), ", "),
            F.lit(")"),
        ),
    )
    return F.concat(F.lit("("), F.array_join(texts, ", "), F.lit(")"))


def to_wkt(rings: Column) -> Column:
    """A polygon's text, with up to six decimals."""
    return F.concat(F.lit("POLYGON "), _polygon_text(rings))


def polygons_to_wkt(polygons: Column) -> Column:
    """The text of polygons: ``POLYGON`` for one, ``MULTIPOLYGON`` for more, with up to six decimals."""
    many = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(polygons, _polygon_text), ", "), F.lit(")"))
    return (
        F.when(polygons.isNull(), F.lit(None))
        .when(F.size(polygons) == 0, "MULTIPOLYGON EMPTY")
        .when(F.size(polygons) == 1, to_wkt(polygons[0]))
        .otherwise(many)
    )


_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
#: A place, of which the first two numbers count: a height and a measure are left out.
_PLACE = rf"({_NUMBER})\s+({_NUMBER})(?:\s+{_NUMBER}){{0,2}}"


def polygons_from_wkt(text: Column) -> Column:
    """The polygons of a ``POLYGON``'s or ``MULTIPOLYGON``'s text; other text is an error, null stays null.

    Brackets and places become those of nested lists, which a parser of nested lists reads, so that
    levels are told by their depth. ``EMPTY`` is no polygon.
    """
    shape = F.regexp_extract(text, r"(?s)^\s*(?i:(MULTIPOLYGON|POLYGON))(?i:\s*(?:ZM|Z|M))?\s*((?i:EMPTY)|\(.*\))\s*$", 1)
    body = F.regexp_extract(text, r"(?s)^\s*(?i:MULTIPOLYGON|POLYGON)(?i:\s*(?:ZM|Z|M))?\s*((?i:EMPTY)|\(.*\))\s*$", 1)
    many = F.upper(shape) == "MULTIPOLYGON"
    nested = F.translate(F.regexp_replace(body, _PLACE, '["$1","$2"]'), "()", "[]")
    nested = F.when(many, nested).otherwise(F.concat(F.lit("["), nested, F.lit("]")))
    parsed = F.from_json(nested, "array<array<array<array<string>>>>", {"mode": "FAILFAST"})
    polygons = F.transform(
        parsed,
        lambda rings: F.transform(
            rings, lambda r: F.transform(r, lambda p: point(p[0].cast("double"), p[1].cast("double")))
        ),
    )
    wrong = F.raise_error(F.concat(F.lit("not a polygon's text: "), F.substring(text, 1, 60)))
    return (
        F.when(text.isNull(), F.lit(None))
        .when(shape == "", wrong)
        .when(F.upper(body) == "EMPTY", F.array().cast("array<array<array<struct<x:double,y:double>>>>"))
        .otherwise(polygons)
    )


def from_wkt(text: Column) -> Column:
    """The rings of the text of one polygon; that of several is an error."""
    several = F.raise_error(F.concat(F.lit("several polygons: "), F.substring(text, 1, 60)))
    return _bound(polygons_from_wkt(text))(lambda p: F.when(F.size(p) > 1, several).otherwise(F.get(p, F.lit(0))))


def contains(rings: Column, x: Column, y: Column) -> Column:
    """Even-odd ray casting: a point on an edge is inside on its west and south sides only."""

    def crossings(ring):
        n = F.size(ring)
        return F.aggregate(
            F.zip_with(
                F.slice(ring, F.lit(1), n - 1),
                F.slice(ring, F.lit(2), n - 1),
                lambda a, b: F.when(
                    ((a["y"] > y) != (b["y"] > y))
                    & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]),
                    1,
                ).otherwise(0),
            ),
            F.lit(0),
            lambda s, c: s + c,
        )

    total = F.aggregate(F.transform(rings, crossings), F.lit(0), lambda s, c: s + c)
    return total % 2 == 1


def edge_meets_box(a: Column, b: Column, box: Column) -> Column:
    """Whether the edge from a to b touches the box, by clipping its parameter range."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]

    def clipped(d, start, low, high):
        near = F.when(d > 0, (low - start) / d).when(d < 0, (high - start) / d).otherwise(0.0)
        far = F.when(d > 0, (high - start) / d).when(d < 0, (low - start) / d).otherwise(1.0)
        return near, far, (d != 0) | start.between(low, high)

    near_x, far_x, ok_x = clipped(dx, a["x"], box["west"], box["east"])
    near_y, far_y, ok_y = clipped(dy, a["y"], box["south"], box["north"])
    least, most = F.greatest(F.lit(0.0), near_x, near_y), F.least(F.lit(1.0), far_x, far_y)
    return ok_x & ok_y & (least <= most)


def box_meets(rings: Column, box: Column) -> Column:
    """Whether a polygon and a box share a point: an edge meets the box, or a corner is inside."""
    edges = F.exists(
        rings,
        lambda r: F.exists(
            F.zip_with(
                F.slice(r, F.lit(1), F.size(r) - 1), F.slice(r, F.lit(2), F.size(r) - 1),
                lambda a, b: edge_meets_box(a, b, box),
            ),
            lambda hit: hit,
        ),
    )
    return edges | contains(rings, box["west"], box["south"])
