"""Polygons of several parts, vector files, covers of cells, borders and nearest points."""

from __future__ import annotations

import json
import math
import random
import struct

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from agroloom.functions import geo
from agroloom.operators import classes, cover, spatial, tables
from agroloom.sources import geojson, readers, wkb, writers

ERRORS = (PySparkException, Py4JJavaError)
RINGS = "array<array<struct<x:double,y:double>>>"
SQUARE = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]
HOLED = [*SQUARE, [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]
AWAY = [[(10.0, 0.0), (12.0, 0.0), (12.0, 2.0), (10.0, 2.0), (10.0, 0.0)]]


def shaped(rings):
    return None if rings is None else [[{"x": x, "y": y} for x, y in r] for r in rings]


def plain(polygons):
    return None if polygons is None else [[[(p["x"], p["y"]) for p in r] for r in rings] for rings in polygons]


def polygons_table(spark, rows):
    rows = [(i, None if ps is None else [shaped(p) for p in ps]) for i, ps in rows]
    return spark.createDataFrame(rows, f"id int, polygons array<{RINGS}>")


CASES = [(1, [SQUARE]), (2, [HOLED, AWAY]), (3, None), (4, []), (5, [AWAY, HOLED, SQUARE])]


def test_centroids_weigh_parts_by_area(spark):
    rows = polygons_table(spark, CASES).select("id", geo.centroid_of(F.col("polygons")).alias("c"))
    got = {r["id"]: r["c"] and tuple(r["c"]) for r in rows.collect()}
    areas = {"s": (16.0, 2.0, 2.0), "a": (4.0, 11.0, 1.0), "t": (-0.5, 5 / 3, 4 / 3)}

    def mean(names):
        total = sum(areas[n][0] for n in names)
        return tuple(sum(areas[n][0] * areas[n][k] for n in names) / total for k in (1, 2))

    assert got[1] == pytest.approx(mean("s")) and got[2] == pytest.approx(mean("sta")) and got[5] == pytest.approx(mean("ssta"))
    assert got[3] is None and got[4] is None


def test_text_of_parts_is_read_and_written(spark):
    rows = polygons_table(spark, CASES)
    back = rows.select("id", "polygons", geo.polygons_to_wkt(F.col("polygons")).alias("t"))
    back = back.select("id", "polygons", "t", geo.polygons_from_wkt(F.col("t")).alias("p"))
    for r in back.collect():
        assert plain(r["p"]) == plain(r["polygons"])
    texts = {r["id"]: r["t"] for r in back.collect()}
    assert texts[1].startswith("POLYGON ((0 0, ") and texts[2].startswith("MULTIPOLYGON (((0 0, ") and texts[4] == "MULTIPOLYGON EMPTY"
    odd = ["multipolygon(((0 0,1 0,1 1,0 0)),\n((5 5 9, 6.5 5 9, -6e-1 .5 9, 5 5 9)))", "POLYGON Z ((0 0 1, 1 0 1, 1 1 1, 0 0 1))", "Polygon Empty", None]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    got = [plain(r[0]) for r in df.select(geo.polygons_from_wkt(F.col("t"))).collect()]
    triangle = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    assert got == [[[triangle], [[(5.0, 5.0), (6.5, 5.0), (-0.6, 0.5), (5.0, 5.0)]]], [[triangle]], [], None]
    for bad in ("POINT (1 2)", "POLYGON ((1 2, 3", "", "POLYGON ((1 2, x 3))"):
        with pytest.raises(ERRORS):
            spark.createDataFrame([(bad,)], "t string").select(geo.polygons_from_wkt(F.col("t"))).collect()
    with pytest.raises(ERRORS):
        spark.createDataFrame([(odd[0],)], "t string").select(geo.from_wkt(F.col("t"))).collect()


def test_binary_geometries(spark):
    rows = polygons_table(spark, CASES * 3)
    both = rows.select("polygons", wkb.from_wkb(wkb.to_wkb(F.col("polygons"))).alias("p"))
    for r in both.collect():
        assert plain(r["p"]) == plain(r["polygons"])
    places = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]

    def polygon(order, kind, width, code=b""):
        out = struct.pack(f"{order}BI", order == "<", kind) + code + struct.pack(f"{order}II", 1, len(places))
        return out + b"".join(struct.pack(f"{order}{width}d", *p, *[7.0] * (width - 2)) for p in places)

    kinds = [polygon(">", 3, 2), polygon("<", 1003, 3), polygon(">", 3003, 4), polygon("<", 0x80000003, 3), polygon("<", 0x20000003, 2, b"\xe6\x10\0\0"), None]
    got = wkb.decoded(pa.array(kinds, pa.binary())).to_pylist()
    assert [plain(g) for g in got] == [[[places]]] * 5 + [None]
    assert wkb.decoded(pa.array(kinds, pa.binary()).slice(4, 2)).to_pylist() == got[4:]
    with pytest.raises(ValueError):
        wkb.decoded(pa.array([struct.pack("<BIdd", 1, 1, 0, 0)], pa.binary()))


def feature(i, kind="Polygon", **more):
    coordinates = {"Polygon": SQUARE, "MultiPolygon": [HOLED, AWAY], "Point": [1.0, 2.0]}[kind]
    geometry = {"type": kind, "coordinates": coordinates}
    return {"type": "Feature", "properties": {"name": f"n{i}", "note": 'a "quoted" } { brace \\', **more}, "geometry": geometry}


def collection(features):
    crs = {"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}
    return {"type": "FeatureCollection", "name": "x", "crs": crs, "features": features}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split", [None, 700])
def test_collections_are_split_into_features(spark, tmp_path, indent, split):
    features = [feature(i, ("Polygon", "MultiPolygon")[i % 2], pad="{" * (i * 37 % 900)) for i in range(60)]
    features.append({"type": "Feature", "properties": {"name": "none"}, "geometry": None})
    path = tmp_path / "c.geojson"
    path.write_text(json.dumps(collection(features), indent=indent))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = readers.scan_features(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["properties"]["name"] for r in got) == sorted([f"n{i}" for i in range(60)] + ["none"])
    by_name = {r["properties"]["name"]: r for r in got}
    assert plain(by_name["n0"]["polygons"]) == [SQUARE] and plain([by_name["n1"]["rings"]]) == [HOLED]
    assert plain(by_name["n1"]["polygons"]) == [HOLED, AWAY] and by_name["none"]["polygons"] is None
    assert by_name["n7"]["properties"]["pad"] == "{" * 259 and by_name["n0"]["kind"] == "Polygon"


def test_lines_and_files_without_features(spark, tmp_path):
    def read(text):
        path = tmp_path / f"{abs(hash(text))}.geojson"
        path.write_text(text)
        return readers.read_geojson(spark, str(path)).collect()

    lines = "\n".join(json.dumps(feature(i)) for i in range(3)) + "\n\n"
    assert len(read(lines)) == 3
    for none in ("", "[]", json.dumps(collection([]))):
        with pytest.raises(ValueError):
            read(none)
    with pytest.raises(ValueError):
        read(json.dumps(collection([feature(1), feature(2)]))[:-40])
    for wrong in (json.dumps(collection([feature(1, "Point")])), json.dumps(feature(1)["geometry"]), lines + "{}"):
        with pytest.raises(ERRORS):
            read(wrong)


def test_features_are_written_and_read(spark, tmp_path):
    rows = polygons_table(spark, CASES).where("id <> 4")
    writers.write_geojson(rows, f"{tmp_path}/f.geojson", "polygons", ["id"])
    got = {int(r["properties"]["id"]): plain(r["polygons"]) for r in readers.scan_features(spark, f"{tmp_path}/f.geojson").collect()}
    assert got == {i: ps for i, ps in CASES if i != 4}


def test_footers_state_the_code(spark, tmp_path):
    geometry = wkb.encoded(pa.array([[shaped(SQUARE)]], pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))))
    names = {"own": "shape", "code": 32635}
    crs = {"id": {"authority": "EPSG", "code": names["code"]}}
    for k, (column, wanted) in enumerate((({"crs": crs}, 32635), ({}, 4326), ({"crs": None}, None), (None, None))):
        path = tmp_path / f"{k}.parquet"
        table = pa.table({"id": [1], "shape" if column is not None else "geometry": geometry})
        if column is not None:
            meta = {"version": "1.1.0", "primary_column": "shape", "columns": {"shape": {"encoding": "WKB", **column}}}
            table = table.replace_schema_metadata({"geo": json.dumps(meta)})
        pq.write_table(table, path)
        if wanted is None:
            with pytest.raises(ValueError):
                readers.scan_features(spark, str(path))
            assert readers.scan_features(spark, str(path), 3035).first()["epsg"] == 3035
        else:
            row = readers.scan_features(spark, str(path)).first()
            assert row["epsg"] == wanted and plain(row["polygons"]) == [SQUARE]


def star(n, x=0.0, y=0.0, size=1.0, seed=1):
    """A ring of n edges that no ray crosses alike."""
    rng = random.Random(seed)
    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    ring = [(x + size * r * math.cos(t), y + size * r * math.sin(t)) for t in turns for r in [rng.uniform(0.3, 1)]]
    return [*ring, ring[0]]


def inside(rings, xs, ys):
    hit = np.zeros(len(xs), int)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            if ay != by:
                hit += ((ay > ys) != (by > ys)) & (xs < (bx - ax) * (ys - ay) / (by - ay) + ax)
    return hit % 2 == 1


@pytest.mark.parametrize("cap", [4, 40, 512])
def test_cells_decide_as_all_edges_do(cap):
    rng = np.random.default_rng(2)
    hole = star(40, 0.1, 0.0, 0.2, 5)
    for rings in (SQUARE, HOLED, [star(7)], [star(900), hole], [star(300, 25.0, -47.0, 1e-3)], [star(60, 4e5, 5e6, 3e4)]):
        edges = np.array([(*a, *b) for r in rings for a, b in zip(r, r[1:], strict=False)])
        cells = cover.cover(edges, cap)
        assert len(cells) <= cap
        low, high = edges[:, :2].min(0), edges[:, :2].max(0)
        xs, ys = (rng.uniform(low[k] - 0.1 * (high[k] - low[k]), high[k] + 0.1 * (high[k] - low[k]), 2000) for k in (0, 1))
        xs, ys = np.concatenate((xs, edges[:, 0])), np.concatenate((ys, edges[:, 1]))
        got = np.zeros(len(xs), int)
        for c in cells:
            size = cover.side(c.level)
            own = (np.floor(xs / size) == c.cx) & (np.floor(ys / size) == c.cy)
            crossed = int(c.odd) + (c.turns[None, :] <= ys[own, None]).sum(1)
            for ax, ay, bx, by in c.edges:
                if ay != by:
                    crossed += ((ay > ys[own]) != (by > ys[own])) & (xs[own] < (bx - ax) * (ys[own] - ay) / (by - ay) + ax)
            got[own] += crossed % 2
        assert got.max() <= 1  # cells don't overlap
        assert (got.astype(bool) == inside(rings, xs, ys)).all()


def test_points_in_a_country_and_in_fields(spark):
    rng = random.Random(4)
    country = [star(3000, 27.0, 46.0, 3.0)]
    fields = [(f"f{k:03d}", [star(5, 24 + rng.random() * 6, 43 + rng.random() * 6, 0.05, k)]) for k in range(150)]
    rows = [("zz", shaped(country)), *[(n, shaped(r)) for n, r in fields], (None, shaped(SQUARE)), ("none", None), ("flat", [[]])]
    polygons = spark.createDataFrame(rows, f"name string, rings {RINGS}")
    places = [(k, 24 + rng.random() * 6, 43 + rng.random() * 6) for k in range(3000)] + [(3000, None, 45.0)]
    points = spark.createDataFrame(places, "point_id int, lon double, lat double")
    xs, ys = np.array([p[1] for p in places[:-1]]), np.array([p[2] for p in places[:-1]])
    wanted = dict.fromkeys(range(3001))
    for name, rings in sorted([("zz", country), *fields], reverse=True):
        for k in np.flatnonzero(inside(rings, xs, ys)):
            wanted[int(k)] = name
    got = {r["point_id"]: r["name"] for r in spatial.point_in_polygon(points, polygons, "name").collect()}
    assert got == wanted and len(set(got.values())) > 10
    cells = cover.covers(polygons, "name").groupBy("name").count().agg(F.max("count")).first()[0]
    assert 16 < cells <= cover.CAP
    several = spark.createDataFrame([("m", [shaped(SQUARE), shaped(AWAY)])], f"name string, polygons array<{RINGS}>")
    two = spark.createDataFrame([(1, 11.0, 1.0), (2, 3.0, 3.0), (3, 7.0, 1.0)], "point_id int, lon double, lat double")
    assert {r["point_id"]: r["name"] for r in spatial.point_in_polygon(two, several, "name").collect()} == {1: "m", 2: "m", 3: None}
    assert spatial.point_in_polygon(two, several.where("false"), "name").where("name is null").count() == 3


def test_tiles_against_a_long_border(spark):
    ring = star(100_000, 10.0, 10.0, 9.0)
    borders = spark.createDataFrame([("a", shaped([ring])), ("b", shaped([[(30.2, 0.1), (30.4, 0.1), (30.4, 0.3), (30.2, 0.1)]]))], f"name string, rings {RINGS}")
    box = spark.createDataFrame([(0.0, 0.0, 31.0, 21.0)], "west double, south double, east double, north double")
    tiles = spatial.tile_cover(box, 0.5)
    kept = spatial.tiles_meeting(tiles, borders, 0.5)
    assert "rings" not in kept.columns and kept.columns == tiles.columns
    edges = np.array([(*a, *b) for a, b in zip(ring, ring[1:], strict=False)])
    wanted, rows = set(), tiles.collect()
    corners = inside([ring], np.array([r["west"] for r in rows]), np.array([r["south"] for r in rows]))
    for r, corner in zip(rows, corners, strict=True):
        ax, ay, bx, by = edges.T
        ok = np.ones(len(edges), bool)
        low, high = np.zeros(len(edges)), np.ones(len(edges))
        with np.errstate(divide="ignore", invalid="ignore"):
            for d, s, a, b in ((bx - ax, ax, r["west"], r["east"]), (by - ay, ay, r["south"], r["north"])):
                near, far = np.where(d > 0, (a - s) / d, (b - s) / d), np.where(d > 0, (b - s) / d, (a - s) / d)
                low, high = np.maximum(low, np.where(d == 0, 0, near)), np.minimum(high, np.where(d == 0, 1, far))
                ok &= (d != 0) | ((s >= a) & (s <= b))
        if (ok & (low <= high)).any() or corner:
            wanted.add((r["x"], r["y"]))
    wanted.add((60, 0))
    assert {(r["x"], r["y"]) for r in kept.collect()} == wanted and 500 < len(wanted) < tiles.count()


def test_a_country_of_several_rows_is_one_grid(spark):
    one = [(27.0, 46.0), (27.5, 46.0), (27.5, 46.5), (27.0, 46.0)]
    two = [(x + 1, y) for x, y in one]
    rows = [("x", [shaped([one])]), ("x", [shaped([two])]), ("y", [shaped([one])])]
    borders = spark.createDataFrame(rows, f"name string, polygons array<{RINGS}>")
    names = [r["tile_name"] for r in spatial.country_grid_job(borders, "x", 32635, 20_000.0, "T").collect()]
    assert len(names) == len(set(names)) > 6


def test_the_nearest_is_found_however_far(spark):
    rng = random.Random(6)
    crowd = [(k, 5 + rng.random() * 1e-4, 5 + rng.random() * 1e-4) for k in range(400)]
    spread = [(1000 + k, rng.random() * 10, rng.random() * 10) for k in range(300)]
    ties = [(2000, 50.0, 51.0), (2001, 50.0, 49.0), (2002, 49.0, 50.0), (1999, 51.0, 50.0), (2003, 51.0, 50.0)]
    known = crowd + spread + ties
    table = spark.createDataFrame([(k, x, y, f"a{k}") for k, x, y in [*known, (9, None, 1.0)]], "known_id int, lon double, lat double, kind string")
    places = [(k, rng.random() * 10, rng.random() * 10) for k in range(500)]
    places += [(600 + k, 5 + rng.random() * 2e-4, 5 + rng.random() * 2e-4) for k in range(100)]
    places += [(800, 50.0, 50.0), (801, -500.0, 900.0), (802, 1e4, 5.0), (803, None, 5.0), (804, 5.0, 5.0)]
    points = spark.createDataFrame(places, "point_id int, lon double, lat double")
    wanted = {}
    for p, x, y in places:
        wanted[p] = None if x is None else min(((x - kx) * (x - kx) + (y - ky) * (y - ky), k) for k, kx, ky in known)[1]
    got = {r["point_id"]: r for r in spatial.nearest(points, table, ["kind"]).collect()}
    assert {p: r["known_id"] for p, r in got.items()} == wanted
    assert all(r["kind"] == (None if r["known_id"] is None else f"a{r['known_id']}") for r in got.values())
    near = {r["point_id"]: r["known_id"] for r in spatial.nearest(points, table, [], 1.0).collect()}
    assert near[801] is None and near[800] == 1999
    none = spatial.nearest(points, table.where("false"), ["kind"])
    assert none.where("known_id is null and kind is null").count() == len(places)


def test_units_of_several_parts_are_enriched_and_counted(spark, tmp_path):
    tile = shaped([[(26.0, 45.0), (28.0, 45.0), (28.0, 47.0), (26.0, 47.0), (26.0, 45.0)]])
    tiles = spark.createDataFrame([("35TPN", tile), ("??", shaped([[(40.0, 45.0), (41.0, 45.0), (41.0, 46.0), (40.0, 45.0)]]))], f"tile string, rings {RINGS}")
    small = [[(26.5, 45.5), (26.6, 45.5), (26.6, 45.6), (26.5, 45.5)]]
    other = [[(x + 0.5, y) for x, y in small[0]]]
    odd = [[(40.5, 45.1), (40.6, 45.1), (40.6, 45.2), (40.5, 45.1)]]
    units = polygons_table(spark, [(1, [small]), (2, [small, other]), (3, None), (4, [[[(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]]), (5, [odd])])
    rows, lost = spatial.enrich_job(units, tiles, "id", f"{tmp_path}/units")
    assert lost == {"rows": 5, "without_shape": 1, "without_tile": 2, "without_code": 3}
    got = {r["id"]: r for r in rows.collect()}
    assert got[1]["geometry_utm_wkt"].startswith("POLYGON ((") and got[2]["geometry_utm_wkt"].startswith("MULTIPOLYGON (((")
    assert got[2]["tile"] == "35TPN" and got[4]["tile"] is None and got[5]["geometry_utm_wkt"] is None


def test_what_is_lost_is_counted_on_the_way(spark, tmp_path):
    df = spark.createDataFrame([(k, "abc"[k % 3]) for k in range(30)] + [(99, None)], "id int, cls string")
    mapping = spark.createDataFrame([("a",), ("b",), ("b",)], "m string")
    rows, seen = classes.drop_unmapped_counted(df, mapping, "cls", "m")
    rows.write.parquet(f"{tmp_path}/kept")
    assert seen.get == {"rows": 31, "unmapped": 11}
    kept = spark.read.parquet(f"{tmp_path}/kept")
    assert sorted(kept.collect()) == sorted(classes.drop_unmapped(df, mapping, "cls", "m").collect()) and kept.columns == df.columns
    codes = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z"), ("4", "gone")], "code string, label string")
    facts = spark.createDataFrame([("1", "one")], "code string, cls string")
    legend = spark.createDataFrame([("2", "two")], "code string, name string")
    overrides = spark.createDataFrame([], "label string, cls string")
    excluded = spark.createDataFrame([("gone",)], "label string")
    found, seen = classes.resolve_landcover_counted(codes, facts, legend, overrides, excluded)
    assert len(found.collect()) == 3
    assert seen.get == {"rows": 3, "review": 2, "without_class": 1}


def test_places_are_dense_and_a_common_key_is_spread(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 < 8, 7).otherwise(F.col("id") % 50).alias("k"))
    rows = tables.with_position(df, [F.col("k")], "id")
    got = rows.orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(20_000)) and [r["k"] for r in got] == sorted(r["k"] for r in got)
    again = {r["id"]: r["position"] for r in tables.with_position(df.repartition(7), [F.col("k")], "id").collect()}
    assert again == {r["id"]: r["position"] for r in got}
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 2 * 20_000 / 4
    assert tables.with_position(df.where("false"), [F.col("k")], "id").count() == 0


def test_a_list_of_ids_is_written_in_lines(spark, tmp_path):
    df = spark.createDataFrame([(k % 500,) for k in range(2000)] + [(None,)], "k bigint")
    writers.write_id_list(df, "k", f"{tmp_path}/ids.json")
    (file,) = tmp_path.glob("ids.json/*.txt")
    assert json.loads(file.read_text()) == list(range(500)) and len(file.read_text().splitlines()) == 502
    writers.write_id_list(df.select(F.concat(F.lit('a"'), "k").alias("k")), "k", f"{tmp_path}/texts.json")
    (file,) = tmp_path.glob("texts.json/*.txt")
    assert sorted(json.loads(file.read_text())) == sorted(f'a"{k}' for k in range(500))
    writers.write_id_list(df.where("false"), "k", f"{tmp_path}/none.json")
    (file,) = tmp_path.glob("none.json/*.txt")
    assert json.loads(file.read_text()) == []


def test_pieces_begin_where_splits_do(spark, tmp_path):
    path = tmp_path / "c.geojson"
    path.write_text(json.dumps(collection([feature(i) for i in range(20)])))
    assert geojson.is_collection(spark, str(path))
    assert geojson.collection_features(spark, str(path)).count() == 21  # with the description of coordinates
