"""Queries on rows that only larger tables have."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from agroloom.functions import geo
from agroloom.plans.queries import ORACLE_SQL, QUERIES
from agroloom.sources import readers

from .sqlcheck import connect, rows
from .test_shapes import polygons_table


def _same(spark, name: str, folder) -> None:
    found, wanted = QUERIES[name](spark, str(folder)).toPandas(), connect(str(folder)).execute(ORACLE_SQL[name]).df()
    assert rows(found) == rows(wanted)


def test_units_in_the_middle_of_a_border_and_of_a_millimetre(spark, tmp_path):
    # centroids on a tile's border; corners whose millimetre another rounding before changes; keys that repeat or lack
    keys = [1228, 2628, 5426, 7178, 9978, 3083, 5328, 2040, 3415, 3952, 1, 1, 1, None]
    spark.createDataFrame([(k,) for k in keys], "s_suppkey bigint").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(25).select(F.col("id").cast("int").alias("n_nationkey")).write.parquet(f"{tmp_path}/nation.parquet")
    _same(spark, "utm_enrich", tmp_path)


def test_the_middle_of_a_rectangle_is_exact(spark):
    draw = random.Random(5)
    boxes = []
    for _ in range(300):
        west, south = 16 + draw.random() * 12, 45 + draw.random() * 4
        boxes.append((west, south, west + 0.05 + draw.random() * 0.1, south + 0.05 + draw.random() * 0.1))
    df = spark.createDataFrame(boxes, "west double, south double, east double, north double")
    rings = geo.rectangle(*[F.col(c) for c in df.columns])
    got = df.select(*df.columns, geo.centroid(rings).alias("c"), geo.centroid_by_mercator(rings).alias("m")).collect()
    assert [r["c"]["x"] for r in got] == [r["m"]["x"] for r in got] == [(r["west"] + r["east"]) / 2 for r in got]
    assert [r["c"]["y"] for r in got] == [(r["south"] + r["north"]) / 2 for r in got]


def test_centroids_of_parts_far_apart_equal_those_of_plain_sums(spark):
    draw = random.Random(7)
    shapes = []
    for k in range(40):
        parts = []
        for _ in range(1 + k % 3):
            x, y, size = draw.uniform(-150, 150), draw.uniform(-60, 60), draw.uniform(0.5, 3)
            ring = [(x - size, y - size), (x + size, y - size / 2), (x + size / 2, y + size), (x - size, y + size)]
            hole = [(x - 0.2, y - 0.2), (x, y + 0.1), (x + 0.2, y - 0.1)]
            ring, hole = (r[:: draw.choice((1, -1))] for r in (ring, hole))
            parts.append([[*ring, ring[0]], [*hole, hole[0]]])
        shapes.append((k, parts))

    def plain(parts):
        area = mx = my = 0.0
        for rings in parts:
            for i, ring in enumerate(rings):
                x0, y0 = ring[0]
                pairs = [(ax - x0, ay - y0, bx - x0, by - y0) for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False)]
                crosses = [ax * by - bx * ay for ax, ay, bx, by in pairs]
                way = (1 if i == 0 else -1) * (1 if sum(crosses) > 0 else -1)
                area += way * sum(crosses)
                mx += way * sum(c * (ax + bx + 3 * x0) for c, (ax, _, bx, _) in zip(crosses, pairs, strict=True))
                my += way * sum(c * (ay + by + 3 * y0) for c, (_, ay, _, by) in zip(crosses, pairs, strict=True))
        return mx / (3 * area), my / (3 * area)

    got = {r["id"]: r["c"] for r in polygons_table(spark, shapes).select("id", geo.centroid_of(F.col("polygons")).alias("c")).collect()}
    for k, parts in shapes:
        x, y = plain(parts)
        assert abs(got[k]["x"] - x) < 1e-9 and abs(got[k]["y"] - y) < 1e-9


def test_a_long_list_of_ids_is_read_by_many_tasks(spark, tmp_path):
    lines = spark.range(40_000).select(
        (F.col("id") % 20_000 * 7).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit("2024-05-01").cast("date").alias("l_shipdate")
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    _same(spark, "json_list_roundtrip", tmp_path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "10k")
        got = QUERIES["json_list_roundtrip"](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)
    assert sum(r["count"] for r in got) == 20_000 and len(got) > 5


@pytest.mark.parametrize(
    ("text", "kind", "ids"),
    [
        ("[1, 2, 3]", "bigint", [1, 2, 3]),
        ("[\r\n  1,\r\n  2\r\n]", "bigint", [1, 2]),
        ("[\n1\n,null\n]\n", "bigint", [1, None]),
        ("[ ]", "bigint", []),
        ('["a]"\n,"[b\\n", ",c,"\n]', "string", ["a]", "[b\n", ",c,"]),
        ("[1.5]", "bigint", None),
        ('[1\n,"2"]', "bigint", None),
        ("[1],[2]", "bigint", None),
        ("[1 2]", "bigint", None),
        ('{"a":1}', "bigint", None),
    ],
)
def test_lists_of_ids_in_any_lines(spark, tmp_path, text, kind, ids):
    (tmp_path / "ids.json").write_bytes(text.encode())
    found = readers.scan_id_list(spark, f"{tmp_path}/ids.json", kind)
    if ids is None:
        with pytest.raises(Exception, match="(?i)malformed"):
            found.collect()
    else:
        assert [r["id"] for r in found.collect()] == ids
