"""GeoJSON: features of a collection of any size, split on the executors by the depth of its brackets.

A collection is one JSON value, often one line of gigabytes. Spark reads it in pieces between opening
braces, so that its splits go to many tasks. A first pass sums up each split: by how many braces it
rises or falls, how low it gets, and whether it ends inside a string, for a beginning inside one
and outside. From these few numbers a split, the driver knows the state in which each begins; the
second pass then cuts out the objects of the second level, which are the features. One that crosses
splits is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MARK = re.compile(r'\\.|["}]', re.S)
#: Depth within an object of a collection's first level: its features and the description of coordinates.
_INSIDE = 2
_FEATURE = "struct<type:string,geometry:struct<type:string,coordinates:string>,properties:map<string,string>>"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path, lineSep="{")
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _splits(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[tuple[bool, str]]]]:
    """Each split's pieces in order, with whether a brace stands before each."""
    rows = ((p, s, v) for b in batches for p, s, v in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, own in groupby(rows, key=lambda r: r[:2]):
        yield key, ((bool(k or key[1]), value) for k, (_, _, value) in enumerate(own))


def _step(before: bool, value: str, depth: int, quoted: bool) -> Iterator[tuple[int, int, bool]]:
    """(end, depth, quoted) after the piece's opening brace (end -1), each closing one, and the whole piece."""
    depth += before and not quoted
    yield -1, depth, quoted
    for mark in _MARK.finditer(value):
        if mark[0] == '"':
            quoted = not quoted
        elif mark[0] == "}" and not quoted:
            depth -= 1
            yield mark.end(), depth, quoted
    yield len(value), depth, quoted


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (path, start), pieces in _splits(batches):
        states = {False: (0, 0, False), True: (0, 0, True)}  # depth, the lowest one, inside a string
        for before, value in pieces:
            for began, (depth, lowest, quoted) in states.items():
                for _, depth, quoted in _step(before, value, depth, quoted):  # noqa: B020, PLW2901  the last one stays
                    lowest = min(lowest, depth)  # noqa: PLW2901
                states[began] = depth, lowest, quoted
        columns = zip(*((path, start, began, *state) for began, state in states.items()), strict=True)
        yield pa.RecordBatch.from_pydict(dict(zip(("path", "start", "began", "depth", "lowest", "quoted"), columns, strict=True)))


def _beginnings(pieces: DataFrame) -> dict[tuple[str, int], tuple[int, bool, int]]:
    """For each split the depth that it begins at, whether in a string, and the split in which its first feature began."""
    sums = pieces.mapInArrow(_summed, "path string, start bigint, began boolean, depth bigint, lowest bigint, quoted boolean")
    found = {(r["path"], r["start"], r["began"]): r for r in sums.collect()}  # two short rows a split
    out: dict[tuple[str, int], tuple[int, bool, int]] = {}
    for path, splits in groupby(sorted({k[:2] for k in found}), key=lambda k: k[0]):
        depth, quoted, owner = 0, False, 0
        for _, start in splits:
            out[path, start] = (depth, quoted, owner)
            row = found[path, start, quoted]
            if depth < _INSIDE or depth + row["lowest"] < _INSIDE:
                owner = start
            depth, quoted = depth + row["depth"], row["quoted"]
        if depth or quoted:
            raise ValueError(f"{path} ends within an object")
    return out


def collection_features(spark: SparkSession, path: str) -> DataFrame:
    """Rows (feature): the text of each object on the first level of the collections in a file or folder."""
    pieces = _pieces(spark, path)
    beginnings = spark.sparkContext.broadcast(_beginnings(pieces))

    def cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, int | None, int, str]]:
            for (path, start), own in _splits(batches):
                depth, quoted, owner = beginnings.value[path, start]
                parts: list[str] = []
                for before, value in own:
                    at = 0
                    for end, now, quoted in _step(before, value, depth, quoted):  # noqa: B020
                        if end < 0:
                            if before and now >= _INSIDE:
                                if depth < _INSIDE:
                                    parts, owner = [], start
                                parts.append("{")
                            depth = now
                            continue
                        if now < _INSIDE <= depth:
                            yield path, None if owner == start else owner, start, "".join([*parts, value[at:end]])
                            parts, owner = [], start
                        elif now >= _INSIDE:
                            parts.append(value[at:end])
                        at, depth = end, now
                if depth >= _INSIDE:
                    yield path, owner, start, "".join(parts)

        found: list[tuple] = []
        size = 0
        for row in rows():
            found.append(row)
            size += len(row[3])
            if size > 4_000_000:
                yield pa.RecordBatch.from_pydict(dict(zip(("path", "owner", "start", "text"), zip(*found, strict=True), strict=True)), _CUT)
                found, size = [], 0
        if found:
            yield pa.RecordBatch.from_pydict(dict(zip(("path", "owner", "start", "text"), zip(*found, strict=True), strict=True)), _CUT)

    out = pieces.mapInArrow(cut_out, "path string, owner bigint, start bigint, text string")
    whole = out.where("owner is null").select(F.col("text").alias("feature"))
    parts = out.where("owner is not null").groupBy("path", "owner").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("p"))
    return whole.union(parts.select(F.array_join("p.text", "").alias("feature")))


_CUT = pa.schema([("path", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("text", pa.string())])


def is_collection(spark: SparkSession, path: str) -> bool:
    """Whether a file, or the first one of a folder, is a collection, by what stands before its second brace."""
    head = [r["value"] for r in spark.read.text(path, lineSep="{").limit(2).collect()]
    if len(head) < 2:
        raise ValueError(f"no feature in {path}")
    return bool(re.search(r'"FeatureCollection"|"features"\s*:', head[1]))


def polygons_of(feature: Column) -> Column:
    """The polygons of a parsed feature; null without a geometry, an error for another kind."""
    kind, coordinates = feature["geometry"]["type"], feature["geometry"]["coordinates"]

    def places(levels: str) -> Column:
        return F.from_json(coordinates, levels, {"mode": "FAILFAST"})

    one, many = F.array(places("array<array<array<double>>>")), places("array<array<array<array<double>>>>")
    polygons = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many)
    polygons = F.transform(
        polygons,
        lambda rings: F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))),
    )
    wrong = F.raise_error(F.concat(F.lit("not a polygon: "), F.coalesce(kind, F.lit("null"))))
    return F.when(feature["geometry"].isNull(), F.lit(None)).when(~kind.isin("Polygon", "MultiPolygon") | kind.isNull(), wrong).otherwise(polygons)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Rows (properties, kind, polygons, rings) of features of polygons and multipolygons.

    ``path`` is a collection, in one line or many, a folder of such files, or text with one feature a
    line. ``rings`` is the first polygon. A feature without a geometry has nulls. Another kind
    of geometry or of value is an error, as is a file without any feature.
    """
    collection = is_collection(spark, path)
    if collection:
        text = collection_features(spark, path)
    else:
        text = spark.read.text(path).select(F.col("value").alias("feature")).where(F.trim("feature") != "")
    rows = text.select(F.from_json("feature", _FEATURE).alias("f"), "feature")
    if collection:  # beside features there may be a description of the coordinates, and other members
        rows = rows.where(F.col("f.type") == "Feature")
    else:
        wrong = F.raise_error(F.concat(F.lit("not a feature: "), F.substring("feature", 1, 60)))
        rows = rows.select(F.when(F.col("f.type") == "Feature", F.col("f")).otherwise(wrong).alias("f"))
    polygons = polygons_of(F.col("f"))
    rows = rows.select(F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), polygons.alias("polygons"))
    if rows.isEmpty():
        raise ValueError(f"no feature in {path}")
    return rows.withColumn("rings", F.get("polygons", F.lit(0)))
