"""Writers, and reuse of tables that were written before."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_root
from .wkb import to_wkb


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_root(spark)}/{uuid4().hex}/{name}"


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write, with one folder for each value of ``partition_by``, and give the table as read back."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def wkb(rings: str) -> Column:
    """A column of polygons as well-known binary; null stays null."""
    return to_wkb(F.when(F.col(rings).isNotNull(), F.array(rings)))


def _write_list(items: DataFrame, head: str, tail: str, path: str) -> None:
    """Rows (k, value) as one file: the head, each value in order of ``k`` and behind a comma, the tail.

    One task writes the file, as one file has to be, and sorts what it writes on disk if need be.
    """
    ends = items.sparkSession.createDataFrame([(0, head), (2, tail)], "part int, value string")
    rows = items.withColumn("part", F.lit(1)).unionByName(ends, allowMissingColumns=True)
    rows = rows.coalesce(1).sortWithinPartitions("part", "k").withColumn("at", F.monotonically_increasing_id())
    comma = F.when((F.col("part") == 1) & (F.col("at") > 1), ",").otherwise("")
    rows.select(F.concat(comma, "value").alias("value")).write.mode("overwrite").text(path)


def write_id_list(df: DataFrame, key: str, path: str) -> None:
    """The distinct keys as one JSON list, sorted, in one file with a key a line."""
    keys = df.select(F.col(key).alias("k")).where("k is not null").distinct()
    text = F.regexp_extract(F.to_json(F.struct("k")), r"^\{\"k\":(.*)\}$", 1)
    _write_list(keys.withColumn("value", text), "[", "]", path)


def write_mapping_json(df: DataFrame, path: str) -> None:
    """Rows (scheme, code, cls) as one dictionary of dictionaries; for mappings, which are small."""
    codes = df.groupBy("scheme").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("code", "cls")))).alias("codes")
    )
    whole = codes.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("scheme", F.to_json("codes").alias("j"))))).alias("m"))
    text = F.concat(
        F.lit("{"),
        F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"])), ", "),
        F.lit("}"),
    )
    whole.select(text.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def geojson_features(df: DataFrame, shape: str, properties: list[str]) -> DataFrame:
    """Rows (value): a GeoJSON feature for each row; ``shape`` is a column of rings or of polygons.

    Several polygons make a multipolygon; a null shape is a feature without a geometry.
    """

    def places(rings: Column) -> Column:
        return F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))

    column = F.col(shape)
    if df.schema[shape].dataType.simpleString().startswith("array<array<array<"):
        single = F.size(column) == 1
        kind = F.when(single, "Polygon").otherwise("MultiPolygon")
        coordinates = F.when(single, F.to_json(places(column[0]))).otherwise(F.to_json(F.transform(column, places)))
    else:
        kind, coordinates = F.lit("Polygon"), F.to_json(places(column))
    geometry = F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coordinates, F.lit("}"))
    parts = [F.lit('{"type":"Feature","geometry":'), F.coalesce(geometry, F.lit("null"))]
    parts += [F.lit(',"properties":'), F.to_json(F.struct(*properties)), F.lit("}")]
    return df.select(F.concat(*parts).alias("value"))


def write_geojson(df: DataFrame, path: str, shape: str, properties: list[str]) -> None:
    geojson_features(df, shape, properties).write.mode("overwrite").text(path)


def write_geojson_collection(df: DataFrame, path: str, shape: str, properties: list[str]) -> None:
    """The rows as one FeatureCollection in one file, with a feature a line, in no particular order."""
    features = geojson_features(df, shape, properties).withColumn("k", F.lit(0))
    _write_list(features, '{"type":"FeatureCollection","features":[', "]}", path)


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and what counts them (``rows``) and those that meet each condition as they pass.

    The counts are there (``.get``) once something has read the rows to their end; nothing is read twice.
    """
    seen = Observation()
    sums = [F.coalesce(F.count_if(c), F.lit(0)).alias(name) for name, c in counts.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums), seen


def write_counted(df: DataFrame, path: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """The table as written and read back, and the counts of :func:`observed` from that pass."""
    rows, seen = observed(df, **counts)
    return write_parquet(rows, path), seen.get


_MARKER = "published.json"


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _published(spark: SparkSession, folder: str) -> dict:
    """What the marker of a folder says: the fingerprint, and each table's own folder and rows; {} without one."""
    files, at = _hadoop(spark, f"{folder}/{_MARKER}")
    if not files.exists(at):
        return {}
    return json.loads("".join(r["value"] for r in spark.read.text(f"{folder}/{_MARKER}", wholetext=True).collect()))


def _publish(spark: SparkSession, folder: str, content: dict) -> None:
    """Put the marker in place by one renaming, so that readers see the old one, none or the whole new one."""
    files, side = _hadoop(spark, f"{folder}/{_MARKER}.{uuid4().hex}")
    out = files.create(side, True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    _, marker = _hadoop(spark, f"{folder}/{_MARKER}")
    if files.exists(marker):
        files.delete(marker, False)
    if not files.rename(side, marker):
        raise OSError(f"can't publish {marker}")


def load_or_compute(
    spark: SparkSession, folder: str, compute: Callable[[], dict[str, DataFrame]], fingerprint: str = ""
) -> dict[str, DataFrame]:
    """The tables last published in ``folder`` with this fingerprint, else computed, written and published.

    ``fingerprint`` says what the tables depend on, such as a hash of paths and parameters; tables of
    another one are computed again. Each table is written to a new folder beside those that are read,
    with its rows counted as they are written; one marker, renamed into place after the last table,
    names them. So a job that ends halfway leaves nothing that counts as saved, and a table whose
    files were lost since (fewer rows than were written, or none to be read) is computed again.
    """
    saved = _published(spark, folder)
    if saved.get("fingerprint") == fingerprint:
        tables = {name: _saved(spark, f"{folder}/{t['folder']}", t) for name, t in saved["tables"].items()}
        if all(tables[name] is not None for name in saved["tables"]):
            return tables
    names, tables = {}, {}
    for name, df in compute().items():
        own = f"{name}-{uuid4().hex}"
        tables[name], counts = write_counted(df, f"{folder}/{own}")
        names[name] = {"folder": own, "rows": counts["rows"], "schema": df.schema.jsonValue()}
    _publish(spark, folder, {"fingerprint": fingerprint, "tables": names})
    return tables


def _saved(spark: SparkSession, path: str, entry: dict) -> DataFrame | None:
    """A table if it was finished and still has its rows, which Spark counts from the files' footers."""
    files, at = _hadoop(spark, f"{path}/_SUCCESS")
    if not files.exists(at):
        return None
    table = spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(path)
    return table if table.count() == entry["rows"] else None


def fingerprint_of(*parts: object) -> str:
    """A fingerprint of parameters, paths and schemas: equal for equal values, whatever the session."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()
