"""Readers: parquet, delimited text with bad rows, GeoJSON, nested JSON dictionaries, file lists."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import WGS84
from .geojson import read_geojson
from .wkb import from_wkb


def scan_parquet(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """Several parquet files as one table; only ``columns`` are read, if given."""
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def dataset_paths(catalog: DataFrame, country: str, frequency: str) -> list[str]:
    """The paths of a dataset in a catalog (country, frequency, path); each kind of miss is an error."""
    here = catalog.where(F.col("country") == country)
    if here.isEmpty():
        raise ValueError(f"unknown country {country!r}")
    here = here.where(F.col("frequency") == frequency)
    if here.isEmpty():
        raise ValueError(f"unknown frequency {frequency!r} for {country!r}")
    paths = [r["path"] for r in here.where(F.col("path").isNotNull()).orderBy("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no dataset for {country!r} at {frequency!r}")
    return paths


def mapping_name(names: DataFrame, country: str) -> str:
    """The name of a country's class mapping in a table (country, mapping); a miss is an error."""
    row = names.where(F.col("country") == country).select("mapping").first()
    if row is None:
        raise ValueError(f"no mapping for {country!r}")
    return row["mapping"]


def scan_csv_skip_bad(spark: SparkSession, path: str, columns: list[str], sep: str = ";") -> DataFrame:
    """Delimited text as strings; rows with too many fields are dropped, short rows filled with null."""
    extra = "__more"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, extra]])
    df = spark.read.csv(path, schema=schema, sep=sep, header=True, enforceSchema=True, mode="PERMISSIVE")
    return df.where(F.col(extra).isNull()).drop(extra)


def read_mapping_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows (scheme, code, cls) of a dictionary of dictionaries."""
    text = spark.read.text(path, wholetext=True)
    nested = F.from_json("value", "map<string,map<string,string>>")
    schemes = text.select(F.explode(nested).alias("scheme", "codes"))
    return schemes.select("scheme", F.explode("codes").alias("code", "cls"))


def read_colormap_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows (index, name, red, green, blue, alpha) of a colour map."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", "map<string,struct<name:string,color:array<int>>>")
    rows = text.select(F.explode(entries).alias("index", "entry"))
    channels = [F.get("entry.color", i).alias(c) for i, c in enumerate(("red", "green", "blue", "alpha"))]
    return rows.select(F.col("index").cast("int"), "entry.name", *channels)


def geo_metadata(spark: SparkSession, path: str) -> dict | None:
    """What the footer of a table's first file says of its geometries, under the key ``geo``; None if nothing."""
    first = min(spark.read.parquet(path).inputFiles(), default=None)
    if first is None:
        return None
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(first), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        text = reader.getFooter().getFileMetaData().getKeyValueMetaData().get("geo")
    finally:
        reader.close()
    return None if text is None else json.loads(text)


def _stated(geo: dict | None) -> tuple[str, int | None]:
    """The column of geometries, and the code of its coordinates where the footer states one.

    Without a word on coordinates they are longitude and latitude; an explicit null leaves them open.
    """
    if geo is None:
        return "geometry", None
    column = geo.get("primary_column", "geometry")
    crs = geo.get("columns", {}).get(column, {}).get("crs", {"id": {"authority": "OGC", "code": "CRS84"}})
    own = (crs or {}).get("id", {})
    if own.get("authority") == "OGC" and own.get("code") == "CRS84":
        return column, WGS84
    return column, int(own["code"]) if own.get("authority") == "EPSG" else None


def scan_features(spark: SparkSession, path: str, epsg: int | None = None) -> DataFrame:
    """A vector file by its extension.

    A table needs ``rings``, or geometries as well-known binary, and the code of its coordinates: the
    column ``epsg``, the one given, or the one that the footers of GeoParquet state. From binary come
    ``polygons`` and, as ``rings``, the first of them.
    """
    if path.endswith(".geojson"):
        return read_geojson(spark, path)
    if not path.endswith(".parquet"):
        raise ValueError(f"unsupported vector file: {path}")
    df = spark.read.parquet(path)
    column, stated = ("geometry", None) if "rings" in df.columns and "epsg" in df.columns else _stated(geo_metadata(spark, path))
    if "epsg" not in df.columns:
        if epsg is None and stated is None:
            raise ValueError("the table has no code of its coordinates, and none is given")
        df = df.withColumn("epsg", F.lit(stated if epsg is None else epsg))
    if "rings" in df.columns:
        return df
    if column not in df.columns:
        raise ValueError("the table has no geometry")
    df = df.withColumn("polygons", from_wkb(F.col(column))).drop(column)
    return df.withColumn("rings", F.get("polygons", F.lit(0)))


def scan_labels(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A label file with a header, of these columns, all read as text: so codes keep their zeros."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def scan_ids(spark: SparkSession, path: str) -> DataFrame:
    """A list of sample ids, from a file with the header ``sample_id``."""
    return spark.read.csv(path, header=True, schema="sample_id string")


def scan_id_list(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """Rows (id) of a JSON list of keys of a kind, in a file or folder; another value is an error.

    Each line is parsed by itself, so a list with a key a line may have any size and goes to many tasks. A
    line may hold several whole keys too: one without line breaks is a single row's.
    """
    lines = spark.read.text(path)
    keys = F.regexp_replace(F.regexp_replace("value", r"^\s*[\[,]?\s*", ""), r"\s*[\],]?\s*$", "")
    # as a field, since a parser of a list alone leaves out what comes after it
    parsed = F.from_json(F.concat(F.lit('{"k":['), keys, F.lit("]}")), f"k array<{kind}>", {"mode": "FAILFAST"})
    return lines.select(F.explode(parsed["k"]).alias("id"))


def scan_job_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A job table that was written as delimited text."""
    return spark.read.csv(path, header=True, schema=schema)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.nc") -> DataFrame:
    """Rows (path, length) of the files below a folder, without their content."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", "true").load(folder).select("path", "length")
