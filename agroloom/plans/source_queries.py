"""Queries: catalogs, files that are written and read back, and values in text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, geo, text
from ..operators import classes, jobs, scoring, splits, survey, tables
from ..sources import readers, writers
from .fixtures import Tables
from .model_queries import _SPLIT
from .registry import query
from .table_queries import with_rings

_CATALOG = """
    c as (select r_name as country, case when n_nationkey % 2 = 0 then 'month' else 'dekad' end as frequency,
          concat('/data/', n_name, '.parquet') as path from nation join region on n_regionkey = r_regionkey)
"""


def catalog(t: Tables) -> DataFrame:
    rows = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(
        F.col("r_name").alias("country"),
        F.when(F.col("n_nationkey") % 2 == 0, "month").otherwise("dekad").alias("frequency"),
        F.concat(F.lit("/data/"), "n_name", F.lit(".parquet")).alias("path"),
    )


@query(f"with {_CATALOG} select path, 'EUROPE_mapping' as mapping from c where country = 'EUROPE' and frequency = 'month'")
def dataset_lookup(t: Tables) -> DataFrame:
    names = t("region").select(F.col("r_name").alias("country"), F.concat("r_name", F.lit("_mapping")).alias("mapping"))
    paths = readers.dataset_paths(catalog(t), "EUROPE", "month")
    mapping = readers.mapping_name(names, "EUROPE")
    return t.spark.createDataFrame([(p, mapping) for p in paths], "path string, mapping string")


@query("""
    select unit_id, cast(4326 as int) as epsg, cast(case when unit_id % 2 = 0 then 2 else 1 end as int) as n_polygons,
           round(west, 6) as west, round(north, 6) as north
    from fx_units
""")
def read_wkb(t: Tables) -> DataFrame:
    units = with_rings(t("fx_units"))
    # every other geometry is a multipolygon: its header, and the polygon twice
    single = writers.wkb("rings")
    header = F.unhex(F.lit("01" + "06000000" + "02000000"))
    units = units.withColumn("one", single)
    geometry = F.when(F.col("unit_id") % 2 == 0, F.concat(header, "one", "one")).otherwise(F.col("one"))
    path = writers.scratch_path(t.spark, "units.parquet")
    writers.write_parquet(units.select("unit_id", geometry.alias("geometry")), path)
    df = readers.scan_features(t.spark, path, epsg=4326)
    box = geo.bounds(F.col("rings"))
    return df.select(
        "unit_id", "epsg", F.size("polygons").alias("n_polygons"),
        F.round(box["west"], 6).alias("west"), F.round(box["north"], 6).alias("north"),
    )


@query("select lpad(cast(c_custkey as varchar), 8, '0') as code, c_mktsegment as label from customer")
def scan_labels(t: Tables) -> DataFrame:
    rows = t("customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"), F.col("c_mktsegment").alias("label"))
    path = writers.scratch_path(t.spark, "labels.csv")
    writers.write_csv(rows, path)
    return readers.scan_labels(t.spark, path, ["code", "label"])


@query(f"select sample_id from fx_samples where {_SPLIT} = 'val'")
def scan_ids(t: Tables) -> DataFrame:
    rows = t("fx_samples").where(splits.random_split(F.col("sample_id")) == "val").select("sample_id")
    path = writers.scratch_path(t.spark, "ids.csv")
    writers.write_csv(rows, path)
    return readers.scan_ids(t.spark, path)


@query("""
    select tile_name as name, case when status in ('error', 'start_failed') then 'not_started' else status end as status,
           '2024-10-01' as start_date, '2025-09-30' as end_date from fx_jobs
""")
def job_table_roundtrip(t: Tables) -> DataFrame:
    """A job table with renamed and constant columns, written as CSV, read back and reset."""
    grid = t("fx_jobs").withColumnRenamed("tile_name", "tile")
    table = jobs.build_job_table(grid, ["tile", "status"], "2024-10-01", "2025-09-30", renamed={"tile": "name"})
    path = writers.scratch_path(t.spark, "jobs.csv")
    writers.write_csv(table, path)
    found = jobs.reset_failed(readers.scan_job_table(t.spark, path, "name string, status string, start_date date, end_date date"))
    return found.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


@query("""
    select concat('tile_name=T_', cast(n_regionkey as varchar)) as folder, cast(1 as bigint) as n from nation group by n_regionkey
""")
def tile_folders(t: Tables) -> DataFrame:
    """A folder for each tile, found again by listing the files below their root."""
    rows = t("nation").withColumn("tile_name", F.concat(F.lit("T_"), F.col("n_regionkey").cast("string")))
    path = writers.scratch_path(t.spark, "tiles")
    writers.write_parquet(rows.repartition("tile_name"), path, ["tile_name"])
    files = readers.list_files(t.spark, path, "*.parquet").where("length > 0")
    folder = F.element_at(F.split("path", "/"), -2)
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("n"))


@query("select distinct tile_key as id from fx_links")
def json_list_roundtrip(t: Tables) -> DataFrame:
    rows = t("fx_links").select("tile_key")
    path = writers.scratch_path(t.spark, "ids.json")
    writers.write_id_list(rows, "tile_key", path)
    return readers.scan_id_list(t.spark, path)


@query(f"select {_SPLIT} as split, count(*) as n, cast(2 as bigint) as n_reads from fx_samples group by 1")
def saved_splits(t: Tables) -> DataFrame:
    """Tables of splits: computed and saved at first, then read as they were saved."""
    rows = t("fx_samples").select("sample_id", splits.random_split(F.col("sample_id")).alias("split"))
    root = writers.scratch_path(t.spark, "splits")
    print_ = writers.fingerprint_of(t.sf_dir, splits.SHARES)

    def compute() -> dict[str, DataFrame]:
        return {name: rows.where(F.col("split") == name) for name in splits.SHARES}

    first = writers.load_or_compute(t.spark, root, compute, print_)
    again = writers.load_or_compute(t.spark, root, lambda: {}, print_)
    both = tables.union_splits(*first.values(), *again.values())
    counts = both.groupBy("split", "sample_id").agg(F.count("*").alias("k"))
    return counts.groupBy("split").agg(F.count("*").alias("n"), F.max("k").alias("n_reads"))


@query("""
    with w as (select unnest(['o_orderkey', 'o_totalprice', 'tile_name', 'geometry']) as name)
    select name from w where name not in (select column_name from information_schema.columns where table_name = 'orders')
""")
def missing_columns(t: Tables) -> DataFrame:
    return tables.missing_columns(t("orders"), ["o_orderkey", "o_totalprice", "tile_name", "geometry"])


@query("""
    select vec_id, embedding[2]::double as emb_1, embedding[11]::double as emb_10, embedding[12]::double as emb_11, embedding[13]::double as emb_12,
           embedding[14]::double as emb_13, embedding[15]::double as emb_14, embedding[16]::double as emb_15, embedding[17]::double as emb_16,
           embedding[18]::double as emb_17, embedding[19]::double as emb_18, embedding[20]::double as emb_19
    from embeddings
""")
def prefix_columns(t: Tables) -> DataFrame:
    rows = t("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    wide = scoring.embedding_columns(rows, "embedding", 64)
    return wide.select("vec_id", *tables.prefixed_columns(wide, "emb_1"))


@query("""
    with w as (select p_partkey, unnest(string_split(concat(p_name, ' ', p_brand, ' ', p_name), ' ')) as w from part)
    select p_partkey, string_agg(distinct w, '|' order by w) as words from w group by 1
""")
def distinct_in_list(t: Tables) -> DataFrame:
    words = F.split(F.concat_ws(" ", "p_name", "p_brand", "p_name"), " ")
    return t("part").select("p_partkey", F.array_join(text.distinct_sorted(words), "|").alias("words"))


@query("""
    select n_nationkey, case when n_nationkey % 3 = 2 then null else 32601 + n_nationkey end as epsg from nation
""")
def parse_crs(t: Tables) -> DataFrame:
    code = (F.lit(32601) + F.col("n_nationkey")).cast("string")
    crs = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("EPSG:"), code)).when(F.col("n_nationkey") % 3 == 1, code)
    crs = crs.otherwise(F.concat(F.lit("UTM "), code))
    return t("nation").select("n_nationkey", text.parse_epsg(crs).cast("bigint").alias("epsg"))


@query("select o_orderkey, substr(cast(o_orderdate as varchar), 1, 10) as d from orders")
def date_prefix(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", text.date_prefix(F.col("o_orderdate").cast("string")).alias("d"))


@query("select p_partkey, replace(p_brand, '#', '_') as tag from part")
def run_tag(t: Tables) -> DataFrame:
    model = F.concat_ws("-", F.lit("encoder"), F.col("p_type"), F.col("p_brand"))
    tag = text.run_tag(F.replace(model, F.lit("#"), F.lit("_")))
    return t("part").select("p_partkey", tag.alias("tag"))


@query("select user_id, event_type, case event_type when 'view' then 12 when 'click' then 36 end as steps from events")
def frequency_steps(t: Tables) -> DataFrame:
    frequency = F.when(F.col("event_type") == "view", "month").when(F.col("event_type") == "click", "dekad").otherwise(F.col("event_type"))
    return t("events").select("user_id", "event_type", dates.timesteps_per_year(frequency).alias("steps"))


@query("""
    select n_nationkey, k.key as code, k.value as cls from nation,
    lateral (select unnest([{'key': concat('c_', n_regionkey), 'value': n_name}, {'key': 'other', 'value': 'other'}]) as k)
""")
def dictionary_argument(t: Tables) -> DataFrame:
    given = F.to_json(
        F.map_from_arrays(
            F.array(F.concat(F.lit("c_"), F.col("n_regionkey").cast("string")), F.lit("other")), F.array(F.col("n_name"), F.lit("other"))
        )
    )
    return t("nation").select("n_nationkey", F.explode(classes.parse_dictionary(given)).alias("code", "cls"))


@query("""
    select d.id_psu, d.box_id, d.id_ssu, d.lu_code, s.landuse, concat('desk_', cast(d.id_ssu as varchar)) as geometry
    from fx_survey s right join fx_desk d
    on s.id_psu = d.id_psu and s.box_id = d.box_id and s.id_ssu = d.id_ssu and s.lu_code = d.lu_code
""")
def survey_desk_geometry(t: Tables) -> DataFrame:
    def located(df: DataFrame, kind: str) -> DataFrame:
        return df.withColumn("geometry", F.concat(F.lit(f"{kind}_"), F.col("id_ssu").cast("string")))

    rows = survey.join_survey(located(t("fx_survey"), "survey"), located(t("fx_desk"), "desk"), geometry="geometry")
    return rows.select("id_psu", "box_id", "id_ssu", "lu_code", "landuse", "geometry")
