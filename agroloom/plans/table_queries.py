"""Queries: scans, projections, counts, joins, classes and survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands, geo, text
from ..operators import classes, inputs, jobs, survey, tables
from ..sources import readers, writers
from .fixtures import Tables
from .registry import query

#: Keeps codes that a mapping knows, without the marked class and too short series.
MIN_TIMESTEPS = 12


def samples(t: Tables) -> DataFrame:
    return classes.map_classes(t("fx_samples"), t("fx_mapping"))


_SAMPLES = """
    s as (select x.*, m.cls as finetune_class from fx_samples x
          join fx_mapping m on cast(x.ewoc_code as varchar) = m.ewoc_code)
"""


@query("select o_orderkey, o_custkey, o_totalprice from orders")
def scan_parquet(t: Tables) -> DataFrame:
    path = f"{t.sf_dir}/orders.parquet"
    return readers.scan_parquet(t.spark, [path], ["o_orderkey", "o_custkey", "o_totalprice"])


@query("""
    select unit_id, 'Polygon' as kind, cast(5 as bigint) as n_points, round(west, 6) as west, round(north, 6) as north
    from fx_units
""")
def read_geojson(t: Tables) -> DataFrame:
    units = with_rings(t("fx_units")).withColumn("unit_id", F.col("unit_id").cast("string"))
    path = writers.scratch_path(t.spark, "units.geojson")
    writers.write_geojson(units, path, "rings", ["unit_id"])
    df = readers.scan_features(t.spark, path)
    box = geo.bounds(F.col("rings"))
    return df.select(
        F.col("properties")["unit_id"].cast("bigint").alias("unit_id"), "kind",
        F.size(F.get("rings", F.lit(0))).cast("bigint").alias("n_points"),
        F.round(box["west"], 6).alias("west"), F.round(box["north"], 6).alias("north"),
    )


def with_rings(df: DataFrame) -> DataFrame:
    return df.withColumn("rings", geo.rectangle(*[F.col(c) for c in ("west", "south", "east", "north")]))


@query("""
    select cast(l_orderkey as varchar) as a, case when l_linenumber % 3 = 0 then null else cast(l_partkey as varchar) end as b
    from lineitem where l_linenumber % 3 <> 1
""")
def scan_csv_skip_bad(t: Tables) -> DataFrame:
    # lines with three, one and two fields; those with too many are bad
    line = (
        F.when(F.col("l_linenumber") % 3 == 1, F.concat_ws(";", "l_orderkey", "l_partkey", "l_suppkey"))
        .when(F.col("l_linenumber") % 3 == 0, F.col("l_orderkey").cast("string"))
        .otherwise(F.concat_ws(";", "l_orderkey", "l_partkey"))
    )
    path = writers.scratch_path(t.spark, "lines.csv")
    t("lineitem").select(line.alias("a;b")).write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    return readers.scan_csv_skip_bad(t.spark, path, ["a", "b"])


@query("select 'CROPTYPE' as scheme, ewoc_code as code, cls from fx_mapping")
def class_mapping_explode(t: Tables) -> DataFrame:
    rows = t("fx_mapping").select(F.lit("CROPTYPE").alias("scheme"), F.col("ewoc_code").alias("code"), "cls")
    path = writers.scratch_path(t.spark, "mapping.json")
    writers.write_mapping_json(rows, path)
    return readers.read_mapping_json(t.spark, f"{path}/*.txt")


@query("""
    select cast(n_nationkey as int) as index, n_name as name, cast(n_nationkey * 10 as int) as red,
           cast(n_regionkey as int) as green, 0 as blue, 255 as alpha
    from nation
""")
def colormap_explode(t: Tables) -> DataFrame:
    entry = F.struct(
        F.col("n_name").alias("name"),
        F.array(F.col("n_nationkey") * 10, F.col("n_regionkey"), F.lit(0), F.lit(255)).alias("color"),
    )
    whole = t("nation").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), entry)))).alias("value")
    )
    path = writers.scratch_path(t.spark, "colours.json")
    whole.coalesce(1).write.text(path)
    return readers.read_colormap_json(t.spark, f"{path}/*.txt")


@query("select c_custkey, c_name, c_nationkey, c_acctbal from customer")
def sink_roundtrip(t: Tables) -> DataFrame:
    df = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    path = writers.scratch_path(t.spark, "customers")
    back = writers.write_parquet(df, path, ["c_nationkey"])
    return back.select("c_custkey", "c_name", F.col("c_nationkey").cast(df.schema["c_nationkey"].dataType), "c_acctbal")


@query("select id_psu, id_ssu, lu_code from fx_desk")
def project_keep(t: Tables) -> DataFrame:
    return tables.keep_columns(t("fx_desk"), ["id_psu", "id_ssu", "lu_code"])


@query("select tile, count(*) as n from fx_tiles where tile is not null group by 1 having count(*) > 1")
def key_duplicates(t: Tables) -> DataFrame:
    return tables.key_duplicates(t("fx_tiles"), "tile")


@query("select sample_id, available_timesteps from fx_samples where available_timesteps >= 12")
def min_timesteps(t: Tables) -> DataFrame:
    return t("fx_samples").where(F.col("available_timesteps") >= MIN_TIMESTEPS).select("sample_id", "available_timesteps")


@query(f"with {_SAMPLES} select sample_id, finetune_class from s where finetune_class <> 'remove'")
def drop_marker_class(t: Tables) -> DataFrame:
    return classes.drop_marked(samples(t)).select("sample_id", "finetune_class")


_DOWNSTREAM = "d(cls, target) as (values ('cropland', 'cropland'), ('not_cropland', 'other'), ('wetlands', 'other'))"


def downstream(t: Tables) -> DataFrame:
    rows = [("cropland", "cropland"), ("not_cropland", "other"), ("wetlands", "other")]
    return t.spark.createDataFrame(rows, "cls string, target string")


@query(f"""
    with {_SAMPLES}, {_DOWNSTREAM}
    select finetune_class, 'kept' as what, count(*) as n from s where finetune_class in (select cls from d) group by 1
    union all
    select finetune_class, 'lost', count(*) from s where finetune_class not in (select cls from d) group by 1
""")
def drop_unmapped_classes(t: Tables) -> DataFrame:
    rows, known = samples(t), downstream(t)
    kept = classes.drop_unmapped(rows, known, "finetune_class", "cls").groupBy("finetune_class").agg(F.count("*").alias("n"))
    lost = classes.count_unmapped(rows, known, "finetune_class", "cls")
    return kept.withColumn("what", F.lit("kept")).unionByName(lost.withColumn("what", F.lit("lost")))


@query("select tile_name, status from fx_jobs where tile_name in ('T_1', 'T_2', 'T_3', 'T_4', 'T_5', 'T_32', 'T_33')")
def tile_selection(t: Tables) -> DataFrame:
    return jobs.select_tiles(t("fx_jobs"), ["T_1", "T_2", "T_3", "T_4", "T_5", "T_32", "T_33"])


@query("""
    select band, count(*) as n, cast(sum(case when value <> 65535 then 1 else 0 end) as bigint) as n_valid
    from fx_series group by 1
""")
def nodata_valid_share(t: Tables) -> DataFrame:
    return t("fx_series").groupBy("band").agg(
        F.count("*").alias("n"), F.sum(bands.valid(F.col("value")).cast("bigint")).alias("n_valid")
    )


@query(f"""
    with {_SAMPLES}
    select count(distinct finetune_class) as n_classes, 'multiclass' as task, count(distinct finetune_class) as n_outputs
    from s
""")
def task_type(t: Tables) -> DataFrame:
    return classes.task_type(samples(t), "finetune_class")


@query("select count(distinct quality) as n_classes, 'binary' as task, cast(1 as bigint) as n_outputs from labels where quality is not null")
def task_type_binary(t: Tables) -> DataFrame:
    return classes.task_type(t("labels").where("quality is not null"), "quality")


@query("""
    select label_id, case when coalesce(label, 'nan') like '%no\\_dominant%' escape '\\' then 'no_dominant'
        when coalesce(label, 'nan') like '%yes%' then 'mixed'
        when coalesce(label, 'nan') like '% %' then 'no_dominant' else 'clean' end as kind
    from fx_labels
""")
def label_triage(t: Tables) -> DataFrame:
    return t("fx_labels").select("label_id", text.triage(F.col("label")).alias("kind"))


@query(f"with {_SAMPLES} select string_agg(c, ',' order by c) as classes from (select distinct finetune_class as c from s)")
def classes_present(t: Tables) -> DataFrame:
    found = classes.classes_present(t("fx_mapping"), samples(t), "finetune_class")
    return found.select(F.array_join("classes", ",").alias("classes"))


@query("select tile_name, case when status in ('error', 'start_failed') then 'not_started' else status end as status from fx_jobs")
def reset_failed_jobs(t: Tables) -> DataFrame:
    return jobs.reset_failed(t("fx_jobs"))


@query("select tile_name, status, '2024-10-01' as start_date, '2025-09-30' as end_date from fx_jobs")
def build_job_table(t: Tables) -> DataFrame:
    found = jobs.build_job_table(t("fx_jobs"), ["tile_name", "status"], "2024-10-01", "2025-09-30", shuffle=True)
    return found.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


_NAMES = (
    "case {} "
    + " ".join(f"when '{k}' then '{v}'" for k, v in survey.LAND_USE.items())
    + " end"
)


def joined_survey(t: Tables) -> DataFrame:
    return survey.join_survey(t("fx_survey"), t("fx_desk"))


@query(f"""
    with j as (select d.id_ssu, coalesce(d.lu_code, '9') as lu_code, s.landuse
               from fx_survey s right join fx_desk d
               on s.id_psu = d.id_psu and s.box_id = d.box_id and s.id_ssu = d.id_ssu and s.lu_code = d.lu_code),
    k as (select id_ssu, lu_code, case when landuse = '3.0' then 'agriculture'
                 when landuse is null then {_NAMES.format('lu_code')} else landuse end as landuse from j)
    select id_ssu, lu_code, landuse, landuse as croptype from k
""")
def landuse_recode(t: Tables) -> DataFrame:
    rows = joined_survey(t).withColumn("croptype", F.lit(None).cast("string"))
    return survey.recode_land_use(rows).select("id_ssu", "lu_code", "landuse", "croptype")


@query("""
    select d.id_psu, d.box_id, d.id_ssu, d.lu_code, s.landuse, s.start_text
    from fx_survey s right join fx_desk d
    on s.id_psu = d.id_psu and s.box_id = d.box_id and s.id_ssu = d.id_ssu and s.lu_code = d.lu_code
""")
def survey_desk_join(t: Tables) -> DataFrame:
    return joined_survey(t).select("id_psu", "box_id", "id_ssu", "lu_code", "landuse", "start_text")


@query("""
    with a as (select point_id, lon + 0.00004e0 as x, lat - 0.00004e0 as y from fx_points),
    b as (select point_id as id, lon as x, lat as y from fx_points where point_id % 3 <> 0)
    select a.point_id, b.id, round(a.x, 6) as x, round(b.x, 6) as x_original
    from a left join b on round_even(a.x, 4) = round_even(b.x, 4) and round_even(a.y, 4) = round_even(b.y, 4)
""")
def coord_round_join(t: Tables) -> DataFrame:
    points = t("fx_points")
    left = points.select("point_id", (F.col("lon") + 0.00004).alias("x"), (F.col("lat") - 0.00004).alias("y"))
    right = points.where("point_id % 3 <> 0").select(F.col("point_id").alias("id"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    joined = survey.join_rounded(left, right)
    return joined.select("point_id", "id", F.round("x", 6).alias("x"), F.round("x_original", 6).alias("x_original"))


@query("""
    with legend as (select concat(substr(ewoc_code, 1, 4), '-', substr(ewoc_code, 5)) as code, cls as name from fx_mapping)
    select x.sample_id, l.name from fx_samples x left join legend l on cast(x.ewoc_code as varchar) = replace(l.code, '-', '')
""")
def code_legend_join(t: Tables) -> DataFrame:
    dashed = F.concat(F.substring("ewoc_code", 1, 4), F.lit("-"), F.substring("ewoc_code", 5, 20))
    legend = t("fx_mapping").select(dashed.alias("code"), F.col("cls").alias("name"))
    labels = t("fx_samples").withColumn("ewoc", F.col("ewoc_code").cast("string"))
    return classes.join_legend(labels, legend, "ewoc", "code").select("sample_id", "name")


@query("""
    with f as (select o_custkey, o_orderpriority, row_number() over (partition by o_custkey order by o_orderkey desc) as r from orders)
    select c_custkey, f.o_orderpriority as last_priority from customer left join f on c_custkey = f.o_custkey and f.r = 1
""")
def attach_attributes(t: Tables) -> DataFrame:
    facts = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderpriority").alias("last_priority"))
    found = tables.attach_attributes(t("customer"), facts, "c_custkey", F.col("o_orderkey"), ["last_priority"])
    return found.select("c_custkey", "last_priority")


@query(f"with {_SAMPLES} select sample_id, ewoc_code, finetune_class from s")
def map_classes(t: Tables) -> DataFrame:
    return samples(t).select("sample_id", "ewoc_code", "finetune_class")


_LANDCOVER = """
    r as (select distinct cast(ewoc_code as varchar) as code, concat('label_', cast(ewoc_code % 7 as varchar)) as label from fx_samples),
    m as (select ewoc_code as code, cls from fx_mapping where cls <> 'wetlands'),
    o as (select distinct concat('label_', cast(ewoc_code % 7 as varchar)) as label, 'overridden' as cls from fx_samples where ewoc_code % 7 = 2),
    g as (select cast(ewoc_code as varchar) as code, min(concat('legend_', cast(ewoc_code as varchar))) as name from fx_samples group by 1)
"""


@query(f"""
    with {_LANDCOVER}
    select r.code, r.label, coalesce(m.cls, o.cls, g.name) as cls, m.cls is null as needs_review
    from r left join m on r.code = m.code left join o on r.label = o.label left join g on r.code = g.code
    where r.label <> 'label_5'
""")
def landcover_resolve(t: Tables) -> DataFrame:
    s = t("fx_samples")
    code, label = F.col("ewoc_code").cast("string"), F.concat(F.lit("label_"), (F.col("ewoc_code") % 7).cast("string"))
    rows = s.select(code.alias("code"), label.alias("label")).distinct()
    mapping = t("fx_mapping").where("cls <> 'wetlands'").select(F.col("ewoc_code").alias("code"), "cls")
    overrides = rows.where("label = 'label_2'").select("label", F.lit("overridden").alias("cls")).distinct()
    legend = rows.groupBy("code").agg(F.min(F.concat(F.lit("legend_"), "code")).alias("name"))
    excluded = rows.where("label = 'label_5'").select("label").distinct()
    return classes.resolve_landcover(rows, mapping, legend, overrides, excluded)


def spellings(t: Tables) -> DataFrame:
    rows = [(1, "red_things", ["red", "red widget"]), (2, "small_things", ["small"]), (3, "rings", ["ring"])]
    return t.spark.createDataFrame(rows, "ordinal int, cls string, spellings array<string>")


_SPELLINGS = "l(label, cls) as (values ('red', 'red_things'), ('red widget', 'red_things'), ('small', 'small_things'), ('ring', 'rings'))"


@query(f"with {_SPELLINGS} select x.label_id, x.label, l.cls from fx_labels x left join l on x.label = l.label")
def crop_list_lookup(t: Tables) -> DataFrame:
    return classes.lookup_in_lists(t("fx_labels"), "label", spellings(t))


_TOKENS = """
    t as (select distinct label, unnest(string_split(label, ' ')) as w from fx_labels where label is not null),
    c as (select t.label, coalesce(l.cls, 'other_crops') as crop from t left join l on replace(t.w, 'yes_', '') = l.label),
    n as (select label, list_sort(list(distinct crop)) as crops from c group by 1)
"""


@query("""
    with t as (select label_id, unnest(string_split(label, ' ')) as w from fx_labels where label is not null)
    select label_id, string_agg(distinct replace(w, 'yes_', ''), ',' order by replace(w, 'yes_', '')) as crops from t group by 1
""")
def split_label(t: Tables) -> DataFrame:
    rows = t("fx_labels").where("label is not null")
    return rows.select("label_id", F.array_join(text.split_label(F.col("label")), ",").alias("crops"))


@query(f"with {_SPELLINGS}, {_TOKENS} select label, array_to_string(crops, ',') as crops from n")
def normalise_tokens(t: Tables) -> DataFrame:
    found = classes.normalise_tokens(t("fx_labels"), "label", spellings(t))
    return found.select("label", F.array_join("crops", ",").alias("crops"))


@query(f"with {_SPELLINGS}, {_TOKENS} select distinct label_id from fx_labels join n using (label) where len(crops) > 1")
def duplicated_ids(t: Tables) -> DataFrame:
    rows = t("fx_labels")
    crops = classes.normalise_tokens(rows, "label", spellings(t))
    return classes.duplicated_ids(rows, "label_id", "label", crops)


@query(f"""
    with {_SPELLINGS}, {_TOKENS}, k(cls, code) as (values ('red_things', 11), ('rings', 12), ('other_crops', 13)),
    e as (select label_id, unnest(case when len(crops) > 1 then crops else [label] end) as croptype
          from fx_labels left join n using (label))
    select label_id, croptype, code as ewoc_code from e left join k on croptype = cls
""")
def duplicate_mixed(t: Tables) -> DataFrame:
    rows = t("fx_labels")
    crops = classes.normalise_tokens(rows, "label", spellings(t))
    codes = t.spark.createDataFrame([("red_things", 11), ("rings", 12), ("other_crops", 13)], "cls string, code int")
    return classes.duplicate_mixed(rows, "label", crops, codes).select("label_id", "croptype", "ewoc_code")


@query(f"with {_SAMPLES}, {_DOWNSTREAM} select sample_id, target as downstream_class from s join d on finetune_class = cls")
def downstream_classes(t: Tables) -> DataFrame:
    return classes.downstream_classes(samples(t), "finetune_class", downstream(t)).select("sample_id", "downstream_class")


@query("select cls, min(ewoc_code) as code from fx_mapping group by 1")
def invert_mapping_first(t: Tables) -> DataFrame:
    return classes.invert_first(t("fx_mapping"))


@query("""
    select ewoc_code, arg_max(sample_id, o_orderkey) as sample_id from fx_samples group by 1
""")
def code_last_wins(t: Tables) -> DataFrame:
    return classes.last_wins(t("fx_samples"), "ewoc_code", "sample_id", "o_orderkey")


@query(f"with {_SAMPLES} select distinct finetune_class as cls from s except select 'cropland'")
def class_difference(t: Tables) -> DataFrame:
    known = downstream(t).where("cls = 'cropland'")
    return classes.class_difference(samples(t), "finetune_class", known, "cls")


@query("""
    select c_custkey, case when c_custkey % 5 = 0 then 'level_5' when c_custkey % 4 = 0 then 'level_4'
        when c_custkey % 3 = 0 then 'level_3' when c_custkey % 2 = 0 then 'level_2' else 'level_1' end as level
    from customer
""")
def most_detailed_level(t: Tables) -> DataFrame:
    rows = t("customer").select("c_custkey", *[F.when(F.col("c_custkey") % k == 0, "x").alias(f"level_{k}") for k in range(1, 6)])
    return rows.select("c_custkey", classes.most_detailed_level().alias("level"))


@query(f"with {_SAMPLES} select finetune_class, count(sample_id) as n from s where finetune_class <> 'remove' and available_timesteps >= 12 group by 1")
def class_counts(t: Tables) -> DataFrame:
    rows = classes.drop_marked(samples(t)).where(F.col("available_timesteps") >= MIN_TIMESTEPS)
    return tables.counts_by(rows, "finetune_class", "sample_id")


@query(f"with {_SAMPLES} select finetune_class, count(sample_id) as n from s group by 1 order by 2 desc, 1 limit 3")
def top_classes(t: Tables) -> DataFrame:
    return tables.top_classes(samples(t), "finetune_class", "sample_id", 3)


@query(f"with {_SAMPLES} select distinct finetune_class from s")
def distinct_classes(t: Tables) -> DataFrame:
    return samples(t).select("finetune_class").distinct()


@query("""
    with j as (select d.id_ssu, cast(substr(s.start_text, 1, 10) as date) as d
               from fx_survey s right join fx_desk d
               on s.id_psu = d.id_psu and s.box_id = d.box_id and s.id_ssu = d.id_ssu and s.lu_code = d.lu_code)
    select id_ssu, cast(coalesce(d, (select min(d) from j)) as varchar) as date from j
""")
def min_date_fill(t: Tables) -> DataFrame:
    rows = survey.fill_dates(joined_survey(t), "start_text")
    return rows.select("id_ssu", F.col("date").cast("string").alias("date"))


@query("""
    select ewoc_code, cls, cast(ewoc_code as bigint) as code, row_number() over (order by cast(ewoc_code as bigint)) - 1 as position
    from fx_mapping
""")
def sort_codes(t: Tables) -> DataFrame:
    rows = t("fx_mapping").withColumn("code", F.col("ewoc_code").cast("bigint"))
    return tables.with_position(rows, [F.col("code")], "code")


@query("select tile_name, status, row_number() over (order by md5('42|' || tile_name), tile_name) - 1 as position from fx_jobs")
def shuffle_tiles(t: Tables) -> DataFrame:
    order = tables.random_order("tile_name")
    return tables.with_position(t("fx_jobs"), [order, F.col("tile_name")], "tile_name")


@query("""
    select tile_key, cast(max(strptime(regexp_extract(link_json, '_(\\d{8})T', 1), '%Y%m%d')::date) as varchar) as latest_image
    from fx_links group by 1
""")
def latest_image(t: Tables) -> DataFrame:
    found = jobs.latest_images(t("fx_links"), "tile_key", "link_json")
    return found.select("tile_key", F.col("latest_image").cast("string").alias("latest_image"))


@query("""
    with l as (select tile_key, cast(max(strptime(regexp_extract(link_json, '_(\\d{8})T', 1), '%Y%m%d')::date) as varchar) as d
               from fx_links group by 1)
    select tile_key, concat('cropland_2024-10-01_', d, '_T_', cast(tile_key as varchar), '.tif') as product,
           concat('inputs_T_', cast(tile_key as varchar)) as inputs
    from l
""")
def product_names(t: Tables) -> DataFrame:
    rows = jobs.latest_images(t("fx_links"), "tile_key", "link_json")
    tile = F.concat(F.lit("T_"), F.col("tile_key").cast("string"))
    return rows.select(
        "tile_key",
        text.product_name(F.lit("cropland_2024-10-01_2025-09-30"), F.col("latest_image").cast("string"), tile).alias("product"),
        text.input_name(F.lit("inputs"), tile).alias("inputs"),
    )


@query("""
    select p_partkey, concat('/detail_pix/', p_name) as source,
           concat(cast(p_partkey as varchar), '_', p_name, '_', p_brand, '.jpg') as target
    from part
""")
def photo_names(t: Tables) -> DataFrame:
    return t("part").select(
        "p_partkey",
        text.photo_source(F.col("p_name")).alias("source"),
        text.photo_target(F.col("p_partkey"), F.col("p_name"), F.col("p_brand")).alias("target"),
    )


@query(f"with {_SAMPLES} select sample_id, case when finetune_class like 'not\\_%' escape '\\' then 0 else 1 end as y from s")
def binary_label(t: Tables) -> DataFrame:
    return samples(t).select("sample_id", text.binary_label(F.col("finetune_class")).alias("y"))


@query("""
    select distinct case when event_type in ('view', 'click') then 'B2' else event_type end as band
    from events where event_type not in ('view', 'click')
""")
def unknown_bands(t: Tables) -> DataFrame:
    band = F.when(F.col("event_type").isin("view", "click"), "B2").otherwise(F.col("event_type"))
    return inputs.unknown_bands(t("events").select(band.alias("band")))
