"""Views over the given tables in the shapes that the operators take, for Spark and for SQL.

Each view is one projection whose expressions both engines read alike; ``{day}`` and ``{emb}`` stand
for the two spots where they differ.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class View(NamedTuple):
    table: str
    columns: tuple[str, ...]
    where: str | None = None
    distinct: bool = False
    group_by: int = 0  # so many leading columns are the key


VIEWS = {
    "fx_points": View(
        "customer",
        (
            "c_custkey as point_id",
            "c_nationkey as zone_key",
            "26.6e0 + (c_custkey*7919 % 3500)/1000.0e0 as lon",
            "45.4e0 + (c_custkey*3571 % 3100)/1000.0e0 as lat",
        ),
    ),
    "fx_samples": View(
        "orders",
        (
            "concat('S_', cast(o_orderkey as varchar(20))) as sample_id",
            "o_orderkey",
            "o_custkey",
            "cast(1101010000 + o_custkey % 40 as bigint) as ewoc_code",
            "cast(6 + o_orderkey % 13 as int) as available_timesteps",
            "cast(o_orderkey % 12 as int) as valid_position",
            "o_orderdate as start_ts",
        ),
    ),
    "fx_mapping": View(
        "orders",
        (
            "cast(1101010000 + o_custkey % 40 as varchar(20)) as ewoc_code",
            "case when o_custkey % 40 >= 36 then 'remove' when o_custkey % 40 >= 20 then 'other'"
            " when o_custkey % 40 >= 12 then 'not_cropland' when o_custkey % 40 >= 4 then 'cropland'"
            " else 'wetlands' end as cls",
        ),
        where="o_custkey % 40 <> 3",
        distinct=True,
    ),
    "fx_series": View(
        "events",
        (
            "user_id as sample_id",
            "cast(floor((extract(day from ts)-1)/2) as int) as pos",
            "case event_type when 'view' then 'B2' when 'click' then 'B8' when 'purchase' then 'VV'"
            " when 'signup' then 'precipitation' else 'temperature' end as band",
            "round(sum(cast(round(value * 1000000) as bigint)) / count(value)) / 1000000.0e0 as value",
        ),
        group_by=3,
    ),
    "fx_labels": View(
        "part",
        (
            "p_partkey as label_id",
            "case when p_partkey % 5 = 0 then concat('no_dominant ', p_name, ' none')"
            " when p_partkey % 5 = 1 then concat('yes_', p_name) when p_partkey % 5 = 2 then p_name"
            " when p_partkey % 5 = 3 then lower(p_type) else cast(null as varchar(10)) end as label",
        ),
    ),
    "fx_pred": View(
        "orders",
        (
            "o_orderkey as sample_id",
            "o_orderstatus as y_true",
            "case when o_orderkey % 4 = 0 then 'F' when o_orderkey % 7 = 0 then 'P' else o_orderstatus end as y_pred",
        ),
    ),
    "fx_pred_bin": View(
        "labels",
        (
            "doc_id as sample_id",
            "case when quality=1 then 'cropland' else 'other' end as y_true",
            "case when toxic=1 then 'cropland' else 'other' end as y_pred",
        ),
    ),
    "fx_jobs": View(
        "orders",
        (
            "concat('T_', cast(o_orderkey as varchar(20))) as tile_name",
            "case o_orderpriority when '1-URGENT' then 'error' when '2-HIGH' then 'start_failed'"
            " when '3-MEDIUM' then 'finished' when '4-NOT SPECIFIED' then 'running'"
            " else 'not_started' end as status",
        ),
    ),
    "fx_units": View(
        "supplier",
        (
            "s_suppkey as unit_id",
            "26.6e0 + (s_suppkey*37 % 350)/100.0e0 as west",
            "45.4e0 + (s_suppkey*53 % 310)/100.0e0 as south",
            "26.6e0 + (s_suppkey*37 % 350)/100.0e0 + 0.05e0 + (s_suppkey % 7)/100.0e0 as east",
            "45.4e0 + (s_suppkey*53 % 310)/100.0e0 + 0.05e0 + (s_suppkey % 5)/100.0e0 as north",
        ),
    ),
    "fx_tiles": View(
        "nation",
        (
            "n_nationkey as tile_key",
            "concat(cast(34 + n_nationkey % 3 as varchar(2)), case when n_nationkey % 4 = 0 then 'L'"
            " else 'T' end, 'Q', case when n_nationkey % 2 = 0 then 'A' else 'B' end) as tile",
            "26.5e0 + (n_nationkey % 5)*0.75e0 as west",
            "45.3e0 + floor(n_nationkey/5)*0.65e0 as south",
            "26.5e0 + (n_nationkey % 5)*0.75e0 + 0.8e0 as east",
            "45.3e0 + floor(n_nationkey/5)*0.65e0 + 0.7e0 as north",
        ),
    ),
    "fx_desk": View(
        "customer",
        (
            "c_nationkey as id_psu",
            "cast(c_custkey % 10 as int) as box_id",
            "c_custkey as id_ssu",
            "case when c_custkey % 9 = 0 then cast(null as varchar(2)) else cast(1 + c_custkey % 8 as varchar(2)) end as lu_code",
        ),
    ),
    "fx_survey": View(
        "customer",
        (
            "c_nationkey as id_psu",
            "cast(c_custkey % 10 as int) as box_id",
            "c_custkey as id_ssu",
            "cast(1 + c_custkey % 8 as varchar(2)) as lu_code",
            "case when c_custkey % 3 = 0 then '3.0' when c_custkey % 3 = 1 then lower(c_mktsegment)"
            " else cast(null as varchar(10)) end as landuse",
            "case when c_custkey % 2 = 0 then concat('2025-06-', lpad(cast(1 + c_custkey % 28 as varchar(2)),2,'0'))"
            " else cast(null as varchar(10)) end as start_text",
        ),
        where="c_custkey % 4 <> 0",
    ),
    "fx_links": View(
        "lineitem",
        (
            "l_orderkey as tile_key",
            "concat('{{\"title\":\"', case when l_linenumber % 2 = 0 then"
            " concat('Sentinel-2 S2A_MSIL2A_N0500_R036_T35TPN_', {day}, 'T101010.zip') else"
            " concat('Sentinel-1 S1A_IW_GRDH_1SDV_', {day}, 'T040506_052936.zip') end, '\"}}') as link_json",
        ),
    ),
    "fx_logits": View(
        "embeddings",
        ("vec_id as sample_id", "label", "{emb0} as l0", "{emb1} as l1", "{emb2} as l2"),
    ),
}

_SPARK = {"day": "date_format(l_shipdate,'yyyyMMdd')"} | {f"emb{i}": f"cast(embedding[{i}] as double)" for i in range(3)}
_SQL = {"day": "strftime(l_shipdate,'%Y%m%d')"} | {f"emb{i}": f"embedding[{i + 1}]::double" for i in range(3)}


class Tables:
    """The given tables and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        view = VIEWS.get(name)
        if view is None:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        df = self(view.table)
        if view.where:
            df = df.where(view.where)
        columns = [c.format(**_SPARK) for c in view.columns]
        if view.group_by:
            keys, rest = columns[: view.group_by], columns[view.group_by :]
            names = [k.rsplit(" as ", 1)[1] for k in keys]
            return df.selectExpr("*", *keys).groupBy(*names).agg(*map(F.expr, rest))
        df = df.selectExpr(*columns)
        return df.distinct() if view.distinct else df


def with_views(sql: str) -> str:
    """The statement, with the views that it names as common table expressions before it."""
    sql = sql.strip()
    parts = []
    for name, view in VIEWS.items():
        if not re.search(rf"\b{name}\b", sql):
            continue
        columns = ", ".join(c.format(**_SQL) for c in view.columns)
        body = f"select {'distinct ' * view.distinct}{columns} from {view.table}"
        if view.where:
            body += f" where {view.where}"
        if view.group_by:
            body += " group by " + ", ".join(str(i + 1) for i in range(view.group_by))
        parts.append(f"{name} as ({body})")
    if not parts:
        return sql
    head = "with " + ", ".join(parts)
    return f"{head}, {sql[5:]}" if sql.lower().startswith("with ") else f"{head} {sql}"
