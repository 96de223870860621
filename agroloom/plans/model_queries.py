"""Queries: series, dates, labels, splits, weights, evaluation and scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, bands, dates
from ..operators import classes, evaluate, inputs, records, scoring, splits, tables
from .fixtures import Tables
from .registry import query
from .table_queries import _SAMPLES, MIN_TIMESTEPS, samples

SERIES_BANDS = ["B2", "B8", "VV", "precipitation", "temperature"]
SERIES_STEPS = 16
LENGTH = 12
CLASSES = ["cropland", "not_cropland", "other", "remove", "wetlands"]
_HASH = "('0x' || substr(md5(concat_ws('|', '{seed}', {key})), 1, 8))::bigint"


def _texts(column: Column, scale: int = 1000) -> Column:
    """A series as text that both engines write alike."""
    return F.array_join(F.transform(column, lambda v: F.round(v * scale).cast("bigint").cast("string")), ",")


def long_samples(t: Tables) -> DataFrame:
    """Mapped samples whose series are long enough for a window."""
    return samples(t).where(F.col("available_timesteps") >= MIN_TIMESTEPS)


# --- bands and series


@query("select sample_id, pos, round(case when value > 0 and value <> 65535 then 20 * log10(value) - 83 else value end, 6) as db from fx_series where band = 'VV'")
def sar_to_db(t: Tables) -> DataFrame:
    rows = t("fx_series").where("band = 'VV'")
    return rows.select("sample_id", "pos", F.round(bands.sar_to_db(F.col("value")), 6).alias("db"))


@query("select sample_id, pos, round(value / 100000 * 1000, 6) as mm from fx_series where band = 'precipitation'")
def precip_scale(t: Tables) -> DataFrame:
    rows = t("fx_series").where("band = 'precipitation'")
    value = bands.in_units("precipitation", F.col("value"))
    return rows.select("sample_id", "pos", F.round(value * 1000, 6).alias("mm"))


@query("select sample_id, pos, round(value / 100, 6) as degrees from fx_series where band = 'temperature'")
def temp_scale(t: Tables) -> DataFrame:
    rows = t("fx_series").where("band = 'temperature'")
    return rows.select("sample_id", "pos", F.round(bands.in_units("temperature", F.col("value")), 6).alias("degrees"))


_PACKED = """
    with ids as (select distinct sample_id from fx_series),
    grid as (select sample_id, b.band, p.pos from ids, (select unnest(['B2', 'VV']) as band) b,
             (select cast(unnest(range(0, 16)) as int) as pos) p),
    v as (select g.*, coalesce(s.value, 65535) as value from grid g left join fx_series s using (sample_id, band, pos))
"""


@query(f"""
    {_PACKED} select sample_id,
    string_agg(cast(cast(round(value * 1000) as bigint) as varchar), ',' order by pos) filter (band = 'B2') as b2,
    string_agg(cast(cast(round(value * 1000) as bigint) as varchar), ',' order by pos) filter (band = 'VV') as vv
    from v group by 1
""")
def pack_bands(t: Tables) -> DataFrame:
    wide = inputs.widen(t("fx_series"), "sample_id", SERIES_BANDS, SERIES_STEPS)
    packed = inputs.pack_wide(wide, SERIES_BANDS, SERIES_STEPS)
    return packed.select("sample_id", _texts(F.col("B2")).alias("b2"), _texts(F.col("VV")).alias("vv"))


def _window_inputs(t: Tables) -> DataFrame:
    packed = inputs.pack_long(t("fx_series"), "sample_id", SERIES_BANDS, SERIES_STEPS)
    return packed.withColumns(
        {
            "valid_position": (F.col("sample_id") % SERIES_STEPS).cast("int"),
            "available_timesteps": F.lit(SERIES_STEPS),
            "start_date": F.to_date(F.lit("2021-01-03")),
            "end_date": F.to_date(F.lit("2022-04-20")),
            "lat": 45.0 + F.col("sample_id") / 1000,
            "lon": 27.0 + F.col("sample_id") / 1000,
        }
    )


@query(f"""
    {_PACKED}, w as (select *, greatest(0, least(cast(sample_id % 16 as int) - 6, 4)) as s from v)
    select sample_id,
    string_agg(cast(cast(round(value * 1000) as bigint) as varchar), ',' order by pos) filter (band = 'B2' and pos >= s and pos < s + 12) as b2,
    string_agg(cast(cast(round(case when value > 0 and value <> 65535 then 20 * log10(value) - 83 else value end * 1000) as bigint) as varchar), ','
               order by pos) filter (band = 'VV' and pos >= s and pos < s + 12) as vv,
    12 as n_b3,
    cast(max(sample_id % 16 - s) as int) as label_position,
    strftime(date '2021-01-01' + to_months(cast(max(s) as int)), '%-d/%-m/%Y') as first_timestamp,
    round(45.0 + sample_id / 1000, 6) as lat
    from w group by sample_id
""")
def model_inputs(t: Tables) -> DataFrame:
    rows = inputs.model_inputs(_window_inputs(t), LENGTH, "month")
    first = F.col("inputs.timestamps")[0]
    return rows.select(
        "sample_id",
        _texts(F.col("inputs.s2.B2")).alias("b2"),
        _texts(F.col("inputs.s1.VV")).alias("vv"),
        F.size(F.filter("inputs.s2.B3", lambda v: v == bands.NODATA)).alias("n_b3"),
        F.col("label_position").cast("int").alias("label_position"),
        F.concat_ws("/", first["day"], first["month"], first["year"]).alias("first_timestamp"),
        F.round("inputs.latlon.lat", 6).alias("lat"),
    )


@query(f"""
    {_PACKED} select sample_id,
    string_agg(cast(cast(round(case when pos >= 8 then 65535 else value end * 1000) as bigint) as varchar), ',' order by pos) as b2
    from v where band = 'B2' group by 1
""")
def mask_from_position(t: Tables) -> DataFrame:
    rows = _window_inputs(t)
    return rows.select("sample_id", _texts(arrays.masked_from(F.col("B2"), 8)).alias("b2"))


_UNIFORM = "((" + _HASH.format(seed="{0}", key="cast(sample_id as varchar)") + " + 0.5) / 4294967296.0)"
_BETA = f"""
    u as (select distinct sample_id, {', '.join(_UNIFORM.format(11 + k) + f'::double as u{k}' for k in range(5))} from fx_series),
    g as (select sample_id, -ln(u0) - ln(u3) * cos(2 * pi() * u4) * cos(2 * pi() * u4) as a,
          -ln(u1) - ln(u2) - ln(u3) * sin(2 * pi() * u4) * sin(2 * pi() * u4) as b from u),
    k as (select sample_id, greatest(4, least(15, cast(floor(4 + a / (a + b) * 11) as int))) as k from g)
"""


@query(f"""
    {_PACKED}, {_BETA} select sample_id, max(k) as masked_from,
    string_agg(cast(cast(round(case when pos >= k then 65535 else value end * 1000) as bigint) as varchar), ',' order by pos) as b2
    from v join k using (sample_id) where band = 'B2' group by 1
""")
def mask_random(t: Tables) -> DataFrame:
    """Series masked from a position on that is drawn for each sample, early ones likelier."""
    rows = _window_inputs(t).withColumn("masked_from", arrays.mask_position(4, SERIES_STEPS - 1, 11, F.col("sample_id")))
    return rows.select("sample_id", "masked_from", _texts(arrays.masked_from(F.col("B2"), F.col("masked_from"))).alias("b2"))


@query(f"""
    {_PACKED} select sample_id, cast(12 as int) as n_steps, cast(12 * 65535 as bigint) as total,
    max(case when pos = 0 then cast(round(value * 1000) as bigint) end) as elevation, cast(65535 as bigint) as slope
    from v where band = 'B2' group by 1
""")
def missing_bands(t: Tables) -> DataFrame:
    """Bands that a sample lacks are all no data; a band of terrain is its series' first value."""
    rows = _window_inputs(t).withColumn("elevation", F.col("B2"))
    inputs_ = inputs.model_inputs(rows, LENGTH, "month").select("sample_id", "inputs")
    empty = F.col("inputs.s1.VH")
    return inputs_.select(
        "sample_id", F.size(empty).alias("n_steps"), F.aggregate(empty, F.lit(0.0), lambda s, v: s + v).cast("bigint").alias("total"),
        F.round(F.col("inputs.dem.elevation") * 1000).cast("bigint").alias("elevation"), F.col("inputs.dem.slope").cast("bigint").alias("slope"),
    )


@query("select sample_id, pos, round(greatest(-0.5, least(0.5, value)), 6) as value from fx_series where value is not null")
def clip_values(t: Tables) -> DataFrame:
    rows = t("fx_series").where("value is not null")
    return rows.select("sample_id", "pos", F.round(arrays.clip(F.col("value"), -0.5, 0.5), 6).alias("value"))


@query("""
    select sample_id, pos, max(value) filter (band = 'B2') as "B2", max(value) filter (band = 'B8') as "B8", max(value) filter (band = 'VV') as "VV"
    from fx_series group by 1, 2
""")
def bands_pivot(t: Tables) -> DataFrame:
    return inputs.bands_as_columns(t("fx_series"), ["sample_id", "pos"], ["B2", "B8", "VV"])


@query("select sample_id, pos, band, value from fx_series where band in ('B2', 'B8', 'VV') and value is not null")
def bands_unpivot(t: Tables) -> DataFrame:
    names = ["B2", "B8", "VV"]
    return inputs.columns_as_bands(bands_pivot(t), ["sample_id", "pos"], names)


# --- windows and labels


@query(f"""
    with {_SAMPLES} select sample_id, cast(greatest(0, least(valid_position - 6, available_timesteps - 12)) as int) as start,
    valid_position - greatest(0, least(valid_position - 6, available_timesteps - 12)) as label_position
    from s where available_timesteps >= 12
""")
def timestep_window(t: Tables) -> DataFrame:
    start = arrays.window_start(F.col("valid_position"), F.col("available_timesteps"), LENGTH)
    rows = long_samples(t).select("sample_id", "valid_position", start.cast("int").alias("start"))
    return rows.select("sample_id", "start", (F.col("valid_position") - F.col("start")).alias("label_position"))


_DRAWN = (
    "greatest(valid_position - 11, 0) + cast(" + _HASH.format(seed=5, key="sample_id")
    + " % (least(valid_position, available_timesteps - 12) - greatest(valid_position - 11, 0) + 1) as int)"
)


@query(f"with {_SAMPLES} select sample_id, {_DRAWN} as start, valid_position - ({_DRAWN}) as label_position from s where available_timesteps >= 12 and valid_position < available_timesteps")
def timestep_window_augmented(t: Tables) -> DataFrame:
    start = arrays.augmented_start(F.col("valid_position"), F.col("available_timesteps"), LENGTH, 5, F.col("sample_id"))
    rows = long_samples(t).where("valid_position < available_timesteps").select("sample_id", "valid_position", start.alias("start"))
    return rows.select("sample_id", "start", (F.col("valid_position") - F.col("start")).alias("label_position"))


_CLASS = "case finetune_class " + " ".join(f"when '{c}' then {i}" for i, c in enumerate(CLASSES)) + " end"


def _label_sql(low: str, high: str) -> str:
    return f"""
        with {_SAMPLES}, p as (select cast(unnest(range(0, 12)) as int) as pos)
        select sample_id, string_agg(case when pos >= {low} and pos <= {high} then cast({_CLASS} as varchar) else '65535' end, ',' order by pos) as label
        from s, p where available_timesteps >= 12 group by sample_id
    """


def _label(t: Tables, low: Column | None, high: Column | None) -> DataFrame:
    value = arrays.class_index(F.col("finetune_class"), CLASSES)
    label = arrays.label_vector(value, LENGTH, low, high)
    return long_samples(t).select("sample_id", F.array_join(label.cast("array<string>"), ",").alias("label"))


@query(_label_sql("0", "11"))
def label_vector(t: Tables) -> DataFrame:
    return _label(t, None, None)


@query(_label_sql("valid_position - 1", "valid_position + 1"))
def label_window(t: Tables) -> DataFrame:
    value = arrays.class_index(F.col("finetune_class"), CLASSES)
    label = arrays.label_positions(F.array("valid_position"), LENGTH, value, window=1)
    return long_samples(t).select("sample_id", F.array_join(label.cast("array<string>"), ",").alias("label"))


@query(f"""
    with {_SAMPLES}, p as (select cast(unnest(range(0, 12)) as int) as pos),
    q as (select sample_id, cast({_CLASS} as varchar) as y, valid_position as a, (valid_position + 3) % 12 as b,
          {_HASH.format(seed=7, key='sample_id')} % 3 - 1 as move, {_HASH.format(seed=8, key='sample_id')} % 2 as pick
          from s where available_timesteps >= 12),
    h as (select sample_id, y, pos, pos in (a, b) as exact, pos between least(a, b) - 1 and greatest(a, b) + 1 as wide,
          case when pick = 0 then pos in (greatest(0, least(11, a + move)), greatest(0, least(11, b + move)))
               else pos between least(a, b) - 1 and greatest(a, b) + 1 end as either from q, p)
    select sample_id, string_agg(case when exact then y else '65535' end, ',' order by pos) as exact,
           string_agg(case when wide then y else '65535' end, ',' order by pos) as wide,
           string_agg(case when either then y else '65535' end, ',' order by pos) as either
    from h group by 1
""")
def label_positions(t: Tables) -> DataFrame:
    """Labels at two positions, mostly with a gap: as they are, widened, and moved or widened."""
    value, at = arrays.class_index(F.col("finetune_class"), CLASSES), F.col("valid_position")
    positions = F.array(at, ((at + 3) % LENGTH).cast("int"))
    kinds = {"exact": {}, "wide": {"window": 1}, "either": {"window": 1, "jitter": 1, "seed": 7, "key": F.col("sample_id")}}
    labels = {name: arrays.label_positions(positions, LENGTH, value, **options) for name, options in kinds.items()}
    texts = [F.array_join(label.cast("array<string>"), ",").alias(name) for name, label in labels.items()]
    return long_samples(t).select("sample_id", *texts)


_MOVED = f"least(11, greatest(0, valid_position + {_HASH.format(seed=7, key='sample_id')} % 5 - 2))"


@query(f"""
    with {_SAMPLES}, p as (select cast(unnest(range(0, 12)) as int) as pos)
    select sample_id, string_agg(case when available_timesteps % 2 = 0 or pos between {_MOVED} - 1 and {_MOVED} + 1
                                 then cast({_CLASS} as varchar) else '65535' end, ',' order by pos) as label,
    string_agg(cast({_CLASS} as varchar), ',') filter (pos = 0) as whole
    from s, p where available_timesteps >= 12 group by 1
""")
def label_scalar(t: Tables) -> DataFrame:
    """Labels at one position, moved and then widened; everywhere without one; and one for a whole sample."""
    value = arrays.class_index(F.col("finetune_class"), CLASSES)
    at = F.when(F.col("available_timesteps") % 2 == 1, F.col("valid_position"))
    label = arrays.label_at(at, LENGTH, value, jitter=2, window=1, seed=7, key=F.col("sample_id"))
    whole = arrays.label_vector(value, 1)
    return long_samples(t).select(
        "sample_id", *[F.array_join(x.cast("array<string>"), ",").alias(n) for n, x in (("label", label), ("whole", whole))]
    )


_JITTER = f"least(11, greatest(0, valid_position + {_HASH.format(seed=7, key='sample_id')} % 5 - 2))"


@query(_label_sql(_JITTER, _JITTER))
def label_jitter(t: Tables) -> DataFrame:
    at = arrays.jittered(F.col("valid_position"), LENGTH, 2, 7, F.col("sample_id"))
    return _label(t, at, at)


@query(f"with {_SAMPLES} select sample_id, {_CLASS} as y from s")
def class_index(t: Tables) -> DataFrame:
    return samples(t).select("sample_id", arrays.class_index(F.col("finetune_class"), CLASSES).alias("y"))


@query("select o_orderkey, case o_orderkey % 4 when 0 then 'a' when 1 then 'b' when 2 then 'c' else 'unknown' end as cls from orders")
def index_to_class(t: Tables) -> DataFrame:
    index = F.when(F.col("o_orderkey") % 4 == 3, bands.NODATA).otherwise(F.col("o_orderkey") % 4)
    return t("orders").select("o_orderkey", arrays.index_class(index, ["a", "b", "c"]).alias("cls"))


# --- dates


@query("""
    select sample_id, cast(make_date(year(start_ts), month(start_ts),
        case when day(start_ts) <= 10 then 1 when day(start_ts) <= 20 then 11 else 21 end) as varchar) as d
    from fx_samples
""")
def align_dekad(t: Tables) -> DataFrame:
    return t("fx_samples").select("sample_id", dates.align(F.col("start_ts"), "dekad").cast("string").alias("d"))


@query("select sample_id, cast(date_trunc('month', start_ts)::date as varchar) as d from fx_samples")
def align_month(t: Tables) -> DataFrame:
    return t("fx_samples").select("sample_id", dates.align(F.col("start_ts"), "month").cast("string").alias("d"))


def _stamps(t: Tables, frequency: str) -> DataFrame:
    start = F.to_date("start_ts")
    found = dates.timestamps(start, F.date_add(start, 100), frequency)
    texts = F.transform(found, lambda d: F.concat_ws("/", d["day"], d["month"], d["year"]))
    return t("fx_samples").select("sample_id", F.array_join(texts, ",").alias("stamps"))


@query("""
    with m as (select sample_id, unnest(generate_series(date_trunc('month', start_ts)::date::timestamp,
        date_trunc('month', start_ts::date + 100)::timestamp, interval 1 month)) as d from fx_samples)
    select sample_id, string_agg(strftime(d, '%-d/%-m/%Y'), ',' order by d) as stamps from m group by 1
""")
def monthly_timestamps(t: Tables) -> DataFrame:
    return _stamps(t, "month")


@query("""
    with b as (select sample_id, start_ts::date as a, start_ts::date + 100 as z from fx_samples),
    m as (select sample_id, a, z, unnest(generate_series(date_trunc('month', a)::timestamp, date_trunc('month', z)::timestamp, interval 1 month))::date as f from b),
    d as (select sample_id, f + unnest([0, 10, 20]) as d,
          make_date(year(a), month(a), case when day(a) <= 10 then 1 when day(a) <= 20 then 11 else 21 end) as lo,
          make_date(year(z), month(z), case when day(z) <= 10 then 1 when day(z) <= 20 then 11 else 21 end) as hi from m)
    select sample_id, string_agg(strftime(d, '%-d/%-m/%Y'), ',' order by d) as stamps from d where d between lo and hi group by 1
""")
def dekad_timestamps(t: Tables) -> DataFrame:
    return _stamps(t, "dekad")


# --- splits, folds and weights


@query("""
    select sample_id, case when o_orderkey % 10 = 0 then 'val' when o_orderkey % 10 = 1 then 'test' else 'train' end as split
    from fx_samples
""")
def split_by_ids(t: Tables) -> DataFrame:
    rows = t("fx_samples")
    val, test = (rows.where(F.col("o_orderkey") % 10 == k).select("sample_id") for k in (0, 1))
    return splits.split_by_ids(rows, "sample_id", val, test).select("sample_id", "split")


_BUCKET = _HASH.format(seed=42, key="sample_id")
_SPLIT = f"case when {_BUCKET} % 100 < 70 then 'train' when {_BUCKET} % 100 < 85 then 'val' else 'test' end"


@query(f"select sample_id, {_SPLIT} as split from fx_samples")
def random_split(t: Tables) -> DataFrame:
    return t("fx_samples").select("sample_id", splits.random_split(F.col("sample_id")).alias("split"))


@query(f"select {_SPLIT} as split, count(*) as n from fx_samples group by 1")
def split_sizes(t: Tables) -> DataFrame:
    return splits.split_sizes(t("fx_samples").withColumn("split", splits.random_split(F.col("sample_id"))))


@query(f"with {_SAMPLES} select sample_id, finetune_class from s where {_SPLIT} in ('train', 'val')")
def union_splits(t: Tables) -> DataFrame:
    rows = samples(t).withColumn("split", splits.random_split(F.col("sample_id")))
    parts = [rows.where(F.col("split") == name).select("sample_id", "finetune_class") for name in ("train", "val")]
    return tables.union_splits(*parts)


@query(f"""
    with {_SAMPLES} select sample_id, finetune_class,
    cast((row_number() over (partition by finetune_class order by {_BUCKET}, sample_id) - 1) % 5 as int) as fold from s
""")
def stratified_kfold(t: Tables) -> DataFrame:
    return splits.stratified_folds(samples(t), "finetune_class", "sample_id").select("sample_id", "finetune_class", "fold")


_COUNTS = f"{_SAMPLES}, c as (select finetune_class, count(*) as n from s group by 1)"
_BALANCED = "(select sum(n) from c) / (select count(*) from c) / n"
_WEIGHTS = f"{_COUNTS}, b as (select finetune_class, n, {_BALANCED} as w from c), w as (select finetune_class, n, w / (select avg(w) from b) as weight from b)"


@query(f"with {_WEIGHTS} select finetune_class, n, round(weight, 6) as weight from w")
def class_weights_balanced(t: Tables) -> DataFrame:
    found = splits.class_weights(samples(t), "finetune_class")
    return found.withColumn("weight", F.round("weight", 6))


@query(f"with {_COUNTS} select finetune_class, n, round(least(1.0, greatest(0.2, ln((select sum(n) from c) / n))), 6) as weight from c")
def class_weights_log(t: Tables) -> DataFrame:
    found = splits.class_weights(samples(t), "finetune_class", "log", (0.2, 1.0), normalize=False)
    return found.withColumn("weight", F.round("weight", 6))


@query(f"with {_WEIGHTS} select sample_id, round(coalesce(w.weight, 1.0), 6) as weight from s left join w using (finetune_class)")
def sample_weights(t: Tables) -> DataFrame:
    rows = samples(t)
    weighted = splits.sample_weights(rows, "finetune_class", splits.class_weights(rows, "finetune_class"))
    return weighted.select("sample_id", F.round("weight", 6).alias("weight"))


@query(f"""
    with {_WEIGHTS}, r as (select sample_id, finetune_class, weight, row_number() over (partition by finetune_class order by {_BUCKET}, sample_id) as i,
        (select sum(n) from w) * weight / (select sum(n * weight) from w) as rate from s join w using (finetune_class)),
    k as (select sample_id, finetune_class, cast(floor(i * rate + 0.5) - floor((i - 1) * rate + 0.5) as bigint) as copies from r)
    select * from k where copies > 0
""")
def balanced_resample(t: Tables) -> DataFrame:
    rows = samples(t)
    weights = splits.class_weights(rows, "finetune_class")
    drawn = splits.balanced_resample(rows, "finetune_class", "sample_id", weights)
    return drawn.select("sample_id", "finetune_class", "copies")


# --- evaluation


_MATRIX = """
    names as (select y_true as c from {0} union select y_pred from {0}),
    m as (select a.c as t, b.c as p, (select count(*) from {0} x where x.y_true = a.c and x.y_pred = b.c) as n from names a, names b)
"""
_FIGURES = (
    _MATRIX
    + """,
    f0 as (select c, coalesce((select n from m where t = c and p = c), 0) as hits,
           cast((select sum(n) from m where t = c) as double) as support,
           cast((select sum(n) from m where p = c) as double) as predicted from names),
    f1 as (select *, case when predicted > 0 then hits / predicted else 0 end as precision,
           case when support > 0 then hits / support else 0 end as recall from f0),
    f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1 from f1)
"""
)


def _matrix(t: Tables, view: str = "fx_pred") -> DataFrame:
    return evaluate.confusion_matrix(t(view), "y_true", "y_pred")


@query(f"with {_MATRIX.format('fx_pred')} select t as true_class, p as pred_class, n from m")
def confusion_matrix(t: Tables) -> DataFrame:
    return _matrix(t)


@query(f"""
    with {_MATRIX.format('fx_pred')} select t as true_class, p as pred_class, n,
    round(case when sum(n) over (partition by t) > 0 then n / sum(n) over (partition by t) else 0 end, 6) as share from m
""")
def confusion_matrix_norm(t: Tables) -> DataFrame:
    return evaluate.normalised(_matrix(t)).withColumn("share", F.round("share", 6))


_REPORT = """
    a as (select sum(hits) / sum(support) as acc from f),
    rep as (select c as class, precision, recall, f1, support from f
    union all select 'accuracy', acc, acc, acc, acc from a
    union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from f
    union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
              sum(f1 * support) / sum(support), sum(support) from f)
    select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, round(support, 6) as support from rep
"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "support")])


@query(f"with {_FIGURES.format('fx_pred')}, {_REPORT}")
def classification_report(t: Tables) -> DataFrame:
    return _rounded(evaluate.classification_report(_matrix(t)))


@query(f"""
    with {_FIGURES.format('fx_pred_bin')} select round_even((select sum(hits) / sum(support) from f), 3) as "OA", round_even(f1, 3) as "F1",
    round_even(precision, 3) as precision, round_even(recall, 3) as recall from f where c = 'cropland'
""")
def summary_metrics_binary(t: Tables) -> DataFrame:
    positive = classes.class_order(["cropland", "other"])[1]
    return evaluate.summary_metrics(_matrix(t, "fx_pred_bin"), positive)


@query(f"""
    with {_FIGURES.format('fx_pred')} select round_even(sum(hits) / sum(support), 3) as "OA", round_even(avg(f1), 3) as "F1",
    round_even(avg(precision), 3) as precision, round_even(avg(recall), 3) as recall from f
""")
def summary_metrics_multi(t: Tables) -> DataFrame:
    return evaluate.summary_metrics(_matrix(t))


@query(f"""
    with {_SAMPLES}, p as (select cast(unnest(range(0, 12)) as int) as pos)
    select {_CLASS} as y_true, cast((o_orderkey + pos) % 5 as int) as y_pred, count(*) as n
    from s, p where available_timesteps >= 12 and pos between valid_position - 1 and valid_position + 1 group by 1, 2
""")
def time_explicit_eval(t: Tables) -> DataFrame:
    value, at = arrays.class_index(F.col("finetune_class"), CLASSES), F.col("valid_position")
    places = F.sequence(F.lit(0), F.lit(LENGTH - 1))
    rows = long_samples(t).select(
        arrays.label_vector(value, LENGTH, at - 1, at + 1).alias("y_true"),
        F.transform(places, lambda p: ((F.col("o_orderkey") + p) % 5).cast("int")).alias("y_pred"),
    )
    return evaluate.valid_timesteps(rows, "y_true", "y_pred").groupBy("y_true", "y_pred").agg(F.count("*").alias("n"))


@query("select sample_id, round(1 / (1 + exp(-l0)), 6) as prob, cast(1 / (1 + exp(-l0)) > 0.5 as int) as y from fx_logits")
def sigmoid_threshold(t: Tables) -> DataFrame:
    prob = arrays.sigmoid(F.col("l0"))
    return t("fx_logits").select("sample_id", F.round(prob, 6).alias("prob"), (prob > 0.5).cast("int").alias("y"))


_SOFTMAX = """
    e as (select *, exp(l0 - greatest(l0, l1, l2)) as a, exp(l1 - greatest(l0, l1, l2)) as b, exp(l2 - greatest(l0, l1, l2)) as c from fx_logits),
    p as (select sample_id, label, greatest(a, b, c) / (a + b + c) as prob,
          case when a >= b and a >= c then 0 when b >= c then 1 else 2 end as y from e)
"""


@query(f"with {_SOFTMAX} select sample_id, round(prob, 6) as prob, y from p")
def softmax_argmax(t: Tables) -> DataFrame:
    p = arrays.softmax(F.array("l0", "l1", "l2"))
    rows = t("fx_logits").withColumn("p", p)
    return rows.select("sample_id", F.round(F.array_max("p"), 6).alias("prob"), arrays.argmax(F.col("p")).alias("y"))


@query(f"""
    with {_SOFTMAX}, q as (select case label % 3 when 0 then 'a' when 1 then 'b' else 'c' end as y_true,
        case y when 0 then 'a' when 1 then 'b' else 'c' end as y_pred from p),
    {_FIGURES.format('q')}, {_REPORT}
""")
def evaluate_predictions(t: Tables) -> DataFrame:
    names = ["a", "b", "c"]
    rows = t("fx_logits").withColumn("logits", F.array("l0", "l1", "l2"))
    rows = evaluate.multiclass_predictions(rows, "logits", names)
    rows = rows.withColumn("y_true", arrays.index_class(F.col("label") % 3, names))
    return _rounded(evaluate.classification_report(evaluate.confusion_matrix(rows, "y_true", "y_pred")))


_USABLE = "embedding is not null and label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def usable(t: Tables) -> DataFrame:
    """Labelled embeddings whose components are all numbers."""
    return t("embeddings").where(F.col("label").isNotNull() & scoring.usable("embedding"))


@query(f"""
    with k as (select unnest([16, 32, 64]) as masked_from),
    e as (select masked_from, label, list_transform(range(1, 65), lambda i: case when i > masked_from then 0 else embedding[i]::double end) as v
          from embeddings, k where {_USABLE}),
    q as (select masked_from, case label % 3 when 0 then 'a' when 1 then 'b' else 'c' end as y_true,
          case (list_position(v, list_max(v)) - 1) % 3 when 0 then 'a' when 1 then 'b' else 'c' end as y_pred from e),
    names as (select masked_from, y_true as c from q union select masked_from, y_pred from q),
    f0 as (select n.masked_from, c, count(*) filter (y_true = c and y_pred = c) as hits, cast(count(*) filter (y_true = c) as double) as support,
           cast(count(*) filter (y_pred = c) as double) as predicted from names n join q using (masked_from) group by 1, 2),
    f1 as (select *, case when predicted > 0 then hits / predicted else 0 end as precision,
           case when support > 0 then hits / support else 0 end as recall from f0),
    f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1 from f1),
    a as (select masked_from, sum(hits) / sum(support) as acc from f group by 1),
    rep as (select masked_from, c as class, precision, recall, f1, support from f
    union all select masked_from, 'accuracy', acc, acc, acc, acc from a
    union all select masked_from, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from f group by 1
    union all select masked_from, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
              sum(f1 * support) / sum(support), sum(support) from f group by 1)
    select masked_from, class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, round(support, 6) as support from rep
""")
def masked_evaluation(t: Tables) -> DataFrame:
    """A report for each position from which a sample's embedding is masked; the place of the largest
    value that is left tells the class.
    """
    names = ["a", "b", "c"]
    rows = usable(t).select(F.col("embedding").cast("array<double>").alias("series"), arrays.index_class(F.col("label") % 3, names).alias("y_true"))

    def predict(df: DataFrame, series: str) -> DataFrame:
        seen = F.transform(F.col(series), lambda v: F.when(v == bands.NODATA, 0.0).otherwise(v))
        return df.withColumn("y_pred", arrays.index_class(arrays.argmax(seen) % 3, names))

    reports = evaluate.masked_reports(rows, "series", "y_true", [16, 32, 64], predict)
    return reports.select("masked_from", "class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "support")])


# --- scoring


DIMENSIONS = 64


@query("select vec_id, label, " + ", ".join(f"embedding[{i + 1}]::double as emb_{i}" for i in range(DIMENSIONS)) + " from embeddings")
def embedding_columns(t: Tables) -> DataFrame:
    rows = t("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return scoring.embedding_columns(rows, "embedding", DIMENSIONS)


@query("""
    select o_orderkey, case when o_orderstatus = 'F' then o_orderpriority end as croptype, cast(coalesce(o_orderstatus = 'F', false) as int) as cropland_mask
    from orders
""")
def mask_croptype(t: Tables) -> DataFrame:
    rows = t("orders").select("o_orderkey", F.col("o_orderstatus").alias("landcover"), F.col("o_orderpriority").alias("croptype"))
    return scoring.mask_crop_type(rows, cropland="F").select("o_orderkey", "croptype", "cropland_mask")


@query("select cast(floor(median(o_custkey % 40 + 1)) as int) as iterations from orders")
def median_iterations(t: Tables) -> DataFrame:
    return scoring.median_iterations(t("orders").select((F.col("o_custkey") % 40 + 1).alias("best")), "best")


@query("""
    with b as (select band as name, round(sum(cast(round(abs(value) * 1000000) as bigint)) / 1000) / 1000000 as importance from fx_series group by 1)
    select name, importance, cast(rank() over (order by importance desc) as int) as rank from b
""")
def importance_rank(t: Tables) -> DataFrame:
    rows = t("fx_series").groupBy(F.col("band").alias("name")).agg(
        # sums of whole numbers, so that their order does not matter
        (F.round(F.sum(F.round(F.abs("value") * 1_000_000).cast("bigint")) / 1000) / 1_000_000).alias("importance")
    )
    return scoring.importance_table(rows)


_H42 = _HASH.format(seed=42, key="cast(sample_id as varchar)")


@query(f"""
    {_PACKED}, o as (select distinct sample_id, cast(sample_id % 16 as int) as vp, {_SPLIT.replace('sample_id', 'cast(sample_id as varchar)')} as split,
        {_H42} as h from fx_series),
    w as (select *, case when split = 'train' then greatest(vp - 11, 0) + cast(h % (least(vp, 4) - greatest(vp - 11, 0) + 1) as int)
                    else greatest(0, least(vp - 6, 4)) end as s from o),
    l as (select *, case when split = 'train' then least(11, greatest(0, vp - s + cast(h % 3 as int) - 1)) else vp - s end as place,
          case when split = 'train' then 1 else 0 end as wide from w)
    select l.sample_id, split, max(vp - s) as label_position,
    string_agg(case when pos - s between place - wide and place + wide then cast(l.sample_id % 5 as varchar) else '65535' end, ',' order by pos) as label,
    string_agg(cast(cast(round(value * 1000) as bigint) as varchar), ',' order by pos) as b2
    from l join v using (sample_id) where band = 'B2' and pos >= s and pos < s + 12 group by 1, 2
""")
def training_inputs(t: Tables) -> DataFrame:
    """Label vectors and windows by split: augmented with jitter for train, plain otherwise."""
    rows = _window_inputs(t).withColumns(
        {
            "finetune_class": F.element_at(F.array(*map(F.lit, CLASSES)), (F.col("sample_id") % 5 + 1).cast("int")),
            "split": splits.random_split(F.col("sample_id")),
        }
    )
    rows = inputs.training_inputs(rows, LENGTH, "month", CLASSES, jitter=1, window=1)
    return rows.select(
        "sample_id", "split", "label_position",
        F.array_join(F.col("label").cast("array<string>"), ",").alias("label"),
        _texts(F.col("inputs.s2.B2")).alias("b2"),
    )


def _labelled(t: Tables) -> DataFrame:
    return usable(t).select(
        "vec_id", "embedding", F.concat(F.lit("class_"), (F.col("label") % 2).cast("string")).alias("finetune_class")
    )


def load_mean_encoder():
    """An encoder for :func:`scoring.embed` that keeps the means of pairs of values."""

    def encode(series):
        return series.reshape(len(series), -1, 2).mean(axis=2, dtype="f8")

    return encode


@query(
    "select vec_id, "
    + ", ".join(f"cast((embedding[{2 * i + 1}]::double + embedding[{2 * i + 2}]::double) / 2 as float) as emb_{i}" for i in range(DIMENSIONS // 2))
    + f" from embeddings where {_USABLE}"
)
def batch_embedding(t: Tables) -> DataFrame:
    encoded = scoring.embed(usable(t), load_mean_encoder, "vec_id", "embedding")
    return scoring.embedding_columns(encoded, "embedding", DIMENSIONS // 2)


@query()
def pixel_scoring(t: Tables) -> DataFrame:
    """Two fitted models in turn on each row, land cover and crop type, and the mask of the first."""
    rows = _labelled(t).withColumns({"weight": F.lit(1.0), "kind": F.concat(F.lit("crop_"), (F.col("vec_id") % 3).cast("string"))})
    cover = scoring.fit_classifier(rows, "finetune_class", 2)
    kind = scoring.fit_classifier(rows, "kind", 3, trees=5)
    scored = scoring.predict(rows, cover).select("vec_id", "embedding", F.col("y_pred").alias("landcover"))
    scored = scoring.predict(scored, kind).withColumnRenamed("y_pred", "croptype")
    return scoring.mask_crop_type(scored, cropland="class_1").select("vec_id", "landcover", "croptype", "cropland_mask")


def _weighted(t: Tables) -> DataFrame:
    rows = _labelled(t)
    return splits.sample_weights(rows, "finetune_class", splits.class_weights(rows, "finetune_class"))


MOST, PATIENCE, FOLDS = 8, 2, 3


@query()
def classifier_kfold(t: Tables) -> DataFrame:
    """The loss of each fold after each tree of a weighted classifier, and the size of least loss; the median is in each row."""
    table, size = scoring.select_by_folds(_weighted(t), "finetune_class", "vec_id", 2, MOST, PATIENCE, FOLDS)
    return table.withColumn("median", F.lit(size))


@query(f"""
    with e as (select vec_id, concat('class_', cast(label % 3 as varchar)) as true_class from embeddings
               where {_USABLE} and {_SPLIT.replace('sample_id', 'cast(vec_id as varchar)')} = 'test')
    select true_class, count(*) as n from e group by 1
""")
def classifier_test(t: Tables) -> DataFrame:
    """How often each of three classes stands in the confusion matrix of the test split, by a classifier
    whose size folds of the other rows select.
    """
    rows = usable(t).select("vec_id", "embedding", F.concat(F.lit("class_"), (F.col("label") % 3).cast("string")).alias("finetune_class"))
    rows = splits.sample_weights(rows, "finetune_class", splits.class_weights(rows, "finetune_class"))
    rows = rows.withColumn("split", splits.random_split(F.col("vec_id")))
    train, test = rows.where("split <> 'test'").drop("split"), rows.where("split = 'test'").drop("split")
    _, predicted = scoring.fit_and_test(train, test, "finetune_class", "vec_id", 3, 4, PATIENCE, 2)
    matrix = evaluate.confusion_matrix(predicted, "finetune_class", "y_pred")
    return matrix.groupBy("true_class").agg(F.sum("n").cast("bigint").alias("n")).where("n > 0")


def load_sum_encoder():
    """A linear encoder for :func:`records.embed_records`: sums of whole parts of two bands, weighted by step, and the slope."""

    def encode(blocks):
        steps = np.arange(1, blocks["s2"].shape[1] + 1)
        b2, vv = np.floor(blocks["s2"][:, :, bands.OPTICAL.index("B2")]), np.floor(blocks["s1"][:, :, bands.SAR.index("VV")])
        return np.stack([(b2 * (b2 != bands.NODATA)) @ steps, (vv * (vv != bands.NODATA)) @ steps, blocks["timestamps"][:, 0, 1]], 1)

    return encode


@query(f"""
    {_PACKED}, w as (select *, greatest(0, least(cast(sample_id % 16 as int) - 6, 4)) as s from v),
    u as (select *, pos - s + 1 as step, floor(case when band = 'VV' and value > 0 and value <> 65535 then 20 * log10(value) - 83 else value end) as whole
          from w where pos >= s and pos < s + 12)
    select sample_id,
    cast(coalesce(sum(whole * step) filter (band = 'B2' and whole <> 65535), 0) as float) as emb_0,
    cast(coalesce(sum(whole * step) filter (band = 'VV' and whole <> 65535), 0) as float) as emb_1,
    cast(extract(month from date '2021-01-01' + to_months(cast(max(s) as int))) as float) as emb_2
    from u group by 1
""")
def record_embedding(t: Tables) -> DataFrame:
    """From records of model inputs to embeddings by a linear encoder, in batches of 100."""
    rows = inputs.model_inputs(_window_inputs(t), LENGTH, "month")
    encoded = records.embed_records(rows, load_sum_encoder, LENGTH, batch=100)
    return scoring.embedding_columns(encoded, "embedding", 3)


@query()
def feature_importance(t: Tables) -> DataFrame:
    rows = _labelled(t).withColumn("weight", F.lit(1.0))
    return scoring.feature_importance(t.spark, scoring.fit_classifier(rows, "finetune_class", 2))
