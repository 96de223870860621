"""Model inputs from series of samples, wide, long or packed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, bands, dates


def pack_wide(df: DataFrame, names: list[str], timesteps: int) -> DataFrame:
    """``df`` with an array for each band in place of its timestep columns; one projection."""
    wide = {bands.BAND_COLUMNS[b].format(t) for b in names for t in range(timesteps)}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in wide]
    return df.select(*rest, *[bands.packed(b, timesteps).alias(b) for b in names])


def pack_long(df: DataFrame, key: str, names: list[str], timesteps: int) -> DataFrame:
    """An array for each band from rows (key, pos, band, value); a missing value is no data."""
    value = F.map_from_entries(
        F.collect_list(F.when(F.col("band").isin(names), F.struct(F.concat_ws("@", "band", "pos"), "value")))
    )
    packed = df.groupBy(key).agg(value.alias("__v"))
    places = F.sequence(F.lit(0), F.lit(timesteps - 1))

    def series(band: str) -> Column:
        at = F.transform(places, lambda t: F.try_element_at("__v", F.concat(F.lit(f"{band}@"), t.cast("string"))))
        return F.transform(at, lambda v: F.coalesce(v.cast("double"), F.lit(float(bands.NODATA))))

    return packed.select(key, *[series(b).alias(b) for b in names])


def widen(df: DataFrame, key: str, names: list[str], timesteps: int) -> DataFrame:
    """Rows (key, pos, band, value) as a column for each band and timestep."""
    columns = [
        F.max(F.when((F.col("band") == b) & (F.col("pos") == t), F.col("value"))).alias(bands.BAND_COLUMNS[b].format(t))
        for b in names
        for t in range(timesteps)
    ]
    return df.groupBy(key).agg(*columns)


def unknown_bands(df: DataFrame) -> DataFrame:
    """Distinct bands that aren't in the band table."""
    return df.select("band").where(~F.col("band").isin(list(bands.BAND_COLUMNS))).distinct()


def bands_as_columns(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return df.groupBy(*keys).pivot("band", names).agg(F.first("value"))


def columns_as_bands(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return df.unpivot(keys, names, "band", "value").where(F.col("value").isNotNull())


def model_inputs(
    df: DataFrame, length: int, frequency: str, augment: bool | Column = False, seed: int = 42, key: str = "sample_id"
) -> DataFrame:
    """``df`` with ``inputs``: s1, s2, meteo, dem, latlon and timestamps of ``length`` steps in units.

    Series are arrays named by band; a band that ``df`` lacks is all no data. The window holds
    ``valid_position``: as central as can be, or drawn by a hash where ``augment`` is true.
    Also adds ``label_position``, the valid position within the window.
    """
    vp, available = F.col("valid_position"), F.col("available_timesteps")
    central = arrays.window_start(vp, available, length)
    drawn = arrays.augmented_start(vp, available, length, seed, F.col(key))
    choose = augment if isinstance(augment, Column) else F.lit(augment)
    df = df.withColumn("__start", F.when(choose, drawn).otherwise(central).cast("int"))
    start = F.col("__start")

    def series(band: str) -> Column:
        if band not in df.columns:
            return bands.no_values(length)
        window = arrays.window_of(F.col(band), start, length)
        return F.transform(window, lambda v: bands.in_units(band, v))

    def constant(band: str) -> Column:
        if band not in df.columns:
            return F.lit(float(bands.NODATA))
        column = F.col(band)
        return F.get(column, F.lit(0)) if dict(df.dtypes)[band].startswith("array") else column.cast("double")

    def group(names) -> Column:
        return F.struct(*[series(b).alias(b) for b in names])

    stamps = arrays.window_of(dates.timestamps(F.col("start_date"), F.col("end_date"), frequency), start, length)
    inputs = F.struct(
        group(bands.SAR).alias("s1"),
        group(bands.OPTICAL).alias("s2"),
        group(bands.METEO).alias("meteo"),
        F.struct(*[constant(b).alias(b) for b in bands.DEM]).alias("dem"),
        F.struct(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).alias("latlon"),
        stamps.alias("timestamps"),
    )
    return df.withColumns({"inputs": inputs, "label_position": vp - start}).drop("__start")


def training_inputs(df: DataFrame, length: int, frequency: str, classes: list[str], jitter: int = 0, window: int = 0, seed: int = 42) -> DataFrame:
    """:func:`model_inputs` with ``label``, by ``split``: train with augmented windows, jitter and
    label windows; the other splits without.
    """
    train = F.col("split") == "train"
    rows = model_inputs(df, length, frequency, augment=train, seed=seed)
    at = F.col("label_position")
    moved = arrays.jittered(at, length, jitter, seed, F.col("sample_id")) if jitter else at
    at = F.when(train, moved).otherwise(at)
    width = F.when(train, window).otherwise(0)
    value = arrays.class_index(F.col("finetune_class"), classes)
    return rows.withColumn("label", arrays.label_vector(value, length, at - width, at + width))
