"""Labels, names and codes in text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def triage(label: Column) -> Column:
    """What a survey label is: ``no_dominant``, ``mixed`` or ``clean``; the first rule that fits."""
    label = F.coalesce(label, F.lit("nan"))
    return (
        F.when(label.contains("no_dominant"), "no_dominant")
        .when(label.contains("yes"), "mixed")
        .when(label.contains(" "), "no_dominant")
        .otherwise("clean")
    )


def label_tokens(label: Column) -> Column:
    """The crops that a label names, in order, without the mark of a mixed field."""
    return F.transform(F.split(label, " "), lambda t: F.replace(t, F.lit("yes_"), F.lit("")))


def distinct_sorted(values: Column) -> Column:
    """The distinct values of a list, in order."""
    return F.array_sort(F.array_distinct(values))


def split_label(label: Column) -> Column:
    """The distinct crops that a label names, sorted."""
    return distinct_sorted(label_tokens(label))


def mgrs_to_epsg(tile: Column) -> Column:
    """The UTM code of an MGRS tile name; null where that isn't one."""
    zone = F.regexp_extract(tile, r"^(\d{1,2})[A-Z]", 1).try_cast("int")
    band = F.regexp_extract(tile, r"^\d{1,2}([A-Z])", 1)
    fits = (F.length(tile) >= 3) & zone.between(1, 60)
    return F.when(fits, F.when(band >= "N", 32600 + zone).otherwise(32700 + zone))


def parse_epsg(crs: Column) -> Column:
    return F.regexp_extract(crs, r"^(?i:EPSG:)?(\d+)$", 1).try_cast("int")


def epsg_is_metres(epsg: Column) -> Column:
    return epsg.between(32601, 32660) | epsg.between(32701, 32760) | (epsg == 3857)


def image_date(title: Column) -> Column:
    """The date in the title of a satellite image: of its first or second kind; else null."""
    name = F.element_at(F.split(title, " "), -1)
    parts = F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "_")
    part = F.when(title.contains("Sentinel-2"), F.element_at(parts, -1)).when(
        title.contains("Sentinel-1"), F.get(parts, F.lit(4))
    )
    return F.to_date(F.regexp_extract(part, r"^(\d{8})", 1), "yyyyMMdd")


def product_name(stem: Column, latest: Column, tile: Column) -> Column:
    """A product's name with the latest image's date for its last part, and its tile."""
    parts = F.split(stem, "_")
    head = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "_")
    return F.concat(head, F.when(F.size(parts) > 1, "_").otherwise(""), latest, F.lit("_"), tile, F.lit(".tif"))


def input_name(stem: Column, tile: Column) -> Column:
    return F.concat_ws("_", stem, tile)


def photo_source(name: Column) -> Column:
    return F.concat(F.lit("/detail_pix/"), name)


def photo_target(unit: Column, name: Column, label: Column) -> Column:
    return F.concat(F.concat_ws("_", unit.cast("string"), name, label), F.lit(".jpg"))


def date_prefix(text: Column) -> Column:
    return F.substring(text, 1, 10)


def run_tag(model: Column) -> Column:
    return F.element_at(F.split(model, "-"), -1)


def derived_sample_id(sample_id: Column, fid: Column) -> Column:
    return F.concat_ws("_AL_", sample_id, fid.cast("string"))


def binary_label(cls: Column) -> Column:
    return F.when(cls.startswith("not_"), 0).otherwise(1)


def code_from_number(text: Column) -> Column:
    """``"3.0"`` as ``"3"``; null where the text is no number."""
    return text.try_cast("double").cast("int").cast("string")
