"""Class mappings, legends and labels as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.writers import observed

from ..functions.text import label_tokens

REMOVED = "remove"
OTHER = "other"
OTHER_CROPS = "other_crops"
LEVELS = ("level_5", "level_4", "level_3", "level_2", "level_1")


def map_classes(df: DataFrame, mapping: DataFrame, code: str = "ewoc_code") -> DataFrame:
    """``df`` with ``finetune_class`` by its code; rows whose code isn't in (ewoc_code, cls) go."""
    known = mapping.select(F.col("ewoc_code").alias("__code"), F.col("cls").alias("finetune_class"))
    return df.join(known, F.col(code).cast("string") == F.col("__code")).drop("__code")


def drop_marked(df: DataFrame, cls: str = "finetune_class", marker: str = REMOVED) -> DataFrame:
    """Rows of classes other than the marker; a null class stays out too."""
    return df.where(F.col(cls) != marker)


def drop_unmapped(df: DataFrame, mapping: DataFrame, cls: str, mapped: str) -> DataFrame:
    """Rows whose class the mapping has."""
    return df.join(mapping.select(F.col(mapped).alias("__m")), F.col(cls) == F.col("__m"), "left_semi")


def count_unmapped(df: DataFrame, mapping: DataFrame, cls: str, mapped: str) -> DataFrame:
    """Rows (cls, n) of the classes that the mapping lacks."""
    lost = df.join(mapping.select(F.col(mapped).alias("__m")), F.col(cls) == F.col("__m"), "left_anti")
    return lost.groupBy(cls).agg(F.count("*").alias("n"))


def drop_unmapped_counted(df: DataFrame, mapping: DataFrame, cls: str, mapped: str) -> tuple[DataFrame, Observation]:
    """:func:`drop_unmapped`, and what counts the ``rows`` and those ``unmapped`` as they pass."""
    have = mapping.select(F.col(mapped).alias("__m")).distinct().withColumn("__has", F.lit(True))
    rows, seen = observed(df.join(have, F.col(cls) == F.col("__m"), "left"), unmapped=F.col("__has").isNull())
    return rows.where("__has").drop("__m", "__has"), seen


def task_type(df: DataFrame, cls: str) -> DataFrame:
    """One row (n_classes, task, n_outputs); fewer than two classes are an error."""
    counted = df.agg(F.countDistinct(cls).alias("n_classes"))
    n = F.col("n_classes")
    few = F.raise_error(F.concat(F.lit("too few classes: "), n.cast("string")))
    return counted.select(
        n,
        F.when(n == 2, "binary").when(n > 2, "multiclass").otherwise(few.cast("string")).alias("task"),
        F.when(n == 2, F.lit(1).cast("bigint")).otherwise(n).alias("n_outputs"),
    )


def classes_present(mapping: DataFrame, df: DataFrame, cls: str) -> DataFrame:
    """One row (classes): the mapping's classes that occur in the data, in order."""
    have = df.select(F.col(cls).alias("cls")).distinct()
    found = mapping.select("cls").distinct().join(have, "cls", "left_semi")
    return found.agg(F.sort_array(F.collect_set("cls")).alias("classes"))


def class_difference(df: DataFrame, cls: str, mapping: DataFrame, mapped: str) -> DataFrame:
    """Classes of the data that the mapping lacks."""
    return df.select(F.col(cls).alias("cls")).subtract(mapping.select(F.col(mapped).alias("cls")))


def join_legend(labels: DataFrame, legend: DataFrame, code: str, legend_code: str) -> DataFrame:
    """Labels with the legend's row of their code, whose dashes don't count; null where there's none."""
    plain = legend.withColumn("__code", F.replace(F.col(legend_code), F.lit("-"), F.lit("")))
    return labels.join(plain.drop(legend_code), F.col(code) == F.col("__code"), "left").drop("__code")


def lookup_in_lists(df: DataFrame, label: str, lists: DataFrame) -> DataFrame:
    """``df`` with ``cls``: the first entry (ordinal, cls, spellings) whose list has the label."""
    entries = lists.select(F.explode("spellings").alias("__label"), "ordinal", "cls")
    first = entries.groupBy("__label").agg(F.min_by("cls", "ordinal").alias("cls"))
    return df.join(first, F.col(label) == F.col("__label"), "left").drop("__label")


def resolve_landcover(df: DataFrame, mapping: DataFrame, legend: DataFrame, overrides: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows (code, label, cls, needs_review) of (code, label): the code's class, else an override of
    its label, else the legend's label. Excluded labels drop out; what no mapping knew needs review.
    """
    rows = df.join(excluded.select("label"), "label", "left_anti")
    rows = rows.join(mapping.select("code", F.col("cls").alias("__mapped")), "code", "left")
    rows = rows.join(overrides.select("label", F.col("cls").alias("__own")), "label", "left")
    rows = rows.join(legend.select("code", F.col("name").alias("__name")), "code", "left")
    return rows.select(
        "code", "label", F.coalesce("__mapped", "__own", "__name").alias("cls"),
        F.col("__mapped").isNull().alias("needs_review"),
    )


def resolve_landcover_counted(
    df: DataFrame, mapping: DataFrame, legend: DataFrame, overrides: DataFrame, excluded: DataFrame
) -> tuple[DataFrame, Observation]:
    """:func:`resolve_landcover`, and what counts the ``rows``, those for ``review`` and those ``without_class`` as they pass."""
    rows = resolve_landcover(df, mapping, legend, overrides, excluded)
    return observed(rows, review=F.col("needs_review"), without_class=F.col("cls").isNull())


def invert_first(mapping: DataFrame) -> DataFrame:
    """Rows (cls, code): of the codes of a class, the first in order."""
    return mapping.groupBy("cls").agg(F.min("ewoc_code").alias("code"))


def last_wins(df: DataFrame, code: str, cls: str, ordinal: str) -> DataFrame:
    """Rows (code, cls): of rows that share a code, the last."""
    return df.groupBy(code).agg(F.max_by(cls, ordinal).alias(cls))


def normalise_tokens(df: DataFrame, label: str, lists: DataFrame, compat: bool = False) -> DataFrame:
    """Rows (label, crops): the distinct classes of a label's crops, sorted; unknown ones are others.

    ``compat`` also counts every list passed before the match as another crop.
    """
    tokens = df.select(label).where(F.col(label).isNotNull()).distinct()
    tokens = tokens.select(label, F.explode(label_tokens(F.col(label))).alias("__token"))
    found = lookup_in_lists(tokens, "__token", lists)
    crops = F.coalesce("cls", F.lit(OTHER_CROPS))
    if compat:
        first = lists.groupBy().agg(F.min_by("cls", "ordinal").alias("__first"))
        found = found.crossJoin(F.broadcast(first))  # one row
        passed = F.when(F.col("cls") != F.col("__first"), F.lit(OTHER_CROPS))
        crops = F.explode(F.array_compact(F.array(crops, passed)))
    found = found.select(label, crops.alias("__crop"))
    return found.groupBy(label).agg(F.sort_array(F.collect_set("__crop")).alias("crops"))


def duplicated_ids(df: DataFrame, sample_id: str, label: str, crops: DataFrame) -> DataFrame:
    """Distinct ids of samples whose label names several crops, by rows (label, crops)."""
    several = crops.where(F.size("crops") > 1).select(F.col(label).alias("__label"))
    return df.join(several, F.col(label) == F.col("__label"), "left_semi").select(sample_id).distinct()


def duplicate_mixed(df: DataFrame, label: str, crops: DataFrame, codes: DataFrame) -> DataFrame:
    """A row for each crop of a row's label, with ``croptype`` and ``ewoc_code`` of that crop.

    ``crops`` has rows (label, crops), ``codes`` rows (cls, code). Rows with one crop or none keep
    their label as the crop type.
    """
    lists = crops.where(F.size("crops") > 1).select(F.col(label).alias("__label"), "crops")
    rows = df.join(lists, F.col(label) == F.col("__label"), "left")
    rows = rows.withColumn("croptype", F.explode(F.coalesce("crops", F.array(F.col(label)))))
    rows = rows.drop("__label", "crops")
    codes = codes.select(F.col("cls").alias("__cls"), F.col("code").alias("ewoc_code"))
    return rows.join(codes, F.col("croptype") == F.col("__cls"), "left").drop("__cls")


def downstream_classes(df: DataFrame, cls: str, mapping: DataFrame | None) -> DataFrame:
    """``df`` with ``downstream_class`` by rows (cls, target); without a mapping, the class itself.

    Rows whose class the mapping lacks drop out.
    """
    if mapping is None:
        return df.withColumn("downstream_class", F.col(cls))
    pairs = mapping.select(F.col("cls").alias("__cls"), F.col("target").alias("downstream_class"))
    return df.join(pairs, F.col(cls) == F.col("__cls")).drop("__cls")


def class_order(classes: list[str]) -> list[str]:
    """Sorted, but of two classes the one called ``other`` comes first."""
    return sorted(classes, key=lambda c: (len(classes) == 2 and c != OTHER, c))


def most_detailed_level(*levels: str) -> Column:
    """The name of the first level that isn't null; none is an error."""
    named = [F.when(F.col(c).isNotNull(), F.lit(c)) for c in levels or LEVELS]
    return F.coalesce(*named, F.raise_error(F.lit("no level is given")).cast("string"))


def parse_dictionary(text: Column) -> Column:
    """A dictionary of strings from JSON; malformed text is an error."""
    return F.from_json(text, "map<string,string>", {"mode": "FAILFAST"})
