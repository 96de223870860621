"""Splits, folds, weights and resampling that don't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import clip, hash_number

SHARES = {"train": 70, "val": 15, "test": 15}


def split_by_ids(df: DataFrame, key: str, val: DataFrame, test: DataFrame) -> DataFrame:
    """``df`` with ``split``: val or test by lists of ids (val first), else train."""
    lists = val.select(F.col("sample_id").alias("__id"), F.lit(0).alias("__o")).union(
        test.select("sample_id", F.lit(1))
    )
    first = lists.groupBy("__id").agg(F.min("__o").alias("__o"))
    tagged = df.join(first, F.col(key) == F.col("__id"), "left")
    split = F.when(F.col("__o") == 0, "val").when(F.col("__o") == 1, "test").otherwise("train")
    return tagged.withColumn("split", split).drop("__id", "__o")


def random_split(key: Column, shares: dict[str, int] | None = None, seed: int = 42) -> Column:
    """The split of a sample by a hash of its id; the shares add up to 100."""
    bucket, low, out = hash_number(seed, key) % 100, 0, F.lit(None).cast("string")
    for name, share in (shares or SHARES).items():
        out = F.when(bucket >= low, name).otherwise(out)
        low += share
    return out


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def numbered(df: DataFrame, cls: str, key: str, seed: int, name: str) -> DataFrame:
    """``df`` with the row's number in its class, from 1, in a random order that the seed fixes.

    A class of any size is numbered in buckets: rows within one, and a running count of the
    buckets before it, so no task holds a class.
    """
    h = hash_number(seed, F.col(key))
    rows = df.withColumn("__h", h).withColumn("__b", F.floor(F.col("__h") / (1 << 22)))
    sizes = rows.groupBy(cls, "__b").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(cls).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(cls).alias("__c"), F.col("__b").alias("__sb"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s")
    )
    rows = rows.join(starts, F.col(cls).eqNullSafe(F.col("__c")) & (F.col("__b") == F.col("__sb")))
    within = F.row_number().over(Window.partitionBy(cls, "__b").orderBy("__h", key))
    return rows.withColumn(name, F.col("__s") + within).drop("__h", "__b", "__n", "__c", "__sb", "__s")


def stratified_folds(df: DataFrame, cls: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """``df`` with ``fold`` from 0 to k - 1; the folds of a class differ by one row at most."""
    rows = numbered(df, cls, key, seed, "__i")
    return rows.withColumn("fold", ((F.col("__i") - 1) % k).cast("int")).drop("__i")


def class_weights(
    df: DataFrame,
    cls: str,
    method: str = "balanced",
    clip_range: tuple[float, float] | None = None,
    normalize: bool = True,
) -> DataFrame:
    """Rows (cls, n, weight): N / (K n), or ln(N / n); then clipped; then by the mean over classes."""
    counts = df.groupBy(cls).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("__all"), F.count("*").alias("__k"))
    if method == "balanced":
        weight = F.col("__all") / (F.col("__k") * F.col("n"))
    elif method == "log":
        weight = F.ln(F.col("__all") / F.col("n"))
    else:
        raise ValueError(f"unknown method: {method}")
    if clip_range:
        weight = clip(weight, *clip_range)
    rows = counts.crossJoin(F.broadcast(totals)).select(cls, "n", weight.alias("weight"))
    if normalize:
        mean = rows.agg(F.avg("weight").alias("__mean"))
        rows = rows.crossJoin(F.broadcast(mean)).select(cls, "n", (F.col("weight") / F.col("__mean")).alias("weight"))
    return rows


def sample_weights(df: DataFrame, cls: str, weights: DataFrame | None) -> DataFrame:
    """``df`` with its class's weight; 1 without weights, and for a class that has none."""
    if weights is None:
        return df.withColumn("weight", F.lit(1.0))
    pairs = weights.select(F.col(cls).alias("__c"), "weight")
    joined = df.join(pairs, F.col(cls) == F.col("__c"), "left").drop("__c")
    return joined.withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def balanced_resample(df: DataFrame, cls: str, key: str, weights: DataFrame, seed: int = 42, start: float = 0.5) -> DataFrame:
    """``df`` drawn with replacement, as many rows as it has, by class weight: ``copies`` of each row.

    Systematic: a class's rows in random order share its expected draws evenly, so its total is
    within one of the expectation. Rows with 0 copies are left out.
    """
    rows = numbered(sample_weights(df, cls, weights), cls, key, seed, "__i")
    totals = weights.agg(
        F.sum("n").alias("__rows"), F.sum(F.col("n") * F.col("weight")).alias("__mass")
    )
    rate = F.col("__rows") * F.col("weight") / F.col("__mass")
    i = F.col("__i")
    copies = F.floor(i * rate + start) - F.floor((i - 1) * rate + start)
    rows = rows.crossJoin(F.broadcast(totals)).withColumn("copies", copies.cast("bigint"))
    return rows.where("copies > 0").drop("__i", "__rows", "__mass")
