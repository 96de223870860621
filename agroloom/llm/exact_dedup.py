"""Exact deduplication by a 128-bit content hash, with the bytes compared inside each group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, content_key, cut, few, keyed, row_key, semi, text_of


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.regexp_replace(text_of(), f"[{SPACE_CLASS}]+", " ")
    rows = docs.select("doc_id", content_key().alias("key"), text.alias("norm"))
    return rows.withColumn("h128", F.unhex(F.md5("norm")))


def _collide(base: DataFrame, repeated: DataFrame) -> bool:
    """Whether one of the ``repeated`` hashes stands for two texts; compares the bytes of their rows.

    Only texts of these hashes are moved, and equal ones of a task as one. Where there are too many
    hashes for a broadcast, all texts meet them by a shuffle.
    """
    hashes = repeated.select(F.col("h128").alias("__h"))
    hashes = F.broadcast(hashes) if few(hashes) else hashes
    texts = base.join(hashes, F.col("h128") == F.col("__h"), "left_semi").select("h128", "norm").distinct()
    return not texts.groupBy("h128").count().where("count > 1").isEmpty()


def _members(docs: DataFrame) -> DataFrame:
    """Rows (row, first, group_size, text_sha256): each row's key, and that of its group's first row.

    Rows are grouped by their hash. Hashes that occur again have their texts compared; only if some
    hash has two texts do rows meet by text as well. Spark combines equal rows in each map task, so
    a text that fills a third of the table sends one row a task; members meet their group's narrow
    row by a join of plain exchanges, which can be split at run time.
    """
    base = _hashed(docs)
    row, digest = row_key("doc_id", "key").alias("row"), F.sha2("norm", 256).alias("text_sha256")
    facts = [F.min("row").alias("first"), F.count("*").alias("group_size")]
    narrow = cut(base.select(row, "h128", digest))
    groups = cut(narrow.groupBy("h128").agg(*facts))
    if not _collide(base, groups.where("group_size > 1")):
        return narrow.join(groups, "h128").select("row", "first", "group_size", "text_sha256")
    texts = base.select(row, "h128", "norm").groupBy("h128", "norm").agg(*facts)
    members = base.select(row, "h128", "norm").join(texts, ["h128", "norm"])
    return members.select("row", "first", "group_size", digest)


def exact_groups(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one for each row of ``docs``.

    Texts are equal if their bytes are, after each run of white space became one space.

    A null text counts as empty. A null ``doc_id`` is kept only in a group with no other id. Rows
    that repeat a ``doc_id`` are the same document and share its flag; each counts in
    ``group_size``. Other columns are ignored; an empty table gives no rows. A task holds one text at a
    time, however long.
    """
    return _members(docs).select(
        F.col("row.id").alias("doc_id"),
        F.col("first.id").alias("keep_id"),
        "group_size",
        F.col("row.id").eqNullSafe(F.col("first.id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts: that with the smallest id.

    Rows are told apart by id and text together, so ids may be null or repeat; a null id comes
    after all others, and of rows that share an id the one first by its text's hash stays. Rows
    equal in both go or stay together. All columns stay, whatever their names.
    """
    gone = cut(_members(docs).where("row != first").select("row.*").distinct())
    return semi(keyed(docs), gone, "left_anti").select("__row.*")
