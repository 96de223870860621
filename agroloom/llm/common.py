"""What the operators of this subpackage share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, shared_root

__all__ = ["cut", "shared_folder"]

#: White space of the text contracts, as a Java and a Python character class.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """True for the fold that nothing is learnt from: crc32 of the id's text divisible by 5.

    A null id counts as held out.
    """
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(True))


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns' values alone."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


#: Rows of two or three numbers that may be broadcast: some 15 MB.
FEW = 200_000


def few(rows: DataFrame) -> bool:
    """Whether the narrow ``rows`` are so few that each task can hold them; counts FEW + 1 at most."""
    return rows.limit(FEW + 1).count() <= FEW


def content_key(*more: str) -> Column:
    """A hash of the text, null as the empty text, and of more columns: with the id, what tells rows apart."""
    return F.xxhash64(text_of(), *[F.col(c).cast("string") for c in more])


def row_key(doc_id: str, key: str) -> Column:
    """(absent, id, key): a row's place in the order by id, null last, and then by a hash of its text."""
    return F.struct(F.col(doc_id).isNull().alias("absent"), F.col(doc_id).alias("id"), F.col(key).alias("key"))


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """Rows (doc_id, key, __row): each row whole, in a struct, so that its columns' names don't clash."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), content_key(*more).alias("key"), F.struct("*").alias("__row")
    )


def semi(docs: DataFrame, rows: DataFrame, how: str = "left_semi") -> DataFrame:
    """``docs`` (doc_id, key, …) that have a row (id, key) in ``rows``, or that have none (``left_anti``).

    Few rows are broadcast, so that no text is moved; more meet the documents by a shuffle.
    """
    rows = rows.select(F.col("id").alias("__id"), F.col("key").alias("__key"))
    rows = F.broadcast(rows) if few(rows) else rows
    return docs.join(rows, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), how)


#: Texts that a worker holds as Python objects at once.
TEXTS = 500


def values(column):
    """The values of an Arrow array one by one, TEXTS of them as Python objects at a time."""
    for i in range(0, len(column), TEXTS):
        yield from column.slice(i, TEXTS).to_pylist()


_KEPT: dict = {}


def worker_cache(key=None, make=None):
    """What ``make`` gives, kept in a Python worker between its tasks.

    A worker holds the cache of one operator at a time: another key lets go of the last one, and so
    does a call without a key. Workers outlive a stage, and their memory is the executor's.
    """
    if _KEPT.get("key") != key:
        _KEPT.clear()
    if key is not None and not _KEPT:
        _KEPT.update(value=make(), key=key)
    return _KEPT.get("value")


def shared_folder(spark: SparkSession) -> str:
    """The application's own folder below the shared checkpoint folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/{uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
