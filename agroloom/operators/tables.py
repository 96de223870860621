"""Projections, key checks, counts and set operations on any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return require_columns(df, names).select(*names)


def prefixed_columns(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def key_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows (key, n) of the values that occur more than once."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def check_key(df: DataFrame, key: str) -> DataFrame:
    """The table, if the column is there, never null and unique; else an error with some examples."""
    require_columns(df, [key])
    if not df.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} has nulls")
    some = [r[0] for r in key_duplicates(df, key).orderBy(key).limit(5).collect()]
    if some:
        raise ValueError(f"{key} has duplicates, such as {some}")
    return df


def counts_by(df: DataFrame, cls: str, counted: str) -> DataFrame:
    """Rows (cls, n): non-null values of ``counted`` in each class, the largest class first."""
    return df.groupBy(cls).agg(F.count(counted).alias("n")).orderBy(F.desc("n"), cls)


def top_classes(df: DataFrame, cls: str, counted: str, n: int = 5) -> DataFrame:
    return counts_by(df, cls, counted).limit(n)


def null_count(df: DataFrame, column: str) -> DataFrame:
    """One row (n_null, n_rows)."""
    return df.agg(
        F.coalesce(F.sum(F.col(column).isNull().cast("bigint")), F.lit(0)).cast("bigint").alias("n_null"),
        F.count("*").alias("n_rows"),
    )


def random_order(key: str, seed: int = 42) -> Column:
    """What puts rows in an order that depends on their keys and the seed alone."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


def in_random_order(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """The rows in an order that depends on the keys and the seed alone."""
    return df.orderBy(random_order(key, seed), key)


def with_position(df: DataFrame, order: list[Column], key: str, name: str = "position") -> DataFrame:
    """The rows in order, each with its place from 0; of equal ones, those of smaller hashes of ``key`` first.

    Spark samples the order, hash included, for borders between tasks, so that a value which many
    rows share is spread over tasks too. Each task numbers its rows as it sorts them; what the tasks
    before it hold, one number a task, is added afterwards.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = df.columns
    ranged = df.withColumns({f"__o{k}": c for k, c in enumerate(order)} | {"__tie": F.xxhash64(key)})
    by = [*(f"__o{k}" for k in range(len(order))), "__tie", key]
    ranged = ranged.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    ranged = cut(ranged.select(*fields, F.monotonically_increasing_id().alias("__m")))  # the task, and the place in it below 33 bits
    task, place = F.shiftright("__m", 33), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(task.alias("__task")).agg(F.count("*").alias("__n"))  # a row for each task
    starts = starts.select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    rows = ranged.withColumn("__task", task).join(F.broadcast(starts), "__task")
    return rows.withColumn(name, F.col("__s") + place).select(*fields, name)


def missing_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows (name) of the columns that the table lacks."""
    missing = sorted(set(names) - set(df.columns))
    return df.sparkSession.createDataFrame([(n,) for n in missing], "name string")


def last_values(df: DataFrame, key: str, order: Column, columns: list[str]) -> DataFrame:
    """One row for each key: of rows that share it, the last."""
    last = F.max_by(F.struct(*columns), order).alias("last")
    return df.groupBy(key).agg(last).select(key, "last.*")


def attach_attributes(df: DataFrame, facts: DataFrame, key: str, order: Column, columns: list[str]) -> DataFrame:
    """``df`` with the facts of its keys: the last of several, null where there are none."""
    return df.join(last_values(facts, key, order, columns), key, "left")


def union_splits(*splits: DataFrame) -> DataFrame:
    """All rows of the splits, by column name."""
    out = splits[0]
    for split in splits[1:]:
        out = out.unionByName(split)
    return out
