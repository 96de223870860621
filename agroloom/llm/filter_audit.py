"""How filters act together: what each removes, in every order in which they can be applied.

Each filter has a relation of its own: the stored table of the rows that fail it. Left-semi and
left-anti joins with one relation after the other split all rows into cells, the common parts of
all prefixes of all orders: the survivors of a prefix are the cells that fail none of its filters,
and what the next filter removes there are those of them that it fails. Only counts of cells are
added up for the orders, so the joins grow with the filters and not with their permutations.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS, content_key, cut, few, stored, text_of

FILTERS = "ABCDE"
_KEYS = ["id", "key"]


def _checked(docs: DataFrame) -> DataFrame:
    """Rows (id, key, present, part, digest, A … D): one for each row of ``docs``; the texts are read once."""
    text = text_of()
    words = F.array_remove(F.split(text, f"[{SPACE_CLASS}]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(content_key(), F.col("doc_id").isNull()).alias("key"),
        F.col("doc_id").isNotNull().alias("present"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        (F.size(words) < 100).alias("A"),
        (100 * F.size(F.array_distinct(words)) < 80 * F.size(words)).alias("B"),
        (F.lit(100) * capitals > F.lit(10) * F.length(text)).alias("C"),
        text.rlike("[#$%&*|]").alias("D"),
    )


def _copies(checked: DataFrame) -> DataFrame:
    """The rows whose text a row of a smaller id has; a null id comes after all others."""
    first = checked.groupBy("digest").agg(F.min(F.when(F.col("present"), F.col("id"))).alias("first"), F.count("*").alias("n"))
    first = cut(first.where("n > 1 and first is not null").select("digest", "first"))
    first = F.broadcast(first) if few(first) else first
    return checked.join(first, "digest").where("not present or id > first")


def failing_relations(checked: DataFrame) -> dict[str, DataFrame]:
    """One stored table (id, key) of the rows that fail it, for each filter."""
    rows = {name: checked.where(name) for name in FILTERS[:-1]} | {FILTERS[-1]: _copies(checked)}
    return {name: stored(failing.select(*_KEYS).distinct()) for name, failing in rows.items()}


def split_by(rows: DataFrame, relation: DataFrame, keys: list[str], flag: Column | int) -> DataFrame:
    """``rows`` with ``flag`` added to their ``cell`` where ``relation`` has a row of the same keys.

    Rows that have one are found by a left-semi join and the others by a left-anti join. A relation of
    few rows is broadcast; else both joins use the same exchanges. The result is written, so that later
    joins don't repeat these, in as many parts as a shuffle makes.
    """
    relation = F.broadcast(relation) if few(relation) else relation
    has = rows.join(relation, keys, "left_semi").withColumn("cell", F.col("cell") + flag)
    both = has.unionByName(rows.join(relation, keys, "left_anti"))
    return cut(both.coalesce(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, cell, n): how many documents fail which filters and have which labels.

    ``cell`` has bit k for the k-th filter, then one for ``quality`` = 1 and one for ``toxic`` = 1.
    Rows equal in id, text and part go through the joins as one, with their number.
    """
    checked = stored(_checked(docs))
    rows = checked.groupBy(*_KEYS, "present", "part").agg(F.count("*").alias("n")).withColumn("cell", F.lit(0))
    for k, relation in enumerate(failing_relations(checked).values()):
        rows = split_by(rows, relation, _KEYS, F.lit(1 << k))
    for k, name in enumerate(("quality", "toxic"), len(FILTERS)):
        marked = labels.where(F.col(name) == 1).select(F.col("doc_id").cast("bigint").alias("id"), F.lit(True).alias("present"))
        rows = split_by(rows, marked.distinct(), ["id", "present"], F.lit(1 << k))
    return rows.groupBy("part", "cell").agg(F.sum("n").alias("n"))


def _bits(filters: str) -> int:
    return sum(1 << FILTERS.index(name) for name in filters)


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One for each value of ``lang`` (null: the empty string), each order of the filters and each step:

    * A: under 100 words; B: under 80 distinct words for each 100 words; C: over 10 of 100 code
      points are of A-Z; D: one of ``#$%&*|`` occurs; E: some smaller id has the same text.

    A null or empty text has no words: it fails A, and E if it is not the first. A null id comes after
    all others and has no labels; rows that repeat an id are each counted, and none is a copy of the
    other. A label that is null or repeated counts as it stands: 1 somewhere is enough. Texts may be
    long: a task holds the words of one text at a time. Without a document there is no row.
    """
    before = [("".join(s), f) for f in FILTERS for k in range(len(FILTERS)) for s in combinations(FILTERS.replace(f, ""), k)]
    pairs = F.array(*[
        F.struct(
            F.lit(_bits(s)).alias("earlier"),
            F.lit(_bits(f)).alias("own"),
            F.lit(factorial(len(s)) * factorial(len(FILTERS) - 1 - len(s))).alias("orders"),
        )
        for s, f in before
    ])
    cell, earlier, own = F.col("cell"), F.col("earlier"), F.col("own")
    failed = cell.bitwiseAND(F.lit(_bits(FILTERS)))
    passes, fails = failed.bitwiseAND(earlier) == 0, failed.bitwiseAND(own) != 0
    good, toxic = (cell.bitwiseAND(F.lit(1 << k)) != 0 for k in (len(FILTERS), len(FILTERS) + 1))

    def documents(where: Column) -> Column:
        return F.sum(F.when(where, F.col("n")).otherwise(F.lit(0))).cast("bigint")

    prefixes = (
        cells(docs, labels).select("part", "cell", "n", F.explode(pairs).alias("pair")).select("part", "cell", "n", "pair.*")
        .groupBy("part", "earlier", "own", "orders")
        .agg(
            documents(passes & ~fails).alias("kept"),
            documents(passes & fails).alias("removed"),
            documents(~passes & fails).alias("redundant"),
            documents(failed == own).alias("unique_fails"),
            documents(passes & fails & good).alias("good_lost"),
            documents(passes & fails & toxic).alias("toxic_lost"),
        )
    )
    shapley = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "own"))
    prefixes = prefixes.withColumn("shapley", shapley.cast("bigint"))
    steps = [(o, k + 1, _bits(o[:k]), _bits(o[k])) for o in map("".join, permutations(FILTERS)) for k in range(len(FILTERS))]
    steps = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, earlier int, own int")
    return prefixes.join(F.broadcast(steps), ["earlier", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
