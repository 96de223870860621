"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, content_key, cut, keyed, text_of, uniform

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
#: Units that one step of the reduction tree pairs up in one array.
BLOCK = 64
SEED = 20240607


def source_targets(sized: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Rows (source, source_size, n_docs, target) from rows (source, size).

    Sources in code point order, null last, take the weights in turn. Targets share the sum of all
    sizes by weight; one that exceeds ``max_copies`` times its source's size stops there, and the
    rest is shared again until none exceeds. Only sums reach the driver.
    """
    order = F.col("source").asc_nulls_last()
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    parts = cut(
        sources.repartitionByRange(8, order).withColumn("part", F.spark_partition_id())
    )
    # a running count over range partitions numbers the sources without one task that holds all
    starts, total = {}, 0
    for part, n in sorted(map(tuple, parts.groupBy("part").count().collect())):
        starts[part], total = total, total + n
    if not starts:
        return parts.select("source", "source_size", "n_docs", F.lit(0.0).alias("target"))
    start = F.element_at(
        F.create_map(*[F.lit(x) for item in starts.items() for x in item]), F.col("part")
    )
    rank = start + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    ranked = cut(parts.withColumn("weight", weight))
    cap = F.col("source_size") * max_copies
    whole, weight_sum = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    share = whole / weight_sum
    while True:
        above = cap < F.col("weight") * share
        fixed, free = ranked.agg(
            F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        new = (whole - (fixed or 0)) / free if free else share
        if new <= share:
            break
        share = new
    target = F.least(cap.cast("double"), F.col("weight") * share)
    return ranked.select("source", "source_size", "n_docs", target.alias("target"))


# One step of the fold: ``s.left`` is the unit that is still fractional, ``x`` the next one. Mass,
# that is size times probability, moves between the two until one probability is 0 or 1; which way
# is drawn so that each expectation stays. ``s.done`` gathers the decided units.
_STEP = """
aggregate(
  units,
  named_struct('left', cast(null as struct<u:double,unit:struct<doc_id:bigint,key:bigint,m:bigint,sure:bigint>,size:bigint,p:double>),
               'done', cast(array() as array<struct<unit:struct<doc_id:bigint,key:bigint,m:bigint,sure:bigint>,size:bigint,extra:int>>)),
  (s, x) -> if(s.left is null, named_struct('left', x, 'done', s.done),
    element_at(transform(array(named_struct(
        'up', least(s.left.size * (1 - s.left.p), x.size * x.p),
        'down', least(s.left.size * s.left.p, x.size * (1 - x.p)))),
      m -> case
        when x.u * (m.up + m.down) < m.down and s.left.size * (1 - s.left.p) <= x.size * x.p then
          named_struct('left', named_struct('u', x.u, 'unit', x.unit, 'size', x.size, 'p', x.p - m.up / x.size),
                       'done', concat(s.done, array(named_struct('unit', s.left.unit, 'size', s.left.size, 'extra', 1))))
        when x.u * (m.up + m.down) < m.down then
          named_struct('left', named_struct('u', s.left.u, 'unit', s.left.unit, 'size', s.left.size, 'p', s.left.p + m.up / s.left.size),
                       'done', concat(s.done, array(named_struct('unit', x.unit, 'size', x.size, 'extra', 0))))
        when s.left.size * s.left.p <= x.size * (1 - x.p) then
          named_struct('left', named_struct('u', x.u, 'unit', x.unit, 'size', x.size, 'p', x.p + m.down / x.size),
                       'done', concat(s.done, array(named_struct('unit', s.left.unit, 'size', s.left.size, 'extra', 0))))
        else
          named_struct('left', named_struct('u', s.left.u, 'unit', s.left.unit, 'size', s.left.size, 'p', s.left.p - m.down / s.left.size),
                       'done', concat(s.done, array(named_struct('unit', x.unit, 'size', x.size, 'extra', 1))))
      end), 1)))
"""


def _mixed(docs: DataFrame, weights, max_copies: int, seed: int) -> DataFrame:
    """Rows (doc_id, key, m, size, source_size, target, base, extra), one for ``m`` equal rows of ``docs``:
    each of them is taken ``base`` times, and the first ``extra`` of them once more."""
    sized = docs.select(
        F.col("doc_id").cast("bigint"), content_key("source").alias("key"), F.col("source").cast("string"),
        F.regexp_count(text_of(), F.lit(WORD_PATTERN)).cast("bigint").alias("size"),
    )
    sized = cut(sized.groupBy("doc_id", "key", "source", "size").agg(F.count("*").alias("m")))
    targets = source_targets(sized.select("source", (F.col("size") * F.col("m")).alias("size")), weights, max_copies)
    targets = cut(targets.withColumnRenamed("source", "of"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(ratio)
    spread = (ratio - base) * F.col("m")  # copies that equal rows are to share beyond their base
    units = sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).withColumns(
        {"base": base.cast("int"), "sure": F.floor(spread).cast("bigint"), "p": spread - F.floor(spread)}
    )
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    group = ["of", "source_size", "target", "base", "n"]
    unit = F.struct("doc_id", "key", "m", "sure").alias("unit")
    decided = units.where(~open_).select(unit, "size", *group[1:4], F.lit(0).alias("extra"))
    units = units.where(open_).withColumnRenamed("n_docs", "n").select(unit, "size", "p", *group)
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    level = 0
    while most > 1 or level == 0:
        blocks = F.ceil(F.col("n") / BLOCK)
        dealt = units.withColumns(
            {
                "block": F.pmod(F.xxhash64(F.lit(seed + level), "unit"), blocks),
                "u": uniform(F.lit(-seed - level), F.col("unit")),
            }
        )
        folded = cut(
            dealt.groupBy(*group, "block")
            .agg(F.sort_array(F.collect_list(F.struct("u", "unit", "size", "p"))).alias("units"))
            .withColumn("state", F.expr(_STEP))
            .drop("units")
        )
        done = folded.select(*group[1:4], F.explode("state.done").alias("x"))
        decided = decided.unionByName(done.select("x.unit", "x.size", *group[1:4], "x.extra"))
        left = folded.where("state.left is not null").select(
            "state.left.unit", "state.left.size", "state.left.p", *group[:4],
            F.ceil(F.col("n") / BLOCK).alias("n"),
        )
        units, most, level = left, math.ceil(most / BLOCK), level + 1
    last = uniform(F.lit(seed), F.col("unit")) < F.col("p")
    decided = decided.unionByName(
        units.select("unit", "size", *group[1:4], last.cast("int").alias("extra"))
    )
    return decided.select(
        "unit.doc_id", "unit.key", "unit.m", "size", "source_size", "target", "base",
        (F.col("unit.sure") + F.col("extra")).alias("extra"),
    )


def mixed(
    docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED
) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, copies), one for each row of ``docs``.

    ``size`` counts words; a document of a source with target t and size s gets floor(t/s) copies
    and one more with the rest of t/s as its probability. The probabilities are rounded in blocks
    of about ``BLOCK`` documents of one source, dealt by a hash; what stays fractional in each
    block goes to the next level, with a block for about ``BLOCK`` blocks, and so on: a reduction
    tree in which no array grows with the source. Every step keeps the words taken, so a source
    misses its target by less than its last document.

    Equal tables give equal results, whatever their partitions. A null text has size 0 and is
    taken 0 times; a null source is a source. Rows equal in id, text and source are one unit with
    a count, so that no block grows with them, and share its copies as evenly as whole copies can;
    other rows that repeat a ``doc_id``, and those without one, are documents of their own. Empty
    tables give no rows. Other columns are ignored. Of a text only its size is kept, however long.
    """
    rows = _mixed(docs, weights, max_copies, seed)
    rows = rows.withColumn("__nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))))
    copies = F.col("base") + (F.col("__nth") <= F.col("extra")).cast("int")
    return rows.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * copies).alias("taken"), copies.alias("copies"),
    )


def mixed_documents(
    docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED
) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say, perhaps never.

    Documents without words drop out; an empty table stays empty. Rows meet their copies by id,
    text and source together, so ids may be null or repeat; rows equal in all three are each taken
    as often as they are on average, rounded. All columns stay, whatever their names.
    """
    taken = _mixed(docs, weights, max_copies, seed)
    copies = F.col("base") + F.round(F.col("extra") / F.col("m")).cast("int")
    # a row is taken max_copies times at most: an explode of so short an array is no growth
    taken = taken.where("size > 0").select(
        F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.sequence(F.lit(1), copies).alias("__copies"), copies.alias("__n")
    ).where("__n > 0")
    rows = keyed(docs, "source").join(taken, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")))
    return rows.select("__row", F.explode("__copies")).select("__row.*")
