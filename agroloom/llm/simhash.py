"""SimHash near-duplicates: a binary trie of fingerprints joined with itself."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of
from .components import connected_labels

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
#: Fingerprints that a pair of trie nodes may hold before it is split further.
NODE_PAIR = 32_768
#: Bits by which a pair that holds more is split.
STEP = 4
#: Comparisons that end the descent into a pair of nodes, and those done at once.
LEAF, AT_ONCE = 64, 1_000_000


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits, each the majority of that bit over the hashes of all shingles; no word: 0."""
    words = text.encode().lower().split()  # of bytes: A-Z and the six white-space bytes only
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False)))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), "<u8", len(shingles)))


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set where more than half of the hashes have it."""
    ones = np.zeros(64, "i8")
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536].view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, fp), one for each row of ``docs``; ``fp`` holds the 64 bits as a bigint."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()]
            fp = pa.array(np.array(found, "<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def _split(pairs: DataFrame, depth: int, step: int, budget: int) -> DataFrame:
    """Node pairs at ``depth`` as node pairs ``step`` bits deeper, within the error budget.

    A row (fp, a, b, err) says that the fingerprint lies under node a or b and that the two differ
    in err bits. It goes to each pair of children that holds its own child and differs by no more
    than the budget; the children's low bits differ by a mask.
    """
    masks = [0]
    for n in range(1, budget + 1):
        masks += [sum(1 << i for i in c) for c in combinations(range(step), n)]
    own = F.shiftrightunsigned("fp", 64 - depth - step)
    low = (1 << step) - 1
    mask = F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks]))
    rows = pairs.withColumns({"own": own, "mask": mask})
    rows = rows.withColumn("err", F.col("err") + F.bit_count("mask")).where(F.col("err") <= budget)
    under_a = F.shiftrightunsigned("own", step) == F.col("a")
    other = F.when(under_a, F.col("b")).otherwise(F.col("a"))
    child = F.shiftleft(other, step) + F.col("own").bitwiseAND(F.lit(low)).bitwiseXOR(F.col("mask"))
    rows = rows.withColumn("child", child)
    return rows.select(
        "fp", F.least("own", "child").alias("a"), F.greatest("own", "child").alias("b"), "err"
    )


def trie_pairs(x: np.ndarray, y: np.ndarray | None, depth: int, err: int, budget: int):
    """Blocks of index pairs (i, j) with x[i] and y[j] at most ``budget`` bits apart.

    Both arrays are sorted and each lies under one node at ``depth``; ``err`` bits differ above.
    Without ``y``, x meets itself and i < j. All live pairs of nodes go down a level together; a
    node is a range of its array, and a pair of nodes whose differing bits exceed the budget ends.
    """
    same = y is None
    y = x if same else y
    live = np.array([[0, len(x), 0, len(y), err, int(same)]], "i8")
    while len(live):
        size = (live[:, 1] - live[:, 0]) * (live[:, 3] - live[:, 2])
        leaf = (size <= LEAF) | (depth == 64)
        yield from _compare(x, y, live[leaf], size[leaf], budget)
        live = live[~leaf]
        if not len(live):
            return
        a0, a2, b0, b2, e, own = live.T
        shift = np.uint64(63 - depth)
        ones = [np.concatenate([[0], np.cumsum((v >> shift) & np.uint64(1), dtype="i8")]) for v in (x, y)]
        a1 = a2 - (ones[0][a2] - ones[0][a0])
        b1 = b2 - (ones[1][b2] - ones[1][b0])
        children = [
            np.stack([a0, a1, b0, b1, e, own], 1),
            np.stack([a1, a2, b1, b2, e, own], 1),
            np.stack([a0, a1, b1, b2, e + 1, 0 * own], 1),
            np.stack([a1, a2, b0, b1, e + 1, 0 * own], 1)[own == 0],
        ]
        live = np.concatenate(children)
        live = live[(live[:, 0] < live[:, 1]) & (live[:, 2] < live[:, 3]) & (live[:, 4] <= budget)]
        depth += 1


def _compare(x, y, pairs, size, budget):
    """The index pairs within the budget, of small pairs of nodes; some of them at a time."""
    ends = np.cumsum(size)
    start = 0
    while start < len(pairs):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + AT_ONCE, "right")))
        part, n = pairs[start:stop], size[start:stop]
        at = np.repeat(np.arange(len(part)), n)
        k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        width = (part[:, 3] - part[:, 2])[at]
        i, j = part[at, 0] + k // width, part[at, 2] + k % width
        near = np.bitwise_count(x[i] ^ y[j]) <= budget
        near &= (part[at, 5] == 0) | (i < j)
        if near.any():
            yield i[near], j[near]
        start = stop


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches by the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_links(fps: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """Edges (src, dst) that span the classes of distinct ``fps`` linked within ``budget`` bits.

    The top of the trie is walked by Spark: fingerprints are dealt to pairs of nodes whose prefixes
    differ within the budget, and pairs that hold over NODE_PAIR of them are split further, so a
    dense region costs more tasks and not a larger one. Below, each pair is joined in one task,
    which hands on a spanning forest of the links it finds, at most one edge per fingerprint. A
    fingerprint has at most 2080 others within two bits, so links stay in proportion to them.
    """
    n = fps.count()
    depth = STEP
    while n >> depth > NODE_PAIR // 2:
        depth += STEP
    root = F.lit(0).cast("bigint")
    pairs = fps.select("fp", root.alias("a"), root.alias("b"), F.lit(0).alias("err"))
    pairs = cut(_split(pairs, 0, depth, budget))
    node = ["a", "b", "err"]
    edges = None
    while True:
        large = cut(pairs.groupBy(*node).count().where(F.col("count") > NODE_PAIR).drop("count"))
        found = _joined(pairs.join(large, node, "left_anti"), depth, budget)
        edges = found if edges is None else edges.union(found)
        if depth + STEP > 64 or large.isEmpty():
            return edges
        pairs = cut(_split(pairs.join(large, node, "left_semi"), depth, STEP, budget))
        depth += STEP


def _joined(pairs: DataFrame, depth: int, budget: int) -> DataFrame:
    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b, err = map(int, key)
        fp = np.sort(rows["fp"].to_numpy().view("u8"))
        if a == b:
            found = list(trie_pairs(fp, None, depth, err, budget))
            shift = 0
        else:
            shift = int(np.searchsorted(fp, np.uint64(b << (64 - depth))))
            x, y = fp[:shift], fp[shift:]
            found = list(trie_pairs(x, y, depth, err, budget)) if len(x) and len(y) else []
        if not found:
            return pd.DataFrame({"src": np.array([], "i8"), "dst": np.array([], "i8")})
        i = np.concatenate([f[0] for f in found])
        j = np.concatenate([f[1] for f in found]) + shift
        label = spanning(len(fp), i, j)
        moved = label != np.arange(len(fp))
        return pd.DataFrame({"src": fp[moved].view("i8"), "dst": fp[label[moved]].view("i8")})

    return pairs.groupBy("a", "b", "err").applyInPandas(join, "src bigint, dst bigint")


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one for each row of ``docs``.

    Documents link if their fingerprints differ in ``max_bits`` bits or fewer; ``component_id`` is
    the smallest id that links reach. Copies share a fingerprint and are joined as one; they find
    their class by a join that Spark can split when a fingerprint is very common.

    A null text counts as empty: fingerprint zero, which links like any other. Null ids never name
    a component that has another id. Ids may repeat, row for row; other columns are ignored. A task
    holds the words of one text at a time, however long.
    """
    marked = cut(fingerprints(docs, shingle_words))
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = connected_labels(near_links(distinct.select("fp"), max_bits))
    label = F.coalesce("label", "fp").alias("label")
    labelled = cut(
        distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", label, "least")
    )
    names = cut(labelled.groupBy("label").agg(F.min("least").alias("component_id")))
    classes = cut(labelled.select("fp", "label").join(names, "label").select("fp", "component_id"))
    return marked.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group of near copies: that with the smallest id."""
    groups = near_groups(docs, shingle_words, max_bits)
    keep = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = keep.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
