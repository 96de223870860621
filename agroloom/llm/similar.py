"""Near copies by word shingles: SimHash links first, completed to all pairs of a Jaccard similarity of 0.8.

SimHash alone can't give that threshold: such pairs differ in about 10 of 64 bits, where a trie
prunes nothing. So the trie self-join finds what lies within its budget, and an exact prefix join
completes it; every link of either is decided by the sets themselves.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import TEXTS, content_key, cut, keyed, row_key, semi, text_of, worker_cache
from .components import connected_labels

SHINGLE_WORDS = 5
#: Bytes of text in a chunk, on average.
CHUNK_BYTES = 8_000_000
#: Tokens for each counter of a sketch, on average.
EACH = 4


def shingles(text: str, words_each: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending; a shorter text is one shingle."""
    words = text.encode().lower().split()  # as for fingerprints
    if not words:
        return np.zeros(0, "i8")
    if len(words) < words_each:
        parts = [b" ".join(words)]
    else:
        parts = list(map(b" ".join, zip(*(words[i:] for i in range(words_each)), strict=False)))
    hashes = map(xxhash.xxh64_intdigest, parts, repeat(simhash.HASH_SEED))
    return np.unique(np.fromiter(hashes, "<u8", len(parts)).view("<i8"))


def nodes_of(sets: list[np.ndarray]) -> pa.Array:
    """64 bits that name each set."""
    return pa.array(np.fromiter((xxhash.xxh3_64_intdigest(t.tobytes()) for t in sets), "<u8", len(sets)).view("<i8"))


def prefix(tokens: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of a set that others have too, and their places in the set's order.

    Tokens go by weight, which grows with the number of sets that have one and is 0 for one alone.
    A set of n shares at least 0.8 n tokens with a similar one, so both ends of a link meet in the
    first n - ceil(0.8 n) + 1 of any order that is the same for all sets.
    """
    n = len(tokens)
    first = np.lexsort((tokens, weight))[: n - (4 * n + 4) // 5 + 1] if n else np.zeros(0, "i8")
    at = np.flatnonzero(weight[first] > 0)
    return tokens[first[at]], at


def sketch(tokens: np.ndarray) -> bytes:
    """How many tokens fall on each value of their low bits, a byte a counter; empty if one is too large."""
    size = 8
    while size * EACH < len(tokens):
        size *= 2
    counts = np.bincount(tokens & (size - 1), minlength=size)
    return counts.astype("u1").tobytes() if counts.max() < 256 else b""


def may_be_similar(a: bytes, b: bytes) -> bool:
    """False only where the sketches prove a similarity under 0.8: what two sets share of each
    counter is no more than the lesser of its counts."""
    if not a or not b:
        return True
    x, y = (np.frombuffer(v, "u1").astype("i4") for v in (a, b))
    total, size = int(x.sum() + y.sum()), min(len(x), len(y))
    shared = np.minimum(x.reshape(-1, size).sum(axis=0), y.reshape(-1, size).sum(axis=0)).sum()
    return 9 * int(shared) >= 4 * total


def _sets(batches):
    """Rows (node, tokens)."""
    worker_cache()  # what an earlier stage left
    for whole, i in ((b, i) for b in batches for i in range(0, len(b), TEXTS)):
        found = [shingles(t) for t in whole.column("text").slice(i, TEXTS).to_pylist()]
        columns = [nodes_of(found), pa.array(found, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["node", "tokens"])


class _Tally:
    """The distinct tokens of a chunk, in the order of their shards."""

    def __init__(self, sets: list[np.ndarray], shards: int) -> None:
        flat = np.concatenate([np.zeros(0, "i8"), *sets]).view("u8")
        code = (flat >> np.uint64(32)) % np.uint64(shards) << np.uint64(31) | flat & _LOW
        self.codes, self.of, self.counts = np.unique(code, return_inverse=True, return_counts=True)


_LOW = np.uint64((1 << 31) - 1)
_AGAIN = np.uint32(1 << 31)


def _tallies(shards: int):
    """Rows (shard, chunk, body): a chunk's tokens, 31 bits each, and whether several of its sets have them."""

    def run(table: pa.Table) -> pa.Table:
        worker_cache()
        t = _Tally([shingles(x) for x in table.column("text").to_pylist()], shards)
        body = (t.codes & _LOW).astype("u4") | np.where(t.counts > 1, _AGAIN, np.uint32(0))
        shard = (t.codes >> np.uint64(31)).astype("i4")
        edges = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard)).tolist()
        rows = [(int(shard[a]), body[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
        chunk = table.column("chunk")[0].as_py()
        return pa.table(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            ["shard", "chunk", "body"],
        )

    return run


def _weights(table: pa.Table) -> pa.Table:
    """Rows (chunk, shard, body): for each token of a chunk 0, or 1 and the logarithm of how often it is met."""
    bodies = [np.frombuffer(b, "<u4") for b in table.column("body").to_pylist()]
    every = np.concatenate(bodies)
    _, of = np.unique(every & ~_AGAIN, return_inverse=True)
    met = np.bincount(of, 1 + (every >= _AGAIN))
    weight = np.where(met > 1, 1 + np.log2(np.maximum(met, 1)), 0).astype("u1")[of]
    parts = np.split(weight, np.cumsum([len(b) for b in bodies])[:-1])
    return pa.table([table.column("chunk"), table.column("shard"), pa.array([p.tobytes() for p in parts], pa.binary())], ["chunk", "shard", "body"])


def _marks(shards: int):
    names = ["doc_id", "key", "node", "n", "fp", "sketch", "prefix", "places"]

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        worker_cache()
        sets = [shingles(t) for t in table.column("text").to_pylist()] if len(table) else []
        tally = _Tally(sets, shards)
        answers = answers.sort_by("shard")
        weight = np.frombuffer(b"".join(answers.column("body").to_pylist()), "u1")[tally.of]
        found = [prefix(t, w) for t, w in zip(sets, np.split(weight, np.cumsum([len(t) for t in sets])[:-1]), strict=True)] if sets else []
        fps = np.array([simhash.majority(t.view("u8")) for t in sets], "<u8").view("<i8")
        return pa.table(
            [
                table.column("doc_id"), table.column("key"), nodes_of(sets), pa.array(list(map(len, sets)), pa.int32()),
                pa.array(fps), pa.array(list(map(sketch, sets)), pa.binary()),
                pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.int64())),
            ],
            names,
        )

    return run


def _marked(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, key, node, n, fp, sketch, prefix, places), one for each row of ``docs``.

    Texts are dealt to chunks. A chunk sends its distinct tokens, four bytes each, to shards that
    see which ones others have too, and a byte for each comes back. Tokens of equal bits count as
    one, which changes their order alike in all sets.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // CHUNK_BYTES))
    by_chunk = docs.withColumn("chunk", F.pmod(F.xxhash64(F.lit(19), "doc_id", "key"), F.lit(parts)).cast("int")).groupBy("chunk")
    tallies = by_chunk.applyInArrow(_tallies(parts), "shard int, chunk int, body binary")
    weights = tallies.groupBy("shard").applyInArrow(_weights, "chunk int, shard int, body binary")
    schema = (
        "doc_id bigint, key bigint, node bigint, n int, fp bigint, sketch binary, prefix array<bigint>, places array<bigint>"
    )
    return by_chunk.cogroup(weights.groupBy("chunk")).applyInArrow(_marks(parts), schema)


def _bounded(batches):
    """The pairs that their sketches leave open."""
    for batch in batches:
        a, b = (batch.column(c).to_pylist() for c in ("x", "y"))
        yield batch.select(["src", "dst"]).filter(pa.array(list(map(may_be_similar, a, b)), pa.bool_()))


def _with_both(pairs: DataFrame, facts: DataFrame, value: str) -> DataFrame:
    """Rows (src, dst, x, y): the value of each end. ``facts`` has a row (node, value) for each."""
    x = facts.select(F.col("node").alias("src"), F.col(value).alias("x"))
    y = facts.select(F.col("node").alias("dst"), F.col(value).alias("y"))
    return pairs.join(x, "src").join(y, "dst")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def _similar(pairs: DataFrame, docs: DataFrame, marked: DataFrame) -> DataFrame:
    """Those of the ``pairs`` (src, dst) of nodes whose sets have a similarity of 0.8 or more.

    Sketches, a byte for four tokens, come first. Whole sets are made and moved only for the ends
    of pairs that these leave open, which are nearly all links.
    """
    sketches = marked.select("node", "sketch").join(_ends(pairs), "node", "left_semi")
    open_ = _with_both(pairs, cut(sketches.dropDuplicates(["node"])), "sketch")
    open_ = cut(open_.mapInArrow(_bounded, "src bigint, dst bigint"))
    rows = marked.select("node", "doc_id", "key").join(_ends(open_), "node", "left_semi")
    rows = rows.groupBy("node").agg(F.min(row_key("doc_id", "key")).alias("row")).select("row.*").distinct()
    sets = semi(docs, cut(rows)).select("text").mapInArrow(_sets, "node bigint, tokens array<bigint>")
    both = _with_both(open_, cut(sets.dropDuplicates(["node"])), "tokens")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(9 * shared >= 4 * (F.size("x") + F.size("y"))).select("src", "dst")


def _ordered(a: str | Column, b: str | Column) -> list[Column]:
    return [F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")]


def _reach(n: str, at: str, other_n: str, other_at: str) -> Column:
    """Whether two sets can be similar if the token at these places is the first that they share:
    they have no more in common than what follows it."""
    return 9 * F.least(F.col(n) - F.col(at), F.col(other_n) - F.col(other_at)) >= 4 * (F.col(n) + F.col(other_n))


def _simhash_pairs(marked: DataFrame, max_bits: int) -> DataFrame:
    """Pairs of nodes that span the classes of fingerprints within ``max_bits``, found by the trie."""
    nodes = cut(marked.where("n > 0").groupBy("fp").agg(F.min("node").alias("rep"), F.max("node").alias("most")))
    edges = cut(simhash.near_links(nodes.select("fp"), max_bits))
    a = nodes.select(F.col("fp").alias("src"), F.col("rep").alias("a"))
    b = nodes.select(F.col("fp").alias("dst"), F.col("rep").alias("b"))
    across = edges.join(a, "src").join(b, "dst").select(*_ordered("a", "b"))
    several = nodes.where("rep != most").select("fp", "rep")
    same = marked.where("n > 0").select("fp", "node").join(several, "fp").where("node != rep")
    return across.union(same.select(*_ordered("node", "rep"))).distinct()


def near_classes(docs: DataFrame, marked: DataFrame, max_bits: int = simhash.MAX_BITS) -> DataFrame:
    """Rows (node, label): the classes of similar sets, for the nodes that have a link.

    The trie self-join over fingerprints gives the first pairs. Sets also meet by the tokens of
    their prefixes, where each is compared with one other of each token; and then, for tokens whose
    sets aren't all of one class by now, with every set of another class that is within reach. So no
    pair that could join two classes is left out, and neither a large group of copies nor a passage
    that many sets share costs a square.
    """
    # tokens that no other set has were left out, so this is little unless most of a set is shared
    rows = marked.select("node", "n", F.explode(F.arrays_zip("prefix", "places")).alias("x"))
    rows = cut(rows.select("node", "n", F.col("x.prefix").alias("token"), F.col("x.places").alias("at")).distinct())
    shared = rows.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    met = cut(rows.join(shared.where("low != high").select("token"), "token"))
    # where the token comes first there are fewest tokens that others lack: an original, not a changed copy
    centres = met.groupBy("token").agg(F.min(F.struct("at", "n", "node")).alias("centre"))
    near = met.join(centres, "token").where(F.col("node") != F.col("centre.node"))
    near = near.where(_reach("n", "at", "centre.n", "centre.at"))
    pairs = near.select(*_ordered("node", "centre.node")).union(_simhash_pairs(marked, max_bits))
    pairs = cut(pairs.distinct())
    links = cut(_similar(pairs, docs, marked))
    labels = cut(connected_labels(links))
    met = met.join(labels, "node", "left").select("token", "node", "n", "at", F.coalesce("label", "node").alias("label"))
    met = cut(met)
    mixed = met.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    met = cut(met.join(mixed.select("token"), "token", "left_semi"))
    a, b = met.alias("a"), met.alias("b")
    fits = (F.col("a.label") < F.col("b.label")) & _reach("a.n", "a.at", "b.n", "b.at")
    rest = a.join(b, (F.col("a.token") == F.col("b.token")) & fits)
    rest = rest.select(*_ordered("a.node", "b.node")).distinct()
    rest = cut(rest.join(pairs, ["src", "dst"], "left_anti"))
    more = cut(_similar(rest, docs, marked))
    return labels if more.isEmpty() else cut(connected_labels(links.union(more)))


def drop_near_copies(docs: DataFrame, max_bits: int = simhash.MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group of near copies: that with the smallest id.

    Documents link if the sets of their five-word shingles, without regard to case, have a Jaccard
    similarity of 0.8 or more; groups are what links reach. Texts without a word are one group. A
    null text counts as empty. Rows are told apart by id and text together, so ids may be null or
    repeat; a null id comes after all others, and of rows that share an id the one first by its
    text's hash stays. Rows equal in both go or stay together. All columns stay, whatever their
    names; an empty table stays empty. A text is hashed as a whole: some 8 bytes for each word, beside it.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), content_key().alias("key"), text_of().alias("text"))
    marked = cut(_marked(texts))
    labels = near_classes(texts, marked, max_bits)
    rows = marked.select("node", row_key("doc_id", "key").alias("row"))
    least = cut(rows.groupBy("node").agg(F.min("row").alias("least"), F.max("row").alias("most")))
    named = cut(least.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    first = named.groupBy("label").agg(F.min("least").alias("first"), F.max("most").alias("last"))
    classes = named.join(first.where("first != last"), "label").select("node", "first")
    gone = cut(rows.join(classes, "node").where("row != first").select("row.*").distinct())
    return semi(keyed(docs), gone, "left_anti").select("__row.*")
