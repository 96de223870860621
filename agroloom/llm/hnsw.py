"""Embedding near-duplicates: a navigable small-world graph per shard, asked by every vector."""

from __future__ import annotations

import pickle
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import connected_labels
from .simhash import spanning

THRESHOLD = 0.93
#: Vectors of a shard, and of a block of queries, at most (on average: they are dealt by a hash).
SHARD = 20_000
#: Links of a vector in each layer (twice as many at the bottom), and the beam that finds them.
LINKS, BUILD_BEAM = 10, 48
#: First beam of a query, and the beam beyond which it is compared with the whole shard.
BEAM, WIDEST = 32, 128
#: Queries that an audit compares with brute force, queries planted near vectors of the shard, and
#: the share of their links that the audit asks for.
AUDITED, PLANTED, RECALL = 512, 64, 0.95
#: What single precision may take from a cosine.
SLACK = 1e-4
#: Queries that are compared with a shard at once, and links that are held before they are folded.
EXACT_BLOCK, HELD = 256, 2_000_000
#: Vectors of a block, when links are counted in pairs of blocks of a component; components of
#: some thousands have FEW_BLOCKS smaller ones, so that no task gets most of one.
COUNT_BLOCK, SMALL_BLOCK, FEW_BLOCKS = 1024, 64, 16


class Graph:
    """Hierarchical navigable small world over unit vectors."""

    def __init__(self, vectors: np.ndarray, seed: int = 5) -> None:
        self.x = vectors
        height = -np.log(1 - np.random.default_rng(seed).random(len(vectors))) / np.log(LINKS)
        self.height = height.astype(int).tolist()
        self.layers: list[dict[int, list[int]]] = []
        self.top = -1
        for node in range(len(vectors)):
            self._insert(node)

    def _insert(self, node: int) -> None:
        q, height = self.x[node], self.height[node]
        entries = [self.top] if self.top >= 0 else []
        for layer in range(len(self.layers) - 1, -1, -1):
            links = self.layers[layer]
            if layer > height:
                entries = [self.beam(q, entries, 1, layer)[0][1]]
                continue
            found = self.beam(q, entries, BUILD_BEAM, layer)
            most = LINKS * (1 + (layer == 0))
            links[node] = self._spread(found, LINKS)
            for other in links[node]:
                back = links[other]
                back.append(node)
                if len(back) > most:
                    near = self.x[back] @ self.x[other]
                    order = np.argsort(-near, kind="stable")
                    links[other] = self._spread([(float(near[k]), back[k]) for k in order], most)
            entries = [n for _, n in found]
        if height >= len(self.layers):
            while len(self.layers) <= height:
                self.layers.append({node: []})
            self.top = node

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Of candidates, nearest first: those nearer to the node than to any taken; then the rest."""
        if len(found) <= most:
            return [n for _, n in found]
        nodes = [n for _, n in found]
        near = self.x[nodes] @ self.x[nodes].T
        worst = np.full(len(nodes), -np.inf)
        taken: list[int] = []
        for k, (s, _) in enumerate(found):
            if s > worst[k]:
                taken.append(k)
                if len(taken) == most:
                    break
                np.maximum(worst, near[k], out=worst)
        if len(taken) < most:
            have = set(taken)
            taken += [k for k in range(len(nodes)) if k not in have][: most - len(taken)]
        return [nodes[k] for k in taken]

    def beam(self, q: np.ndarray, entries: list[int], width: int, layer: int) -> list[tuple[float, int]]:
        """The ``width`` nearest that a best-first search finds, nearest first."""
        links, x = self.layers[layer], self.x
        seen = set(entries)
        start = list(zip((x[entries] @ q).tolist(), entries, strict=True))
        todo = [(-s, n) for s, n in start]
        best = start[:]
        heapify(todo)
        heapify(best)
        while len(best) > width:
            heappop(best)
        while todo:
            s, node = heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            new = [n for n in links[node] if n not in seen]
            if not new:
                continue
            seen.update(new)
            for s, n in zip((x[new] @ q).tolist(), new, strict=True):
                if len(best) < width:
                    heappush(best, (s, n))
                elif s > best[0][0]:
                    heapreplace(best, (s, n))
                else:
                    continue
                heappush(todo, (-s, n))
        return sorted(best, reverse=True)

    def search(self, q: np.ndarray, width: int, own: int | None = None) -> list[tuple[float, int]]:
        """The nearest to ``q`` at the bottom layer; ``own`` is its node, if it is in the graph."""
        entries = [self.top]
        for layer in range(len(self.layers) - 1, 0, -1):
            entries = [self.beam(q, entries, 1, layer)[0][1]]
        if own is not None and own not in entries:
            entries.append(own)
        return self.beam(q, entries, width, 0)


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack(rows.to_numpy()).astype("f8")
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep")
    graph = Graph(_unit(rows["embedding"]).astype("f4"))
    body = pickle.dumps((rows["rep"].to_numpy(), graph))
    return pd.DataFrame({"label": rows["label"].iloc[:1], "dim": rows["dim"].iloc[0], "shard": rows["shard"].iloc[0], "graph": [body]})


def _linked(graph: Graph, q: np.ndarray, own: int | None, width: int) -> list[int] | None:
    """Nodes that may link with ``q``: the beam is widened until its farthest hit does not.

    None if that takes a beam over WIDEST, or one that all nodes within reach don't fill.
    """
    while True:
        found = graph.search(q, width, own)
        if found[-1][0] < THRESHOLD - SLACK:
            return [n for s, n in found if s >= THRESHOLD - SLACK and n != own]
        if len(found) < width or width >= WIDEST:
            return None
        width *= 2


def _planted(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Vectors just within THRESHOLD of some of ``x``."""
    base = x[np.linspace(0, len(x) - 1, min(PLANTED, len(x))).astype(int)]
    off = rng.normal(0, 1, base.shape)
    off -= (off * base).sum(axis=1, keepdims=True) * base
    norm = np.sqrt((off * off).sum(axis=1, keepdims=True))
    near = THRESHOLD + 0.01
    return near * base + np.sqrt(1 - near * near) * off / np.maximum(norm, 1e-12)


def _first_beam(graph: Graph, x: np.ndarray, q: np.ndarray, own: list[int | None]) -> int | None:
    """The beam at which the graph gives enough of the audited queries' links; None: none up to WIDEST.

    All links of a query count. Those of planted queries are asked for as well, so the audit says
    something of the graph even where no audited query has a link. Queries that the beam does not
    decide are compared with the whole shard anyway, and prove nothing.
    """
    audited = np.linspace(0, len(q) - 1, min(AUDITED, len(q))).astype(int)
    planted = _planted(x, np.random.default_rng(7))
    asked = np.concatenate([q[audited], planted])
    own = [own[k] for k in audited] + [None] * len(planted)
    truth = []
    for sims, node in zip(asked @ x.T, own, strict=True):
        linked = np.flatnonzero(sims >= THRESHOLD)
        truth.append(linked[linked != node] if node is not None else linked)
    width = BEAM
    while width <= WIDEST:
        # the rows' own links and the planted ones each have to come back
        for part in (slice(0, len(audited)), slice(len(audited), None)):
            owed = got = 0
            for v, wanted, node in zip(asked[part].astype("f4"), truth[part], own[part], strict=True):
                found = _linked(graph, v, node, width) if len(wanted) else None
                if found is not None:
                    owed += len(wanted)
                    got += len(set(found).intersection(wanted.tolist()))
            if got < RECALL * owed:
                break
        else:
            return width
        width *= 2
    return None


def _query(graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest of the links that one block of queries has with one shard.

    Each query's beam is widened until it holds all that may link; a query with more links than the
    widest beam, and all of them where the audit never passes, are compared with the whole shard.
    """
    if not len(graphs) or not len(queries):
        return pd.DataFrame({"src": np.array([], "i8"), "dst": np.array([], "i8")})
    ids, graph = pickle.loads(graphs["graph"].iloc[0])
    queries = queries.sort_values("rep")
    reps, q = queries["rep"].to_numpy(), _unit(queries["embedding"])
    x = graph.x.astype("f8")
    at = {r: k for k, r in enumerate(ids.tolist())}
    own = [at.get(r) for r in reps.tolist()]
    names = np.concatenate([ids, reps])
    node = np.array([len(ids) + k if n is None else n for k, n in enumerate(own)])
    label = np.arange(len(names))
    i, j, held = [], [], 0

    def fold() -> None:
        nonlocal label, held
        label = spanning(len(names), np.concatenate([np.arange(len(names)), *i]), np.concatenate([label, *j]))
        i.clear()
        j.clear()
        held = 0

    width = _first_beam(graph, x, q, own)
    rest = []
    for k, v in enumerate(q.astype("f4")):
        found = None if width is None else _linked(graph, v, own[k], width)
        if found is None:
            rest.append(k)
        elif found:
            close = np.array(found)[x[found] @ q[k] >= THRESHOLD]
            i.append(np.full(len(close), node[k]))
            j.append(close)
            held += len(close)
            if held > HELD:
                fold()
    for start in range(0, len(rest), EXACT_BLOCK):
        block = np.array(rest[start : start + EXACT_BLOCK])
        a, b = np.nonzero(q[block] @ x.T >= THRESHOLD)
        i.append(node[block[a]])
        j.append(b)
        held += len(b)
        if held > HELD:
            fold()
    fold()
    moved = label != np.arange(len(names))
    return pd.DataFrame({"src": names[moved], "dst": names[label[moved]]})


def _count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For each vector of one or two blocks of a component, the vectors linked in the other."""
    _, low, high = key
    x, copies, block = _unit(rows["embedding"]), rows["copies"].to_numpy("i8"), rows["block"].to_numpy()
    a, b = block == low, block == high
    near = x[a] @ x[b].T >= THRESHOLD
    out = [pd.DataFrame({"rep": rows["rep"][a], "links": near @ copies[b]})]
    if low != high:
        out.append(pd.DataFrame({"rep": rows["rep"][b], "links": near.T @ copies[a]}))
    return pd.concat(out)


def embedding_groups(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``vectors``.

    Vectors of one label and length link at a cosine of THRESHOLD or more, in double precision.
    Equal vectors are joined as one with a count. A label's vectors are dealt to shards by a hash,
    each with a graph, and to blocks of queries; every block asks every shard of its label. Tasks
    hand on spanning forests, never all pairs. Links are then counted exactly among the members
    of each component, in pairs of blocks, so both ends of a link count it.

    Vectors that are null, zero, or hold null or non-finite components, and rows with a null label
    or a null ``vec_id``, link with nothing: 0 links, their own component, kept. Rows that repeat a
    ``vec_id`` with one vector count as copies. Other columns are ignored.
    """
    values = F.col("embedding").cast("array<double>")
    norm = F.aggregate(values, F.lit(0.0), lambda s, v: s + v * v)
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = finite & (norm > 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("string"), values.alias("embedding"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
    )
    linkable = rows.where("usable").withColumn("dim", F.size("embedding"))
    key = ["label", "dim"]
    reps = cut(
        linkable.groupBy(*key, "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    sizes = cut(reps.groupBy(*key).agg(F.ceil(F.count("*") / SHARD).cast("int").alias("parts")))
    dealt = reps.join(sizes, key).withColumns(
        {
            "shard": F.pmod(F.xxhash64("rep"), "parts").cast("int"),
            "block": F.pmod(F.xxhash64(F.lit(1), "rep"), "parts").cast("int"),
        }
    )
    graphs = dealt.groupBy(*key, "shard").applyInPandas(
        _build, "label string, dim int, shard int, graph binary"
    )
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    graphs = graphs.join(sizes, key).withColumn("block", F.explode(every))
    queries = dealt.drop("shard").withColumn("shard", F.explode(every))
    pair = [*key, "shard", "block"]
    links = (
        graphs.select(*pair, "graph").groupBy(*pair)
        .cogroup(queries.select(*pair, "rep", "embedding").groupBy(*pair))
        .applyInPandas(_query, "src bigint, dst bigint")
    )
    labels = cut(connected_labels(cut(links)).withColumnRenamed("label", "class"))
    classes = cut(
        labels.groupBy("class").agg(F.min("node").alias("component_id"), F.count("*").alias("members"))
    )
    members = labels.join(classes, "class").join(reps, F.col("node") == F.col("rep"))
    small = F.least(F.ceil(F.col("members") / SMALL_BLOCK), F.lit(FEW_BLOCKS))
    blocks = F.greatest(small, F.ceil(F.col("members") / COUNT_BLOCK)).cast("int")
    members = members.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "rep"), blocks).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.select(
        "class", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "rep", "embedding", "copies", "block",
    )
    counted = members.groupBy("class", "low", "high").applyInPandas(_count, "rep bigint, links bigint")
    counted = counted.groupBy("rep").agg(F.sum("links").alias("links"))
    named = labels.join(classes, "class").select(F.col("node").alias("rep"), "component_id")
    facts = reps.join(counted, "rep", "left").join(named, "rep", "left").select(
        *key, "embedding",
        (F.coalesce("links", "copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    found = linkable.join(cut(facts), [*key, "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
