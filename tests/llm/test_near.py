"""SimHash, components and embedding groups against brute force."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from agroloom.llm import components, hnsw, simhash


def groups_of(n, links):
    least = list(range(n))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_paths_stars_and_cycles(spark):
    random.seed(3)
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 40)]
    cycle = [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    edges = path + star + cycle + [(300, 300), (0, 1)]
    random.shuffle(edges)
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    rows = components.connected_labels(df).collect()
    found: dict[int, set[int]] = {}
    for r in rows:
        found.setdefault(r["label"], set()).add(r["node"])
    wanted = [set(range(61)), set(range(100, 140)), set(range(200, 207))]
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted))
    assert components.connected_labels(df.limit(0)).count() == 0


def brute_fingerprint(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    for text in ("", " \n", "One", "ÄB c", "a b c", "a b C d e f", "x " * 3000, "word " * 70_000):
        assert simhash.fingerprint(text) == brute_fingerprint(text, 3)


def test_the_trie_join_finds_every_pair(monkeypatch):
    random.seed(5)
    centre = random.getrandbits(64)
    near = [centre ^ sum(1 << random.randrange(64) for _ in range(3)) for _ in range(300)]
    values = np.unique(np.array(near + [random.getrandbits(64) for _ in range(300)], "u8"))
    for leaf, at_once in ((64, 1_000_000), (1, 10)):
        monkeypatch.setattr(simhash, "LEAF", leaf)
        monkeypatch.setattr(simhash, "AT_ONCE", at_once)
        found = {(int(a), int(b)) for i, j in simhash.trie_pairs(values, None, 0, 0, 2) for a, b in zip(i, j, strict=True)}
        wanted = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if bin(int(values[i]) ^ int(values[j])).count("1") <= 2}
        assert found == wanted


def test_near_groups_split_dense_nodes(spark, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_PAIR", 20)
    random.seed(6)
    words = [f"w{i}" for i in range(400)]
    base = [random.choice(words) for _ in range(300)]
    rows = []
    for i in range(120):
        text = base[:]
        for _ in range(i % 4):
            text[random.randrange(300)] = random.choice(words)
        rows.append((i, " ".join(text) if i % 3 else " ".join(random.choice(words) for _ in range(50)), "x"))
    rows += [(900, None, "x"), (901, "", "x"), (None, " ".join(base), "x"), (5, rows[5][1], "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    got = simhash.near_groups(df).collect()
    assert len(got) == len(rows)
    prints = [brute_fingerprint(t or "", 3) for _, t, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 2]
    group = groups_of(len(rows), links)
    least: dict[int, int] = {}
    for (i, _, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    wanted = sorted((str(i), f"{p:016x}", least[g]) for (i, _, _), p, g in zip(rows, prints, group, strict=True))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == wanted
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == set(least.values())
    assert simhash.near_groups(df.limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, n_links string")


def test_embedding_groups(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 100)
    monkeypatch.setattr(hnsw, "COUNT_BLOCK", 7)
    random = np.random.default_rng(8)
    rows = []
    for i in range(400):
        if i % 4 == 0:
            x = rows[i % 40][1] + random.normal(0, 0.02, 16) if i > 40 else random.normal(0, 1, 16)
        else:
            x = random.normal(0, 1, 16)
        rows.append((i, x.astype("f4").astype("f8"), i % 2 if i < 390 else 3))
    rows += [(500 + i, rows[0][1], 0) for i in range(5)]
    table = [(i, x.tolist(), int(lab), "x") for i, x, lab in rows]
    odd = [
        (600, None, 1, None), (601, [0.0] * 16, 1, None), (602, [1.0, None] + [0.0] * 14, 1, None),
        (603, [float("nan")] + [1.0] * 15, 1, None), (604, [float("inf")] + [1.0] * 15, 1, None),
        (605, rows[0][1].tolist(), None, None), (None, rows[0][1].tolist(), 0, None), (606, [1.0, 2.0], 0, None),
    ]
    got = hnsw.embedding_groups(vectors(spark, table + odd)).collect()
    assert len(got) == len(table) + len(odd)
    by_id = {r["vec_id"]: r for r in got}
    for i in (600, 601, 602, 603, 604, 605, 606):
        assert (by_id[i]["n_links"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    group = groups_of(len(rows), list(zip(*np.nonzero(near), strict=True)))
    ids = [r[0] for r in rows]
    least: dict[int, int] = {}
    for i, g in zip(ids, group, strict=True):
        least[g] = min(i, least.get(g, i))
    for k, i in enumerate(ids):
        assert by_id[i]["n_links"] == near[k].sum()
        assert by_id[i]["component_id"] == least[group[k]]
    assert hnsw.embedding_groups(vectors(spark, [])).count() == 0


def test_tight_groups_larger_than_the_beam_link_across(spark):
    random = np.random.default_rng(4)
    angle = np.arccos(0.94)
    centres = np.zeros((2, 32))
    centres[0, 0], centres[1, :2] = 1, (np.cos(angle), np.sin(angle))
    x = np.repeat(centres, 200, axis=0)
    x[:, 2:] += random.normal(0, 0.005, (400, 30))
    x = x.astype("f4").astype("f8")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T
    assert near[:200, :200].min() > 0.99 and near[:200, 200:].min() > 0.93 and near[:200, 200:].max() < 0.95
    rows = [(i, v.tolist(), 0, None) for i, v in enumerate(x)]
    got = hnsw.embedding_groups(vectors(spark, rows)).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(399, 0)}


def brute_links(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    return near


def test_a_chain_of_dense_groups_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 150)
    monkeypatch.setattr(hnsw, "SMALL_BLOCK", 16)
    random = np.random.default_rng(14)
    step = np.arccos(0.945)
    groups = []
    for k, size in enumerate((120, 60, 40, 90)):
        centre = np.zeros(24)
        centre[:2] = np.cos(k * step), np.sin(k * step)
        groups.append(centre + np.concatenate([np.zeros((size, 2)), random.normal(0, 0.006, (size, 22))], axis=1))
    x = np.concatenate([*groups, random.normal(0, 1, (100, 24))]).astype("f4").astype("f8")
    near = brute_links(x)
    assert near[0, 120:180].all() and not near[0, 180:310].any()
    group = groups_of(len(x), list(zip(*np.nonzero(near), strict=True)))
    rows = [(i, v.tolist(), 0, None) for i, v in enumerate(x)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in hnsw.embedding_groups(vectors(spark, rows)).collect()}
    assert got == {i: (int(near[i].sum()), group[i]) for i in range(len(x))}


def test_links_are_folded_in_parts(monkeypatch):
    random = np.random.default_rng(9)
    x = random.normal(0, 1, (90, 16))
    x[30:] = x[:30].repeat(2, axis=0) + random.normal(0, 0.05, (60, 16))
    graphs = pd.DataFrame({"label": "0", "dim": 16, "shard": 0, "rep": np.arange(90) * 2, "embedding": list(x)})
    graphs = hnsw._build(graphs)
    queries = pd.DataFrame({"rep": np.arange(90) * 2 + 1, "embedding": list(x + 1e-6)})
    whole = hnsw._query(graphs, queries)
    monkeypatch.setattr(hnsw, "HELD", 5)
    parts = hnsw._query(graphs, queries)
    monkeypatch.setattr(hnsw, "RECALL", 2)  # no beam passes the audit: all are compared
    monkeypatch.setattr(hnsw, "EXACT_BLOCK", 7)
    exact = hnsw._query(graphs, queries)
    assert len(whole) == 150
    for other in (parts, exact):
        assert sorted(other.itertuples(index=False)) == sorted(whole.itertuples(index=False))


def test_the_graph_recalls_neighbours():
    x = np.random.default_rng(1).normal(0, 1, (1500, 24)).astype("f4")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph(x)
    near = x @ x.T
    hits = 0
    for k in range(0, 1500, 50):
        truth = set(np.argsort(-near[k])[:5].tolist())
        hits += len(truth & {n for _, n in graph.search(x[k], 64)})
    assert hits >= 0.9 * 5 * 30


def test_a_component_keeps_its_smallest_id(spark):
    df = spark.createDataFrame([(7, "a b c d"), (3, "A B c d"), (9, "q r s t u v w")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(df).collect()}
    assert got == {7: 3, 3: 3, 9: 9}
    assert simhash.drop_near_copies(df).select(F.sort_array(F.collect_list("doc_id"))).first()[0] == [3, 9]
