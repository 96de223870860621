"""The pipeline's near-dedup stage against brute force."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
from agroloom.llm import similar

from .test_near import groups_of


def brute_set(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return 9 * len(a & b) >= 4 * (len(a) + len(b))


def corpus():
    random.seed(12)
    words = [f"w{i}" for i in range(500)]
    lines = [" ".join(random.choice(words) for _ in range(30)) for _ in range(3)]
    rows = []
    for base in range(25):
        text = [random.choice(words) for _ in range(random.randrange(20, 200))]
        for _ in range(8):
            copy = text[:]
            for _ in range(random.choice([0, 1, 1, 2, 3, 5])):
                copy[random.randrange(len(copy))] = random.choice(words)
            if random.random() < 0.3:
                copy.append(random.choice(lines))
            rows.append((len(rows), " ".join(copy)))
            text = copy if base % 2 else text
    # a chain of links in a large group, and awkward rows
    chain = [random.choice(words) for _ in range(100)]
    for k in range(60):
        rows.append((1000 + k, " ".join(chain[k // 2 :] + [f"x{i}" for i in range(k // 2)])))
    return rows + [(2000, "One two"), (2001, "one TWO"), (2002, ""), (2003, None), (2004, " \n"), (None, rows[3][1])]


def test_the_stage_keeps_what_brute_force_keeps(spark, monkeypatch):
    rows = corpus()
    random.shuffle(rows)
    sets = [brute_set(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if alike(sets[a], sets[b])]
    assert len({*map(len, sets)}) > 20 and len(links) > 300
    least: dict[int, int] = {}
    for (i, _), g in zip(rows, groups_of(len(rows), links), strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for chunk_bytes in (10**7, 20_000):
        monkeypatch.setattr(similar, "CHUNK_BYTES", chunk_bytes)
        kept = corpus_pipeline.drop_near_copies(spark, df, "")
        assert kept.columns == df.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())
    assert corpus_pipeline.drop_near_copies(spark, df.limit(0), "").count() == 0


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    random.seed(21)
    words = [f"w{i}" for i in range(3000)]
    passage = [random.choice(words) for _ in range(60)]
    rows = []
    for i in range(200):
        own = [random.choice(words) for _ in range(30 + i % 50)]
        rows.append((i, " ".join(own + passage + own[:10])))
    counts = []
    plain = similar._similar

    def counted(pairs, docs, marked):
        counts.append(pairs.count())
        return plain(pairs, docs, marked)

    monkeypatch.setattr(similar, "_similar", counted)
    monkeypatch.setattr(similar, "CHUNK_BYTES", 30_000)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert corpus_pipeline.drop_near_copies(spark, df, "").count() == len(rows)
    assert sum(counts) < len(rows)


def test_sketches_never_rule_out_a_link():
    random.seed(22)
    for _ in range(300):
        n = random.randint(1, 400)
        a = np.unique(np.array([random.getrandbits(63) for _ in range(n)], "i8"))
        keep = a[: max(1, int(len(a) * random.uniform(0.7, 1)))]
        b = np.unique(np.concatenate([keep, np.array([random.getrandbits(63) for _ in range(random.randint(0, n // 4))], "i8")]))
        shared = len(np.intersect1d(a, b))
        if 9 * shared >= 4 * (len(a) + len(b)):
            assert similar.may_be_similar(similar.sketch(a), similar.sketch(b))
    assert similar.sketch(np.zeros(300, "i8")) == b"" and similar.may_be_similar(b"", b"x")
