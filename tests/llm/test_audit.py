"""The audit of filters against a plain simulation of all orders."""

from __future__ import annotations

import random
import re
from itertools import permutations

from agroloom.llm import filter_audit

DOCS = "doc_id bigint, text string, lang string, n string, cell string, id string"
LABELS = "doc_id bigint, quality int, toxic int, present string"


def tables(spark, rows, labels):
    return (
        spark.createDataFrame([(i, t, p, "x", "y", "z") for i, t, p in rows], DOCS),
        spark.createDataFrame([(*r, "x") for r in labels], LABELS),
    )


def brute(rows, labels) -> dict:
    def fails(doc_id, text):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        text = text or ""
        earlier = [i for i, t, _ in rows if (t or "") == text and i is not None and (doc_id is None or i < doc_id)]
        return "".join(name for name, failed in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)), bool(earlier),
        ), strict=True) if failed)

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    each = [(p or "", fails(i, t), i in good, i in toxic) for i, t, p in rows]
    out = {}
    for part in {p for p, *_ in each}:
        own = [r[1:] for r in each if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                failing = [r for r in own if f in r[0]]
                total[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(r[0] == f for r in own),
                                          sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(spark, rows, labels) -> dict:
    got = filter_audit.interactions(*tables(spark, rows, labels)).collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got}
    assert len(out) == len(got)
    return out


def test_equal_to_a_simulation_of_all_orders(spark):
    random.seed(5)

    def text():
        words = [f"w{k}" for k in range(random.choice([5, 130, 99, 100]))]
        words *= random.choice([1, 1, 2])
        words += random.choice([[], ["#x"], ["ABC" * 60], ["a|b"]])
        return " ".join(words)

    texts = [text() for _ in range(40)]
    rows = [(random.randrange(150), random.choice(texts), random.choice(["en", "de", None, ""])) for _ in range(200)]
    rows += [(None, texts[0], "en"), (None, None, None), (5, "", "en"), (5, "", "en"), (6, None, "fr"), (200, "Ab " * 200_000, "en")]
    labels = [(i, random.choice([0, 1, None]), random.choice([0, 1])) for i in range(120)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    wanted = brute(rows, labels)
    assert found(spark, rows, labels) == wanted
    assert len(wanted) == 4 * 600


def test_empty_tables(spark):
    assert found(spark, [], [(1, 1, 1)]) == {}
    one = found(spark, [(1, "word", "en")], [])
    assert one == brute([(1, "word", "en")], []) and len(one) == 600


def test_copies_of_one_text(spark):
    rows = [(i, "the same text", "en") for i in range(3000)] + [(0, "the same text", "de")]
    assert found(spark, rows, []) == brute(rows, [])


def test_relations_are_stored_by_filter(spark):
    docs, _ = tables(spark, [(1, "a #b", "en"), (2, "a #b", "en"), (3, "word " * 200, "en")], [])
    got = {name: sorted(r["id"] for r in rows.collect()) for name, rows in filter_audit.failing_relations(filter_audit._checked(docs)).items()}
    assert got == {"A": [1, 2], "B": [3], "C": [], "D": [1, 2], "E": [2]}
