"""Spelling variants against every pair of words, and numbers of trie nodes."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

from agroloom.llm import spelling

DOCS = "doc_id bigint, text string, id string, word string, n string, kind string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", None) for i, t in rows], DOCS)


def lowered(run: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def brute(rows) -> dict:
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: sorted((v for v in n if near(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: vs[0] if vs and n[vs[0]] >= 5 * n[w] else None for w, vs in close.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n}


def found(spark, rows) -> dict:
    got = spelling.variants(docs(spark, rows)).collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


def test_equal_to_all_pairs(spark):
    random.seed(3)
    stems = ["colour", "ÀÉàéßü", "aabbaa", "letter", "banana", "aaaaaa", "straße"]
    words = set(stems)
    for _ in range(300):
        w = random.choice(sorted(words))
        at, letter = random.randrange(len(w)), random.choice("abteÀéz×÷ÿ")
        words.add(random.choice([w[:at] + letter + w[at:], w[:at] + w[at + 1 :], w[:at] + letter + w[at + 1 :]]))
    rows, words = [], sorted(words)
    for i in range(600):
        k = [min(int(random.paretovariate(0.6)), len(words)) - 1 for _ in range(60)]
        rows.append((i, " ".join(words[j].title() if random.random() < 0.2 else words[j] for j in k)))
    rows += [(900, "zebras " * 800), (901, "zebrass " * 100), (902, "zebrasss " * 8)]
    rows += [(None, "colour " * 400), (None, None), (7, ""), (8, "a" * 30_000 + " tail-less"), (8, "ÿ" * 6 + "1" + "Ā")] * 5
    wanted = brute(rows)
    assert sum(form is not None for form, *_ in wanted.values()) > 10
    assert any(root != form and form for form, root, *_ in wanted.values())  # a chain
    got = found(spark, rows)
    assert got == wanted


def test_without_words(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, None), (2, "short a1b2"), (3, "lonely words here")]) == {}
    assert found(spark, [(1, "letter " * 5)]) == {"letter": (None, "letter", 5, 0, None)}


def test_an_extremely_common_word_and_its_variants(spark):
    rows = [(i, "common " * 50 + "commen coomon comon commons") for i in range(400)]
    assert found(spark, rows) == brute(rows)


def test_numbers_that_clash_are_found_and_others_taken(spark, monkeypatch):
    words = spark.createDataFrame([("letter",), ("ladder",), ("better",)], "word string")
    assert spelling.clashes(words, 1).isEmpty()
    tried = []
    plain = spelling.clashes

    def first_fails(rows, root):
        tried.append(root)
        return rows if root == 1 else plain(rows, root)

    monkeypatch.setattr(spelling, "clashes", first_fails)
    rows = spark.createDataFrame([("letter", 50, 1), ("better", 5, 0)], "word string, n bigint, id bigint")
    assert {r["id"]: r["n_near"] for r in spelling.near_words(rows).collect()} == {0: 1, 1: 1}
    assert tried == [1, 2]


def test_equal_prefixes_and_suffixes_have_equal_nodes():
    words = ["ab", "abc", "c", "abcbc"]
    tries = spelling.Tries(words, 9)
    places = [(w, i) for w in words for i in range(len(w) + 1)]
    for nodes, part in ((tries.prefix, lambda w, i: w[:i]), (tries.suffix, lambda w, i: w[i:])):
        by_part = {}
        for (w, i), node in zip(places, nodes, strict=True):
            assert by_part.setdefault(part(w, i), node) == node
        assert len(np.unique(list(by_part.values()))) == len(by_part)
