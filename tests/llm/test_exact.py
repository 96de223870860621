"""Exact dedup, mixing, token counts and byte-level BPE."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agroloom.llm import bpe, exact_dedup, mixing, token_counts

DOCS = "doc_id bigint, text string, lang string, source string, keep_id string, count string"


def docs(spark, rows):
    """Documents (id, text, source) with extra columns whose names clash with those of operators."""
    return spark.createDataFrame([(i, t, None, s, "x", None) for i, t, s in rows], DOCS)


AWKWARD = [
    (1, None, "a"), (2, "", "a"), (3, " \t", None), (4, "one  two", "a"), (5, "one two", "b"),
    (5, "one two", "b"), (None, "one two", "b"), (6, "Ä ß 中文 😀 <|endoftext|> 12345 'll  x", "b"),
    (7, "word " * 20_000, "c"), (8, "a" * 50_000, None),
]


def test_exact_groups(spark):
    got = {(r["doc_id"], r["kept"]): r for r in exact_dedup.exact_groups(docs(spark, AWKWARD)).collect()}
    assert (got[1, True]["keep_id"], got[1, True]["group_size"]) == (1, 2)
    assert not got[2, False]["kept"]
    assert got[3, True]["group_size"] == 1  # white space alone is one space, not nothing
    assert got[4, True]["group_size"] == 4 and got[5, False]["keep_id"] == 4 and got[None, False]["keep_id"] == 4
    assert got[4, True]["text_sha256"] == hashlib.sha256(b"one two").hexdigest()
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0


def test_a_hash_with_two_texts_is_told_apart(spark, monkeypatch):
    plain = exact_dedup._hashed
    monkeypatch.setattr(exact_dedup, "_hashed", lambda d: plain(d).withColumn("h128", F.unhex(F.lit("00" * 16))))
    rows = [(1, "a", None), (2, "b", None), (3, "a", None)]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(docs(spark, rows)).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2)}


def test_copies_go_and_columns_stay(spark):
    df = docs(spark, AWKWARD)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 6, 7, 8]


def test_mix_comes_near_its_targets(spark):
    random.seed(4)
    sources = ["a"] * 600 + ["b"] * 300 + ["c"] * 30 + [None] * 70
    rows = [(i, "w " * random.randint(0, 60), s) for i, s in enumerate(sources)]
    df = docs(spark, rows)
    got = mixing.mixed(df).toPandas()
    assert len(got) == len(rows)
    size = {i: len(t.split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    assert all(size[r.doc_id] == r.size for r in got.itertuples())
    assert set(got.copies) <= {0, 1, 2, 3} and (got.taken == got.copies * got["size"]).all()
    whole = sum(size.values())
    own = {s: sum(v for i, v in size.items() if source[i] == s) for s in set(sources)}
    # weights 5, 2, 1, 5 in code point order, null last; c and null stop at three times their size
    weight, target = {"a": 5, "b": 2, "c": 1, None: 5}, {}
    free = set(weight)
    while True:
        share = (whole - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share > 3 * own[s]}
        if not over:
            break
        free -= over
        target |= {s: 3.0 * own[s] for s in over}
    target |= {s: weight[s] * share for s in free}
    for s in own:
        part = got[[source[i] == s for i in got.doc_id]]
        assert part.target.iloc[0] == pytest.approx(target[s])
        assert abs(part.taken.sum() - target[s]) <= 60
    again = mixing.mixed(df.repartition(7)).toPandas()
    assert dict(zip(got.doc_id, got.taken, strict=True)) == dict(zip(again.doc_id, again.taken, strict=True))


def test_rounding_is_unbiased(spark):
    rows = [(i, "w " * (1 + i % 5), "a" if i % 2 else "b") for i in range(40)]
    df = docs(spark, rows)
    total: dict[int, int] = {}
    for seed in range(12):
        for r in mixing.mixed(df, weights=(1.0, 2.0), seed=seed * 1000).collect():
            total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["copies"]
    for which in (0, 1):
        mean = np.mean([total[i] / 12 for i in range(40) if i % 2 == which])
        own, whole = sum(1 + i % 5 for i in range(40) if i % 2 == which), sum(1 + i % 5 for i in range(40))
        expected = whole * (1 / 3 if which else 2 / 3) / own
        assert abs(mean - expected) < 0.15


def test_mix_of_awkward_rows(spark):
    got = mixing.mixed(docs(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["taken"] for r in got if r["size"] == 0} == {0}
    assert mixing.mixed(docs(spark, [])).count() == 0
    df = docs(spark, AWKWARD)
    assert mixing.mixed_documents(df).columns == df.columns


def test_token_counts_are_the_librarys(spark):
    path = public_tokenizers.path(token_counts.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    got = token_counts.token_counts(docs(spark, AWKWARD), path).collect()
    wanted = sorted((len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for _, t, _ in AWKWARD)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == wanted
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    assert token_counts.token_counts(docs(spark, []), path).count() == 0


def test_pretokens_of_all_scripts_are_looked_up(spark, monkeypatch):
    path = public_tokenizers.path(token_counts.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    texts = ["中文 字符 中文。", "สวัสดี ครับ", "مرحبا بالعالم 123", "ok 😀😀 ™ x", "नमस्ते दुनिया", "a\u2028b \u3000 c", "한국어 텍스트 <|endoftext|> 中", "Ⅷ ½ ٣٤ x\u00a0y", "q" * 400 + " 中", "\U0001f468\u200d\U0001f469"]
    split = token_counts._splitter(path)
    for text in texts[:6]:
        assert "".join(split(text)) == text
    monkeypatch.setattr(token_counts, "AT_ONCE", 5)
    got = token_counts.token_counts(docs(spark, list(zip(range(len(texts)), texts, [None] * len(texts), strict=True))), path)
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)}
    frequent = token_counts.frequent_pretokens(docs(spark, [(1, "中文 中文", None), (2, "y" * 100, None)]), path)
    assert sorted(frequent) == [" 中文", "中文"]  # none that is longer than the bound


def test_a_full_summary_keeps_the_most_frequent(monkeypatch):
    from collections import Counter

    monkeypatch.setattr(token_counts, "FREQUENT", 2)
    assert token_counts._pruned(Counter("aaaabbbcc")) == Counter({"a": 2, "b": 1})


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path(bpe.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_ids_are_the_librarys(spark, library):
    df = docs(spark, AWKWARD)
    path, pattern = public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN
    got = bpe.encode(df, path, pattern)
    ids = sorted(np.frombuffer(r["ids"], "<u4").tolist() for r in got.collect())
    assert ids == sorted(library.encode_ordinary(t or "") for _, t, _ in AWKWARD)
    texts = sorted(bytes(r["decoded"]) for r in bpe.decode(got, path, pattern).collect())
    assert texts == sorted((t or "").encode() for _, t, _ in AWKWARD)
    assert bpe.round_trip(docs(spark, []), path, pattern).count() == 0


def test_merges_follow_the_library(library):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    random.seed(2)
    for _ in range(500):
        piece = "".join(random.choice(["a", "an", "the", "é", "中", "ing", "q"]) for _ in range(random.randint(1, 40)))
        assert bpe.merge(piece.encode(), ranks) == library.encode_ordinary(piece)


def test_new_pretokens_are_merged_together_as_one_by_one(library, monkeypatch):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    random.seed(3)
    parts = ["a", "an", "the", "é", "中", "ing", "q", " ", "aaaa", "\0", "es"]
    words = sorted({"".join(random.choices(parts, k=random.randint(1, 25))) for _ in range(2000)} | {"a" * 300, "ab" * 40})
    want = [np.array(bpe.merge(w.encode(), ranks), "<u4").tobytes() for w in words]
    assert bpe.merge_all([w.encode() for w in words], ranks) == want
    assert bpe.merge_all([], ranks) == []
    # short new ones are never merged one by one, whatever the cache turns over
    seen, merge = [], bpe.merge
    monkeypatch.setattr(bpe, "merge", lambda piece, ranks: seen.append(piece) or merge(piece, ranks))
    monkeypatch.setattr(bpe, "CACHED", 100)
    pieces = bpe._Pieces(ranks)
    for i in range(0, len(words), 50):
        for _ in range(2):
            assert pieces.encoded([words[i : i + 50], words[:3], []]) == [b"".join(want[i : i + 50]), b"".join(want[:3]), b""]
    assert all(len(piece) > bpe.TOGETHER or piece in ranks for piece in seen)
    assert len(pieces.new) + len(pieces.old) < 400 and not any("a" * 300 in kept for kept in (pieces.new, pieces.old))
