"""Repeated windows: the sorting, the index, and both operators against brute force."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from agroloom.llm import fm_index, repeats, suffix_dedup, suffix_sort, window_dedup, windows


def brute_suffixes(t):
    order = sorted(range(len(t)), key=lambda i: t[i:].tolist())
    shared = [0]
    for a, b in zip(order, order[1:], strict=False):
        k = 0
        while a + k < len(t) and b + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        shared.append(k)
    return order, shared


@pytest.mark.parametrize("in_memory", [1, 10**6])
def test_suffix_arrays(monkeypatch, in_memory):
    plain = suffix_sort.BucketQueue.__init__
    monkeypatch.setattr(suffix_sort.BucketQueue, "__init__", lambda self, n: plain(self, n, in_memory))
    source = np.random.default_rng(1)
    for _ in range(150):
        t = source.integers(0, source.integers(1, 5), source.integers(1, 50)).astype("i8")
        order, shared = suffix_sort.suffix_array(t, 100)
        assert (order.tolist(), shared.tolist()) == brute_suffixes(t)
        cap = int(source.integers(1, 12))
        order, shared = suffix_sort.suffix_array(t, cap)
        heads = [t[i : i + cap].tolist() for i in order]
        assert heads == sorted(heads) and sorted(order.tolist()) == list(range(len(t)))
        for k in range(1, len(t)):
            a, b = heads[k - 1], heads[k]
            n = next((m for m, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert shared[k] == n


def test_backward_search_counts():
    source = np.random.default_rng(2)
    for _ in range(20):
        parts = [source.integers(1, 4, source.integers(3, 30)) for _ in range(6)]
        text = np.concatenate([np.append(p, 0) for p in parts])
        index = fm_index.FMIndex(text, 4, 40)
        for width in (1, 3):
            starts = np.array([i for i in range(len(text) - width + 1) if (text[i : i + width] > 0).all()])
            found = index.occurrences(text, starts, width, threshold=1)
            wanted = [sum((text[j : j + width] == text[i : i + width]).all() for j in range(len(text) - width + 1)) for i in starts]
            assert found.tolist() == wanted


def test_equal_windows_have_equal_owners(monkeypatch):
    source = np.random.default_rng(3)
    shared = source.integers(0, 2**60, 90).astype("u8")
    a = np.concatenate([source.integers(0, 2**60, 33).astype("u8"), shared])
    b = np.concatenate([shared, source.integers(0, 2**60, 70).astype("u8")])
    bounds = np.array([0, len(a), len(a) + len(b)])
    for at_once in (400_000, 64):
        monkeypatch.setattr(windows, "AT_ONCE", at_once)
        r = windows.runs(np.concatenate([a, b]), bounds, 50, 20)
        owner = {}
        for key, begin, n, place in zip(r.key, r.begin, r.n, r.owner, strict=True):
            for k in range(n):
                owner[begin + k] = (int(key), int(place - begin - k))
        assert sorted(owner) == [*range(len(a) - 49), *range(len(a), len(a) + len(b) - 49)]
        for k in range(41):
            assert owner[33 + k] == owner[len(a) + k]


def corpus():
    source = random.Random(9)
    words = ["the", "of", "ä", "cat", "sat", "中文", "x", "mat", "and", "zebra"]

    def text(n):
        return "".join(source.choice(words) + source.choice([" ", "  ", "\n"]) for _ in range(n))

    shared = [text(k) for k in (12, 20, 40, 80)]
    rows = []
    for i in range(60):
        parts = [text(source.randint(0, 40))]
        for _ in range(source.randint(0, 3)):
            piece = source.choice(shared)
            cut = source.randint(0, len(piece) // 3)
            parts += [piece[cut:], text(source.randint(0, 20))]
        rows.append((i * 3, "".join(parts)))
    rows += [(500, None), (501, ""), (502, "a" * 400), (503, "a" * 300), (1, rows[4][1]), (None, rows[6][1]), (7, shared[3] * 2), (9, rows[9][1]), (9, rows[9][1])]
    return rows


def brute_bytes(rows, width):
    big = 10**9
    first: dict[bytes, int] = {}
    data = [(big if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for s in range(len(b) - width + 1):
            key = b[s : s + width]
            first[key] = min(i, first.get(key, i))
    out = []
    for (i, b), (identity, _) in zip(data, rows, strict=True):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - width + 1):
            if first[b[s : s + width]] < i:
                gone[s : s + width] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, "u1")[~gone].tobytes()
        out.append((str(identity), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def brute_words(rows, width):
    seen: dict[tuple, int] = {}
    data = [(t or "").encode().split() for _, t in rows]
    for w in data:
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for w, (identity, _) in zip(data, rows, strict=True):
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - width + 1):
            if seen[tuple(w[s : s + width])] > 1:
                gone[s : s + width] = True
        out.append((str(identity), len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out)


@pytest.mark.parametrize("chunk_bytes", [10**7, 900])
def test_both_operators_against_brute_force(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk_bytes)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, kept string")
    got = suffix_dedup.without_earlier_substrings(df).collect()
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got)
    assert found == brute_bytes(rows, 50)
    got = window_dedup.without_repeated_windows(df, words=12, gram=4).collect()
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got)
    assert found == brute_words(rows, 12)


def test_far_apart_ids_and_an_empty_table(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(2**62, text), (-(2**62), text), (5, text)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.without_earlier_substrings(df).collect()}
    assert got == {2**62: len(text), -(2**62): 0, 5: len(text)}
    assert suffix_dedup.without_earlier_substrings(df.limit(0)).count() == 0
    assert window_dedup.without_repeated_windows(df.limit(0)).count() == 0


def lines_in_every_document(n, seed=1):
    """Documents of random text around one line that all of them hold."""
    source = random.Random(seed)
    line = "This text may be used, copied and passed on by anyone, as long as this line stays in it."
    letters = "abcdefghijklmnopqrstuvwxyz     "

    def noise(k):
        return "".join(source.choice(letters) for _ in range(k))

    return [(i, noise(300) + line + noise(300)) for i in range(n)]


def test_the_sample_grows_with_the_corpus():
    assert [repeats.sample_size(n) for n in (0, 1000, 3_000_000, 10**10)] == [1500, 1500, 1500, 5_000_000]


@pytest.mark.parametrize("common", [3, 10**9])
def test_a_line_in_every_document_is_dealt_to_all_shards(spark, monkeypatch, common):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(repeats, "COMMON", common)
    monkeypatch.setattr(repeats, "INDEXED", 3_000)
    rows = lines_in_every_document(600)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sent = []
    plain = repeats._wanted

    def counted(table):
        out = plain(table)
        shard = table.column("shard")[0].as_py()
        total = sum(len(b) // 4 for b in out.column("body").to_pylist())
        return repeats._table([(shard, -1, total.to_bytes(8, "little"))], [("chunk", repeats.pa.int32()), ("shard", repeats.pa.int32()), ("body", repeats.pa.binary())])

    monkeypatch.setattr(repeats, "_wanted", counted)
    task = repeats.Task(50, 24, suffix_dedup._symbols, suffix_dedup.first_ids, suffix_dedup._finish, "", True)
    texts = df.select("doc_id", repeats.content_key().alias("key"), "text")
    grams = repeats._common_grams(texts, len(rows), task)
    shards = 10
    common_table = spark.sparkContext.broadcast(grams)
    chunks = texts.withColumn("chunk", repeats.F.expr(f"cast(doc_id % {shards} as int)"))
    records = chunks.groupBy("chunk").applyInArrow(repeats._summaries(task, shards, common_table), "shard int, chunk int, base bigint, body binary, ids binary")
    for r in records.groupBy("shard").applyInArrow(counted, "chunk int, shard int, body binary").collect():
        sent.append(int.from_bytes(r["body"], "little"))
    # grams that are told to be common spread what lies over the line's edges
    assert (max(sent) <= 3 * sorted(sent)[len(sent) // 2]) == (common == 3)
    monkeypatch.setattr(repeats, "_wanted", plain)
    got = suffix_dedup.without_earlier_substrings(df).collect()
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got)
    assert found == brute_bytes(rows, 50)


def test_word_windows_of_the_contracts_width(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(repeats, "INDEXED", 500)
    source = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    shared = [[source.choice(words) for _ in range(k)] for k in (34, 35, 36, 60, 90)]
    rows = []
    for i in range(150):
        parts = [source.choice(words) for _ in range(source.randint(0, 60))]
        for _ in range(source.randint(0, 2)):
            piece = source.choice(shared)
            parts += piece[source.randint(0, 10) :] + [source.choice(words) for _ in range(source.randint(0, 9))]
        rows.append((None if i % 7 == 0 else i % 40, " ".join(parts)))
    rows += [(None, "x y " * 60), (3, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = window_dedup.without_repeated_windows(df).collect()
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got)
    assert found == brute_words(rows, 35)


def test_batches_hold_whole_owner_grams(monkeypatch):
    monkeypatch.setattr(repeats, "INDEXED", 10)
    owner = np.repeat([1, 2, 3, 9, 10], [2, 1, 5, 1, 1])
    symbols = np.array([4, 4, 3, 9, 9, 9, 9, 9, 1, 1])
    found = list(repeats._batches(owner, symbols))
    assert found == [(0, 2), (2, 3), (3, 8), (8, 10)]
    assert [b for _, b in found][-1] == len(owner) and list(repeats._batches(owner[:0], symbols[:0])) == []


def test_hashing_works_on_arrays_that_fit_a_cores_cache(monkeypatch):
    symbols = windows.mixed(np.arange(1, 257, dtype="u8"))
    h = symbols[np.random.default_rng(1).integers(0, 256, 400_000)]
    tracemalloc.start()
    r = windows.runs(h, np.array([0, len(h)]), 50, 24)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16_000_000  # 3.2 MB are the ends, one number a symbol
    # the same windows under the same owners as in one block
    monkeypatch.setattr(windows, "AT_ONCE", len(h))
    whole = windows.runs(h, np.array([0, len(h)]), 50, 24)
    assert r.n.sum() == whole.n.sum() == len(h) - 49
    assert np.array_equal(np.repeat(r.owner, r.n), np.repeat(whole.owner, whole.n))
    assert np.array_equal(np.repeat(r.key, r.n), np.repeat(whole.key, whole.n))


@pytest.mark.parametrize("at_once", [65_536, 100])
def test_words_are_hashed_together_by_their_bytes(monkeypatch, at_once):
    monkeypatch.setattr(window_dedup, "AT_ONCE", at_once)
    source = random.Random(4)
    letters = [" ", "\t", "\x0b", "\x0c", "\r\n", "\0", "\x1c", "\x85", "\xa0", "a", "b", "中", "ab" * 17]
    hash_of: dict[bytes, int] = {}
    for _ in range(400):
        texts = ["".join(source.choice(letters) for _ in range(source.randint(0, 40))).encode() for _ in range(source.randint(0, 6))]
        hashes, bounds, sent = window_dedup._symbols(texts)
        words = [t.split() for t in texts]
        assert bounds.tolist() == np.cumsum([0, *map(len, words)]).tolist() and sent.dtype == "u8"
        for word, value in zip([w for of in words for w in of], hashes.tolist(), strict=True):
            assert hash_of.setdefault(word, value) == value
    # words that differ in one byte, in the number of their zero bytes, or in where lanes of eight bytes meet
    base = bytes(range(65, 65 + 70))
    others = {base[:n] for n in range(1, 71)} | {b"\0" * n for n in range(1, 71)}
    others |= {base[:k] + bytes([base[k] ^ flip]) + base[k + 1 : n] for n in (8, 9, 16, 64, 65, 70) for k in range(n) for flip in (1, 128)}
    others = sorted(others - set(hash_of))
    hash_of |= zip(others, window_dedup._symbols([b" ".join(others)])[0].tolist(), strict=True)
    assert len(set(hash_of.values())) == len(hash_of) > 1000
    # short words need no call each

    def one_by_one(word):
        raise AssertionError(word)

    monkeypatch.setattr(window_dedup.xxhash, "xxh64_intdigest", one_by_one)
    assert len(np.unique(window_dedup._symbols([" ".join(map(str, range(200_000))).encode()])[0])) == 200_000


def test_equal_patterns_are_searched_once(monkeypatch):
    piece = np.random.default_rng(5).integers(1, 50, 40)
    text = np.concatenate([np.append(piece, 0)] * 30)
    index = fm_index.FMIndex(text, 50, 40)
    asked = []
    plain = fm_index.FMIndex.extend
    monkeypatch.setattr(fm_index.FMIndex, "extend", lambda self, symbol, *rest: asked.append(len(symbol)) or plain(self, symbol, *rest))
    starts = np.arange(30) * 41
    assert index.occurrences(text, starts, 35).tolist() == [30] * 30
    assert asked == [1] * 35
