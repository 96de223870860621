"""Language ID, the quality classifier and the pipeline."""

from __future__ import annotations

import os
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agroloom.llm import language_id, quality, queries

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_language_by_words_and_by_grams(spark):
    random.seed(1)
    vocabulary = {"xx": ["abra", "kadabra", "rabat"], "yy": ["niin", "minun", "nimi"]}
    rows = [(i, " ".join(random.choices(vocabulary[lang], k=6)), lang) for i, lang in enumerate(["xx", "yy"] * 60)]
    rows += [(500, None, "xx"), (501, "12 !? ² ½", "yy"), (502, "abrada", None), (503, "ninu", None), (None, "abra", "xx"), (504, "", "yy")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id bigint, text string, lang string, score double")
    got = {r["doc_id"]: r for r in language_id.identify(df, language_id.learn(df)).collect()}
    for i, _, lang in rows[:120]:
        assert got[i]["lang_pred"] == lang and got[i]["held_out"] == is_held_out(i) and 0 <= got[i]["score"] <= 1
    assert {got[i]["lang_pred"] for i in (500, 501, 504)} == {"und"} and got[501]["score"] == 0
    assert (got[502]["lang_pred"], got[503]["lang_pred"]) == ("xx", "yy")  # unseen words
    assert got[None]["held_out"]
    kept = language_id.keep_identified(df)
    assert kept.columns == df.columns and kept.where("doc_id in (500, 501, 504)").count() == 0
    nothing = df.where("lang is null")
    assert {r["lang_pred"] for r in language_id.identify(nothing, language_id.learn(nothing)).collect()} == {"und"}
    assert language_id.identify(df.limit(0), language_id.learn(df.limit(0))).count() == 0


def brute_model(rows):
    """Log frequencies by (n, unit), a list by language in order, of all units of all rows."""
    langs = sorted({lang for _, _, lang in rows})
    counts = {lang: Counter() for lang in langs}
    for _, text, lang in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            counts[lang][0, word] += 1
            for n in (1, 2, 3, 4):
                marked = word if n == 1 else f"\x02{word}\x03"
                counts[lang].update((n, marked[i : i + n]) for i in range(len(marked) - n + 1))
    units = set().union(*counts.values())
    kinds = Counter(n for n, _ in units)
    totals = {lang: Counter() for lang in langs}
    for lang in langs:
        for (n, _), c in counts[lang].items():
            totals[lang][n] += c
    return langs, {u: np.array([np.log((counts[g][u] + 0.5) / (totals[g][u[0]] + 0.5 * (kinds[u[0]] + 1))) for g in langs]) for u in units}


def brute_language(langs, table, text):
    """Languages' sums of log frequencies, unit by unit: a word, else the longest n-grams that are known."""
    total = np.zeros(len(langs))
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        if (0, word) in table:
            total += table[0, word]
            continue
        for n in (4, 3, 2, 1):
            marked = word if n == 1 else f"\x02{word}\x03"
            rows = [table[n, marked[i : i + n]] for i in range(len(marked) - n + 1) if (n, marked[i : i + n]) in table]
            if rows:
                total += np.mean(rows, axis=0)
                break
    share = np.exp(total - total.max())
    return langs[int(total.argmax())], float(share.max() / share.sum())


def unequal_languages():
    random.seed(4)
    rows, vocabulary = [], {}
    for k in range(8):
        letters = [chr(97 + 3 * k + j) for j in range(3)]
        vocabulary[f"l{k}"] = ["".join(random.choices(letters, k=random.randint(3, 7))) for _ in range(400 if k < 2 else 20)]
        rows += [(len(rows) + j, " ".join(random.choices(vocabulary[f"l{k}"], k=40)), f"l{k}") for j in range(300 if k < 2 else 12)]
    return rows, vocabulary


def test_scores_are_those_of_all_units(spark):
    rows, vocabulary = unequal_languages()
    model = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    langs, table = brute_model([r for r in rows if not is_held_out(r[0])])
    assert model.langs == langs and model.units.size == len(table)
    texts = [" ".join(random.choices(vocabulary[f"l{random.randrange(8)}"], k=5)) + " zyx qrst " + random.choice("abz") for _ in range(60)]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in language_id.identify(asked, model).collect():
        lang, score = brute_language(langs, table, texts[r["doc_id"]])
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-3)


def test_shares_of_a_bounded_model(spark, monkeypatch):
    monkeypatch.setattr(language_id, "UNITS", 2400)
    rows, vocabulary = unequal_languages()
    model = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    for k in range(8):
        assert model.rows(0, sorted(set(vocabulary[f"l{k}"])))[0].sum() >= 15  # none is crowded out by the large ones
    assert model.value.size <= 2400
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    few = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert few.langs == ["l0", "l1"]


def test_a_rare_word_of_a_large_vocabulary_decides(spark):
    """Both languages have the same letters; only words that occur once tell them apart."""
    random.seed(8)
    words = list({"".join(random.choices("abcdefgh", k=9)) for _ in range(60_000)})
    half = len(words) // 2
    own = {"xx": words[:half], "yy": words[half:]}
    rows = []
    for lang, known in own.items():
        rows += [(len(rows) + j, " ".join(known[j * 100 : j * 100 + 100]), lang) for j in range(half // 100)]
    learnt = {lang: [w for i, text, g in rows if g == lang and not is_held_out(i) for w in text.split()] for lang in own}
    assert min(map(len, learnt.values())) > 20_000
    model = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    asked = [(k, learnt[lang][20_000 + k // 2], lang) for k, lang in enumerate(["xx", "yy"] * 100)]
    found = language_id.identify(spark.createDataFrame(asked, "doc_id bigint, text string, lang string"), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {k: lang for k, _, lang in asked}


@needs_tables
def test_held_out_accuracy_of_language(spark):
    got = queries.op5_language_id(spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()


def test_the_sum_of_squares_identity_is_all_pairs():
    source = np.random.default_rng(0)
    factors, weights = source.normal(size=(9, 3)), source.normal(size=9)
    index, value = np.array([1, 4, 7]), np.array([0.5, -1.0, 2.0])
    pairs = sum(
        factors[index[a]] @ factors[index[b]] * value[a] * value[b] for a in range(3) for b in range(a)
    )
    wanted = 0.3 + weights[index] @ value + pairs
    assert quality.fm_logit(0.3, weights, factors, index, value) == pytest.approx(wanted)


def test_quality_of_odd_rows(spark):
    random.seed(2)
    rows = []
    for i in range(300):
        good = i % 3 > 0
        rows.append((i, " ".join(random.choices(["the", "cat", "sat", "on"], k=20)) if good else "BUY!! " * random.randint(5, 20), int(good)))
    df = spark.createDataFrame([(i, t, None) for i, t, _ in rows] + [(900, None, None), (901, "", None), (None, "the cat", None)], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(None, 1, 0), (901, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.learn(df, labels)
    got = {r["doc_id"]: r for r in quality.score(df, model).collect()}
    assert len(got) == len(rows) + 3
    held = [(got[i]["predicted"], y) for i, _, y in rows if is_held_out(i)]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    # fitting again gives the same machine; no labels give the same score to all
    again = quality.learn(df.repartition(5), labels)
    assert np.array_equal(model[1], again[1])
    flat = quality.learn(df, labels.limit(0))
    assert quality.score(df, flat).agg(F.countDistinct("score")).first()[0] == 1


def brute_score(model, text):
    """The machine's probability with every pair of features written out."""
    bias, weights, factors = model
    words, counts = (text or "").encode().split(), {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    index, value = quality.features(text or "", {})
    length = sum(np.log1p(c) ** 2 for c in counts.values()) ** 0.5
    for (word, count), i, v in zip(counts.items(), index, value, strict=False):
        assert i == zlib.crc32(word.lower()) % (1 << quality.HASH_BITS) and v == pytest.approx(np.log1p(count) / length, rel=1e-4)
    logit = bias + sum(float(weights[i]) * float(v) for i, v in zip(index, value, strict=True))
    for a in range(len(index)):
        for b in range(a):
            logit += float(factors[index[a]] @ factors[index[b]]) * float(value[a] * value[b])
    return 1 / (1 + np.exp(-logit))


def test_scores_are_those_of_all_pairs(spark):
    random.seed(8)
    words = ["the", "Cat", "sat", "12", "on", "BUY!!", "ä", "中文", "mat."]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 30))), i % 2) for i in range(120)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(500, None), (501, " \n")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, quality int")
    model = quality.learn(df, labels)
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in quality.score(df, model).collect():
        assert r["score"] == pytest.approx(brute_score(model, texts[r["doc_id"]]), abs=1e-4)


@needs_tables
def test_held_out_ranking_of_quality(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op4_quality(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = got.join(labels, "doc_id").where("held_out").toPandas()
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() >= 0.9


def brute_pipeline_ids(docs):
    """The documents that are left before SimHash: letters, then the first of equal texts."""
    first: dict[str, int] = {}
    for i, text in sorted(docs.items()):
        if any(c.isalpha() for c in text or ""):
            first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", text), i)
    return set(first.values())


@needs_tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "exact dedup", "SimHash near-dedup", "mixing", "byte-level BPE"]
    out = docs
    for name in ("language ID", "exact dedup"):
        out = stages[name](spark, out, SF_DIR)
        assert out.columns == docs.columns
    out = out.cache()
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == brute_pipeline_ids(texts)
    near = stages["SimHash near-dedup"](spark, out, SF_DIR)
    assert near.columns == docs.columns and 0 < near.count() <= out.count()
    mix = stages["mixing"](spark, near, SF_DIR)
    assert mix.columns == docs.columns and mix.groupBy("doc_id").count().where("count > 3").count() == 0
    encoded = stages["byte-level BPE"](spark, mix, SF_DIR)
    assert encoded.count() == mix.count()
    assert encoded.where("n_tokens * 4 != octet_length(ids)").count() == 0


@needs_tables
def test_the_whole_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_a_lookup_of_units_does_not_copy_the_table():
    n = 1_000_000
    keys = np.arange(1, n + 1, dtype="u8") * 7
    model = language_id.Model(["a"], keys, np.zeros(n, "i8"), np.zeros(n, "i8"), np.ones(n), np.full((5, 1), float(n)))
    tracemalloc.start()
    known, _ = model.rows(0, ["word"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not known.any() and peak < n  # the table has 8 bytes a unit
    # keys below, among, between and beyond the units, and no units at all
    asked = np.sort(np.array([language_id.unit_key(1, x) for x in "abcdef"], "u8"))
    by_key = sorted("abcdef", key=lambda x: language_id.unit_key(1, x))
    held = asked[[1, 3, 4]]
    model = language_id.Model(["a"], held, np.zeros(3, "i8"), np.ones(3, "i8"), np.ones(3), np.full((5, 1), 3.0))
    assert model.rows(1, by_key)[0].tolist() == [False, True, False, True, True, False]
    none = np.zeros(0, "i8")
    model = language_id.Model(["a"], none.astype("u8"), none, none, none.astype("f8"), np.zeros((5, 1)))
    assert not model.rows(1, by_key)[0].any()
