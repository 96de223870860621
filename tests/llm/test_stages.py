"""The pipeline's stages on null and repeated ids, clashing columns and empty tables."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import pytest

STAGES = dict(corpus_pipeline.STAGES)
#: Columns whose names the stages use themselves.
SCHEMA = "doc_id bigint, text string, lang string, source string, key string, node int, row string, label string, __n int, id int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, f"k{k}", k, "r", "l", k, k) for k, (i, t, lang, s) in enumerate(rows)], SCHEMA)


def left(df):
    return sorted((str(r["doc_id"]), r["text"], r["node"]) for r in df.collect())


def language_rows():
    random.seed(3)
    words = {"xx": ["abra", "kadabra", "rabat"], "yy": ["niin", "minun", "nimi"]}
    rows = [(i, " ".join(random.choices(words[lang], k=6)), lang, "s") for i, lang in enumerate(["xx", "yy"] * 60)]
    return rows + [(None, "abra kadabra", None, "s"), (None, "12 34", None, "s"), (3, "!!", "xx", "s"), (3, "minun nimi", "yy", None), (7, None, "xx", "s"), (8, "", None, "s")]


def test_language_rejects_rows_and_not_ids(spark):
    rows = language_rows()
    df = table(spark, rows)
    kept = STAGES["language ID"](spark, df, "")
    assert kept.schema == df.schema
    assert left(kept) == sorted((str(i), t, k) for k, (i, t, *_) in enumerate(rows) if any(c.isalpha() for c in t or ""))


def test_exact_copies_go_by_row(spark):
    rows = [(5, "a  b", None, None), (2, "a b", None, None), (None, "a\tb", None, None), (2, "c", None, None), (2, "A b", None, None), (9, "c", None, None), (None, "d", None, None), (None, "e", None, None), (4, None, None, None), (6, "", None, None)]
    df = table(spark, rows)
    kept = STAGES["exact dedup"](spark, df, "")
    assert kept.schema == df.schema
    assert {k for _, _, k in left(kept)} == {1, 3, 4, 6, 7, 8}


def test_near_copies_go_by_row(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(300)]
    base = [random.choice(words) for _ in range(80)]
    near = base[:-1] + ["changed"]
    other = " ".join(random.choice(words) for _ in range(80))
    rows = [(7, " ".join(base), None, "s"), (3, " ".join(near), None, "s"), (3, other, None, "s"), (None, " ".join(near + ["more"]), None, "s"), (None, "quite another text", None, "s"), (8, None, None, None), (9, " ", None, None)]
    df = table(spark, rows)
    kept = STAGES["SimHash near-dedup"](spark, df, "")
    assert kept.schema == df.schema
    assert {k for _, _, k in left(kept)} == {1, 2, 4, 5}


def test_the_mix_takes_rows_and_not_ids(spark):
    rows = [(i % 40, f"w{i} " * (1 + i % 7), None, "ab"[i % 2]) for i in range(200)]
    rows += [(None, f"x{i} y", None, None) for i in range(50)] + [(99, "same row", None, "a")] * 30 + [(98, None, None, "a"), (97, "", None, None)]
    df = table(spark, rows).drop("node", "__n", "id", "key")
    mixed = STAGES["mixing"](spark, df, "")
    assert mixed.schema == df.schema
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect())
    assert set(got) <= {(i, t, s) for i, t, _, s in rows if (t or "").split()}
    size = Counter()
    own = Counter()
    for i, t, _, s in rows:
        own[s] += len((t or "").split())
    for (_, t, s), n in got.items():
        size[s] += n * len(t.split())
    # weights 5, 2 and 1 of all words; the third source stops at three times its own
    whole, target = sum(own.values()), {}
    target[None] = min(3 * own[None], whole / 8)
    for s, w in (("a", 5), ("b", 2)):
        target[s] = (whole - target[None]) * w / 7
    for s in (None, "a", "b"):
        assert abs(size[s] - min(target[s], 3 * own[s])) <= 60
    again = STAGES["mixing"](spark, df.repartition(5), "")
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in again.collect()) == got


def test_encoding_keeps_each_row(spark):
    rows = [(1, "a b", None, None), (1, "a b", None, None), (None, None, None, None), (2, "ä 中文", None, None)]
    got = STAGES["byte-level BPE"](spark, table(spark, rows), "").collect()
    assert len(got) == 4 and sorted(r["n_tokens"] for r in got)[0] == 0


@pytest.mark.parametrize("name", list(STAGES))
def test_an_empty_table_stays_empty(spark, name):
    df = table(spark, [(1, "a b c", "xx", "s")]).limit(0)
    assert STAGES[name](spark, df, "").count() == 0
