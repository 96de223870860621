"""Token counts by a two-tier lookup in the map tasks; no pre-token is shuffled."""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import cache
from uuid import uuid4

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of, worker_cache
from .pretokens import splitters

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
#: Entries of the broadcast table, and of each summary that the table is made from, and the
#: characters of the longest: together a bound of some megabytes.
FREQUENT, LONGEST = 32_768, 64
#: Entries of a worker's cache beside that table, and the characters of the longest; a full one is emptied.
CACHED, LONGEST_CACHED = 400_000, 256
#: Summaries that one step of the reduction merges.
FAN_IN = 16
#: Characters of texts that are split before the misses among them are encoded.
AT_ONCE = 2_000_000


@cache
def _library(path: str):
    """The tokenizer, and a pattern that matches its special strings as the library does."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    parts = json.loads(tokenizer.to_str())
    if (parts["pre_tokenizer"] or {}).get("type") != "ByteLevel" or parts["normalizer"]:
        raise ValueError(f"{path} is no plain byte-level tokenizer")
    added = sorted((re.escape(x["content"]) for x in parts["added_tokens"]), key=len, reverse=True)
    return tokenizer, re.compile("|".join(added) or "(?!)")


@cache
def _splitter(path: str):
    """A function from a text to its pre-tokens; outside the blocks on which all Unicode versions
    agree, they are those of the library's own pre-tokenizer."""
    split, odd = splitters()
    library = _library(path)[0].pre_tokenizer.pre_tokenize_str

    def pretokens(text: str) -> list[str]:
        if odd(text):
            return [text[a:b] for _, (a, b) in library(text)]
        return split(text)

    return pretokens


def _count_frequent(path: str):
    """Each task's summary of its pre-tokens: after Misra and Gries, in FREQUENT counters."""

    def run(batches):
        split = _splitter(path)
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(w for w in split(text) if len(w) <= LONGEST)
                if len(counts) > 8 * FREQUENT:
                    counts = _pruned(counts)
        counts = _pruned(counts)
        yield pa.RecordBatch.from_pydict(
            {"words": [list(counts)], "counts": [list(counts.values())]},
            pa.schema([("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]),
        )

    return run


def _pruned(counts: Counter) -> Counter:
    """The FREQUENT largest counters, less the largest one dropped."""
    if len(counts) <= FREQUENT:
        return counts
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    less = top[FREQUENT][1]
    return Counter({w: n - less for w, n in top[:FREQUENT] if n > less})


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    counts: Counter = Counter()
    for words, numbers in zip(rows["words"], rows["counts"], strict=True):
        for word, n in zip(words, numbers, strict=True):
            counts[word] += int(n)
    counts = _pruned(counts)
    return pd.DataFrame(
        {"node": [rows["node"].iloc[0] // FAN_IN], "words": [list(counts)], "counts": [list(counts.values())]}
    )


def frequent_pretokens(docs: DataFrame, path: str) -> list[str]:
    """The most frequent pre-tokens of all texts, FREQUENT at most, of LONGEST characters at most.

    Every task summarises its own texts; a tree merges the summaries, FAN_IN at a time, so no
    task holds more than that many and the driver gets one. A pre-token that makes up more than
    one in FREQUENT of the corpus is in it. Which ones are in it changes the speed, never a count.
    """
    level = docs.select(text_of().alias("text")).mapInArrow(
        _count_frequent(path), "words array<string>, counts array<bigint>"
    )
    level = cut(level.withColumn("node", F.spark_partition_id()))
    nodes = (level.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1:
        level = level.groupBy(F.expr(f"node div {FAN_IN}").alias("to")).applyInPandas(
            _merged, "node int, words array<string>, counts array<bigint>"
        )
        nodes = -(-nodes // FAN_IN)
    row = level.first()
    return list(row["words"]) if row else []


def _counter(path: str, frequent, token: str):
    """A function from texts to token counts; its tables are kept between a worker's tasks."""
    tokenizer, special = _library(path)
    split = _splitter(path)
    tiers = worker_cache(token, lambda: {"first": frequent.value, "all": dict(frequent.value)})

    def encoded(words: list[str]):
        return zip(words, map(len, tokenizer.encode_batch_fast(words, add_special_tokens=False)), strict=True)

    def counts(texts: list[str]) -> list[int]:
        if len(tiers["all"]) > len(tiers["first"]) + CACHED:
            tiers["all"] = dict(tiers["first"])
        lengths, whole, words, missing = tiers["all"], [], [], set()
        for text in texts:
            found = special.findall(text)
            whole.append(len(found))
            words.append([w for piece in special.split(text) for w in split(piece)] if found else split(text))
            missing.update(set(words[-1]).difference(lengths))
        long = {}
        for word, n in encoded(list(missing)):
            (lengths if len(word) <= LONGEST_CACHED else long)[word] = n
        if long:
            return [n + sum(lengths[x] if x in lengths else long[x] for x in w) for n, w in zip(whole, words, strict=True)]
        return [n + sum(map(lengths.__getitem__, w)) for n, w in zip(whole, words, strict=True)]

    return counts


def token_counts(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each row of ``docs``.

    ``path`` names a byte-level tokenizer for the library ``tokenizers``; counts are the library's,
    with special strings in a text as single tokens (its default) and none added. The first tier
    is a broadcast table of at most FREQUENT pre-token lengths, of LONGEST characters at most;
    misses are encoded together and kept in the worker's bounded cache, long ones apart.

    A null text counts as empty and has no tokens; ids may be null or repeat, row for row. Other
    columns are ignored; an empty table gives no rows.
    """
    tokenizer, _ = _library(path)
    words = frequent_pretokens(docs, path)
    encoded = tokenizer.encode_batch_fast(words, add_special_tokens=False)
    frequent = docs.sparkSession.sparkContext.broadcast(
        {w: len(x) for w, x in zip(words, encoded, strict=True)}
    )

    token = uuid4().hex

    def count(batches):
        counts = _counter(path, frequent, token)
        for batch in batches:
            out, texts, size = [], [], 0
            for text in batch.column("text").to_pylist():
                texts.append(text)
                size += len(text)
                if size > AT_ONCE:
                    out += counts(texts)
                    texts, size = [], 0
            out += counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(out, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.octet_length(text_of()).cast("bigint").alias("n_bytes"),
        text_of().alias("text"),
    ).mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
