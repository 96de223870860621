"""A training-data pipeline over ``documents``: each stage works on all that the one before kept.

All stages take rows one by one: ids may be null or repeat, a null text counts as empty, and the
columns of ``documents`` stay, whatever others there are. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroloom.llm import bpe, exact_dedup, language_id, mixing, similar
from agroloom.llm.common import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the others go.

    A null or empty text, and one without a letter, goes. What labels of ``lang`` there are teach
    the model; without any, no language can be told and every document goes. Equal scores: the
    language first in code point order.
    """
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest id.

    A null id comes after all others; of rows that share the smallest id, the one first by its
    text's hash stays, and rows equal in id and text stay together.
    """
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar five-word shingles: that with the smallest id.

    Texts without a word are one group. Ties as among exact copies.
    """
    return similar.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Texts without a word are never taken; a null source is a source. Rows equal in id, text and
    source are taken equally often. Reruns agree.
    """
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids, decoded_sha256): the texts as token ids, and what those decode to.

    Row for row, repeated ones too; a null text has no tokens, a null id stays null.
    """
    path = public_tokenizers.path(bpe.RANKS)
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode_texts),
]

#: A classifier and random rounding take part, so SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
