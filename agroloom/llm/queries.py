"""The queries over the operators of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    exact_dedup,
    filter_audit,
    hnsw,
    language_id,
    mixing,
    page_text,
    quality,
    simhash,
    spelling,
    suffix_dedup,
    token_counts,
    window_dedup,
)
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each text of ``documents`` by the public byte-level tokenizer."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path(token_counts.TOKENIZER))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text of ``documents`` without 50-byte strings that start in an earlier one, as a digest."""
    rest = suffix_dedup.without_earlier_substrings(table(spark, sf_dir, "documents"))
    return rest.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of sources takes."""
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("copies")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of each document, by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts that each document is in, and which row of it stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text's ids and of the bytes that they decode to."""
    docs = table(spark, sf_dir, "documents")
    both = bpe.round_trip(docs, public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and the component of each vector of ``embeddings``."""
    return hnsw.embedding_groups(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and the component of each document."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op10_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text of ``documents`` without repeated windows of 35 words, as a digest."""
    rest = window_dedup.without_repeated_windows(table(spark, sf_dir, "documents"))
    return rest.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page of ``pages``."""
    return page_text.extracted(table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of ``documents``, and the commoner word that each is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of ``documents`` in each order, by language."""
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_source_mixing": op3_source_mixing,
    "op4_quality": op4_quality,
    "op5_language_id": op5_language_id,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_simhash": op9_simhash,
    "op10_window_dedup": op10_window_dedup,
    "op11_html_extraction": op11_html_extraction,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL = {
    "op2_suffix_dedup": """
        with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        w as (select doc_id, i, substr(h, 2 * i + 1, 100) as s
              from (select doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) as i from d)),
        f as (select s, min(doc_id) as first from w group by s having count(*) > 1),
        hit as (select distinct w.doc_id, unnest(range(w.i, w.i + 50)) as p from w join f using (s) where f.first < w.doc_id),
        span as (select doc_id, count(*) as n_removed,
                 count(*) filter (p - 1 <> coalesce(before, -9)) as n_spans
                 from (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from hit) group by 1),
        kept as (select b.doc_id, string_agg(substr(d.h, 2 * b.p + 1, 2), '' order by b.p) as k
                 from (select doc_id, unnest(range(0, length(h) // 2)) as p from d where doc_id in (select doc_id from span)) b
                 join d using (doc_id) anti join hit on hit.doc_id = b.doc_id and hit.p = b.p group by 1)
        select d.doc_id, length(d.h) // 2 as n_bytes, coalesce(span.n_removed, 0) as n_removed,
               coalesce(span.n_spans, 0) as n_spans,
               sha256(unhex(case when span.doc_id is null then d.h else coalesce(kept.k, '') end)) as kept_sha256
        from d left join span using (doc_id) left join kept using (doc_id)
    """,
    "op8_embedding_dedup": """
        with recursive v as (
            select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings),
        ok as (select * from v where label is not null and e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
               and list_dot_product(e, e) > 0),
        pairs as (select a.vec_id as u, b.vec_id as w from ok a join ok b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
                  where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
        reach(u, w) as (select vec_id, vec_id from embeddings union select r.u, p.w from reach r join pairs p on r.w = p.u),
        least as (select u, min(w) as component_id from reach group by 1),
        links as (select u, count(*) as n from pairs group by 1)
        select vec_id, coalesce(links.n, 0) as n_links, component_id, vec_id = component_id as kept
        from embeddings join least on least.u = vec_id left join links on links.u = vec_id
    """,
    "op10_window_dedup": r"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
        w as (select doc_id, i, array_to_string(words[i:i + 34], ' ') as s
              from (select doc_id, words, unnest(range(1, greatest(1, len(words) - 33))) as i from d)),
        f as (select s from w group by s having count(*) > 1),
        hit as (select distinct doc_id, unnest(range(i, i + 35)) as p from w where s in (select s from f)),
        n as (select doc_id, count(*) as n_removed from hit group by 1),
        kept as (select b.doc_id, string_agg(b.word, ' ' order by b.p) as k
                 from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from d) b
                 anti join hit on hit.doc_id = b.doc_id and hit.p = b.p group by 1)
        select d.doc_id, len(words) as n_words, coalesce(n.n_removed, 0) as n_removed, sha256(coalesce(kept.k, '')) as kept_sha256
        from d left join n using (doc_id) left join kept using (doc_id)
    """,
    "op6_exact_dedup": r"""
        with n as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
            from documents)
        select doc_id,
               min(doc_id) over (partition by norm) as keep_id,
               count(*) over (partition by norm) as group_size,
               doc_id is not distinct from min(doc_id) over (partition by norm) as kept,
               sha256(norm) as text_sha256
        from n
    """,
    "op13_filter_audit": r"""
        with t as (
            select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
        d as (
            select part, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic,
                   case when len(words) < 100 then 'A' else '' end
                   || case when 100 * len(list_distinct(words)) < 80 * len(words) then 'B' else '' end
                   || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 'C' else '' end
                   || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
                   || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as fails
            from t left join labels using (doc_id)),
        g as (select part, good, toxic, fails, count(*) as n from d group by all),
        f as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
        orders as (
            select a.f || b.f || c.f || d.f || e.f as filter_order from f a, f b, f c, f d, f e
            where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        steps as (
            select filter_order, step::integer as step, filter_order[step] as own, filter_order[1:step - 1] as earlier
            from (select filter_order, unnest(range(1, 6)) as step from orders)),
        each as (
            select part, filter_order, step, own, n, good, toxic, contains(fails, own) as failed, fails = own as alone,
                   earlier <> '' and regexp_matches(fails, '[' || earlier || '_]') as gone
            from steps cross join g),
        sums as (
            select part, filter_order, step, own,
                   coalesce(sum(n) filter (not gone and not failed), 0) as kept,
                   coalesce(sum(n) filter (not gone and failed), 0) as removed,
                   coalesce(sum(n) filter (gone and failed), 0) as redundant,
                   coalesce(sum(n) filter (alone), 0) as unique_fails,
                   coalesce(sum(n) filter (not gone and failed and good), 0) as good_lost,
                   coalesce(sum(n) filter (not gone and failed and toxic), 0) as toxic_lost
            from each group by all)
        select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
               unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
               (sum(removed) over (partition by part, own))::bigint as shapley
        from sums
    """,
}
