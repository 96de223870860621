"""The main text of web pages, by the templates of their hosts.

A site fills one template with data. Tokens (opened and closed elements by path, and blocks of text)
that occur equally often on each page of a host are one equivalence class: they come from the same
part of the template. A class is valid if its tags follow each other in one order on every page and
end in the gap of another class that they began in; valid classes, nested, are the template. What stands
in its gaps is data. Gaps of links go, as do blocks that the template itself repeats, and those that
elements, classes or ids name as something else; the other blocks are the article.

Occurrence vectors are never built. Each page has two random numbers, and a token's sums of them
over its occurrences are equal for equal vectors; they differ for others, but for one chance in 2^62.
So Spark combines them in the map tasks, and a host with a third of all pages is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, few
from .html_tokens import FIRST, HINTED, LENGTH_SHIFT, LEVEL_1, LEVEL_2, LINKED, TEXT, Reader

#: A token is of the template if it is on at least this share of its host's pages.
SUPPORT = 0.1
#: A text is of the template only where a host has so many pages that differ in their longest text.
TEXT_PAGES = 10
_PAGE = "host bigint, g1 bigint, g2 bigint, longest bigint, tokens array<bigint>, facts array<bigint>"
_FOUND = "host bigint, class bigint, gap int, bad int, chars bigint, linked bigint"


def _host() -> Column:
    """A number for a page's host; a page without one is a host of its own."""
    name = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    alone = F.xxhash64(F.lit(1), "page_id", "url", "html")
    return F.when(F.coalesce(name, F.lit("")) != "", F.xxhash64(F.lit(0), name)).otherwise(alone).alias("host")


def _pages(pages: DataFrame) -> DataFrame:
    """Each page's tokens, without its texts."""
    own = F.xxhash64("page_id", "url", "html")
    rows = pages.select(_host(), own.alias("own"), F.coalesce("html", F.lit("")).alias("html"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            out = {name: [] for name in ("host", "g1", "g2", "longest", "tokens", "facts")}
            for host, own, html in zip(*(batch[c].to_pylist() for c in ("host", "own", "html")), strict=True):
                found = reader.read(html)
                longest = max((f >> LENGTH_SHIFT, t) for t, f, _ in found)[1] if found else 0
                values = (host, own & 0x7FFFFFFF, own >> 33 & 0x7FFFFFFF, longest, [t for t, _, _ in found], [f for _, f, _ in found])
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    return cut(rows.mapInArrow(read, _PAGE))


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """Rows (host, class, tags, texts): tags with one occurrence vector, in page order, and texts with it.

    A class needs two tags. On hosts of few differing pages texts are in none, so that a text that
    all pages share is not taken for the template's. A token has to be on a share of the pages, so
    that a host's classes together have at most ten times the tokens of an average page.
    """
    hosts = pages.groupBy("host", "longest").agg(F.count("*").alias("n")).groupBy("host").agg(
        F.sum("n").alias("n_pages"), F.count("*").alias("n_differ")
    )
    hosts = cut(hosts)
    each = pages.select("host", "g1", "g2", F.posexplode(F.arrays_zip("tokens", "facts")).alias("at", "token"))
    each = each.select("host", "g1", "g2", "at", F.col("token.tokens").alias("token"), F.col("token.facts").alias("facts"))
    is_text = F.col("facts").bitwiseAND(F.lit(TEXT)) != 0
    tokens = each.groupBy("host", "token").agg(
        F.sum("g1").alias("g1"),
        F.sum("g2").alias("g2"),
        F.count("*").alias("n"),
        F.sum(F.col("facts").bitwiseAND(F.lit(FIRST))).alias("support"),
        F.min("at").alias("at"),
        F.max(is_text).alias("text"),
    )
    tokens = tokens.where((F.col("support") >= 2) | ~F.col("text"))
    hosts = F.broadcast(hosts) if few(hosts) else hosts
    tokens = tokens.join(hosts, "host").where(
        (F.col("support") >= F.least(F.lit(2), F.col("n_pages")))
        & (F.col("support") >= SUPPORT * F.col("n_pages"))
        & (~F.col("text") | (F.col("n_differ") >= TEXT_PAGES))
    )
    vector = F.xxhash64("g1", "g2", "n", "support")
    tags = F.sort_array(F.collect_list(F.when(~F.col("text"), F.struct("at", "token"))))
    texts = F.collect_list(F.when(F.col("text"), F.col("token")))
    classes = tokens.groupBy("host", vector.alias("class")).agg(tags.alias("tags"), texts.alias("texts")).where("size(tags) > 1")
    return cut(classes.select("host", "class", F.col("tags.token").alias("tags"), "texts"))


class Walk:
    """A host's classes, and where a page's texts stand in them."""

    def __init__(self, classes: Iterable[tuple[int, Iterable[int], Iterable[int]]]):
        self.places: dict[int, tuple[int, int, bool]] = {}  # tag: its class, its rank there, whether it is the last one
        self.texts: set[int] = set()
        for number, tags, texts in classes:
            self.places.update((tag, (number, rank, rank == len(tags) - 1)) for rank, tag in enumerate(tags))
            self.texts.update(texts)

    def through(self, tokens: Iterable[int], facts: Iterable[int]) -> tuple[list[tuple[int, int] | None], set[int]]:
        """For each text the gap (class, rank before it) that it stands in, or None if it is the template's; and the classes out of order.

        A text outside all classes is in the gap (0, 0).
        """
        gaps: list[tuple[int, int] | None] = []
        bad: set[int] = set()
        inside: list[tuple[int, int]] = []
        for token, fact in zip(tokens, facts, strict=True):
            if fact & TEXT:
                gaps.append(None if token in self.texts else inside[-1] if inside else (0, 0))
                continue
            place = self.places.get(token)
            if place is None:
                continue
            number, rank, last = place
            at = next((k for k in range(len(inside) - 1, -1, -1) if inside[k][0] == number), -1)
            if rank == 0 and at < 0:
                inside.append((number, 0))
            elif rank and at >= 0 and inside[at][1] == rank - 1:
                bad.update(c for c, _ in inside[at + 1 :])  # they began in this gap and don't end in it
                del inside[at:]
                if not last:
                    inside.append((number, rank))
            else:
                bad.add(number)
                if at >= 0:
                    del inside[at]
        bad.update(c for c, _ in inside)
        return gaps, bad


class _Walks:
    """The walk of the last hosts, since pages of one host often follow each other."""

    def __init__(self, most: int = 64):
        self.most, self.kept = most, {}

    def of(self, host: int, classes) -> Walk:
        walk = self.kept.get(host)
        if walk is None:
            if len(self.kept) >= self.most:
                self.kept.clear()
            walk = self.kept[host] = Walk([(c["class"], c["tags"], c["texts"]) for c in classes])
        return walk


def _by_host(classes: DataFrame) -> DataFrame:
    return classes.groupBy("host").agg(F.collect_list(F.struct("class", "tags", "texts")).alias("classes"))


def _meet(rows: DataFrame, hosts: DataFrame, narrow: DataFrame) -> DataFrame:
    """``rows`` with what ``hosts`` have of their host; a broadcast as long as ``narrow``, all it holds, is few rows."""
    return rows.join(F.broadcast(hosts) if few(narrow) else hosts, "host", "left")


def _findings(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (host, class, gap, bad, chars, linked): the texts in the gaps of classes, and classes out of order (gap -1)."""
    rows = pages.select("host", "tokens", "facts")
    rows = _meet(rows, _by_host(classes), classes.select("host", F.explode(F.concat("tags", "texts")))).where("classes is not null")

    def find(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walks = _Walks()
        for batch in batches:
            sums: dict[tuple[int, int, int], list[int]] = {}
            for host, tokens, facts, classes in zip(batch["host"], batch["tokens"], batch["facts"], batch["classes"], strict=True):
                gaps, bad = walks.of(host, classes).through(tokens, facts)
                for number in bad:
                    sums.setdefault((host, number, -1), [1, 0, 0])
                for gap, fact in zip(gaps, (f for f in facts if f & TEXT), strict=True):
                    if gap and not fact & HINTED:
                        of = sums.setdefault((host, *gap), [0, 0, 0])
                        of[1] += int(fact) >> LENGTH_SHIFT
                        of[2] += int(fact) >> LENGTH_SHIFT if fact & LINKED else 0
            yield pd.DataFrame([(*k, *v) for k, v in sums.items()], columns=["host", "class", "gap", "bad", "chars", "linked"])

    found = rows.mapInPandas(find, _FOUND)
    return found.groupBy("host", "class", "gap").agg(F.max("bad").alias("bad"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))


def templates(pages: DataFrame) -> DataFrame:
    """Rows (host, classes, links): the valid classes of each host, and the gaps whose text is mostly links."""
    classes = equivalence_classes(pages)
    while True:
        found = cut(_findings(pages, classes))
        bad = found.where("bad = 1").select("host", "class")
        if bad.isEmpty():
            break
        classes = cut(classes.join(bad, ["host", "class"], "left_anti"))  # texts then stand in the gaps of others
    links = found.where("2 * linked > chars").select("host", F.struct("class", "gap").alias("gap"))
    links = links.groupBy("host").agg(F.collect_list("gap").alias("links"))
    return cut(_by_host(classes).join(links, "host", "full"))


def main_text(found: list[tuple[int, int, str]], walk: Walk | None, links: set[tuple[int, int]]) -> str:
    """The blocks of a page that are its article, joined by line breaks.

    If a page names its article, only blocks in it count, or else those in the part named as the
    main one; without either, all do. Where names of classes and ids hint at something else in
    every block of such a page, the hints don't count.
    """
    texts = [(f, s) for _, f, s in found if f & TEXT]
    gaps = walk.through([t for t, _, _ in found], [f for _, f, _ in found])[0] if walk else [(0, 0)] * len(texts)
    data = [(f, s) for (f, s), gap in zip(texts, gaps, strict=True) if gap is not None and gap not in links]
    level = max((f & (LEVEL_1 | LEVEL_2) for _, f, _ in found if not f & HINTED), default=0)
    if level:
        level = LEVEL_2 if level & LEVEL_2 else LEVEL_1
        return "\n".join(s for f, s in data if f & level and not f & HINTED)
    return "\n".join([s for f, s in data if not f & HINTED] or [s for _, s in data])


def extracted(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of ``pages``: the article of each page.

    A null or empty page, or one without an article, gives the empty text. Pages without a host (a
    null ``url``, or one without an authority) are told by their own markup. Repeated rows are each a
    page; other columns are ignored; an empty table gives no rows. A page may be long: a task reads
    one page at a time, in time that grows with its length.
    """
    hosts = templates(_pages(pages))
    rows = pages.select("page_id", "url", _host(), F.coalesce("html", F.lit("")).alias("html"))
    rows = _meet(rows, hosts, hosts.select(F.explode("classes").alias("c")).select(F.explode(F.concat("c.tags", "c.texts"))))

    def extract(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, walks = Reader(), _Walks()
        for batch in batches:
            texts = []
            for host, html, classes, links in zip(batch["host"], batch["html"], batch["classes"], batch["links"], strict=True):
                walk = walks.of(host, classes) if classes is not None else None
                skipped = {(g["class"], g["gap"]) for g in links} if links is not None else set()
                texts.append(main_text(reader.read(html), walk, skipped))
            yield batch[["page_id", "url"]].assign(text=texts)

    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return rows.mapInPandas(extract, schema).withColumn("n_chars", F.length("text").cast("bigint"))
