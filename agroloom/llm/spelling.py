"""Spelling variants: words one edit apart, by pairs of trie nodes, and the form that each stands for.

The distinct words make a forward trie, whose nodes are their prefixes, and a reversed one, whose
nodes are their suffixes. A word with one position skipped is a pair of integers (node of the prefix
before it, node of the suffix behind it); a word with an empty place between two letters is a pair
likewise. Words that share a pair are exact neighbours: two with a skipped position differ by one
replaced letter, and one with a skipped position is the other with a letter inserted.

A node's number follows from its parent's number and its letter, so tasks number the tries without
asking each other. That no number stands for two nodes is then checked over all nodes; if one does,
the tries are numbered again from other roots.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of

#: The letters of a word; only A-Z have lower-case forms here.
LETTERS = "A-Za-zÀ-ÿ"
DAMAGED_OF = 199
MIN_LETTERS, MIN_COUNT, TIMES = 6, 5, 5
#: How a word takes part in a pair: an empty place, a skipped letter, or one that its left neighbour repeats.
PLACE, SKIPPED, REPEATED = 0, 1, 2
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ROWS = 100_000


def occurrences(docs: DataFrame) -> DataFrame:
    """Rows (word): every run of letters of six code points or more, some with one code point deleted.

    A run loses a code point if the crc32 of ``<doc_id>:<run>`` says so (a null id as empty text).
    """
    run = F.explode(F.regexp_extract_all(text_of(), F.lit(f"[{LETTERS}]+"), F.lit(0)))
    runs = docs.select("doc_id", run.alias("run")).where(F.length("run") >= MIN_LETTERS)
    runs = runs.select("doc_id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    runs = runs.select("run", F.crc32(name).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DAMAGED_OF == 0, damaged).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= MIN_LETTERS)


def numbered(words: DataFrame) -> DataFrame:
    """The rows of ``words`` with ``id``: larger for words later in code-point order."""
    return cut(cut(words).orderBy("word").withColumn("id", F.monotonically_increasing_id()))


def _child(parent: np.ndarray, letter: np.ndarray) -> np.ndarray:
    x = parent ^ (letter * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Tries:
    """The numbers of both tries' nodes along each of some words, as flat arrays.

    Word k has the letters ``letters[starts[k]:starts[k + 1]]``; its places are one more than its
    letters, from ``starts[k] + k`` on. ``prefix`` and ``suffix`` hold the nodes at each place.
    """

    def __init__(self, words: list[str], root: int):
        lengths = np.fromiter(map(len, words), "i8", len(words))
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype("u8")
        self.starts = np.concatenate(([0], np.cumsum(lengths)))
        self.word = np.repeat(np.arange(len(words)), lengths)
        self.place = np.arange(self.letters.size) + self.word  # the place before each letter
        self.root = np.uint64(root)
        self.prefix = np.full(self.letters.size + len(words), self.root)
        self.suffix = self.prefix.copy()
        longest = np.argsort(-lengths, kind="stable")
        left, right = self.starts[:-1][longest], self.starts[1:][longest] - 1
        sizes = lengths[longest]
        for depth in range(int(sizes[0]) if len(words) else 0):
            many = int(np.searchsorted(-sizes, -depth, "left"))  # words with more letters than the depth
            at, of = left[:many] + depth, longest[:many]
            self.prefix[at + of + 1] = _child(self.prefix[at + of], self.letters[at])
            at = right[:many] - depth
            self.suffix[at + of] = _child(self.suffix[at + of + 1], self.letters[at])

    def nodes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(side, node, parent, letter) of all nodes but the roots, each once."""
        sides = [(self.prefix[self.place + 1], self.prefix[self.place]), (self.suffix[self.place], self.suffix[self.place + 1])]
        rows = [np.stack((np.full(self.letters.size, k, "u8"), node, parent, self.letters), 1) for k, (node, parent) in enumerate(sides)]
        return tuple(np.unique(np.concatenate(rows), axis=0).view("i8").T)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(prefix node, suffix node, word, kind) of all empty places and skipped letters."""
        repeated = np.concatenate(([False], self.letters[1:] == self.letters[:-1])) if self.letters.size else np.zeros(0, bool)
        repeated[self.starts[:-1]] = False
        places = np.repeat(np.arange(self.starts.size - 1), np.diff(self.starts) + 1)
        before = np.concatenate((self.prefix[self.place], self.prefix))
        behind = np.concatenate((self.suffix[self.place + 1], self.suffix))
        kinds = np.concatenate((np.where(repeated, REPEATED, SKIPPED), np.full(places.size, PLACE)))
        return before.view("i8"), behind.view("i8"), np.concatenate((self.word, places)), kinds.astype("i1")


def _sliced(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(next(iter(columns.values()))), _ROWS):
        yield pa.RecordBatch.from_pydict({name: pa.array(column[at : at + _ROWS]) for name, column in columns.items()})


def clashes(words: DataFrame, root: int) -> DataFrame:
    """Numbers (side, node) that stand for more than one node of a trie with that root; empty if exact.

    If each number has one parent and one letter, and the root none, then by induction along the
    parents each number is one prefix, or one suffix.
    """

    def nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _sliced(dict(zip(("side", "node", "parent", "letter"), Tries(batch["word"].to_pylist(), root).nodes(), strict=True)))

    own = words.select("word").mapInArrow(nodes, "side bigint, node bigint, parent bigint, letter bigint")
    of = F.struct("parent", "letter")
    is_root = F.col("node") == int(np.uint64(root).view("i8"))
    return own.groupBy("side", "node").agg(F.min(of).alias("low"), F.max(of).alias("high")).where((F.col("low") != F.col("high")) | is_root)


def near_words(words: DataFrame, root: int = 1) -> DataFrame:
    """Rows (id, n_near, best) for the rows of ``words`` (word, n, id) that have near words.

    ``best`` is (-n, id) of the near word of largest ``n``, the smallest ``id`` among equals. A pair
    is shared by one word for each letter at most, and one with an empty place there, so groups
    are bounded by the alphabet. Two words share one pair only: of a run of equal letters, only the
    first counts as skipped where a letter more is compared with none.
    """
    while not clashes(words, root).isEmpty():
        root += 1

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, behind, word, kind = Tries(batch["word"].to_pylist(), root).pairs()
            own, n = batch["id"].to_numpy()[word], batch["n"].to_numpy()[word]
            yield from _sliced({"prefix": before, "suffix": behind, "id": own, "n": n, "kind": kind})

    own = words.select("word", "id", "n").mapInArrow(pairs, "prefix bigint, suffix bigint, id bigint, n bigint, kind tinyint")
    member = F.struct((-F.col("n")).alias("less"), "id", "kind")
    groups = own.groupBy("prefix", "suffix").agg(F.collect_list(member).alias("all")).where("size(all) > 1")
    groups = groups.select(F.sort_array("all").alias("all")).select("all", F.explode("all").alias("one"))

    def linked(other):
        mine, its = F.col("one.kind"), other["kind"]
        replaced = (mine > PLACE) & (its > PLACE) & (other["id"] != F.col("one.id"))
        return replaced | ((mine == PLACE) & (its == SKIPPED)) | ((mine == SKIPPED) & (its == PLACE))

    near = groups.select("one.id", F.filter("all", linked).alias("near")).where("size(near) > 0")
    first = F.struct(F.col("near")[0]["less"].alias("less"), F.col("near")[0]["id"].alias("id"))
    return near.select("id", F.size("near").alias("k"), first.alias("best")).groupBy("id").agg(
        F.sum("k").alias("n_near"), F.min("best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (id, root): where the forms (id, form) lead to. Each round doubles the steps taken.

    A form occurs five times as often as its word, so that there is no circle, and rounds are few.
    """
    roots = cut(forms.select("id", F.col("form").alias("root")))
    while True:
        on = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        further = cut(roots.join(on, "root", "left").select("id", F.coalesce("next", "root").alias("root"), "next"))
        if further.where("next is not null").isEmpty():
            return roots
        roots = further.drop("next")


def variants(docs: DataFrame) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one for each word of the corpus.

    A null text has no words; a null id counts as empty text where a run is damaged; repeated rows
    count as often as they occur. Other columns are ignored, an empty table gives no rows. Texts may be
    long: a task holds one text's runs; a word of m letters makes 2m + 1 pairs of integers and none
    holds the word itself.
    """
    counted = occurrences(docs).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)
    words = numbered(counted)
    near = words.join(near_words(words), "id", "left")
    far = -F.col("best.less") >= TIMES * F.col("n")
    near = cut(near.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(far, F.col("best.id")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"),
    ))
    led = near.where("form is not null").select("id", "form")
    names = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    root_names = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    named = led.join(_roots(led), "id").join(names, "form").join(root_names, "root").select("id", "form_word", "root_word")
    return near.join(named, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
