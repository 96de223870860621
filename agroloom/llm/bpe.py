"""Byte-level BPE by a rank queue: buckets per merge rank under a hierarchical bitmap."""

from __future__ import annotations

import base64
from array import array
from heapq import heappop, heappush
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TEXTS, text_of, values, worker_cache
from .pretokens import splitters

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens that each of the two generations of a worker's cache holds, and their characters and
#: bytes of ids.
CACHED, CACHED_SIZE = 150_000, 6_000_000
#: Characters of texts, and TEXTS of them at most, whose new pre-tokens are merged together; longer
#: pre-tokens than TOGETHER bytes are merged one by one, and longer ones than LONGEST characters aren't kept.
AT_ONCE, TOGETHER, LONGEST = 4_000_000, 64, 256
#: Bits of a rank that index within one leaf of the bitmap.
LEAF_BITS = 8
_LEAF = (1 << LEAF_BITS) - 1
_BIT = [1 << k for k in range(1 << 12)]


class Ranks(dict):
    """Token bytes to merge rank, which is the id; ``pairs`` has the ranks of two-byte tokens.

    ``bytes`` has the ids of the single bytes. ``joined`` has all pairs of ids, as the left one's
    shifted by 32 bits and the right one, ascending, that make a token, and ``whole`` that token's rank.
    """

    def __init__(self, tokens) -> None:
        super().__init__(tokens)
        self.pairs = [self.get(bytes([x >> 8, x & 255])) for x in range(1 << 16)]
        self.bytes = np.array([self[bytes([x])] for x in range(256)], "i8")
        joined, whole = [np.iinfo("i8").max], [-1]  # the last is met by no pair
        for token, rank in self.items():
            for i in range(1, len(token)):
                a, b = self.get(token[:i]), self.get(token[i:])
                if a is not None and b is not None:
                    joined.append(a << 32 | b)
                    whole.append(rank)
        order = np.argsort(joined)
        self.joined, self.whole = np.array(joined, "i8")[order], np.array(whole, "i8")[order]

    def of_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids, -1 where they make no token; an id of -1 is part of none."""
        pairs = a << 32 | b
        at = self.joined.searchsorted(pairs)
        return np.where(self.joined[at] == pairs, self.whole[at], -1)


def merge(piece: bytes, ranks: Ranks) -> list[int]:
    """The ids of one pre-token: the pair of the smallest rank merges first, of ties the leftmost.

    Parts are a doubly linked list over byte positions. The queue has a bucket for each rank, with
    the positions of the parts whose pair has it, under a bitmap of two levels: a bit a rank in its
    leaf, and a summary bit a leaf. Finding the next rank is two find-first-sets, however long the
    piece. An entry is stale if its part is gone or the pair that begins there now has another
    rank; it is skipped when it comes up.
    """
    find = ranks.get
    whole = find(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    pair: list[int | None] = list(map(ranks.pairs.__getitem__, [a << 8 | b for a, b in zip(piece, piece[1:])]))
    pair.append(None)
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    summary = 0
    for i, rank in enumerate(pair):
        if rank is None:
            continue
        if rank in buckets:
            buckets[rank].append(i)
        else:
            buckets[rank] = [i]
            leaf = rank >> LEAF_BITS
            leaves[leaf] = leaves.get(leaf, 0) | _BIT[rank & _LEAF]
            summary |= _BIT[leaf]
    after = list(range(1, n + 1))  # where the next part begins
    before = list(range(-1, n - 1))
    while summary:
        leaf = (summary & -summary).bit_length() - 1
        bits = leaves[leaf]
        low = bits & -bits
        rank = (leaf << LEAF_BITS) + low.bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            i = heappop(bucket)
        else:
            i = bucket.pop()
            leaves[leaf] = bits = bits ^ low
            if not bits:
                summary ^= _BIT[leaf]
        if pair[i] != rank:
            continue
        j = after[i]
        after[i] = k = after[j]
        pair[j] = None
        if k < n:
            before[k] = i
            pair[i] = find(piece[i : after[k]])
        else:
            pair[i] = None
        changed = (i,)
        h = before[i]
        if h >= 0:
            rank = find(piece[h:k])
            if rank != pair[h]:
                pair[h] = rank
                changed = (i, h)
        for at in changed:
            rank = pair[at]
            if rank is None:
                continue
            bucket = buckets.get(rank)
            if bucket:
                heappush(bucket, at)
            else:
                buckets[rank] = [at]
                leaf = rank >> LEAF_BITS
                leaves[leaf] = leaves.get(leaf, 0) | _BIT[rank & _LEAF]
                summary |= _BIT[leaf]
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


def merge_all(pieces: list[bytes], ranks: Ranks) -> list[bytes]:
    """The ids of many pre-tokens, as :func:`merge` gives them one by one, in little-endian 32 bits.

    One queue holds the positions of all pre-tokens, which lie one after another with a gap between.
    What comes up at a rank is merged together: of each pre-token the leftmost position; its others
    go back, since the merge may have made a pair of a smaller rank there.
    """
    if not pieces:
        return []
    data = np.frombuffer(b"\0".join(pieces) + b"\0", "u1")
    n = len(data)
    ends = np.cumsum(np.fromiter(map(len, pieces), "i8", len(pieces)) + 1) - 1
    token = ranks.bytes[data]  # of the part that begins there; -1: none does
    token[ends] = -1
    piece = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    pair = np.append(ranks.of_pairs(token[:-1], token[1:]), -1)
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    summary = 0
    at = np.flatnonzero(pair >= 0)
    todo = zip(pair[at].tolist(), at.tolist(), strict=True)
    while True:
        for rank, i in todo:
            bucket = buckets.get(rank)
            if bucket:
                bucket.append(i)
            else:
                buckets[rank] = [i]
                leaf = rank >> LEAF_BITS
                leaves[leaf] = leaves.get(leaf, 0) | _BIT[rank & _LEAF]
                summary |= _BIT[leaf]
        if not summary:
            break
        leaf = (summary & -summary).bit_length() - 1
        bits = leaves[leaf]
        low = bits & -bits
        rank = (leaf << LEAF_BITS) + low.bit_length() - 1
        leaves[leaf] = bits = bits ^ low
        if not bits:
            summary ^= _BIT[leaf]
        i = np.array(buckets.pop(rank))
        i = np.sort(i[pair[i] == rank])
        of = piece[i]
        later = np.zeros(len(i), bool)
        later[1:] = of[1:] == of[:-1]
        again, i = i[later], i[~later]
        j, h = after[i], before[i]
        k = after[j]
        token[i], token[j], pair[j] = rank, -1, -1
        after[i], before[k] = k, i
        left, right = np.concatenate((i, h)), np.concatenate((k, i))
        pair[left] = new = ranks.of_pairs(token[left], token[right])
        push = np.flatnonzero(new >= 0)
        todo = zip(new[push].tolist(), left[push].tolist(), strict=True)
        if len(again):
            todo = chain(todo, zip(repeat(rank), again.tolist()))
    live = token >= 0
    ids = token[live].astype("<u4").tobytes()
    bounds = (4 * np.cumsum(live)[ends]).tolist()
    return [ids[a:b] for a, b in zip([0, *bounds], bounds)]


def load_ranks(path: str) -> Ranks:
    """The vocabulary of a rank file: lines of a token in base 64 and its rank."""
    lines = Path(path).read_bytes().splitlines()
    return Ranks((base64.b64decode(t), int(r)) for t, r in (x.split() for x in lines if x))


class _Pieces:
    """Pre-token to its ids' bytes; two generations bound the memory and keep what is in use."""

    def __init__(self, ranks: Ranks) -> None:
        self.ranks, self.new, self.old, self.size = ranks, {}, {}, 0

    def _keep(self, pieces: list[str], ids: list[bytes]) -> None:
        self.new.update(zip(pieces, ids, strict=True))
        self.size += sum(map(len, pieces)) + sum(map(len, ids))

    def encoded(self, texts: list[list[str]]) -> list[bytes]:
        """The ids' bytes of texts, given by their pre-tokens."""
        if len(self.new) >= CACHED or self.size >= CACHED_SIZE:
            self.old, self.new, self.size = self.new, {}, 0
        new, old, ranks = self.new, self.old, self.ranks
        missing: set[str] = set()
        for words in texts:
            missing.update(set(words).difference(new))
        known = [w for w in missing if w in old]
        self._keep(known, list(map(old.__getitem__, known)))
        missing.difference_update(known)
        single = [w for w in missing if len(b := w.encode()) > TOGETHER or b in ranks]
        self._keep(single, [array("I", merge(w.encode(), ranks)).tobytes() for w in single])
        missing.difference_update(single)
        rest = list(missing)
        self._keep(rest, merge_all([w.encode() for w in rest], ranks))
        out = [b"".join(map(new.__getitem__, words)) for words in texts]
        for w in single:
            if len(w) > LONGEST:
                self.size -= len(w) + len(new.pop(w))
        return out


def _coder(path: str, pattern: str):
    """``encode`` from texts to ids as little-endian 32-bit integers, and ``decode`` to bytes.

    The vocabulary and the pre-tokens seen are kept between a worker's tasks.
    """
    return worker_cache(("bpe", path, pattern), lambda: _make_coder(path, pattern))


def _make_coder(path: str, pattern: str):
    import public_tokenizers

    ranks = load_ranks(path)
    tokens = {i: t for t, i in ranks.items()}
    pieces = _Pieces(ranks)
    split, odd = splitters()
    full = regex.compile(pattern).findall
    plain = pattern == public_tokenizers.PATTERN

    def encode(texts: list[str]) -> list[bytes]:
        return pieces.encoded([split(text) if plain and not odd(text) else full(text) for text in texts])

    def decode(encoded: list[bytes]) -> list[bytes]:
        return [b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())) for ids in encoded]

    return encode, decode


def _blocks(column):
    """The values of an Arrow array in lists of TEXTS at most, which end when they reach AT_ONCE."""
    block, size = [], 0
    for value in values(column):
        block.append(value)
        size += len(value)
        if len(block) == TEXTS or size >= AT_ONCE:
            yield block
            block, size = [], 0
    if block:
        yield block


def _over(df: DataFrame, source: str, add: dict, path: str, pattern: str) -> DataFrame:
    """(doc_id, …) with binary columns made from ``source`` by functions of the coder and columns."""

    def run(batches):
        coder = _coder(path, pattern)
        for batch in batches:
            ids, start = batch.column("doc_id"), 0
            for block in _blocks(batch.column(source)):
                columns, end = {source: block}, start + len(block)
                for c, f in add.items():
                    columns[c] = f(coder, columns)
                arrays = [pa.array(columns[c], pa.binary()) for c in add]
                yield pa.RecordBatch.from_arrays([ids[start:end], *arrays], ["doc_id", *add])
                start = end

    schema = "doc_id bigint" + "".join(f", {c} binary" for c in add)
    return df.mapInArrow(run, schema)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, ids): the texts' token ids as little-endian unsigned 32-bit integers.

    ``path`` names a rank file with all 256 bytes; each match of ``pattern`` is encoded by itself,
    without special tokens. No shuffle; a worker's memory is bounded by its cache and a block of texts.
    A null text counts as empty and has no ids; ids of documents may be null or repeat, row for
    row; other columns are ignored.
    """
    return _over(_rows(docs), "text", {"ids": lambda c, r: c[0](r["text"])}, path, pattern)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, decoded): the bytes that ``ids`` stand for. Null ids give no bytes."""
    ids = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return _over(ids, "ids", {"decoded": lambda c, r: c[1](r["ids"])}, path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, ids, decoded): :func:`encode`, then :func:`decode` of its ids, in one pass."""
    both = {"ids": lambda c, r: c[0](r["text"]), "decoded": lambda c, r: c[1](r["ids"])}
    return _over(_rows(docs), "text", both, path, pattern)
