"""Windows of a fixed length over symbol sequences, grouped by the minimum that each holds.

Every window of ``width`` symbols is owned by the smallest hash (of ties the leftmost) among the
grams of ``gram`` symbols inside it. Which gram that is depends on the window's content alone, so
equal windows anywhere have equal owners at equal offsets. Consecutive windows share an owner: a
*run* of about (width - gram) / 2 windows is one record instead of one per window.

Grams that are known to be common own a window only if it holds no other: a line that many
documents share would otherwise own the windows over its edges, which differ in every document.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_COMBINE = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(29)
_HIGH = np.uint64(0xFFFFFFFF00000000)
#: Symbols that are hashed at once: so few that the arrays of hashes stay in a core's cache.
AT_ONCE = 65_536
#: High bits of a gram's hash that say whether it counts as common.
COMMON_BITS = 22


class Runs(NamedTuple):
    """Runs in text order. ``begin`` is the first window's start and ``n`` the number of windows."""

    key: np.ndarray  # hash of the owner gram
    context: np.ndarray  # hash of all symbols under the run's windows, and of the owner's place
    begin: np.ndarray
    n: np.ndarray
    owner: np.ndarray  # the owner gram's start


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, in place."""
    x *= _MIX
    x ^= x >> _SHIFT
    x *= _COMBINE
    x ^= x >> _SHIFT
    return x


def _joined(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Hash of a gram from those of its first ``size`` symbols and of its last.

    Linear, with an odd factor for each size; symbols have scrambled 64-bit values, so grams as
    short as these collide no more than random numbers do.
    """
    x = a * np.uint64(int(_COMBINE) * (2 * size + 1) % 2**64 | 1)
    x += b
    return x


def gram_hashes(h: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """For each length, the hashes of all grams of that many symbols, from hashes of symbols."""
    powers, size = {1: h}, 1
    while 2 * size <= max(lengths):
        h = _joined(h[:-size], h[size:], size)
        size *= 2
        powers[size] = h
    out = []
    for length in lengths:
        size = 1 << (length.bit_length() - 1)
        h, rest = powers[size], length - size
        out.append(mixed(_joined(h[: len(h) - rest], h[rest:], rest) if rest else h.copy()))
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def common_table(grams: np.ndarray) -> np.ndarray:
    """Whether a gram is common, by the high bits of its hash. A few others share them, which does no harm."""
    table = np.zeros(1 << COMMON_BITS, bool)
    table[grams >> np.uint64(64 - COMMON_BITS)] = True
    return table


def _runs_of(h: np.ndarray, ends: np.ndarray, width: int, gram: int, common: np.ndarray | None) -> Runs:
    """Runs of a block; ``ends`` says for each symbol where its sequence ends."""
    grams, windows = gram_hashes(h, gram, width)
    rank = grams >> np.uint64(1)
    if common is not None:
        rank |= common[grams >> np.uint64(64 - COMMON_BITS)].astype("u8") << np.uint64(63)
    rank &= _HIGH
    rank |= np.arange(len(grams), dtype="u8")
    own = (_sliding_min(rank, width - gram + 1) & np.uint64(0xFFFFFFFF)).astype("i8")
    start = np.arange(len(own))
    valid = start + width <= ends[: len(own)]
    edge = np.empty(len(own), bool)
    edge[0] = True
    edge[1:] = (own[1:] != own[:-1]) | (valid[1:] != valid[:-1])
    begin = np.flatnonzero(edge)
    n = np.diff(np.append(begin, len(own)))
    good = valid[begin]
    begin, n = begin[good], n[good]
    owner = own[begin]
    place = ((owner - begin) << 16 | n).astype("u8")
    context = mixed(_joined(mixed(_joined(windows[begin], windows[begin + n - 1], width)), place, gram))
    return Runs(grams[owner], context, begin, n, owner)


def runs(h: np.ndarray, bounds: np.ndarray, width: int, gram: int, common: np.ndarray | None = None) -> Runs:
    """Runs over sequences that lie one after another; sequence k is bounds[k]:bounds[k + 1].

    ``common`` is a :func:`common_table`, the same for all sequences whose windows are to meet.

    Blocks of AT_ONCE symbols bound the memory; a run that crosses from one block to the next is
    given as two, which are the same windows.
    """
    ends = np.repeat(bounds[1:], np.diff(bounds))
    parts = []
    for start in range(0, max(1, len(h)), AT_ONCE):
        stop = min(len(h), start + AT_ONCE + width - 1)
        if stop - start < width:
            break
        r = _runs_of(h[start:stop], ends[start:stop] - start, width, gram, common)
        parts.append(r._replace(begin=r.begin + start, owner=r.owner + start))
    if not parts:
        none = np.zeros(0, "i8")
        return Runs(none.astype("u8"), none.astype("u8"), none, none, none)
    return Runs(*map(np.concatenate, zip(*parts, strict=True)))
