"""Suffix arrays with common prefixes by induced sorting, through queues that spill to disk."""

from __future__ import annotations

import tempfile

import numpy as np

#: Entries that the queues of one sort hold in memory; beyond, their longest goes to disk.
IN_MEMORY = 8_000_000


class BucketQueue:
    """A priority queue of (symbol, order of arrival, position, common prefix), taken symbol by symbol.

    Induction adds entries of one symbol in their final order, so arrival is the rank within a
    symbol and a run per symbol is all the structure there is. Runs live in memory up to a bound
    that all share, and then on disk, in the folder of the task's temporary files.
    """

    def __init__(self, symbols: int, in_memory: int = IN_MEMORY) -> None:
        self.runs: list[list] = [[] for _ in range(symbols)]
        self.held = np.zeros(symbols, "i8")
        self.bound = in_memory

    def push(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.runs[symbol].append((positions, prefixes))
        self.held[symbol] += len(positions)
        if self.held.sum() > self.bound:
            longest = int(self.held.argmax())
            file = tempfile.TemporaryFile(prefix="suffixes-")
            for part in self._joined(longest):
                np.save(file, part)
            file.seek(0)
            self.runs[longest] = [file]
            self.held[longest] = 0

    def _joined(self, symbol: int):
        parts = []
        for run in self.runs[symbol]:
            if isinstance(run, tuple):
                parts.append(run)
            else:
                parts.append((np.load(run), np.load(run)))
                run.close()
        if not parts:
            return np.zeros(0, "i8"), np.zeros(0, "i8")
        return tuple(map(np.concatenate, zip(*parts, strict=True)))

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All entries of a symbol so far, in order."""
        out = self._joined(symbol)
        self.runs[symbol], self.held[symbol] = [], 0
        return out


def _repeats(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each stretch of one symbol ends, and how long it is."""
    ends = np.append(np.flatnonzero(t[:-1] != t[1:]), len(t) - 1)
    return ends, np.diff(ends, prepend=-1)


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it."""
    ends, lengths = _repeats(t)
    return np.repeat(np.append(t[ends[:-1]] < t[ends[:-1] + 1], False), lengths)


def _run_lengths(t: np.ndarray) -> np.ndarray:
    """How often each symbol repeats from its place on."""
    ends, lengths = _repeats(t)
    return np.repeat(ends, lengths) - np.arange(len(t)) + 1


class _Induction:
    """One pass: suffixes taken in order put the suffixes before them into their buckets."""

    def __init__(self, t: np.ndarray, wanted: np.ndarray, symbols: int, cap: int) -> None:
        self.t, self.wanted, self.cap = t, wanted, cap
        self.queue = BucketQueue(symbols)
        # the least common prefix met since a bucket last got an entry
        self.since = np.zeros(symbols, "i8")

    def feed(self, positions: np.ndarray, prefixes: np.ndarray) -> None:
        """``prefixes`` are those shared with the suffix taken just before."""
        before = positions - 1
        ok = np.flatnonzero((before >= 0) & self.wanted[before])
        symbol = self.t[before[ok]]
        rest = np.minimum(self.since, prefixes.min())
        order = np.argsort(symbol.astype("u2" if len(self.since) < 65_536 else "i8"), kind="stable")
        ok, symbol = ok[order], symbol[order]
        edges = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]])[: len(ok)])
        for at in np.split(ok, edges[1:]) if len(ok) else ():
            b = int(self.t[before[at[0]]])
            cuts = np.concatenate([[0], at + 1])
            if cuts[-1] == len(prefixes):
                least = np.minimum.reduceat(prefixes, cuts[:-1])
                tail = self.cap
            else:
                least = np.minimum.reduceat(prefixes, cuts)
                least, tail = least[:-1], int(least[-1])
            least[0] = min(least[0], self.since[b])
            rest[b] = tail
            self.queue.push(b, before[at], np.minimum(least + 1, self.cap))
        self.since = rest


def _shared(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, up to ``cap``; several symbols at a time."""
    n = len(t)
    bits = max(1, int(t.max() + 1).bit_length())  # the largest value stands for the end
    each = 63 // bits
    padded = np.append(t, np.full(each, (1 << bits) - 1))
    word = np.full(n + 1, -1)
    word[:n] = 0
    for k in range(each):
        word[:n] |= padded[k : k + n] << (bits * k)
    out = np.zeros(len(a), "i8")
    live, depth = np.arange(len(a)), 0
    while depth < cap and len(live):
        differ = word[np.minimum(a[live] + depth, n)] ^ word[np.minimum(b[live] + depth, n)]
        same = differ == 0
        first = np.bitwise_count((differ & -differ) - 1) // bits
        out[live] += np.where(same, each, first)
        live = live[same]
        depth += each
    return np.minimum(out, cap)


def rank_by_doubling(t: np.ndarray, cap: int) -> np.ndarray:
    """The order of all suffixes by their first ``cap`` symbols at least, ties by position."""
    rank = np.unique(t, return_inverse=True)[1].astype("i8")
    depth, n = 1, len(t)
    while depth < cap and rank.max(initial=0) < n - 1:
        second = np.zeros(n, "i8")
        second[: n - depth] = rank[depth:] + 1
        rank = np.unique(rank * (n + 2) + second, return_inverse=True)[1].astype("i8")
        depth *= 2
    return np.argsort(rank, kind="stable")


def _induce(t, small, starts, prefixes, symbols, cap):
    """(order, prefixes) of all suffixes, from the sorted starts of ascents with their prefixes."""
    length = np.minimum(_run_lengths(t), cap)
    by_symbol = np.searchsorted(t[starts], np.arange(symbols + 1))
    left = _Induction(t, ~small, symbols, cap)
    falling: list = [None] * symbols
    # the last suffix falls to the end of the text and is the first of its bucket
    left.queue.push(int(t[-1]), np.array([len(t) - 1]), np.zeros(1, "i8"))
    for c in range(symbols):
        taken = []
        first = True
        while True:
            p, k = left.queue.take(c)
            if not len(p):
                break
            if first:
                k = k.copy()
                k[0] = 0
                first = False
            taken.append((p, k))
            left.feed(p, k)
        falling[c] = tuple(map(np.concatenate, zip(*taken, strict=True))) if taken else None
        s = starts[by_symbol[c] : by_symbol[c + 1]]
        if len(s):
            k = prefixes[by_symbol[c] : by_symbol[c + 1]].copy()
            k[0] = 0 if falling[c] is None else min(length[s[0]], length[falling[c][0][-1]])
            left.feed(s, k)
    right = _Induction(t, small, symbols, cap)
    order: list = []
    for c in range(symbols - 1, -1, -1):
        taken, first = [], True
        while True:
            p, k = right.queue.take(c)
            if not len(p):
                break
            if first:
                k = k.copy()
                k[0] = 0
                first = False
            taken.append((p, k))
            right.feed(p, k)
        rising = tuple(map(np.concatenate, zip(*taken, strict=True))) if taken else None
        if falling[c] is not None:
            p, k = falling[c]
            down = np.empty(len(k), "i8")  # prefixes shared with the next larger suffix
            down[1:] = k[:0:-1]
            down[0] = 0 if rising is None else min(length[p[-1]], length[rising[0][-1]])
            right.feed(p[::-1], down)
        # ascending: first what falls, then what rises
        if rising is not None:
            p, k = rising
            up = np.empty(len(k), "i8")
            up[1:] = k[:0:-1]
            up[0] = 0 if falling[c] is None else min(length[p[-1]], length[falling[c][0][-1]])
            order.append((p[::-1], up))
        if falling[c] is not None:
            order.append(falling[c])
    order.reverse()
    return tuple(map(np.concatenate, zip(*order, strict=True)))


def suffix_array(t: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, prefixes): suffixes by their first ``cap`` symbols, and what each shares with the one before.

    Suffixes at the starts of ascents are sorted by the names of the pieces between them: a first
    induction sorts the pieces, equal ones get one name, and the string of names is sorted in turn.
    A second induction then sorts every suffix from those, and carries the prefixes along.
    Symbols are small integers; shared prefixes over ``cap`` count as ``cap``.
    """
    n = len(t)
    if n < 2:
        return np.arange(n), np.zeros(n, "i8")
    symbols = int(t.max()) + 1
    small = _types(t)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    by_first = starts[np.argsort(t[starts], kind="stable")]
    if not len(starts):
        return _induce(t, small, by_first, np.zeros(0, "i8"), symbols, cap)
    rough, _ = _induce(t, small, by_first, np.zeros(len(starts), "i8"), symbols, cap)
    where = np.full(n, -1)
    where[starts] = np.arange(len(starts))
    piece = where[rough]
    piece = piece[piece >= 0]
    size = np.append(np.diff(starts) + 1, n - starts[-1] + 1)
    a, b = piece[:-1], piece[1:]
    same = size[a] == size[b]
    shared = _shared(t, starts[a[same]], starts[b[same]], int(size.max()))
    same[same] = shared >= size[a[same]]
    name = np.empty(len(starts), "i8")
    name[piece] = np.concatenate([[0], np.cumsum(~same)])
    by_name = rank_by_doubling(name, cap)
    ordered = starts[by_name]
    prefixes = np.concatenate([[0], _shared(t, ordered[:-1], ordered[1:], cap)])
    return _induce(t, small, ordered, prefixes, symbols, cap)
