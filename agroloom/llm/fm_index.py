"""A compressed FM-index over symbol sequences: backward search for many patterns at once."""

from __future__ import annotations

import numpy as np

from .suffix_sort import rank_by_doubling

#: For each place in a word of 64 bits: the bits below it.
_BELOW = (np.uint64(1) << np.arange(64, dtype="u8")) - np.uint64(1)


class WaveletTree:
    """Ranks of symbols in a sequence, in about its zero-order entropy.

    A symbol's code has as many bits as its frequency asks for, and is the next free one of that
    length, so shorter codes come first in order. Level k holds bit k of the symbols whose codes
    are longer than k, by the k bits before it and then by place; a node of the tree is a stretch
    of its level. Common symbols end near the root, and a walk takes no more levels than its code.
    """

    def __init__(self, symbols: np.ndarray, n_symbols: int) -> None:
        counts = np.bincount(symbols, minlength=n_symbols)
        n = max(1, len(symbols))
        size = np.ceil(np.log2(n / np.maximum(counts, 1))).astype("i8")
        size = np.maximum(size, 1)
        by_size = np.lexsort((np.arange(n_symbols), size))
        longest = int(size.max())
        step = np.int64(1) << (longest - size[by_size])
        # a symbol that doesn't occur needs no code: it can't be told from the last one
        step[counts[by_size] == 0] = 0
        codes = np.cumsum(step) - step  # left-aligned, ascending
        self.rank = np.empty(n_symbols, "i8")
        self.rank[by_size] = np.arange(n_symbols)
        self.size = size[by_size]  # by rank
        before = np.concatenate([[0], np.cumsum(counts[by_size])])
        self.codes, self.longest = codes, longest
        self.absent = counts == 0
        self.words, self.counts, self.starts, self.ones, self.bits, self.skipped = [], [], [], [], [], []
        level = self.rank[symbols]
        for k in range(longest):
            skipped = int(np.searchsorted(self.size, k, "right"))  # ranks whose codes have ended
            prefix = codes[skipped:] >> (longest - k)
            first = skipped + np.searchsorted(prefix, prefix)
            starts = before[first] - before[skipped]
            bit = (codes[level] >> (longest - 1 - k)) & 1
            padded = np.zeros(64 * (len(level) // 64 + 1), bool)
            padded[: len(level)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype("i4"))
            self.starts.append(starts.astype("i4"))
            self.skipped.append(skipped)
            self.ones.append(self._ones(k, starts).astype("i4"))
            self.bits.append((codes[skipped:] >> (longest - 1 - k) & 1).astype(bool))
            if k + 1 == longest:
                break
            # where each symbol stands on the next level, of those that have one
            ones = np.cumsum(bit) - bit
            of = level - skipped
            within = np.where(bit, ones - self.ones[k][of], np.arange(len(level)) - ones - (starts[of] - self.ones[k][of]))
            going = self.size[level] > k + 1
            level, within = level[going], within[going]
            later = int(np.searchsorted(self.size, k + 1, "right"))
            prefix = codes[later:] >> (longest - k - 1)
            place = (before[later + np.searchsorted(prefix, prefix)] - before[later])[level - later] + within
            moved = np.empty_like(level)
            moved[place] = level
            level = moved

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place of a level."""
        word = at >> 6
        low = self.words[k][word]
        low &= _BELOW[at & 63]
        return self.counts[k][word] + np.bitwise_count(low).astype("i8")

    def ranks(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place ``at``, or before each of its places in the rows of ``at``.

        Symbols go down the tree in the order of their codes, so that those whose codes have ended
        lie before the others.
        """
        order = np.argsort(self.rank[symbol], kind="stable")  # no work if they are in order already
        of, at = self.rank[symbol][order], at[..., order].astype("i8")
        for k in range(self.longest):
            ended = int(np.searchsorted(of, self.skipped[k]))
            if ended == len(of):
                break
            node, here = of[ended:] - self.skipped[k], at[..., ended:]
            ones = self._ones(k, here + self.starts[k][node])
            ones -= self.ones[k][node]
            here[...] = np.where(self.bits[k][node], ones, here - ones)
        out = np.empty_like(at)
        out[..., order] = at
        return np.where(self.absent[symbol], 0, out)

    def nbytes(self) -> int:
        """Bytes of the bits and their counts."""
        return sum(w.nbytes + c.nbytes for w, c in zip(self.words, self.counts, strict=True))


class FMIndex:
    """The index of sequences that lie one after another, each ended by the symbol 0.

    ``depth`` is the longest pattern that will be asked for.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int) -> None:
        # separators differ from each other, so that every order is settled within its sequence
        ends = text == 0
        unique = text + ends.sum()
        unique[ends] = np.arange(ends.sum())
        order = rank_by_doubling(unique, max(depth, 2) + 1)
        self.tree = WaveletTree(text[order - 1], symbols)
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])[:-1]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """The intervals of the patterns with ``symbol`` put before them."""
        low, high = self.tree.ranks(symbol, np.stack([low, high])) + self.first[symbol]
        return low, high

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, cap: int, threshold: int = 2):
        """(lengths, matches): the longest stretch that stops before each end, up to ``cap`` symbols,
        which occurs ``threshold`` times or more in the index, and how often it does.

        All ends go one symbol to the left together; one stops when its interval, the matches of
        what has been read, becomes smaller than the threshold. Ends with the same interval have
        read the same symbols, so those whose next symbol agrees too ask the tree once.
        """
        lengths, matches = np.zeros(len(ends), "i8"), np.full(len(ends), self.n, "i8")
        live = np.arange(len(ends))
        low, high = np.zeros(len(ends), "i8"), matches.copy()
        for back in range(1, cap + 1):
            live, low, high = (x[ends[live] >= back] for x in (live, low, high))
            symbol = text[ends[live] - back]
            _, one, state = np.unique(self.tree.rank[symbol] * (self.n + 1) + low, return_index=True, return_inverse=True)
            low, high = (x[state] for x in self.extend(symbol[one], low[one], high[one]))
            good = high - low >= threshold
            live, low, high = live[good], low[good], high[good]
            if not len(live):
                break
            lengths[live] = back
            matches[live] = high - low
        return lengths, matches

    def occurrences(self, text: np.ndarray, starts: np.ndarray, width: int, threshold: int = 2) -> np.ndarray:
        """How often the ``width`` symbols from each start occur in the index; under ``threshold``: 0."""
        lengths, matches = self.matching_statistics(text, starts + width, width, threshold)
        return np.where(lengths == width, matches, 0)
