"""Word windows that occur again, removed; decided by backward search in FM-indexes of shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .fm_index import FMIndex
from .repeats import NO_ID, Task, without_repeats
from .windows import AT_ONCE, mixed

WORDS = 35
GRAM = 10
#: Bytes of the longest word that is hashed together with others, eight bytes at a time.
SHORT = 64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _hash_short(lanes: np.ndarray, starts: np.ndarray, size: np.ndarray, out: np.ndarray) -> None:
    """Puts the hashes of words up to SHORT bytes into ``out``, which has their mixed sizes."""
    live = np.flatnonzero(size <= SHORT)
    for done in range(0, SHORT, 8):
        live = live[size[live] > done]
        if not len(live):
            break
        at = starts[live] + done
        lane, shift = at >> 3, ((at & 7) << 3).astype("u8")
        eight = lanes[lane] >> shift
        eight |= lanes[lane + 1] << np.uint64(1) << (np.uint64(63) - shift)
        beyond = np.maximum(8 - (size[live] - done), 0) << 3
        eight &= np.uint64(0xFFFFFFFFFFFFFFFF) >> beyond.astype("u8")
        eight ^= out[live]
        eight ^= eight >> np.uint64(32)
        out[live] = mixed(eight)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word ``data[start:stop]``, from its bytes and their number alone.

    All words of a block take their first eight bytes together, then the longer ones their next
    eight, and so on; every step is a bijection of those bytes, so words of eight bytes or fewer
    and one length never collide. ``data`` has whole lanes of eight bytes and one more after the
    last word.
    """
    lanes = data.view("<u8")
    out = np.empty(len(starts), "u8")
    for first in range(0, len(out), AT_ONCE):
        block = slice(first, first + AT_ONCE)
        size = stops[block] - starts[block]
        out[block] = mixed(size.astype("u8"))
        _hash_short(lanes, starts[block], size, out[block])
        for k in (first + np.flatnonzero(size > SHORT)).tolist():
            out[k] = xxhash.xxh64_intdigest(data[starts[k] : stops[k]])
    return out


def _symbols(texts: list[bytes]):
    length = sum(map(len, texts)) + len(texts)
    data = np.frombuffer(b" ".join([*texts, b" " * (16 - length % 8)]), "u1")
    space = _SPACE[data]  # the six white-space bytes of the contract
    edges = np.flatnonzero(space[1:] != space[:-1])
    edges += 1
    if not space[0]:
        edges = np.append(0, edges)
    starts, stops = edges[::2], edges[1::2]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    hashes = word_hashes(data, starts, stops)
    return hashes, np.searchsorted(starts, begins), hashes


def repeated(texts: list[np.ndarray], windows, ids, counts, width: int) -> np.ndarray:
    """For each window of the runs, 0 if it occurs twice or more in the corpus, else NO_ID.

    The runs' words are indexed; each run is then read as a document's stream, whose matching
    statistics say how long a stretch before each place occurs twice. Where that is the window's
    width, the window does. Windows of a run that itself occurs twice do so.
    """
    sizes = windows + width
    begins = np.cumsum(sizes) - sizes
    inside = np.ones(int(sizes.sum()), bool)
    inside[begins + sizes - 1] = False
    text = np.zeros(len(inside), "i8")
    names, flat = np.unique(np.concatenate(texts), return_inverse=True)
    text[inside] = flat + 1
    index = FMIndex(text, len(names) + 1, int(sizes.max()))
    run = np.repeat(np.arange(len(windows)), windows)
    place = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
    twice = counts[run] > 1
    ask = np.flatnonzero(~twice)
    lengths, _ = index.matching_statistics(text, begins[run[ask]] + place[ask] + width, width)
    twice[ask] = lengths == width
    return np.where(twice, 0, NO_ID)


def _finish(text: bytes, mask: np.ndarray):
    words = text.split()
    kept = [w for w, gone in zip(words, mask.tolist(), strict=True) if not gone] if mask.any() else words
    return len(words), int(mask.sum()), b" ".join(kept).decode()


def without_repeated_windows(docs: DataFrame, words: int = WORDS, gram: int = GRAM) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept), one for each row of ``docs``.

    A word goes if a window of ``words`` consecutive words over it also starts anywhere else, in
    the same document or another; all its occurrences go. Windows are judged on the input;
    ``kept`` holds the other words, joined by one space.

    A null text has no words. Ids may be null or repeat: each row is a document of its own. Texts
    with fewer words stay whole. Other columns are ignored; an empty table gives no rows.
    A long text is hashed as a whole, in a task that needs some 40 bytes for each of its bytes.
    """
    columns = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    task = Task(words, gram, _symbols, repeated, _finish, schema, other_document=False)
    return without_repeats(docs, task, columns)
