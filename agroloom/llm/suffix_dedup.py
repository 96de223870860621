"""Substrings that an earlier document holds, removed; decided by suffix arrays of shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import Task, without_repeats
from .suffix_sort import suffix_array
from .windows import mixed

LENGTH = 50
GRAM = 24
_TABLE = mixed(np.arange(1, 257, dtype="u8"))


def _symbols(texts: list[bytes]):
    data = np.frombuffer(b"".join(texts), "u1")
    return _TABLE[data], np.cumsum([0, *map(len, texts)]), data


def first_ids(texts: list[np.ndarray], windows, ids, counts, width: int) -> np.ndarray:
    """For each window of the runs, the smallest id of a run that holds it.

    The runs' texts are joined with separators; in their suffix array equal windows are
    neighbours whose common prefixes reach the width.
    """
    sizes = windows + width
    begins = np.cumsum(sizes) - sizes
    text = np.zeros(int(sizes.sum()), "i8")
    for start, part in zip(begins.tolist(), texts, strict=True):
        text[start : start + len(part)] = part
    # symbols in use, so that the buckets are few
    used = np.zeros(258, "i8")
    inside = np.ones(len(text), bool)
    inside[begins + sizes - 1] = False
    text[inside] += 1
    used[np.unique(text)] = 1
    text = (np.cumsum(used) - 1)[text]
    order, prefix = suffix_array(text, width)
    run = np.searchsorted(begins, order, "right") - 1
    place = order - begins[run]
    window = place < windows[run]
    group = np.cumsum(prefix < width)
    run, place, group = run[window], place[window], group[window]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    least = np.minimum.reduceat(ids[run], np.flatnonzero(first))
    out = np.empty(int(windows.sum()), "i8")
    out[(np.cumsum(windows) - windows)[run] + place] = least[np.cumsum(first) - 1]
    return out


def _finish(text: bytes, mask: np.ndarray):
    if not mask.any():
        return len(text), 0, 0, text
    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
    kept = np.frombuffer(text, "u1")[~mask].tobytes()
    return len(text), int(mask.sum()), spans, kept


def without_earlier_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept), one for each row of ``docs``.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller
    id. Strings are judged on the input and never cross documents; ``kept`` holds the rest, as
    bytes, since a cut may fall inside a character.

    A null text counts as empty. A null id counts as greater than any other; rows that repeat an
    id are no earlier documents to each other. Texts shorter than ``length`` stay whole. Other
    columns are ignored; an empty table gives no rows.
    A long text is hashed as a whole, in a task that needs some 40 bytes for each of its bytes.
    """
    columns = [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
        ("n_spans", pa.int64()), ("kept", pa.binary()),
    ]
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    task = Task(length, gram, _symbols, first_ids, _finish, schema, other_document=True)
    return without_repeats(docs, task, columns)
