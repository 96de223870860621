"""Repeated windows of a corpus, found without moving its windows: the frame of two operators.

Texts are dealt to *chunks* by a hash of their id. A chunk's task describes its windows by runs
(:mod:`.windows`): one small record for each distinct run, with the hash of the gram that owns it.
Records are dealt to *shards* by that hash, where equal windows must meet. Owner grams that occur
once in the corpus are done with. Where every occurrence has the same run, its windows occur as
often as it does. Of the others, each distinct run's symbols are sent to the shard once, however
common it is; there an index over those texts decides every window. The answers go back to the
chunks, which mark what their documents lose.

A run that fills a third of the corpus is one record per chunk and one text in its shard. A line in
a third of the documents has other neighbours in each; its grams are learnt from a sample and own
no window that holds another gram, so the windows over its edges are dealt to many shards.

Runs count as equal if 95 bits or more of hashes agree: 64 of all symbols under the run, 31 of the
owner gram, and its shard, from hash functions of their own. Among 10^13 runs, the chance that two
different ones agree is below one in a thousand.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import content_key, text_of, uniform
from .windows import common_table, gram_hashes, runs

#: Bytes of text in a chunk, on average, and bytes that are hashed together.
CHUNK_BYTES = 8_000_000
GROUP_BYTES = 1_000_000
#: Symbols of runs that one index holds, unless those of a single owner gram are more.
INDEXED = 2_000_000
#: Documents (about) that common grams are learnt from: so many, and one of EVERY in a large corpus,
#: so that a gram of 20,000 documents is in ten of the sample, whatever its share of the corpus. How
#: many of them a task reads, how many hold a common gram at least, and how many grams are kept, the
#: most common ones. They decide which task does what, never what is found.
SAMPLE, EVERY, SAMPLED_TOGETHER, COMMON, MOST_COMMON = 1500, 2000, 375, 3, 262_144
NO_ID = np.iinfo("i8").max
_RECORD = np.dtype([("key", "<u4"), ("context", "<u8"), ("order", "<u4")])
_MANY = np.uint32(1 << 31)


class Task(NamedTuple):
    """What tells the two operators apart."""

    width: int  # symbols of a window
    gram: int  # symbols of an owner gram
    symbols: Callable  # (texts as bytes) -> (hashes of all symbols, bounds, symbols to send)
    #: (texts, lengths of runs in windows, ids, counts, width) -> a value for each window:
    #: a document loses a window if its own id is greater than the value
    resolve: Callable
    finish: Callable  # (text, its symbols' mask) -> row of output columns
    schema: str
    #: whether a second occurrence must be in another document
    other_document: bool


class _Chunk(NamedTuple):
    """Distinct runs of a chunk, by shard."""

    ids: np.ndarray  # of documents; null is NO_ID
    texts: list
    groups: list  # (first document, one past the last) that are hashed together
    run: np.ndarray  # for each run: its record
    begin: np.ndarray  # for each run: its first window's start, in its group's symbols
    bounds: np.ndarray  # of groups, in runs
    symbols: list  # for each group: the bounds of its texts and their symbols
    shard: np.ndarray  # for each record, ascending
    key: np.ndarray
    context: np.ndarray
    least: np.ndarray  # the smallest document id
    many: np.ndarray  # whether two occurrences are in the chunk (that count)
    sample: np.ndarray  # a run of the record
    n: np.ndarray  # its windows


def _chunk(table: pa.Table, task: Task, shards: int, common) -> _Chunk:
    table = table.sort_by([("doc_id", "ascending"), ("key", "ascending")])  # one order in all passes
    ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
    texts = [t.encode() for t in table.column("text").to_pylist()]
    groups, start, size = [], 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= GROUP_BYTES or k == len(texts) - 1:
            groups.append((start, k + 1))
            start, size = k + 1, 0
    parts, bounds, symbols = [], [0], []
    for a, b in groups:
        hashes, ends, sent = task.symbols(texts[a:b])
        symbols.append((ends, sent))
        r = runs(hashes, ends, task.width, task.gram, common.value)
        document = np.searchsorted(ends, r.begin, "right") - 1 + a
        parts.append((r.key, r.context, r.begin, r.n, ids[document]))
        bounds.append(bounds[-1] + len(r.n))
    if not parts:
        parts = [(np.zeros(0, "u8"), np.zeros(0, "u8"), *[np.zeros(0, "i8")] * 3)]
    key, context, begin, n, owner_id = map(np.concatenate, zip(*parts, strict=True))
    shard = (key >> np.uint64(32)) % np.uint64(shards)
    order = np.argsort(context)  # what follows doesn't depend on the order of ties
    new = np.ones(len(order), bool)
    new[1:] = context[order[1:]] != context[order[:-1]]
    first = np.flatnonzero(new)
    if len(first):
        least, most = (f.reduceat(owner_id[order], first) for f in (np.minimum, np.maximum))
        sample = np.minimum.reduceat(order, first)
    else:
        least = most = owner_id
        sample = order
    sizes = np.diff(np.append(first, len(order)))
    many = most > least if task.other_document else sizes > 1
    # records by shard
    by_shard = np.argsort(shard[sample], kind="stable")
    place = np.empty(len(first), "i8")
    place[by_shard] = np.arange(len(first))
    record = np.empty(len(order), "i8")
    record[order] = place[np.cumsum(new) - 1]
    sample, least, many = sample[by_shard], least[by_shard], many[by_shard]
    low = (key[sample] & np.uint64(0x7FFFFFFF)).astype("u4")
    return _Chunk(ids, texts, groups, record, begin, np.array(bounds), symbols, shard[sample].astype("i4"), low, context[sample], least, many, sample, n[sample])


def _summaries(task: Task, shards: int, common):
    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        c = _chunk(table, task, shards, common)
        rows = []
        edges = np.append(np.flatnonzero(np.diff(c.shard, prepend=-1)), len(c.shard)).tolist()
        for a, b in zip(edges, edges[1:]):
            s = int(c.shard[a])
            base = int(c.least[a:b].min())
            wide = int(c.least[a:b].max()) - base >= 1 << 32
            body = np.empty(b - a, _RECORD)
            body["key"] = c.key[a:b] | np.where(c.many[a:b], _MANY, np.uint32(0))
            body["context"] = c.context[a:b]
            body["order"] = 0 if wide else c.least[a:b] - base
            rows.append((s, chunk, base, body.tobytes(), c.least[a:b].astype("<i8").tobytes() if wide else None))
        return _table(rows, [("shard", pa.int32()), ("chunk", pa.int32()), ("base", pa.int64()), ("body", pa.binary()), ("ids", pa.binary())])

    return run


def _table(rows: list, columns: list) -> pa.Table:
    schema = pa.schema(columns)
    arrays = [pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(columns)]
    return pa.Table.from_arrays(arrays, schema=schema)


class _Shard(NamedTuple):
    """Records of a shard whose owner gram occurs again, by distinct run."""

    chunk: np.ndarray  # for each live record
    index: np.ndarray  # its place among the chunk's records of this shard
    run: np.ndarray  # its distinct run
    least: np.ndarray  # its smallest id
    first: np.ndarray  # for each distinct run: the record that sends its text
    count: np.ndarray  # for each distinct run: occurrences that count, 2 at most
    alone: np.ndarray  # for each distinct run: whether no other run has its owner gram
    owner: np.ndarray  # for each distinct run: the number of its owner gram


def _shard(table: pa.Table) -> _Shard:
    table = table.sort_by("chunk")
    bodies = [np.frombuffer(b, _RECORD) for b in table.column("body").to_pylist()]
    sizes = np.array([len(b) for b in bodies])
    every = np.concatenate(bodies) if bodies else np.zeros(0, _RECORD)
    least = np.repeat(table.column("base").to_numpy(), sizes) + every["order"]
    at = np.cumsum(sizes) - sizes
    for k, ids in enumerate(table.column("ids").to_pylist()):
        if ids is not None:
            least[at[k] : at[k] + sizes[k]] = np.frombuffer(ids, "<i8")
    chunk = np.repeat(table.column("chunk").to_numpy(), sizes)
    index = np.arange(len(every)) - np.repeat(at, sizes)
    many = (every["key"] & _MANY) > 0
    key, context = every["key"] & ~_MANY, every["context"]
    n = 1 + many.astype("i8")
    # owner grams that occur once go first, before the larger sort
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])[: len(order)]
    total = np.add.reduceat(n[order], np.flatnonzero(new)) if len(order) else n
    live = order[total[np.cumsum(new) - 1] > 1] if len(order) else order
    live = live[np.lexsort((least[live], context[live], key[live]))]
    k, x = key[live], context[live]
    new_key = np.concatenate([[True], k[1:] != k[:-1]])[: len(live)]
    new = new_key | np.concatenate([[True], x[1:] != x[:-1]])[: len(live)]
    first = np.flatnonzero(new)
    count = np.minimum(np.add.reduceat(n[live], first), 2) if len(live) else n[:0]
    starts = new_key[first]
    alone = starts & np.append(starts[1:], True)[: len(first)]
    return _Shard(chunk[live], index[live], np.cumsum(new) - 1, least[live], first, count, alone, np.cumsum(starts))


def _wanted(shard_table: pa.Table) -> pa.Table:
    """For each chunk, the records whose text it is to send."""
    s = _shard(shard_table)
    shard = shard_table.column("shard")[0].as_py()
    senders = s.first[~s.alone]
    chunk, index = s.chunk[senders], s.index[senders]
    order = np.lexsort((index, chunk))
    chunk, index = chunk[order], index[order]
    rows = []
    for part in np.split(np.arange(len(chunk)), np.flatnonzero(np.diff(chunk)) + 1) if len(chunk) else ():
        rows.append((int(chunk[part[0]]), shard, index[part].astype("<u4").tobytes()))
    return _table(rows, [("chunk", pa.int32()), ("shard", pa.int32()), ("body", pa.binary())])


def _texts(task: Task, shards: int, common):
    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        rows = []
        if len(texts) and len(wanted):
            chunk = texts.column("chunk")[0].as_py()
            c = _chunk(texts, task, shards, common)
            edges = _Edges(c.shard)
            asked = {s: np.frombuffer(b, "<u4") for s, b in zip(wanted.column("shard").to_pylist(), wanted.column("body").to_pylist(), strict=True)}
            flat = np.concatenate([edges[s] + i for s, i in asked.items()])
            sent: dict[int, np.ndarray] = {}
            order = flat[np.argsort(c.sample[flat], kind="stable")]
            group = np.searchsorted(c.bounds, c.sample[order], "right") - 1
            for g in np.unique(group).tolist():
                symbols = c.symbols[g][1]
                for r in order[group == g].tolist():
                    start = int(c.begin[c.sample[r]])
                    sent[r] = symbols[start : start + int(c.n[r]) + task.width - 1].copy()
            for s, i in asked.items():
                records = (edges[s] + i).tolist()
                body = np.concatenate([sent[r] for r in records])
                rows.append((s, chunk, i.tobytes(), c.n[records].astype("<u4").tobytes(), body.tobytes()))
        return _table(rows, [("shard", pa.int32()), ("chunk", pa.int32()), ("index", pa.binary()), ("n", pa.binary()), ("body", pa.binary())])

    return run


class _Edges:
    """Where a shard's records begin among those of a chunk."""

    def __init__(self, shard: np.ndarray) -> None:
        self.shard = shard

    def __getitem__(self, s: int) -> int:
        return int(np.searchsorted(self.shard, s))


def _batches(owner: np.ndarray, symbols: np.ndarray):
    """Ranges of runs with about INDEXED symbols; runs of one owner gram stay together."""
    if not len(owner):
        return
    ends = np.append(np.flatnonzero(np.diff(owner)) + 1, len(owner))
    reached = np.cumsum(symbols)[ends - 1]
    start, done = 0, 0
    while start < len(owner):
        k = max(int(np.searchsorted(reached, done + INDEXED, "right")) - 1, int(np.searchsorted(ends, start, "right")))
        yield start, int(ends[k])
        start, done = int(ends[k]), int(reached[k])


def _decided(task: Task, s: _Shard, several: np.ndarray, sent: pa.Table):
    """(run, length, value): pieces of the runs whose windows other runs may hold."""
    senders = s.first[several]
    at = {x: k for k, x in enumerate(zip(s.chunk[senders].tolist(), s.index[senders].tolist(), strict=True))}
    kind = task.symbols([])[2].dtype
    texts: list = [None] * len(several)
    windows = np.zeros(len(several), "i8")
    for chunk, index, n, body in zip(*(sent.column(x).to_pylist() for x in ("chunk", "index", "n", "body")), strict=True):
        n = np.frombuffer(n, "<u4").astype("i8")
        symbols = np.frombuffer(body, kind)
        ends = np.cumsum(n + task.width - 1)
        for i, size, end in zip(np.frombuffer(index, "<u4").tolist(), n.tolist(), ends.tolist(), strict=True):
            k = at[chunk, i]
            texts[k], windows[k] = symbols[end - size - task.width + 1 : end], size
    least, count = s.least[senders], s.count[several]
    values = np.concatenate(
        [
            task.resolve(texts[a:b], windows[a:b], least[a:b], count[a:b], task.width)
            for a, b in _batches(s.owner[several], windows + task.width - 1)
        ]
    )
    begins = np.cumsum(windows) - windows
    change = np.ones(len(values), bool)
    change[1:] = values[1:] != values[:-1]
    change[begins] = True
    edge = np.flatnonzero(change)
    of = several[np.searchsorted(begins, edge, "right") - 1]
    return of, np.diff(np.append(edge, len(values))), values[edge]


def _answers(task: Task):
    def run(records: pa.Table, sent: pa.Table) -> pa.Table:
        rows: list = []
        columns = [("chunk", pa.int32()), ("shard", pa.int32()), ("index", pa.binary()), ("n", pa.binary()), ("values", pa.binary())]
        if not len(records):
            return _table(rows, columns)
        s = _shard(records)
        shard = records.column("shard")[0].as_py()
        alone, several = np.flatnonzero(s.alone), np.flatnonzero(~s.alone)
        ids = s.least[s.first]
        # pieces: stretches of a run's windows with one value; length 0 stands for the whole run
        of, length, value = alone, np.zeros(len(alone), "i8"), ids[alone] if task.other_document else 0 * alone
        if len(several):
            pieces = _decided(task, s, several, sent)
            of, length, value = (np.concatenate(x) for x in zip((of, length, value), pieces, strict=True))
            order = np.argsort(of, kind="stable")
            of, length, value = of[order], length[order], value[order]
        first_piece = np.searchsorted(of, np.arange(len(ids) + 1))
        lowest = np.minimum.reduceat(value, first_piece[:-1]) if len(ids) else ids
        # a record is answered only where some window has a use for it
        useful = (lowest[s.run] < s.least) | (s.count[s.run] > 1) if task.other_document else lowest[s.run] < NO_ID
        live = np.flatnonzero(useful)
        live = live[np.lexsort((s.index[live], s.chunk[live]))]
        chunk = s.chunk[live]
        for part in np.split(live, np.flatnonzero(np.diff(chunk)) + 1) if len(live) else ():
            r = s.run[part]
            pieces = first_piece[r + 1] - first_piece[r]
            take = np.repeat(first_piece[r], pieces) + np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            n = np.stack([np.repeat(s.index[part], pieces), length[take]], 1).astype("<u4")
            rows.append((int(s.chunk[part[0]]), shard, n[:, 0].tobytes(), n[:, 1].astype("<u2").tobytes(), value[take].astype("<i8").tobytes()))
        return _table(rows, columns)

    return run


def _marked(task: Task, shards: int, common, columns: list):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(texts):
            return _table([], columns)
        c = _chunk(texts, task, shards, common)
        edges = _Edges(c.shard)
        record, length, value = [np.zeros(0, "i8")], [np.zeros(0, "i8")], [np.zeros(0, "i8")]
        for s, index, n, v in zip(*(answers.column(x).to_pylist() for x in ("shard", "index", "n", "values")), strict=True):
            record.append(edges[s] + np.frombuffer(index, "<u4"))
            length.append(np.frombuffer(n, "<u2").astype("i8"))
            value.append(np.frombuffer(v, "<i8"))
        record, length, value = map(np.concatenate, (record, length, value))
        order = np.argsort(record, kind="stable")
        record, length, value = record[order], length[order], value[order]
        length = np.where(length > 0, length, c.n[record])
        before = np.cumsum(length) - length
        offset = before - before[np.searchsorted(record, record)] if len(record) else before
        first = np.searchsorted(record, np.arange(len(c.key) + 1))
        out = []
        for g, (a, b) in enumerate(c.groups):
            bounds, _ = c.symbols[g]
            change = np.zeros(int(bounds[-1]) + 1, "i4")
            here = np.arange(c.bounds[g], c.bounds[g + 1])
            pieces = first[c.run[here] + 1] - first[c.run[here]]
            here, pieces = here[pieces > 0], pieces[pieces > 0]
            piece = np.repeat(first[c.run[here]], pieces) + np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = np.repeat(c.begin[here], pieces) + offset[piece]
            document = np.searchsorted(bounds, start, "right") - 1
            hit = c.ids[a + document] > value[piece] if task.other_document else value[piece] < NO_ID
            np.add.at(change, start[hit], 1)
            np.add.at(change, start[hit] + length[piece][hit] + task.width - 1, -1)
            covered = np.cumsum(change[:-1]) > 0
            for k in range(a, b):
                mask = covered[bounds[k - a] : bounds[k - a + 1]]
                identity = None if c.ids[k] == NO_ID else int(c.ids[k])
                out.append((identity, *task.finish(c.texts[k], mask)))
        return _table(out, columns)

    return run


def _sampled(task: Task):
    """Rows (gram, n): in how many of the task's documents a gram occurs, if in several."""

    def run(batches):
        found = []
        for batch in batches:
            for text in batch.column("text").to_pylist():
                hashes = task.symbols([text.encode()])[0]
                if len(hashes) >= task.gram:
                    found.append(np.unique(gram_hashes(hashes, task.gram)[0]))
        grams, n = np.unique(np.concatenate(found or [np.zeros(0, "u8")]), return_counts=True)
        grams, n = grams[n > 1], n[n > 1]
        yield pa.RecordBatch.from_arrays([pa.array(grams.view("i8")), pa.array(n, pa.int64())], ["gram", "n"])

    return run


def sample_size(n_docs: int) -> int:
    """Of how many documents common grams are learnt: it grows with the corpus."""
    return max(SAMPLE, n_docs // EVERY)


def _common_grams(rows: DataFrame, n_docs: int, task: Task) -> np.ndarray | None:
    """The table of grams that several documents of a sample hold; None if there are none."""
    size = sample_size(n_docs)
    sample = rows.where(uniform(F.lit(31), F.col("doc_id"), F.col("key")) < size / max(1, n_docs)).select("text")
    sample = sample.repartition(max(1, size // SAMPLED_TOGETHER))
    counts = sample.mapInArrow(_sampled(task), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = counts.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "gram").limit(MOST_COMMON)
    grams = counts.select("gram").toArrow()["gram"].to_numpy().view("u8")
    return common_table(grams) if len(grams) else None


def without_repeats(docs: DataFrame, task: Task, columns: list) -> DataFrame:
    """A row for each row of ``docs``: ``columns`` (name, Arrow type), made by the task's ``finish``.

    The texts cross the network once; that exchange serves the three passes over the chunks.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), content_key().alias("key"), text_of().alias("text"))
    n_docs, total = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-(total or 0) // CHUNK_BYTES))
    common = docs.sparkSession.sparkContext.broadcast(_common_grams(rows, n_docs, task))
    chunk = F.pmod(F.xxhash64(F.lit(17), "doc_id", "key"), F.lit(parts)).cast("int")
    texts = rows.withColumn("chunk", chunk)
    by_chunk = texts.groupBy("chunk")
    records = by_chunk.applyInArrow(
        _summaries(task, parts, common), "shard int, chunk int, base bigint, body binary, ids binary"
    )
    by_shard = records.groupBy("shard")
    wanted = by_shard.applyInArrow(_wanted, "chunk int, shard int, body binary")
    sent = by_chunk.cogroup(wanted.groupBy("chunk")).applyInArrow(
        _texts(task, parts, common), "shard int, chunk int, index binary, n binary, body binary"
    )
    answers = by_shard.cogroup(sent.groupBy("shard")).applyInArrow(
        _answers(task), "chunk int, shard int, index binary, n binary, values binary"
    )
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
        _marked(task, parts, common, columns), task.schema
    )
