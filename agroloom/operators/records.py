"""Records of model inputs as dense blocks for an encoder, a batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions import bands

#: What a block has of each record: series of bands, constants, a place, and dates as (day, month, year).
SERIES, CONSTANTS = ("s1", "s2", "meteo"), ("dem", "latlon")
Blocks = dict[str, np.ndarray]


def _dense(lists: pa.Array, steps: int) -> np.ndarray:
    """(rows, steps) of lists of numbers: no data where a list is null or ends, or a value is null or NaN."""
    counts = lists.value_lengths().fill_null(0).to_numpy().astype("i8") if len(lists) else np.zeros(0, "i8")
    if counts.size and counts.max() > steps:
        raise ValueError(f"a series of {counts.max()} steps, not {steps}")
    out = np.full((len(lists), steps), bands.NODATA, "f8")
    if counts.sum():
        values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(counts.size), counts)
        out[rows, np.arange(values.size) - np.repeat(np.cumsum(counts) - counts, counts)] = np.where(np.isnan(values), bands.NODATA, values)
    return out


def _numbers(column: pa.Array) -> np.ndarray:
    values = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.where(np.isnan(values), bands.NODATA, values)


def _fields(group: pa.Array) -> list[pa.Array]:
    """The fields of structs, null where the struct is."""
    return group.flatten()


def blocks(records: pa.Array, steps: int) -> Blocks:
    """Each group of records as (rows, steps, bands), constants as (rows, bands)."""
    groups = dict(zip((f.name for f in records.type), _fields(records), strict=True))
    out = {name: np.stack([_dense(band, steps) for band in _fields(groups[name])], 2) for name in SERIES}
    out |= {name: np.stack([_numbers(band) for band in _fields(groups[name])], 1) for name in CONSTANTS}
    dates = groups["timestamps"]
    lengths = dates.value_lengths()
    parts = pa.array(np.concatenate(([0], np.cumsum(lengths.fill_null(0).to_numpy())))).cast(pa.int32()) if len(dates) else pa.array([0], pa.int32())
    flat = dates.flatten()
    each = [_dense(pa.ListArray.from_arrays(parts, part), steps) for part in _fields(flat)]
    return out | {"timestamps": np.stack(each, 2)}


def _regrouped(parts: Iterator[tuple[pa.Array, Blocks]], size: int) -> Iterator[tuple[pa.Array, Blocks]]:
    """Keys and blocks of ``size`` rows each, but for the last."""
    keys: list[pa.Array] = []
    held: list[Blocks] = []
    have = 0

    def joined() -> tuple[pa.Array, Blocks]:
        return pa.concat_arrays(keys), {n: np.concatenate([b[n] for b in held]) for n in held[0]}

    for key, block in parts:
        keys.append(key)
        held.append(block)
        have += len(key)
        if have >= size:
            key, block = joined()  # noqa: PLW2901  what is left stays for the next round
            whole = have - have % size
            for at in range(0, whole, size):
                yield key[at : at + size], {n: b[at : at + size] for n, b in block.items()}
            keys, held, have = [key[whole:]], [{n: b[whole:] for n, b in block.items()}], have - whole
    if have:
        yield joined()


def embed_records(
    df: DataFrame, load: Callable[[], Callable[[Blocks], np.ndarray]], steps: int, key: str = "sample_id", column: str = "inputs", batch: int = 256
) -> DataFrame:
    """Rows (key, embedding): records of model inputs (``column``) by a supplied encoder.

    ``load`` runs once a task and gives a function from blocks of ``batch`` records (the last one of a
    task may be smaller) to their vectors, one row each: ``s1``, ``s2`` and ``meteo`` as (rows, steps,
    bands), ``dem`` and ``latlon`` as (rows, bands), ``timestamps`` as (rows, steps, 3). Blocks come from
    Arrow's buffers, not row by row. Null records, series and values are no data, and so is what a
    series lacks of ``steps``; one that has more is an error. The key travels with its row.
    """

    def run(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load()
        parts = ((b.column(key), blocks(b.column(column), steps)) for b in arrived if b.num_rows)
        for keys, block in _regrouped(parts, batch):
            vectors = np.asarray(encode(block), "f4")
            if vectors.shape[:1] != (len(keys),) or vectors.ndim != 2:
                raise ValueError(f"vectors of shape {vectors.shape} for {len(keys)} records")
            ends = pa.array(np.arange(0, vectors.size + 1, vectors.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(ends, pa.array(vectors.reshape(-1)))], [key, "embedding"])

    kind = dict(df.dtypes)[key]
    return df.select(key, column).mapInArrow(run, f"{key} {kind}, embedding array<float>")
