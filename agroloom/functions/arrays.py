"""Positions, labels and scores in arrays, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bands import NODATA


def clip(value: Column, low, high) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.greatest(F.least(value, high), low)


def hash_number(seed: int, *columns: Column) -> Column:
    """A number below 2**32 by the columns' text; the same on every engine with md5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def window_start(valid_position: Column, available: Column, length: int) -> Column:
    """First of ``length`` positions around a valid one, as central as the series allows."""
    return clip(valid_position - length // 2, 0, available - length)


def augmented_start(valid_position: Column, available: Column, length: int, seed: int, key: Column) -> Column:
    """First of ``length`` positions that hold the valid one, drawn evenly by a hash."""
    low = F.greatest(valid_position - (length - 1), F.lit(0))
    high = F.least(valid_position, available - length)
    return low + (hash_number(seed, key) % (high - low + 1)).cast("int")


def window_of(values: Column, start: Column, length: int) -> Column:
    return F.slice(values, start + 1, F.lit(length))


def jittered(position: Column, length: int, jitter: int, seed: int, key: Column) -> Column:
    """The position moved by up to ``jitter`` steps, by a hash, within the series."""
    move = (hash_number(seed, key) % (2 * jitter + 1)).cast("int") - jitter
    return clip(position + move, 0, length - 1)


def label_vector(value: Column, length: int, low: Column | None = None, high: Column | None = None) -> Column:
    """``length`` labels: the value from ``low`` to ``high`` (by default everywhere), else no data."""
    low = F.lit(0) if low is None else F.greatest(low, F.lit(0))
    high = F.lit(length - 1) if high is None else F.least(high, F.lit(length - 1))
    places = F.sequence(F.lit(0), F.lit(length - 1))
    return F.transform(places, lambda t: F.when((t >= low) & (t <= high), value).otherwise(NODATA).cast("int"))


def label_at(position: Column, length: int, value: Column, jitter: int = 0, window: int = 0, seed: int = 42, key: Column | None = None) -> Column:
    """Labels at one position, moved by ``jitter`` and then widened by ``window``; everywhere if it is null."""
    moved = jittered(position, length, jitter, seed, key) if jitter else position
    return F.when(position.isNull(), label_vector(value, length)).otherwise(
        label_vector(value, length, moved - window, moved + window)
    )


def label_positions(positions: Column, length: int, value: Column, window: int = 0, jitter: int = 0, seed: int = 42, key: Column | None = None) -> Column:
    """Labels at the positions of a list and nowhere between them; everywhere if it is null.

    With ``window``, from the first less to the last plus so many. With ``jitter``, all positions
    move together by up to so many, within the series. With both, a hash of the key takes one.
    """
    places = F.sequence(F.lit(0), F.lit(length - 1))
    moved = positions
    if jitter:
        move = (hash_number(seed, key) % (2 * jitter + 1)).cast("int") - jitter
        moved = F.transform(positions, lambda p: clip(p + move, 0, length - 1))
    exact = F.transform(places, lambda t: F.when(F.array_contains(moved, t), value).otherwise(NODATA).cast("int"))
    if not window:
        out = exact
    else:
        out = label_vector(value, length, F.array_min(positions) - window, F.array_max(positions) + window)
        if jitter:
            out = F.when(hash_number(seed + 1, key) % 2 == 0, exact).otherwise(out)
    return F.when(positions.isNull(), label_vector(value, length)).otherwise(out)


def class_index(cls: Column, classes: list[str]) -> Column:
    """The class's place in the list, from 0; a class that isn't in it is an error."""
    at = F.array_position(F.array(*map(F.lit, classes)), cls)
    unknown = F.raise_error(F.concat(F.lit("unknown class: "), F.coalesce(cls, F.lit("null"))))
    return F.when(at > 0, at - 1).otherwise(unknown.cast("bigint")).cast("int")


def index_class(index: Column, classes: list[str]) -> Column:
    """The class at a place; no data and places beyond the list give ``unknown``."""
    name = F.get(F.array(*map(F.lit, classes)), index.cast("int"))
    return F.coalesce(F.when(index != NODATA, name), F.lit("unknown"))


def masked_from(values: Column, position) -> Column:
    """The series without its values from a position on."""
    return F.transform(values, lambda v, i: F.when(i >= position, float(NODATA)).otherwise(v))


def uniform_number(seed: int, *columns: Column) -> Column:
    """A number between 0 and 1, both left out, by the columns' text."""
    return (hash_number(seed, *columns) + 0.5) / float(1 << 32)


def skewed_number(seed: int, key: Column) -> Column:
    """A draw from the beta distribution of 1.5 and 2.5, which leans to 0, by a hash.

    Gamma variables of those shapes are exponentials plus half a squared normal; the two normals
    come from one Box-Muller pair.
    """
    u = [uniform_number(seed + k, key) for k in range(5)]
    radius, angle = -F.ln(u[3]), 2 * math.pi * u[4]
    a = -F.ln(u[0]) + radius * F.cos(angle) * F.cos(angle)
    b = -F.ln(u[1]) - F.ln(u[2]) + radius * F.sin(angle) * F.sin(angle)
    return a / (a + b)


def mask_position(low: int, high: int, seed: int, key: Column) -> Column:
    """A position from ``low`` to ``high``, early ones likelier, by a hash."""
    return clip(F.floor(low + skewed_number(seed, key) * (high - low)).cast("int"), low, high)


def sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def softmax(logits: Column) -> Column:
    powers = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda s, q: s + q))


def argmax(values: Column) -> Column:
    """The place of the largest value, from 0; of equal ones the first."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
