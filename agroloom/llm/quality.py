"""A quality classifier: a factorisation machine over hashed words, structure and length."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, text_of

#: Bound of the training sample, in labelled rows.
SAMPLE = 6000
HASH_BITS = 14
RANK = 8
BINS = 12
THRESHOLD = 0.3
#: Passes over the sample, of which small samples take more, to make so many steps of a batch.
EPOCHS, STEPS, BATCH, RATE, DECAY = 8, 400, 64, 0.08, 1e-5
STATISTICS = ("upper", "digit", "symbol", "space", "lines", "distinct", "top", "word_length", "run", "size")
N_FEATURES = (1 << HASH_BITS) + BINS * len(STATISTICS)


def _statistics(data: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """Structure of a text, each figure from 0 to 1; the last is its length, as metadata."""
    histogram = np.bincount(np.frombuffer(data, "u1"), minlength=256)
    n, w = max(1, len(data)), max(1, len(words))
    upper, lower = histogram[65:91].sum(), histogram[97:123].sum()
    digit, high = histogram[48:58].sum(), histogram[128:].sum()
    space = histogram[32] + histogram[9:14].sum()
    symbol = n - upper - lower - digit - high - space
    runs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    top = max(counts.values(), default=0)
    return [
        upper / max(1, upper + lower), digit / n * 4, max(0, symbol) / n * 4, space / n * 3,
        histogram[10] / w * 4, len(counts) / w, top / w * 2, sum(map(len, words)) / w / 16,
        runs / w * 2, np.log2(n + 1) / 20,
    ]


def features(text: str, slots: dict) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: hashed words by damped frequency, to length 1, and one bin a statistic."""
    data = text.encode()
    words = data.split()
    counts = Counter(words)
    index = np.empty(len(counts) + len(STATISTICS), "i4")
    for i, word in enumerate(counts):
        slot = slots.get(word)
        if slot is None:
            slot = zlib.crc32(word.lower()) & ((1 << HASH_BITS) - 1)
            if len(slots) < 500_000:
                slots[word] = slot
        index[i] = slot
    value = np.ones(len(index), "f4")
    value[: len(counts)] = np.log1p(np.fromiter(counts.values(), "f4", len(counts)))
    if counts:
        value[: len(counts)] /= np.linalg.norm(value[: len(counts)])
    stats = np.clip(_statistics(data, words, counts), 0, 0.999)
    index[len(counts) :] = (1 << HASH_BITS) + np.arange(len(stats)) * BINS + (stats * BINS).astype(int)
    return index, value


def fm_logit(bias, weights, factors, index, value) -> float:
    """Linear terms and all pairwise interactions, by half of (square of sum - sum of squares)."""
    scaled = factors[index] * value[:, None]
    total = scaled.sum(axis=0)
    return bias + weights[index] @ value + 0.5 * float((total * total).sum() - (scaled * scaled).sum())


def fit(labels: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], seed: int = 7) -> tuple:
    """(bias, weights, factors) by AdaGrad on the log loss, in a fixed order."""
    random = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    weights = np.zeros(N_FEATURES, "f4")
    factors = random.normal(0, 0.02, (N_FEATURES, RANK)).astype("f4")
    g_w, g_v, g_b = np.full(N_FEATURES, 1e-2, "f4"), np.full(factors.shape, 1e-2, "f4"), 1e-2
    if not len(labels) or labels.min() == labels.max():
        return bias, weights, factors * 0
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(labels)))):
        order = random.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            picked = order[start : start + BATCH]
            index = np.concatenate([rows[i][0] for i in picked])
            value = np.concatenate([rows[i][1] for i in picked])
            sizes = np.array([len(rows[i][0]) for i in picked])
            begins = np.cumsum(sizes) - sizes
            scaled = factors[index] * value[:, None]
            total = np.add.reduceat(scaled, begins)
            pairs = 0.5 * (total**2 - np.add.reduceat(scaled**2, begins)).sum(axis=1)
            logit = bias + np.add.reduceat(weights[index] * value, begins) + pairs
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[picked]) / len(picked)
            each = np.repeat(error, sizes) * value
            d_v = each[:, None] * (np.repeat(total, sizes, axis=0) - scaled)
            slots, inverse = np.unique(index, return_inverse=True)
            gw = np.bincount(inverse, each, len(slots)) + DECAY * weights[slots]
            gv = np.stack([np.bincount(inverse, d_v[:, k], len(slots)) for k in range(RANK)], 1)
            gv += DECAY * factors[slots]
            g_w[slots] += gw**2
            g_v[slots] += gv**2
            weights[slots] -= RATE * gw / np.sqrt(g_w[slots])
            factors[slots] -= RATE * gv / np.sqrt(g_v[slots])
            g_b += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(g_b)
    return float(bias), weights, factors


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple:
    """The machine, fitted on at most ``sample`` labelled rows that are not held out.

    The sample is the first rows by a hash of their id; tasks make the features, and the driver
    fits on those of the sample alone. A text's features are bounded, however long it is.
    """
    known = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    order = [F.xxhash64(F.lit(3), "doc_id"), "doc_id", "quality"]
    picked = known.select("doc_id", F.col("quality").cast("int").alias("__y")).orderBy(*order).limit(sample)

    def run(batches):
        slots: dict = {}
        for batch in batches:
            pairs = [features(t, slots) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("y"),
                    pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                    pa.array([p[1] for p in pairs], pa.list_(pa.float32())),
                ],
                ["doc_id", "y", "i", "v"],
            )

    rows = docs.join(F.broadcast(picked), "doc_id").select(
        F.col("doc_id").cast("bigint"), F.col("__y").alias("y"), text_of().alias("text")
    )
    rows = rows.mapInArrow(run, "doc_id bigint, y int, i array<int>, v array<float>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("y", "ascending")])
    pairs = [(i.values.to_numpy(), v.values.to_numpy()) for i, v in zip(rows["i"], rows["v"], strict=True)]
    return fit((rows["y"].to_numpy() == 1).astype("f8"), pairs)


def score(docs: DataFrame, model: tuple, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of ``docs``.

    ``score`` is the machine's probability of label 1, ``predicted`` is 1 from ``threshold`` on.
    Whole texts are scored in place, in time linear in their words. Empty and null texts have the
    features of an empty text. Without labels of both kinds every text gets the labels' share.
    Ids may be null or repeat, row for row; other columns never take part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        slots: dict = {}
        for batch in batches:
            logits = [fm_logit(*shared.value, *features(t, slots)) for t in batch.column("text").to_pylist()]
            scores = 1 / (1 + np.exp(-np.clip(np.array(logits, "f8"), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores)],
                ["doc_id", "held_out", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint"), held_out().alias("held_out"), text_of().alias("text")
    ).mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
