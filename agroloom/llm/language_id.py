"""Language identification by word frequencies, with back-off to character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain, compress, repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import content_key, cut, held_out, keyed, semi, text_of, uniform, values, worker_cache

UNKNOWN = "und"
#: Bound of the training sample: about so many documents of each language.
SAMPLE = 1500
#: Bounds of what is fitted: the languages with most documents, and pairs of a unit and a language
#: that has it, of 14 bytes each. The sample of one language has some 60,000 words and 14,000 n-grams, so
#: about 50 languages are held whole; of more, each has an equal share for its most frequent units.
LANGUAGES, UNITS = 400, 4_000_000
LONGEST = 4
#: Words whose scores a worker keeps; a full cache is emptied.
CACHED = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Runs of letters, in lower case; number signs such as fractions count into them.

    Without any letter there are no words.
    """
    found = _WORD.findall(text.lower())
    return found if any(c.isalpha() for word in found for c in word) else []


def grams(word: str, n: int) -> list[str]:
    """Runs of n characters of the word with its ends marked; of one, without the marks."""
    marked = f"\x02{word}\x03" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _tally(batches):
    """Counts of words (n = 0) and n-grams by language, of one task's share of the sample."""
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts.setdefault(lang, Counter()).update(words(text))
    for lang, found in counts.items():
        units: Counter = Counter({(0, w): c for w, c in found.items()})
        for word, c in found.items():
            for n in range(1, LONGEST + 1):
                for gram in grams(word, n):
                    units[n, gram] += c
        items = list(units.items())
        for i in range(0, len(items), 50_000):
            part = items[i : i + 50_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang] * len(part),
                    "n": pa.array([k[0] for k, _ in part], pa.int32()),
                    "unit": [k[1] for k, _ in part],
                    "count": pa.array([c for _, c in part], pa.int64()),
                }
            )


class Model:
    """Log frequencies by unit and language, as flat sorted arrays: an entry for each language that has a unit.

    Units are told by 64 bits of a hash (of four million, two share one with a chance in a million).
    A language that lacks a unit has the frequency of an unseen one among units of that length.
    """

    def __init__(self, langs: list[str], units: np.ndarray, lang: np.ndarray, n: np.ndarray, count: np.ndarray, totals: np.ndarray):
        self.langs = langs
        order = np.lexsort((lang, units))
        units, lang, n, count = units[order], lang[order], n[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], units[1:] != units[:-1]))) if units.size else np.zeros(0, "i8")
        self.units, self.starts = units[first], np.append(first, units.size)
        kinds = np.bincount(n[first], minlength=LONGEST + 1)  # distinct units by length
        below = totals + 0.5 * (kinds[:, None] + 1)
        self.lang, self.value = lang.astype("u2"), np.log((count + 0.5) / below[n, lang]).astype("f4")
        self.unseen = np.log(0.5 / below).astype("f4")

    def rows(self, n: int, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Which of the units some language has, and the log frequencies of these in each language."""
        keys = np.fromiter(map(unit_key, repeat(n), units), "u8", len(units))
        at = np.searchsorted(self.units, keys)
        # a key beyond the last unit is compared with that one, which it isn't; the table is never copied
        known = self.units.take(at, mode="clip") == keys if self.units.size else np.zeros(keys.size, bool)
        first, last = self.starts[at[known]], self.starts[at[known] + 1]
        rows = np.tile(self.unseen[n], (first.size, 1))
        of = np.repeat(np.arange(first.size), last - first)
        entry = np.arange(of.size) + np.repeat(first - np.cumsum(last - first) + (last - first), last - first)
        rows[of, self.lang[entry]] = self.value[entry]
        return known, rows


def unit_key(n: int, unit: str) -> int:
    return xxhash.xxh3_64_intdigest(unit, n)


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """The model: languages, and by unit its log frequencies per language.

    Learns from text and non-null lang of documents that are not held out: about ``sample`` of
    each language, picked by a hash of the id. All that the sample has is kept, up to the bounds
    LANGUAGES and UNITS, so a broadcast of the model is 56 MB at most.
    """
    known = docs.where(~held_out() & F.col("lang").isNotNull()).select(
        "doc_id", F.col("lang").cast("string"), text_of().alias("text")
    )
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    share = F.lit(float(sample)) / F.col("count")
    picked = known.join(F.broadcast(sizes), "lang")
    picked = picked.where(uniform(F.lit(5), F.col("doc_id")) < share).select("lang", "text")
    units = picked.mapInArrow(_tally, "lang string, n int, unit string, count bigint")
    tally = cut(units.groupBy("lang", "n", "unit").agg(F.sum("count").alias("count")))
    return _model(tally)


def _model(tally: DataFrame) -> Model:
    sizes = tally.groupBy("lang", "n").agg(F.sum("count").alias("total"), F.count("*").alias("units")).collect()
    langs = sorted({r["lang"] for r in sizes})
    at = {lang: i for i, lang in enumerate(langs)}
    totals = np.zeros((LONGEST + 1, max(1, len(langs))))
    for r in sizes:
        totals[r["n"], at[r["lang"]]] = r["total"]
    if sum(r["units"] for r in sizes) > UNITS:
        # a window holds the units of one language's share of the sample, which is bounded
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n") == 0, F.desc("count"), "n", "unit"))
        tally = tally.withColumn("place", place).where(F.col("place") <= max(1, UNITS // len(langs)))
    rows = tally.select("lang", "n", "unit", "count").toArrow()  # at most UNITS rows
    n = rows["n"].to_numpy().astype("i8")
    units = np.fromiter(map(unit_key, n.tolist(), rows["unit"].to_pylist()), "u8", rows.num_rows)
    lang = np.fromiter(map(at.__getitem__, rows["lang"].to_pylist()), "i8", rows.num_rows)
    return Model(langs, units, lang, n, rows["count"].to_numpy().astype("f8"), totals)


class _Scores(dict):
    """Word to the row of its scores: of the word itself, or of its longest known n-grams."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.rows = np.zeros((1024, len(model.langs)), "f4")

    def _keep(self, words: list[str], rows: np.ndarray) -> None:
        while len(self) + len(words) > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        self.rows[len(self) : len(self) + len(words)] = rows
        self.update(zip(words, range(len(self), len(self) + len(words)), strict=True))

    def learn(self, new: list[str]) -> None:
        """Score words that aren't kept yet, all of a text's at once; a word without a known unit scores nothing."""
        known, rows = self.model.rows(0, new)
        self._keep(list(compress(new, known)), rows)
        rest = list(compress(new, ~known))
        for n in range(LONGEST, 0, -1):
            if not rest:
                return
            parts = [grams(word, n) for word in rest]
            sizes = np.fromiter(map(len, parts), "i8", len(parts))
            known, rows = self.model.rows(n, list(chain.from_iterable(parts)))
            of = np.repeat(np.arange(len(rest)), sizes)[known]
            times = np.bincount(of, minlength=len(rest))
            sums = np.zeros((len(rest), rows.shape[1]))
            np.add.at(sums, of, rows)
            hit = times > 0
            self._keep(list(compress(rest, hit)), sums[hit] / times[hit, None])
            rest = list(compress(rest, ~hit))
        self._keep(rest, np.zeros((len(rest), self.rows.shape[1])))


def _predictor(model: Model, token: str):
    """A function from a text to (language, score); a worker's scores are kept between its tasks."""
    kept = worker_cache(token, lambda: {"scores": _Scores(model)})
    langs = model.langs

    def predict(text: str | None) -> tuple[str, float]:
        scores = kept["scores"]
        found = words(text or "")
        if not found or not langs:
            return UNKNOWN, 0.0
        new = [word for word in set(found) if word not in scores]
        if new:
            scores.learn(new)
        rows = list(map(scores.__getitem__, found))
        total = scores.rows[rows].sum(axis=0, dtype="f8")
        best = int(total.argmax())
        if len(scores) > CACHED:
            kept["scores"] = _Scores(model)
        return langs[best], float(1 / np.exp(total - total[best]).sum())

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one for each row of ``docs``.

    The score is the prediction's posterior under equal priors, from 0 to 1; the language is one
    that the model has learnt. ``und`` with score 0: the text is null or has no letter, or the
    model knows no language. Of equal scores the language first in code point order wins. Whole
    texts are read in place, without a shuffle; only ``text`` takes part in a prediction. Ids may
    be null or repeat, row for row.
    """
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid4().hex

    def run(batches):
        predict = _predictor(shared.value, token)
        for batch in batches:
            found = list(map(predict, values(batch.column("text"))))
            names, scores = ([f[k] for f in found] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint"), held_out().alias("held_out"), text_of().alias("text")
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without those whose language can't be told: ``und``, or a score under ``least``.

    Rows are judged by their own texts and told apart by id and text together, so ids may be null
    or repeat, and all columns stay, whatever their names. Rejected rows leave by an anti join, for
    which no text is moved as long as they are few. A null or empty text goes; an empty table stays
    empty.
    """
    shared, token = docs.sparkSession.sparkContext.broadcast(learn(docs)), uuid4().hex

    def run(batches):
        predict = _predictor(shared.value, token)
        for batch in batches:
            found = map(predict, values(batch.column("text")))
            bad = [lang == UNKNOWN or score < least for lang, score in found]
            yield batch.select(["id", "key"]).filter(pa.array(bad, pa.bool_()))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), content_key().alias("key"), text_of().alias("text"))
    gone = cut(rows.mapInArrow(run, "id bigint, key bigint").distinct())
    return semi(keyed(docs), gone, "left_anti").select("__row.*")
