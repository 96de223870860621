"""Scoring with supplied encoders and fitted models, and tables about them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .splits import stratified_folds


def embed(df: DataFrame, load: Callable[[], Callable], key: str, column: str) -> DataFrame:
    """Rows (key, embedding) by a supplied encoder.

    ``load`` runs once a task and gives a function from an Arrow batch's inputs, an array of a row
    each, to their vectors, one row each. The key travels with its row, so order never matters.
    Inputs of one batch have equal lengths; null inputs are the caller's to leave out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load()
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
            vectors = np.asarray(encode(values.reshape(batch.num_rows, -1)), "f4")
            ends = pa.array(np.arange(0, vectors.size + 1, vectors.shape[1]), pa.int32())
            rows = pa.ListArray.from_arrays(ends, pa.array(vectors.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(key), rows], [key, "embedding"])

    kind = dict(df.dtypes)[key]
    return df.select(key, column).mapInArrow(run, f"{key} {kind}, embedding array<float>")


def embedding_columns(df: DataFrame, column: str, length: int, prefix: str = "emb_") -> DataFrame:
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, *[F.get(column, F.lit(i)).alias(f"{prefix}{i}") for i in range(length)])


def mask_crop_type(df: DataFrame, landcover: str = "landcover", croptype: str = "croptype", cropland: str = "cropland") -> DataFrame:
    """The crop type only where there is cropland, and the mask itself."""
    mask = F.coalesce(F.col(landcover) == cropland, F.lit(False))
    return df.withColumns({croptype: F.when(mask, F.col(croptype)), "cropland_mask": mask.cast("int")})


class Boosted:
    """Boosted trees for any number of classes: an additive model for each class but one of two, against the rest.

    ``models`` are of the classes in ``labels``, in order; of two classes there is one, of the second.
    """

    def __init__(self, labels: list[str], models: list):
        self.labels, self.models = labels, models

    @property
    def importances(self) -> np.ndarray:
        return np.mean([m.featureImportances.toArray() for m in self.models], axis=0)

    def margins(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``features``) with ``margins``: each model's sum over its trees."""
        for k, model in enumerate(self.models):
            df = model.setRawPredictionCol(f"__r{k}").setProbabilityCol("").setPredictionCol("").transform(df)
        sums = [vector_to_array(F.col(f"__r{k}"))[1] for k in range(len(self.models))]
        return df.withColumn("margins", F.array(*sums)).drop(*(f"__r{k}" for k in range(len(self.models))))

    def losses(self, df: DataFrame, label: str) -> list[float]:
        """The mean weighted log loss on ``df`` after each number of trees, in one pass over it."""
        rows = _indexed(df, label, self.labels)
        size = min(len(m.trees) for m in self.models)
        for k, model in enumerate(self.models):
            for i, tree in enumerate(model.trees[:size]):
                rows = tree.setFeaturesCol("features").setPredictionCol(f"__p{k}_{i}").transform(rows)
        sums = [F.lit(0.0)] * len(self.models)
        means = []
        for i in range(size):
            sums = [s + model.treeWeights[i] * F.col(f"__p{k}_{i}") for k, (s, model) in enumerate(zip(sums, self.models, strict=True))]
            share = F.get(_shares(F.array(*sums)), F.col("__label"))
            means.append(F.sum(F.col("weight") * -F.ln(F.greatest(share, F.lit(1e-15)))) / F.sum("weight"))
        return [float(v) for v in rows.agg(*[m.alias(f"l{i}") for i, m in enumerate(means)]).first()]


def _shares(margins: Column) -> Column:
    """The probabilities of the classes, given the models' sums; of one model, of both its classes."""
    each = F.transform(margins, lambda m: 1 / (1 + F.exp(-2 * m)))
    total = F.aggregate(each, F.lit(0.0), lambda s, p: s + p)
    return F.when(F.size(margins) == 1, F.array(1 - each[0], each[0])).otherwise(F.transform(each, lambda p: p / total))


def _indexed(df: DataFrame, label: str, labels: list[str]) -> DataFrame:
    """``df`` with features and ``__label``, the place of its class; an unknown class is an error."""
    at = F.array_position(F.array(*map(F.lit, labels)), F.col(label)).cast("int") - 1
    wrong = F.raise_error(F.concat(F.lit("unknown class: "), F.coalesce(F.col(label), F.lit("null"))))
    return with_features(df).withColumn("__label", F.when(F.coalesce(at, F.lit(-1)) < 0, wrong.cast("int")).otherwise(at))


def fit_classifier(df: DataFrame, label: str, n_classes: int, trees: int = 20, depth: int = 5, seed: int = 42) -> Boosted:
    """Boosted trees on ``embedding``, with the weights of ``weight``. Spark trains them on the executors.

    Rows without an embedding of finite numbers (:func:`usable`) or without a class take no part.
    """
    known = df.where(usable("embedding") & F.col(label).isNotNull())
    labels = sorted(r[0] for r in known.select(label).distinct().collect())
    if len(labels) != n_classes:
        raise ValueError(f"{len(labels)} classes, not {n_classes}")
    rows = _indexed(known, label, labels)
    common = {"featuresCol": "features", "labelCol": "__own", "weightCol": "weight", "maxDepth": depth, "maxIter": trees, "seed": seed}

    def against_rest(k: int):
        return GBTClassifier(**common).fit(rows.withColumn("__own", (F.col("__label") == k).cast("double")))

    return Boosted(labels, [against_rest(k) for k in ([1] if n_classes == 2 else range(n_classes))])


def usable(column: str) -> Column:
    """Whether an embedding is there and all of its components are finite numbers."""
    finite = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def with_features(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))


def predict(df: DataFrame, model: Boosted) -> DataFrame:
    """``df`` with ``y_pred`` and ``prob`` by fitted trees; of equal classes the first.

    Both are null where the embedding is null or holds a null or a number that isn't finite.
    """
    fine = usable("embedding")
    filler = F.array_repeat(F.lit(0.0), int(model.models[0].numFeatures))
    rows = df.withColumns({"__fine": fine, "features": array_to_vector(F.when(fine, F.col("embedding").cast("array<double>")).otherwise(filler))})
    scored = model.margins(rows).withColumn("__shares", _shares(F.col("margins")))
    best = F.array_max("__shares")
    name = F.get(F.array(*map(F.lit, model.labels)), (F.array_position("__shares", best) - 1).cast("int"))
    return scored.select(*df.columns, F.when(F.col("__fine"), name).alias("y_pred"), F.when(F.col("__fine"), best).alias("prob"))


def stopped(losses: list[float], patience: int) -> tuple[int, bool]:
    """(the number of trees of least loss, whether boosting stops there): the first of equal ones.

    It stops when as many trees as ``patience`` have followed the best without a smaller loss.
    """
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def select_by_folds(df: DataFrame, label: str, key: str, n_classes: int, most: int, patience: int = 5, k: int = 5, seed: int = 42):
    """(rows (fold, trees, loss, chosen), the median of the chosen sizes) over ``k`` stratified folds.

    Each fold's trees are boosted on the other folds until ``patience`` trees in a row don't lessen the
    loss on the fold, ``most`` at the latest; the loss after each tree is a row, and the least one
    chooses. Fitting begins with few trees and doubles them while the loss still falls. Folds
    are numbered once and written; the driver walks them, each fit and each loss is a Spark job.
    """
    folded = cut(stratified_folds(df.where(usable("embedding")), label, key, k, seed))
    rows = []
    for fold in range(k):
        train, rest = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        size = min(most, 2 * patience)
        while True:
            losses = fit_classifier(train, label, n_classes, size, seed=seed).losses(rest, label)
            best, done = stopped(losses, patience)
            if done or size == most:
                break
            size = min(most, 2 * size)
        seen = min(len(losses), best + patience)
        rows += [(fold, i + 1, loss, i + 1 == best) for i, loss in enumerate(losses[:seen])]
    table = df.sparkSession.createDataFrame(rows, "fold int, trees int, loss double, chosen boolean")
    return table, median_iterations(table.where("chosen"), "trees").first()[0]


def fit_and_test(df: DataFrame, test: DataFrame, label: str, key: str, n_classes: int, most: int, patience: int = 5, k: int = 5, seed: int = 42):
    """(model, predictions): the size that folds of ``df`` select, fitted on all of ``df``, and ``test`` as it predicts it."""
    _, trees = select_by_folds(df, label, key, n_classes, most, patience, k, seed)
    model = fit_classifier(df, label, n_classes, trees, seed=seed)
    return model, predict(test, model)


def median_iterations(df: DataFrame, column: str) -> DataFrame:
    """One row: the median, without its fraction."""
    return df.agg(F.median(column).cast("int").alias("iterations"))


def importance_table(df: DataFrame) -> DataFrame:
    """Rows (name, importance) with ``rank``, the largest first; equal ones share a rank."""
    # a row for each feature of a model: few enough to rank in one place
    rank = F.rank().over(Window.orderBy(F.desc("importance")))
    return df.withColumn("rank", rank).orderBy("rank", "name")


def feature_importance(spark, model: Boosted, prefix: str = "emb_") -> DataFrame:
    rows = [(f"{prefix}{i}", float(v)) for i, v in enumerate(model.importances)]
    return importance_table(spark.createDataFrame(rows, "name string, importance double"))
