"""Confusion matrices, reports and summary figures from predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import argmax, index_class, masked_from, sigmoid, softmax
from ..functions.bands import NODATA


def confusion_matrix(df: DataFrame, true: str, pred: str, labels: list[str] | None = None, by: list[str] = ()) -> DataFrame:
    """Rows (true_class, pred_class, n) for all pairs of labels; by default the labels that occur.

    ``by`` names columns that each have a matrix for each of their values.
    """
    counts = df.groupBy(*by, F.col(true).alias("true_class"), F.col(pred).alias("pred_class")).agg(F.count("*").alias("n"))
    # classes are few by nature: a row for each group holds their list
    if labels is None:
        both = F.array_distinct(F.flatten(F.collect_set(F.array("true_class", "pred_class"))))
        names = counts.groupBy(*by).agg(both.alias("c"))
    else:
        names = counts.groupBy(*by).agg(F.array(*map(F.lit, labels)).alias("c"))
    grid = names.select(*by, F.explode("c").alias("true_class"), "c").select(*by, "true_class", F.explode("c").alias("pred_class"))
    return grid.join(counts, [*by, "true_class", "pred_class"], "left").select(
        *by, "true_class", "pred_class", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def normalised(matrix: DataFrame) -> DataFrame:
    """``matrix`` with each cell's share of its true class; 0 in an empty row."""
    total = F.sum("n").over(Window.partitionBy("true_class"))
    return matrix.withColumn("share", F.when(total > 0, F.col("n") / total).otherwise(0.0))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def class_figures(matrix: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows (class, precision, recall, f1, support, hits) from a confusion matrix."""
    hit = F.when(F.col("true_class") == F.col("pred_class"), F.col("n")).otherwise(0)
    by_true = matrix.groupBy(*by, F.col("true_class").alias("class")).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    by_pred = matrix.groupBy(*by, F.col("pred_class").alias("class")).agg(F.sum("n").alias("predicted"))
    rows = by_true.join(by_pred, [*by, "class"])
    precision, recall = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("hits"), F.col("support"))
    rows = rows.withColumns({"precision": precision, "recall": recall})
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rows.select(*by, "class", "precision", "recall", f1.alias("f1"), F.col("support").cast("double"), "hits")


def classification_report(matrix: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows (class, precision, recall, f1, support): each class, then accuracy and two averages.

    The accuracy stands in all four columns of its row. ``by`` as in :func:`confusion_matrix`.
    """
    figures = class_figures(matrix, by)
    names = ["precision", "recall", "f1"]
    support = F.sum("support")
    accuracy = _ratio(F.sum("hits").cast("double"), support)
    total = figures.groupBy(*by).agg(
        accuracy.alias("accuracy"), support.alias("support"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[_ratio(F.sum(F.col(c) * F.col("support")), support).alias(f"weighted_{c}") for c in names],
    )
    rows = F.array(
        F.struct(F.lit("accuracy").alias("class"), *[F.col("accuracy").alias(c) for c in [*names, "support"]]),
        *[
            F.struct(F.lit(f"{kind} avg").alias("class"), *[F.col(f"{kind}_{c}").alias(c) for c in names], F.col("support"))
            for kind in ("macro", "weighted")
        ],
    )
    summary = total.select(*by, F.inline(rows))
    return figures.drop("hits").unionByName(summary)


def summary_metrics(matrix: DataFrame, positive: str | None = None) -> DataFrame:
    """One row (OA, F1, precision, recall), to three decimals: of the positive class, else the mean."""
    figures = class_figures(matrix)
    chosen = F.lit(True) if positive is None else F.col("class") == positive
    return figures.agg(
        F.bround(_ratio(F.sum("hits").cast("double"), F.sum("support")), 3).alias("OA"),
        *[
            F.bround(F.avg(F.when(chosen, F.col(c))), 3).alias(name)
            for name, c in (("F1", "f1"), ("precision", "precision"), ("recall", "recall"))
        ],
    )


def multiclass_predictions(df: DataFrame, logits: str, classes: list[str]) -> DataFrame:
    """``df`` with ``y_pred`` and ``prob`` by softmax; of equal scores the first class."""
    rows = df.withColumn("__p", softmax(F.col(logits)))
    return rows.withColumns(
        {"y_pred": index_class(argmax(F.col("__p")), classes), "prob": F.array_max("__p")}
    ).drop("__p")


def binary_predictions(df: DataFrame, logit: str, classes: list[str], threshold: float = 0.5) -> DataFrame:
    """``df`` with ``y_pred`` and ``prob`` by a sigmoid."""
    rows = df.withColumn("prob", sigmoid(F.col(logit)))
    index = (F.col("prob") > threshold).cast("int")
    return rows.withColumn("y_pred", index_class(index, classes))


def valid_timesteps(df: DataFrame, true: str, pred: str) -> DataFrame:
    """A row for each timestep of two label vectors that has a true label."""
    pairs = F.explode(F.arrays_zip(F.col(true).alias("t"), F.col(pred).alias("p"))).alias("x")
    rows = df.select("*", pairs)
    return rows.select(*[c for c in df.columns if c not in (true, pred)], F.col("x.t").alias(true), F.col("x.p").alias(pred)).where(
        F.col(true).isNotNull() & (F.col(true) != NODATA)
    )


def masked_reports(df: DataFrame, series: str, true: str, positions: list[int], predict) -> DataFrame:
    """A report for each position from which the series is masked, tagged with the position.

    ``predict`` maps a table and the series' name to the table with ``y_pred``. The positions are
    exploded beside each row, so the table is read once.
    """
    rows = df.withColumn("masked_from", F.explode(F.array(*map(F.lit, positions))))
    masked = predict(rows.withColumn(series, masked_from(F.col(series), F.col("masked_from"))), series)
    return classification_report(confusion_matrix(masked, true, "y_pred", by=["masked_from"]), ["masked_from"])
