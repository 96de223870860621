"""All queries of the engine's own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classes, splits
from . import geo_queries, model_queries, source_queries, table_queries  # noqa: F401  they register their queries
from .fixtures import Tables
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (split, finetune_class, n, weight): class counts of each split, and the log weights of
    the classes over all splits.
    """
    rows = classes.drop_marked(table_queries.samples(Tables(spark, sf_dir)))
    rows = rows.withColumn("split", splits.random_split(F.col("sample_id")))
    weights = splits.class_weights(rows, "finetune_class", "log", (0.2, 10.0), normalize=False)
    counts = rows.groupBy("split", "finetune_class").agg(F.count("*").alias("n"))
    return counts.join(weights.drop("n"), "finetune_class").select("split", "finetune_class", "n", "weight")
