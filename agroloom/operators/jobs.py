"""Job tables of a tile grid, and facts about their products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import image_date
from .tables import in_random_order, keep_columns

FAILED = ("error", "start_failed")
NOT_STARTED = "not_started"


def reset_failed(jobs: DataFrame) -> DataFrame:
    status = F.when(F.col("status").isin(*FAILED), NOT_STARTED).otherwise(F.col("status"))
    return jobs.withColumn("status", status)


def build_job_table(
    grid: DataFrame, columns: list[str], start: str, end: str, shuffle: bool = False, seed: int = 42, renamed: dict[str, str] | None = None
) -> DataFrame:
    """A row for each tile: the columns, which must exist, some under new names, and the job's dates."""
    dates = {name: F.to_date(F.lit(day)) for name, day in (("start_date", start), ("end_date", end))}
    jobs = keep_columns(grid, columns).withColumnsRenamed(renamed or {}).withColumns(dates)
    return in_random_order(jobs, "tile_name", seed) if shuffle else jobs


def select_tiles(grid: DataFrame, names: list[str]) -> DataFrame:
    return grid.where(F.col("tile_name").isin(names))


def latest_images(links: DataFrame, key: str, link_json: str) -> DataFrame:
    """Rows (key, latest_image): the latest date among the images that a key's links name."""
    title = F.get_json_object(F.col(link_json), "$.title")
    dated = links.select(key, image_date(title).alias("__d"))
    return dated.groupBy(key).agg(F.max("__d").alias("latest_image"))
