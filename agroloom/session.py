"""What a session needs before its first query."""

from __future__ import annotations

import tempfile
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).parent


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that their Python can import it."""
    context = spark.sparkContext
    if getattr(context, "_agroloom_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="agroloom-")) / f"{_PACKAGE.name}.zip"
    with ZipFile(archive, "w") as out:
        for path in sorted(_PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    context._agroloom_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a session of this machine alone may leave it unset: on a cluster, a folder of the driver's
    would lose what executors write.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = "/tmp/checkpoints"
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, so that lost executors cost no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()
