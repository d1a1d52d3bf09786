"""Preparing a session: the package on executors, and the size of Arrow batches."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Texts differ much in length, so batches to Python are bounded by bytes and by few rows: a task
#: holds several copies of a batch.  Settings that the user has changed stay as they are.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m")}


def ship(spark: SparkSession) -> None:
    """Bound Arrow batches, and send this package to the executors once for each Spark context."""
    for key, (default, ours) in ARROW.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, ours)
    sc = spark.sparkContext
    if getattr(sc, "_lectern_shipped", False):
        return
    package = Path(__file__).resolve().parent
    into = Path(tempfile.mkdtemp()) / "lectern"
    shutil.copytree(package, into / "lectern", ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(into), "zip", into))
    sc._lectern_shipped = True
