"""The package for executors that do not find it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Send the package along once per application, unless PYTHONPATH already leads to it.

    Tasks load functions by name, so a worker must be able to import them. The
    zip is only handed to Spark, which serves it to every executor.
    """
    context = spark.sparkContext
    on_path = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if str(PACKAGE.parent) in on_path or getattr(context, "_vigilseries_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="vigilseries-")) / "vigilseries.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    context._vigilseries_shipped = True
