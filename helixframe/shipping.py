"""The package's own code on the executors: zipped once a session and given to Spark, so that workers need no path of ours."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Add this package to the files that Spark gives every Python worker; later calls of a session do nothing."""
    context = spark.sparkContext
    if getattr(context, "_helixframe_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if not root.is_dir():  # imported from a zip: it was shipped before
        return
    path = os.path.join(tempfile.mkdtemp(prefix="helixframe-"), "helixframe_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"helixframe/{f.relative_to(root)}")
    context.addPyFile(path)
    context._helixframe_shipped = True
