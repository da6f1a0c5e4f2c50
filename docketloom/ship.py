"""The package on every executor, wherever the driver found it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors once for each context; Spark serves the archive from the driver."""
    context = spark.sparkContext
    if getattr(context, "_docketloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="docketloom-"), "docketloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for module in sorted(root.rglob("*.py")):
            z.write(module, module.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._docketloom_shipped = True
