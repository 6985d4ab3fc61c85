"""Sends the package to the Python workers, so that Arrow kernels can be imported wherever a task runs."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds this package as a zip to the session's Python files, once per application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    top = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="strandforge-")) / f"{top.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(path))
    _sent.add(app)
