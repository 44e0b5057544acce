"""The package as a zip for the executors of a cluster on which it isn't installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Python workers import the operators' functions by name. This sends the package to them, once per session; where it is installed or on PYTHONPATH, it isn't needed."""
    here = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="rollweave-")) / "rollweave.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(to))
