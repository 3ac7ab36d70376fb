"""The package on the executors, for the few functions that run there in Python."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python may not have it on its path; once for each application."""
    if spark.sparkContext.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="spark-package-")) / "barloom_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted((root / "barloom").rglob("*.py")):
            z.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _SENT.add(spark.sparkContext.applicationId)
