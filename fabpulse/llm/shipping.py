"""Make this package importable in Python workers, wherever the session runs."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package's sources to the application, once; Spark hands them to executors."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = Path(tempfile.mkdtemp(prefix="fabpulse-")) / "fabpulse.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(PACKAGE.rglob("*.py")):
                out.write(source, source.relative_to(PACKAGE.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
