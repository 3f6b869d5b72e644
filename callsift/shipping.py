"""Make the package importable in Python workers, wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to the executors, once per application.

    The archive is built on the driver; Spark's file server brings it to the workers.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
