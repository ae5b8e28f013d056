"""The package for the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once a session, so that tasks find it
    wherever the session was started from."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="reachmill-source-")) / "reachmill_source.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _SENT.add(context.applicationId)
