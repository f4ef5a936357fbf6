"""Makes the package importable on executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's modules to the executors, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_folio_shipped", False):
        return spark
    target = Path(tempfile.mkdtemp(prefix="folio-modules-")) / "folioframe_modules.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(PACKAGE.parent))
    context.addPyFile(str(target))
    context._folio_shipped = True
    return spark
