"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors. Only workers of a local master have the driver's own path."""
    known = [*os.environ.get("PYTHONPATH", "").split(":"), os.getcwd()] if re.match(r"local(\[|$)", spark.conf.get("spark.master", "")) else []
    if str(ROOT) not in known and not getattr(spark.sparkContext, "_recordmill_shipped", False):
        path = Path(tempfile.mkdtemp(prefix="recordmill-")) / "recordmill.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted((ROOT / "recordmill").rglob("*.py")):
                z.write(f, f.relative_to(ROOT))
        spark.sparkContext.addPyFile(str(path))
        spark.sparkContext._recordmill_shipped = True
    return spark
