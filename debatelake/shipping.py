"""Sends the package to the executors, for clusters that have it on the driver only."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Rows and bytes of an Arrow batch, unless the session sets them: texts are long. Setting, default and value.
ARROW = (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application, and keep Arrow batches small."""
    for name, default, value in ARROW:
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, value)
    sc = spark.sparkContext
    if getattr(sc, "_debatelake_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    if (root / "debatelake").is_dir():
        target = Path(os.path.realpath(tempfile.mkdtemp())) / "debatelake.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted((root / "debatelake").rglob("*.py")):
                z.write(p, p.relative_to(root))
        sc.addPyFile(str(target))
    sc._debatelake_shipped = True
