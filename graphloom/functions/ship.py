"""Makes this package importable in Python workers, wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to all executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="graphloom-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(p for p in root.rglob("*") if p.suffix in (".py", ".yaml", ".sql")):
            z.write(path, str(path.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(archive))
    # Texts may be long: small Arrow batches keep Python workers small.
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    _shipped.add(app)
