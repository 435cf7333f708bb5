"""Sends this package to the executors, whose Python need not have it on its path."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a batch sent to Python, unless the session says otherwise.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Once per application; Spark hands the archive to executors that join later, too.  Also makes
    the batches sent to Python smaller, unless the session has a number of its own."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    # Batches are counted in rows, and rows hold texts: Spark's own number may mean hundreds of MB.
    if int(spark.conf.get(_BATCH_ROWS, "10000")) == 10_000:
        spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix=f"{package.name}-")  # only the driver reads it, as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(name, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, str(file.relative_to(package.parent)))
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)
