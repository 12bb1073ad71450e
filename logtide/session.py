"""Sessions that can run this package on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch: a Python worker holds a few batches and their temporaries, whatever the rows' size.
BATCH_BYTES = 2 << 20
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's source to the executors, once for each application, so that Python code there can import it.

    Arrow batches are bounded to BATCH_BYTES, unless the session has been given a bound of its own.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("64MB", str(64 << 20), f"{64 << 20}b"):
        spark.conf.set(name, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(), "logtide.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("logtide", os.path.relpath(full, root)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark
