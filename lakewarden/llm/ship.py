"""Make this package importable in Python workers."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

import lakewarden

_shipped: set[str] = set()


#: Texts that go to a worker together: each batch is in memory there, and beside it in the executor.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Limit the batches between executors and workers for this session, unless it has lower limits.
    The defaults, made for short rows, would hold thousands of whole texts at once."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(key).lower()).groups()
        now = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once per application, as ``--py-files`` would."""
    small_batches(spark)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return spark
    top = os.path.dirname(os.path.abspath(lakewarden.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "lakewarden.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
    return spark
