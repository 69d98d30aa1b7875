"""Make this package importable for the Python workers of a session."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

from indicator_lake.llm.memory import BATCH_BYTES

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once per application (as ``--py-files`` would), and bound its Arrow batches."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if context.applicationId not in _SENT:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="package-")  # read by the driver alone; Spark copies the file to executors
        name = os.path.join(folder, "indicator_lake")
        context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        _SENT.add(context.applicationId)
    return spark
