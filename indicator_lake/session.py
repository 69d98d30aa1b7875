"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE supplies run-time broadcast decisions (checked against
# the real size of a side), partition coalescing and the splitting of skewed join keys.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM interprets methods of more than 8000 bytes for ever: a stage fused into such a one runs operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Settings that only a new session can take. Call sites of column expressions are not recorded:
# recording them takes longer than building the expressions.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
# The work of one task: stored bytes read, and shuffled bytes after AQE merged small partitions. Rows weigh many times
# that in a sort, and a stage holds several sorts, so Spark's own sizes (128 and 64 MB) would fill an executor.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}
# An exchange has one partition for so much input: few rows of it are shuffled as more than twice their stored size.
INPUT_BYTES_PER_PARTITION = 4 << 20


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Keep the work of a task the same while the input grows: larger input means more tasks, not larger ones.

    Smaller task sizes and larger partition numbers that the session has already are kept.
    """
    parse = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, size in TASK_BYTES.items():
        spark.conf.set(key, f"{min(size, parse(spark.conf.get(key)))}b")
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pieces(input_bytes, INPUT_BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(number))


def pieces(size: int, each: int, least: int = 1) -> int:
    """How many pieces of ``each`` hold ``size``."""
    return max(least, math.ceil(size / each))


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL settings on an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "indicator-lake", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; cluster sizing is left to the submitter."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, empty folder path for one run under the folder named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only when that setting is absent and Spark runs
    in local mode; on a cluster the other executors could not see it, so it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
