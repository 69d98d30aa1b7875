"""Audit tables: one row per loaded table and one per quality check."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LOGGER = logging.getLogger(__name__)

# Column names and types of the two audit tables.
RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("pipeline", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("destination_table", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)
CHECK_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("violations", T.LongType(), False),
        T.StructField("max_violations", T.LongType(), False),
        T.StructField("executed_at", T.TimestampType(), False),
        T.StructField("error_message", T.StringType()),
    ]
)


def error_text(error: BaseException) -> str:
    return str(error)


def run_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[f.name] for f in RUN_SCHEMA) for r in rows], RUN_SCHEMA)


def check_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[f.name] for f in CHECK_SCHEMA) for r in rows], CHECK_SCHEMA)


def append_audit(rows: DataFrame, path: str, stamp: str) -> None:
    """Append audit rows, partitioned by the day of ``stamp``."""
    day = f"{stamp}_day"
    rows.withColumn(day, F.to_date(stamp)).coalesce(1).write.mode("append").partitionBy(day).parquet(path)


def try_append_audit(rows: DataFrame, path: str, stamp: str) -> None:
    """As ``append_audit``, but a failure is only a warning: it must not stop the load."""
    try:
        append_audit(rows, path, stamp)
    except Exception as exc:  # noqa: BLE001
        LOGGER.warning("audit rows were not stored: %s", exc)
