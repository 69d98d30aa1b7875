"""Pick one row per key: latest run, keep-latest and nearest target."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window as W, functions as F

RUN_ID = "_ingestion_run_id"
INGESTED_AT = "_ingested_at"


class RunTable(Protocol):
    """A table that knows its newest run."""

    def latest(self) -> DataFrame: ...


def latest_run(source: DataFrame | RunTable, run_id: str = RUN_ID, stamp: str = INGESTED_AT) -> DataFrame:
    """Rows of the most recent run.

    A table that keeps marks of its runs names the newest one, and only that run's folder is read. Rows alone are
    asked by a scalar subquery, which finishes first and reads two columns; on a table partitioned by run id its
    value prunes the scan to the partitions of that run. Runs with equal stamps tie-break on the run id.
    """
    if not isinstance(source, DataFrame):
        return source.latest()
    # one row per run first: a maximum of stamps is counted in a hash table, that of text or structures row by row
    stamps = source.groupBy(run_id).agg(F.max(stamp).alias(stamp))
    newest = stamps.select(F.max_by(run_id, F.struct(stamp, run_id))).scalar()
    return source.where(F.col(run_id) == newest)


def _texts_first(df: DataFrame, keys: Sequence[str | Column]) -> list[str | Column]:
    """Keys with the texts in front: a sort compares the first key by eight bytes and only ties by whole rows.

    Text keys are identifiers, numbers are years that most rows share.
    """
    kinds = dict(df.dtypes)
    return sorted(keys, key=lambda key: not (isinstance(key, str) and kinds.get(key) == "string"))


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    The ``= 1`` filter lets Spark keep one row per key in every map task before the shuffle, so
    a key that holds a third of all rows sends at most one row per task.
    """
    window = W.partitionBy(*_texts_first(df, keys)).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def keep_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str] = (INGESTED_AT,)) -> DataFrame:
    """One row per key, newest first; ties fall to the smallest remaining columns in order."""
    rest = [name for name in df.columns if name not in keys and name not in newest_first]
    order = [F.col(name).desc() for name in newest_first] + [F.col(name).asc() for name in rest]
    return first_per_key(df, keys, order)
