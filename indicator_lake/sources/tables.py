"""Parquet tables: versions that are replaced whole, snapshots by run, clustered writes, run exports."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from indicator_lake.operators.picks import INGESTED_AT, RUN_ID, latest_run
from indicator_lake.sources import commits
from indicator_lake.sources.clustering import interleaved

INGESTION_DATE = "ingestion_date"
# A missing folder, or one that a failed first write left without data files.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """A table, or None where there is none yet."""
    try:
        return read_table(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() in _ABSENT:
            return None
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The live version of a table, or a plain folder where nothing was ever committed.

    The schema of a version is the committed one, so no file is opened to find it. Run ids in partition folders
    stay text ('007' does not become 7).
    """
    state = commits.live(spark, path)
    if state is not None:
        return _read_folders(spark, path, list(state.folders), state.schema)
    return _with_text_run_ids(spark, path, lambda reader: reader.parquet(path))


def _read_folders(spark: SparkSession, path: str, folders: Sequence[str], schema: str) -> DataFrame:
    kept = T.StructType.fromJson(json.loads(schema))
    return spark.read.schema(kept).parquet(*[f"{path}/{folder}" for folder in folders])


def _with_text_run_ids(spark: SparkSession, path: str, read) -> DataFrame:
    """The folders are listed once, and again only where Spark took run ids for something else."""
    table = read(spark.read.option("basePath", path))
    text = {RUN_ID, "run_id"}
    fields = [T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in table.schema]
    if fields == table.schema.fields:
        return table
    return read(spark.read.option("basePath", path).schema(T.StructType(fields)))


@dataclass(frozen=True)
class Staged:
    """A written version that nobody reads yet."""

    spark: SparkSession
    path: str
    folder: str
    schema: str
    rows: int
    measured: Mapping[str, int] = field(default_factory=dict)
    partition_by: Sequence[str] = ()

    def read(self) -> DataFrame:
        return _read_folders(self.spark, self.path, [self.folder], self.schema)

    def publish(self, extra: Mapping | None = None) -> DataFrame:
        """Make this the live version: one small file moves the table from the old rows to the new ones.

        ``extra`` is kept with the commit.
        """
        entry, kept = {self.folder: {"rows": self.rows, "partition_by": list(self.partition_by)}}, dict(extra or {})
        commits.commit(self.spark, self.path, lambda last: commits.Commit(last.number, entry, self.schema, extra=kept))
        commits.remove_old(self.spark, self.path)
        return read_table(self.spark, self.path)


def stage(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    max_rows_per_file: int = 5_000_000,
    measures: Mapping[str, Column] | None = None,
    look_up: Sequence[str] = (),
    interleave: bool = False,
) -> Staged:
    """Write a new version of a table beside the live one, sorted so that min/max statistics prune on ``cluster_by``.

    Ranges are cut on partition + cluster columns and then on a hash of the row, so that rows sharing one hot value
    still spread over several tasks and files. Rows and ``measures`` (aggregates) are counted while they are written.
    With ``interleave`` the cluster columns count alike (one more pass finds their quantiles), so a filter on any of
    them prunes, not only one on the first. Columns in ``look_up`` get Bloom filters, by which a scan for one of their
    values skips row groups whose min and max enclose it.
    """
    folder, order = commits.new_folder(), [*partition_by, *[c for c in cluster_by if c not in partition_by]]
    fields = [*[f for f in df.schema if f.name not in partition_by], *[df.schema[c] for c in partition_by]]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields]).json()
    if order:
        if interleave and len(order) - len(partition_by) > 1:
            order = [*partition_by, interleaved(df, order[len(partition_by) :])]
        df = df.repartitionByRange(*order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    names = {f"_measure_{i}": name for i, name in enumerate(measures or {})}
    counted = [measures[name].alias(key) for key, name in names.items()]
    seen = Observation()
    # observed above the exchange: the job that finds the ranges runs what lies below it once more
    writer = df.observe(seen, F.count(F.lit(1)).alias("_rows"), *counted).write
    writer = writer.option("maxRecordsPerFile", max_rows_per_file).option("compression", "snappy")
    for name in look_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    if look_up:  # sized by the distinct values of each row group
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{folder}")
    found = seen.get
    return Staged(df.sparkSession, path, folder, schema, found["_rows"], {n: found[k] for k, n in names.items()}, partition_by)


def live_location(spark: SparkSession, path: str) -> tuple[str, T.StructType, list[str]]:
    """Folder, schema and partition columns of the live version of a table that ``stage`` wrote."""
    state = commits.live(spark, path)
    if state is None or len(state.folders) != 1:
        raise ValueError(f"{path} is no table of one live folder")
    folder = next(iter(state.folders))
    return f"{path}/{folder}", T.StructType.fromJson(json.loads(state.schema)), state.folders[folder].get("partition_by", [])


def replace_table(df: DataFrame, path: str) -> int:
    """Full-replace copy of a table, seen by readers whole or not at all; returns its rows."""
    staged = stage(df, path)
    staged.publish()
    return staged.rows


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    max_rows_per_file: int = 5_000_000,
) -> None:
    """Replace a table by one sorted and partitioned as ``stage`` does it."""
    stage(df, path, cluster_by, partition_by, max_rows_per_file).publish()


@dataclass(frozen=True)
class Snapshots:
    """A table of runs, each under ``ingestion_date / run id``, whose committed runs are told by their marks."""

    spark: SparkSession
    path: str

    def runs(self) -> DataFrame:
        """(run_id, stamp, day, rows) of the committed runs."""
        rows = [(r.run_id, r.stamp, r.day, r.rows) for r in commits.runs(self.spark, self.path)]
        return self.spark.createDataFrame(rows, "run_id string, stamp string, day string, rows long")

    def read(self) -> DataFrame:
        """All committed runs; a run without a mark (its writer failed) does not count."""
        table = read_table(self.spark, self.path)
        known = [r.run_id for r in commits.runs(self.spark, self.path)]
        return table.where(F.col(RUN_ID).isin(known)) if known else table

    def latest(self) -> DataFrame:
        """The newest run, read from its own folder: no other run is listed, and no row asked for its stamp.

        A table without marks is asked for its newest stamp instead.
        """
        known = commits.runs(self.spark, self.path)
        if not known:
            return latest_run(read_table(self.spark, self.path))
        run = known[-1]
        folder = f"{self.path}/{INGESTION_DATE}={run.day}/{RUN_ID}={commits.partition_value(run.run_id)}"
        return _with_text_run_ids(self.spark, self.path, lambda reader: reader.parquet(folder))


def export_run(table: DataFrame, run_id: str, path: str) -> None:
    """Write one run to ``path/ingestion_date=<day>/run_id=<id>`` (Snappy Parquet).

    The day is the one the table stores the run under, else that of its load time. Only that
    run's folders are replaced, so repeating an export changes nothing.
    """
    day = F.col(INGESTION_DATE) if INGESTION_DATE in table.columns else F.to_date(INGESTED_AT)
    (
        table.where(F.col(RUN_ID) == F.lit(run_id))
        .withColumns({INGESTION_DATE: day, "run_id": F.col(RUN_ID)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(INGESTION_DATE, "run_id")
        .parquet(path)
    )
