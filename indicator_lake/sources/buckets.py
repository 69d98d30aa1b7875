"""Catalog tables whose files are cut by a hash of their keys, so that joins and windows on those keys need no exchange.

A bucket is one read task, and its rows cannot be split by AQE, as there is no exchange to split. The rows of the
buckets are therefore counted: a table with a bucket far above the mean (a hot key) is served without its buckets,
and joins on it shuffle and split that key as they would without them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from indicator_lake.sources import commits

#: A bucket is hot when it holds more rows than this and more than ``HOT_FACTOR`` times the mean.
HOT_ROWS, HOT_FACTOR = 5_000_000, 5.0


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Buckets:
    """Where the rows of a table lie: bucket = hash of ``keys`` modulo ``number``."""

    keys: tuple[str, ...]
    number: int
    largest: int
    rows: int

    def hot(self, rows: int = HOT_ROWS, factor: float = HOT_FACTOR) -> bool:
        return self.largest > rows and self.largest > factor * self.rows / self.number


def bucket_of(keys: Sequence[str], number: int):
    """The bucket Spark puts a row in."""
    return F.pmod(F.hash(*keys), F.lit(number))


def write_bucketed(
    df: DataFrame, database: str, name: str, path: str, keys: Sequence[str], number: int, writers: int = 4
) -> Buckets:
    """Replace the table at ``path`` by a version in ``number`` buckets of ``keys``, sorted by them, and name it.

    Each bucket is written by up to ``writers`` tasks, so a hot key is not written by one. Readers of ``path`` see
    the old rows until the version is committed, readers of ``database.name`` until the name is moved after that.
    An empty table has no bucket files and reads as empty.
    """
    if number < 1 or writers < 1:
        raise ValueError("number of buckets and of writers must be at least 1")
    missing = [key for key in keys if key not in df.columns]
    if missing or not keys:
        raise ValueError(f"bucket keys must be columns of the table: {', '.join(missing) or 'none given'}")
    spark, folder = df.sparkSession, commits.new_folder()
    draft = f"{quoted(database)}.{quoted(f'{name}_{folder}'.replace('-', '_').replace('=', '_'))}"
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(writers))
    placed = df.repartition(number * writers, bucket_of(keys, number), salt)
    writer = placed.write.format("parquet").option("path", f"{path}/{folder}").bucketBy(number, *keys).sortBy(*keys)
    writer.saveAsTable(draft)
    spark.sql(f"DROP TABLE {draft}")  # the files stay: the table was an external one
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    written = spark.read.schema(schema).parquet(f"{path}/{folder}").groupBy(bucket_of(keys, number).alias("bucket")).count()
    largest, rows = written.agg(F.max("count"), F.sum("count")).first()
    found = Buckets(tuple(keys), number, largest or 0, rows or 0)
    entry = {folder: {"rows": found.rows, "partition_by": []}}
    commits.commit(
        spark, path, lambda last: commits.Commit(last.number, entry, schema.json(), extra={"buckets": found.__dict__})
    )
    commits.remove_old(spark, path)
    serve_bucketed(spark, database, name, path)
    return found


def stored_buckets(spark: SparkSession, path: str) -> Buckets | None:
    """The buckets of the live version, or None where it has none."""
    state = commits.live(spark, path)
    kept = state.extra.get("buckets") if state else None
    return Buckets(tuple(kept["keys"]), kept["number"], kept["largest"], kept["rows"]) if kept else None


def serve_bucketed(
    spark: SparkSession, database: str, name: str, path: str, hot_rows: int = HOT_ROWS, hot_factor: float = HOT_FACTOR
) -> bool:
    """Point ``database.name`` at the live version of a bucketed table; whether its buckets are used."""
    state, found = commits.live(spark, path), stored_buckets(spark, path)
    if state is None or found is None:
        raise ValueError(f"{path} was not written in buckets")
    used = not found.hot(hot_rows, hot_factor)
    schema = T.StructType.fromJson(json.loads(state.schema))
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    layout = ""
    if used:
        names = ", ".join(map(quoted, found.keys))
        layout = f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {found.number} BUCKETS"
    full = f"{quoted(database)}.{quoted(name)}"
    location = f"{path}/{next(iter(state.folders))}".replace("'", "\\'")
    wanted = json.dumps([columns, layout])
    if spark.catalog.tableExists(full):
        kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
        if kept.get("lake.layout") == wanted:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{location}'")
            spark.catalog.refreshTable(full)
            return used
        spark.sql(f"DROP TABLE {full}")
    note = wanted.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet {layout} LOCATION '{location}' TBLPROPERTIES ('lake.layout' = '{note}')")
    return used
