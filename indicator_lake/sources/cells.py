"""Tables of cells: a refresh rewrites the cells it touches and leaves the others where they are.

Every row belongs to a cell (a short text made from its columns). Each cell is a folder, and a commit names the live
folder of each: replacing some cells is one commit, like replacing a whole table.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from indicator_lake.sources import commits

CELL = "cell"


def read_cells(spark: SparkSession, path: str, cells: Collection[str] | None = None) -> DataFrame | None:
    """The rows of the given cells (of all without ``cells``); only their folders are listed. None before any commit."""
    state = commits.live(spark, path)
    if state is None:
        return None
    schema = T.StructType.fromJson(json.loads(state.schema))
    folders = [f for f, entry in state.folders.items() if cells is None or entry[CELL] in cells]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}" for folder in folders])


def replace_cells(
    rows: DataFrame,
    path: str,
    cell: Column,
    touched: Collection[str] | None = None,
    extra: Mapping | None = None,
    kept: DataFrame | None = None,
) -> None:
    """Put ``rows`` and ``kept`` in place of the touched cells (of the whole table without ``touched``).

    ``kept`` holds those rows of the touched cells that stay: they lie by cell already and are not shuffled.
    Touched cells without rows vanish. ``extra`` is kept with the commit. If another writer committed since the
    rows were computed, the change is refused: it may rest on rows that are gone.
    """
    spark = rows.sparkSession
    before = commits.live(spark, path)
    folder, schema = commits.new_folder(), T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]).json()
    dealt = rows.withColumn(CELL, F.coalesce(cell, F.lit("none")))
    # AQE splits a large cell and merges small ones by size, so that neither a hot cell nor a grown one is one task
    dealt = dealt.hint("rebalance", CELL)
    if kept is not None:
        dealt = dealt.unionByName(kept.withColumn(CELL, F.coalesce(cell, F.lit("none"))))
    dealt.write.option("compression", "snappy").partitionBy(CELL).parquet(f"{path}/{folder}")
    prefix = f"{CELL}="
    written = [n for n in commits.Files(spark, path).names(folder) if n.startswith(prefix)]
    entries = {f"{folder}/{n}": {CELL: n.removeprefix(prefix)} for n in written}

    def change(last: commits.Commit) -> commits.Commit:
        if last.number != (before.number if before else 0):
            raise commits.CommitConflict(f"{path} was changed meanwhile")
        kept = {} if touched is None else {f: e for f, e in last.folders.items() if e[CELL] not in touched}
        return commits.Commit(last.number, {**kept, **entries}, schema, extra=dict(extra or {}))

    commits.commit(spark, path, change)
    commits.remove_old(spark, path)


def cells_of(rows: DataFrame, cell: Column) -> set[str]:
    """The cells that rows fall in; cells are few (days, or years times buckets)."""
    return {r[0] for r in rows.select(F.coalesce(cell, F.lit("none"))).distinct().collect()}


def matching(rows: DataFrame, keys: DataFrame, on: Mapping[str, str], how: str = "left_semi") -> DataFrame:
    """Rows with (``left_semi``) or without (``left_anti``) a key; ``on`` maps row columns to key columns, NULL equals NULL."""
    side = keys.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(on.values())])
    same = [rows[c].eqNullSafe(side[f"_key_{i}"]) for i, c in enumerate(on)]
    return rows.join(side, same, how)


def changed_keys(old: DataFrame | None, new: DataFrame, keys: Collection[str], ignore: Collection[str] = ()) -> DataFrame:
    """Keys whose rows differ between two versions; rows travel as key and hash, added up before the shuffle.

    The halves of the hashes are added apart: 64-bit sums of them cannot overflow below two billion rows of a key.
    """
    columns = [c for c in new.columns if c not in ignore]

    def signed(df: DataFrame, sign: int) -> DataFrame:
        coded = df.select(*keys, F.xxhash64(*[F.col(c) for c in columns]).alias("_hash"))
        high, low = F.shiftright("_hash", 32), F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))
        return coded.select(*keys, (high * sign).alias("_high"), (low * sign).alias("_low"), F.lit(sign).alias("_sign"))

    both = signed(new, 1) if old is None else signed(new, 1).unionByName(signed(old, -1))
    sums = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("_high", "_low", "_sign")])
    return sums.where("_high <> 0 or _low <> 0 or _sign <> 0").select(*keys)
