"""Joins of results with targets and territory.

No join carries a broadcast hint: Spark broadcasts a side only after checking its size against
``spark.sql.autoBroadcastJoinThreshold`` (at plan time or, with AQE, at run time) and otherwise
uses a shuffled join whose skewed keys AQE splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from indicator_lake.operators.picks import first_per_key


def left_lookup(
    rows: DataFrame, lookup: DataFrame, on: Mapping[str, str], take: Sequence[str]
) -> DataFrame:
    """LEFT join that adds ``take`` of ``lookup``; ``on`` maps row columns to lookup columns.

    Rows without a match stay with NULLs, rows with several matches repeat.
    """
    keys = {right: f"_key_{i}" for i, right in enumerate(on.values())}
    side = lookup.select(*[F.col(r).alias(k) for r, k in keys.items()], *take)
    condition = [F.col(left) == F.col(keys[right]) for left, right in on.items()]
    return rows.join(side, condition, "left").drop(*keys.values())


def with_targets(results: DataFrame, targets: DataFrame, on: Mapping[str, str], take: Sequence[str]) -> DataFrame:
    """Every result with each of its target years (1:N)."""
    return left_lookup(results, targets, on, take)


def with_territory(rows: DataFrame, directory: DataFrame, take: Sequence[str]) -> DataFrame:
    return left_lookup(rows, directory, {"id_municipio": "id_municipio"}, take)


def target_of_year(targets: DataFrame, keys: Sequence[str] = ("ano_meta", "id_municipio", "rede")) -> DataFrame:
    """One target per target year and key: the one published with the latest result year."""
    rest = [c for c in targets.columns if c not in keys and c != "ano_resultado"]
    order = [F.col("ano_resultado").desc(), *[F.col(c).asc() for c in rest]]
    return first_per_key(targets, keys, order)


def orphans(rows: DataFrame, parents: DataFrame, key: str = "id_municipio") -> DataFrame:
    """Rows whose key has no parent (a NULL key has none either)."""
    return rows.join(parents.select(key), key, "left_anti")


def mismatches(rows: DataFrame, directory: DataFrame, key: str, column: str, left: str, right: str) -> DataFrame:
    """Matched rows whose ``column`` differs from the directory; NULL on either side is no mismatch."""
    side = directory.select(F.col(key), F.col(column).alias(right))
    return rows.withColumnRenamed(column, left).join(side, key).where(F.col(left) != F.col(right))
