"""Wide targets to a long trajectory, and the union of aligned branches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# First and last target year.
TARGET_YEARS = tuple(range(2024, 2031))


def unpivot_targets(
    df: DataFrame,
    ids: Sequence[str],
    prefix: str = "meta_",
    years: Sequence[int] = TARGET_YEARS,
    year: str = "ano_meta",
    value: str = "meta_alfabetizacao",
) -> DataFrame:
    """One row per non-NULL target; the year comes from the column name."""
    wide = [f"{prefix}{y}" for y in years]
    long = df.unpivot(list(ids), wide, "_name", value).where(F.col(value).isNotNull())
    return long.withColumn(year, F.replace("_name", F.lit(prefix), F.lit("")).try_cast("bigint")).drop("_name")


def union_aligned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; columns a branch lacks become NULL with the first branch's type."""
    out = first
    for other in others:
        unknown = [c for c in other.columns if c not in first.columns]
        if unknown:
            raise ValueError(f"columns unknown to the first branch: {unknown}")
        out = out.unionByName(other, allowMissingColumns=True)
    return out
